"""Services and URLs from parsed host elements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The script that marks a TLS port, and the ports a URL leaves out.
CERT_SCRIPT = "ssl-cert"
DEFAULT_PORTS = {"http": 80, "https": 443}


def service_rows(hosts: DataFrame) -> DataFrame:
    """One row per port of each parsed host (``parse_hosts`` output).

    ``ip, proto, port, state, service, has_cert, product, servicefp, scripts``
    where ``has_cert`` tells whether the port carries an ``ssl-cert`` script.
    """
    p = hosts.select("ip", "source_file", "block_start", "row_id",
                     F.posexplode("h.ports.port").alias("pos", "p"))
    scripts = F.coalesce(F.col("p.script"), F.array().cast("array<struct<_id:string,_output:string>>"))
    return p.select(
        "ip", F.col("p._protocol").alias("proto"), F.col("p._portid").alias("port"),
        F.col("p.state._state").alias("state"), F.col("p.service._name").alias("service"),
        F.exists(scripts, lambda s: s["_id"] == CERT_SCRIPT).alias("has_cert"),
        F.col("p.service._product").alias("product"), F.col("p.service._servicefp").alias("servicefp"),
        scripts.alias("scripts"), "source_file", "block_start", "row_id", "pos")


def open_tcp(services: DataFrame) -> DataFrame:
    """F8: open TCP ports."""
    return services.where((F.col("proto") == "tcp") & (F.col("state") == "open"))


def select_services(services: DataFrame, wanted) -> DataFrame:
    """F9 + P7 scheme: keep requested services and settle http/https.

    ``http`` rows are kept when ``http`` or ``https`` is requested; an ``http``
    port with an ``ssl-cert`` script becomes ``https`` when ``https`` is
    requested, and is dropped when only ``http`` is.  Adds ``scheme``.
    """
    want = [w.strip() for w in (wanted.split(",") if isinstance(wanted, str) else wanted)]
    H, S = "http" in want, "https" in want
    svc, cert = F.col("service"), F.col("has_cert")
    keep = svc.isin(want) | ((svc == "http") & F.lit(S))
    promoted = (svc == "http") & cert
    keep = keep & ~(promoted & F.lit(not S and H))
    scheme = F.when(promoted & F.lit(S), F.lit("https")).otherwise(svc)
    return services.where(keep).withColumn("scheme", scheme)


def _port_text():
    plain = F.lit(False)
    for scheme, port in DEFAULT_PORTS.items():
        plain = plain | ((F.col("scheme") == scheme) & (F.col("port") == port))
    return F.when(plain, F.lit("")).otherwise(F.concat(F.lit(":"), F.col("port").cast("string")))


def service_urls(services: DataFrame, wanted) -> DataFrame:
    """``scheme://ip[:port]`` for open TCP ports of the requested services."""
    s = select_services(open_tcp(services), wanted)
    return s.withColumn("url", F.concat("scheme", F.lit("://"), "ip", _port_text()))


def service_urls_by_name(services: DataFrame, wanted, names: DataFrame) -> DataFrame:
    """One URL per known name of the host (``ip, domain``, as ``host_names`` gives them), or by address when it has none."""
    s = select_services(open_tcp(services), wanted)
    x = s.join(names.select("ip", F.col("domain").alias("name")), "ip", "left").withColumn("name", F.coalesce("name", "ip"))
    return x.withColumn("url", F.concat("scheme", F.lit("://"), "name", _port_text()))


def service_urls_by_domain(services: DataFrame, wanted, domains: DataFrame) -> DataFrame:
    """P8 for names in array form, ``ip, domains`` (A3).  A host missing from it counts as having none."""
    return service_urls_by_name(services, wanted, domains.select("ip", F.explode("domains").alias("domain")))
