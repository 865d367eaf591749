"""Scan-shaped views derived from the driver's tables (test and driver use only).

``obs``, ``svc``, ``res`` and ``big`` follow the formulas fixed in FIXTURES.md.
The Spark side then goes "the long way": it renders them as scanner output,
XML reports and text reports, writes those files to the shared scratch
folder, and the operators read them back.  The oracle SQL computes the same
answers straight from the formulas.

Written fixtures are cached per (data folder, fixture version) below
``spark.checkpoint.dir``; a cached copy is used only when its ``_SUCCESS``
marker exists.
"""

from __future__ import annotations

import hashlib
import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.functions.ip import ip_num
from scanlake.session import path_exists, scratch_dir
from scanlake.sources.reports import write_named_files

FIXTURE_VERSION = "5"

# The port and service lists of the fixture formula (FIXTURES.md).
PORT_LIST = [21, 22, 25, 53, 80, 110, 139, 143, 389, 443, 445, 993, 3306, 3389, 8080, 8443]
SERVICE_LIST = ["ftp", "ssh", "smtp", "domain", "http", "pop3", "netbios-ssn", "imap", "ldap",
                "http", "microsoft-ds", "imaps", "mysql", "ms-wbt-server", "http", "https"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(lst, idx0):
    return F.element_at(F.array(*[F.lit(x) for x in lst]), idx0 + 1)


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations: ``seq, ip, port, service, proto, state, has_cert, domain_csv, domains``."""
    e = table(spark, sf_dir, "events")
    u = F.col("user_id")
    idx = (F.floor("value").cast("bigint") % (1 + u % 16)).cast("int")
    ip = F.concat(F.lit("10."), (u % 3).cast("string"), F.lit("."), (u % 8).cast("string"),
                  F.lit("."), (u % 256).cast("string"))
    # some hosts have two names, the second of which may also be among the resolved ones
    second = F.when(u % 2 == 1, F.concat(F.lit(",srv"), (u % 97).cast("string"), F.lit(".building.example.net"))).otherwise(F.lit(""))
    dcsv = F.when(F.col("event_type") == "purchase",
                  F.concat(F.lit("old"), (u % 5).cast("string"), F.lit(".example.com"), second)).otherwise(F.lit(""))
    return e.select(
        F.col("event_id").alias("seq"),
        ip.alias("ip"),
        _pick(PORT_LIST, idx).cast("int").alias("port"),
        _pick(SERVICE_LIST, idx).alias("service"),
        F.when(F.col("event_type") == "error", "udp").otherwise("tcp").alias("proto"),
        F.when(F.col("event_type") == "view", "closed").otherwise("open").alias("state"),
        (F.col("event_id") % 5 == 0).alias("has_cert"),
        dcsv.alias("domain_csv"),
    ).withColumn("domains", F.when(F.col("domain_csv") == "", F.array().cast("array<string>"))
                 .otherwise(F.split("domain_csv", ",")))


def svc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest state of each (ip, port, proto) – what the XML reports describe."""
    o = obs(spark, sf_dir)
    latest = o.groupBy("ip", "port", "proto").agg(
        F.max_by(F.struct("service", "state", "has_cert"), "seq").alias("s"))
    return latest.select("ip", "port", "proto", "s.service", "s.state", "s.has_cert")


def res(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolution records ``domain, ip``."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 200
    return c.select(
        F.concat(F.lit("srv"), (F.col("c_custkey") % 97).cast("string"), F.lit("."),
                 F.lower("c_mktsegment"), F.lit(".example.net")).alias("domain"),
        F.concat(F.lit("10."), (k % 3).cast("string"), F.lit("."), (k % 8).cast("string"), F.lit("."),
                 (k % 256).cast("string")).alias("ip"))


def big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume fixture from ``lineitem``: ``seq, ip, port, proto``."""
    li = table(spark, sf_dir, "lineitem")
    pk = F.col("l_partkey")
    idx = (F.floor("l_quantity").cast("bigint") % (1 + pk % 16)).cast("int")
    return li.select(
        F.col("l_orderkey").alias("seq"),
        F.concat(F.lit("10."), (pk % 200).cast("string"), F.lit("."), (pk % 8).cast("string"), F.lit("."),
                 (pk % 256).cast("string")).alias("ip"),
        _pick(PORT_LIST, idx).cast("int").alias("port"),
        F.when(F.col("l_returnflag") == "R", "udp").otherwise("tcp").alias("proto"))


# --------------------------------------------------------------- rendering
def render_scanner_lines(o: DataFrame, fmt: str, bad_ports: bool = False) -> DataFrame:
    """Observation rows as lines a scanner of format ``fmt`` prints (``key, value``); with ``bad_ports``, each 13th line of
    a masscan capture has no port number.

    Each capture starts with a ``# command`` header and a blank line and holds
    junk lines the parsers must skip; ``key`` orders the lines.
    """
    ip, port, proto = F.col("ip"), F.col("port").cast("string"), F.col("proto")
    esc = "\u001b"
    if fmt in ("generic", "naabu"):
        line, junk = F.concat(ip, F.lit(":"), port), F.concat(F.lit("a:b:"), ip)
    elif fmt == "sx":
        line, junk = F.concat(ip, F.lit("   "), port), F.concat(F.lit("x "), ip, F.lit(" z"))
    elif fmt in ("nmap", "masscan"):
        line = F.concat(F.lit("Discovered open port "), port, F.lit("/"), proto, F.lit(" on "), ip)
        junk = F.concat(F.lit("Nmap scan report for "), ip)
    elif fmt == "masscan_import":
        line = F.concat(F.lit("Timestamp: "), F.col("seq").cast("string"), F.lit("\tHost: "), ip,
                        F.lit(" ()\tPorts: "), port, F.lit("/open/"), proto, F.lit("//"),
                        F.col("service"), F.lit("//"))
        junk = F.lit("#masscan")
    elif fmt == "nimscan":
        line = F.concat(F.lit(esc + "[32m==> " + esc + "[0m"), ip, F.lit(":"), port,
                        F.lit(esc + "[0m [open]"))
        junk = F.lit("zzz")
    elif fmt == "semicolon":
        line, junk = F.concat(ip, F.lit(";"), port), F.lit("nothing here")
    else:
        raise ValueError(fmt)
    if bad_ports:
        line = F.when(F.col("seq") % 13 == 4, F.regexp_replace(line, r" [0-9]+/", " x/")).otherwise(line)
    rows = o.select(F.col("seq").cast("bigint").alias("key"), line.alias("value"))
    junk_rows = o.where(F.col("seq") % 7 == 3).select((F.col("seq").cast("bigint")).alias("key"),
                                                      junk.alias("value"))
    spark = o.sparkSession
    head = spark.createDataFrame([(-2, f"# {fmt} -p1-65535 10.0.0.0/8"), (-1, "")], "key bigint, value string")
    return head.unionByName(rows).unionByName(junk_rows)


def render_rustscan_lines(o: DataFrame) -> DataFrame:
    """``ip -> [p, ...]`` with up to four consecutive observations of one host per line."""
    g = o.groupBy("ip", F.floor(F.col("seq") / 4).alias("blk")).agg(
        F.min("seq").alias("key"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "port"))),
                                 lambda s: s["port"].cast("string")), ",").alias("plist"))
    lines = g.select("key", F.concat("ip", F.lit(" -> ["), "plist", F.lit("]")).alias("value"))
    junk = o.where(F.col("seq") % 11 == 5).select(F.col("seq").alias("key"),
                                                  F.concat(F.col("ip"), F.lit(" -> []")).alias("value"))
    spark = o.sparkSession
    head = spark.createDataFrame([(-2, "# rustscan -a 10.0.0.0/8"), (-1, "junk")], "key bigint, value string")
    return head.unionByName(lines).unionByName(junk)


def render_resolution_lines(r: DataFrame) -> DataFrame:
    """``domain [ip]`` lines, the resolver's answer format."""
    return r.select(F.concat("domain", F.lit(" ["), "ip", F.lit("]")).alias("value"))


def host_fragment(s: DataFrame) -> DataFrame:
    """``svc`` rows → one ``<host>`` element per IP (``ip, ports_csv, host_xml``)."""
    port_xml = F.concat(
        F.lit('<port protocol="'), F.col("proto"), F.lit('" portid="'), F.col("port").cast("string"),
        F.lit('"><state state="'), F.col("state"), F.lit('" reason="syn-ack"/><service name="'),
        F.col("service"), F.lit('" product="'), F.concat(F.lit("prod-"), F.col("service")),
        F.lit('" servicefp="fp-'), F.col("port").cast("string"), F.lit('" method="probed"/>'),
        F.when(F.col("has_cert"), F.concat(F.lit('<script id="ssl-cert" output="Subject: commonName='),
                                          F.col("ip"), F.lit('"/>'))).otherwise(F.lit("")),
        F.lit("</port>"))
    g = s.groupBy("ip").agg(
        F.array_sort(F.collect_list(F.struct("port", "proto", port_xml.alias("x")))).alias("ps"))
    name = F.concat(F.regexp_replace("ip", r"\.", "-"), F.lit(".example.org"))
    host = F.concat(
        F.lit('<host starttime="1" endtime="2"><status state="up" reason="user-set"/>\n<address addr="'),
        F.col("ip"), F.lit('" addrtype="ipv4"/>\n<hostnames><hostname name="'), name,
        F.lit('" type="PTR"/></hostnames>\n<ports>'),
        F.array_join(F.transform("ps", lambda p: p["x"]), "\n"),
        F.lit('</ports>\n<os><osmatch name="Linux '), F.substring_index("ip", ".", -1),
        F.lit('" accuracy="95"/></os>\n</host>'))
    ports_csv = F.array_join(F.array_distinct(F.transform("ps", lambda p: p["port"].cast("string"))), ",")
    return g.select("ip", ports_csv.alias("ports_csv"), host.alias("host_xml"))


def xml_document(h: DataFrame) -> DataFrame:
    """Whole single-host report documents (``ip, doc``) from :func:`host_fragment`."""
    args = F.concat(F.lit('nmap -sV -oA &quot;out&quot; -p'), F.col("ports_csv"), F.lit(" "), F.col("ip"))
    doc = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE nmaprun>\n'
              '<?xml-stylesheet href="file:///usr/share/nmap/nmap.xsl" type="text/xsl"?>\n'
              '<nmaprun scanner="nmap" args="'), args,
        F.lit('" start="1" startstr="Thu Jan  1 00:00:01 1970" version="7.94" xmloutputversion="1.05">\n'
              '<scaninfo type="syn" protocol="tcp" numservices="1" services="'), F.col("ports_csv"),
        F.lit('"/>\n<verbose level="0"/>\n<debugging level="0"/>\n<hosthint><status state="up"/>'
              '<address addr="'), F.col("ip"), F.lit('" addrtype="ipv4"/></hosthint>\n'),
        F.col("host_xml"),
        F.lit('\n<runstats><finished time="2" elapsed="1" exit="success"/>'
              '<hosts up="1" down="0" total="1"/></runstats>\n</nmaprun>'))
    return h.select("ip", doc.alias("doc"))


def text_report_lines(s: DataFrame) -> DataFrame:
    """``.nmap`` report lines per host: ``ip, n, line`` (n orders lines within a report)."""
    hdr = s.select("ip").distinct()
    a = hdr.select("ip", F.lit(0).alias("n"), F.concat(F.lit("# Nmap 7.94 scan initiated: nmap -sV "),
                                                      F.col("ip")).alias("line"))
    b = hdr.select("ip", F.lit(1).alias("n"), F.concat(F.lit("Nmap scan report for "), F.col("ip")).alias("line"))
    c = hdr.select("ip", F.lit(2).alias("n"), F.lit("PORT STATE SERVICE").alias("line"))
    d = s.select("ip", (F.lit(3) + F.col("port") * 2 + F.when(F.col("proto") == "udp", 1).otherwise(0)).alias("n"),
                 F.concat(F.col("port").cast("string"), F.lit("/"), F.col("proto"), F.lit(" "), F.col("state"),
                          F.lit(" "), F.col("service")).alias("line"))
    e = hdr.select("ip", F.lit(1 << 20).alias("n"), F.lit("# Nmap done: 1 IP address (1 host up)").alias("line"))
    return a.unionByName(b).unionByName(c).unionByName(d).unionByName(e)


def grepable_report_lines(s: DataFrame) -> DataFrame:
    """``.gnmap`` report lines per host: ``ip, n, line``."""
    g = s.groupBy("ip").agg(F.array_sort(F.collect_list(F.struct(
        "port", "proto", F.concat(F.col("port").cast("string"), F.lit("/"), F.col("state"), F.lit("/"),
                                  F.col("proto"), F.lit("//"), F.col("service"), F.lit("///")).alias("t")))).alias("ps"))
    a = g.select("ip", F.lit(0).alias("n"), F.concat(F.lit("# Nmap 7.94 scan initiated: nmap -sV "),
                                                    F.col("ip")).alias("line"))
    b = g.select("ip", F.lit(1).alias("n"), F.concat(
        F.lit("Host: "), F.col("ip"), F.lit(" ()\tPorts: "),
        F.array_join(F.transform("ps", lambda p: p["t"]), ", ")).alias("line"))
    return a.unionByName(b)


# ------------------------------------------------------------ written copies
def _cache_root(spark: SparkSession, sf_dir: str) -> str:
    key = hashlib.sha1(f"{os.path.abspath(sf_dir)}|{FIXTURE_VERSION}".encode()).hexdigest()[:12]
    return f"{scratch_dir(spark)}/scanlake/fixtures/{key}"


_LOCK = threading.RLock()  # queries of one session may run on several threads


def _write_lines_once(spark: SparkSession, path: str, lines: DataFrame, files: int | None = None) -> str:
    """Lines in the order of ``key``; without ``files``, in as many as a shuffle of their size has partitions."""
    with _LOCK:
        if not path_exists(spark, f"{path}/_SUCCESS"):
            (lines.repartitionByRange(*([files] if files else []), "key").sortWithinPartitions("key")
             .select("value").write.mode("overwrite").text(path))
    return path


def scanner_capture(spark: SparkSession, sf_dir: str, fmt: str, bad_ports: bool = False) -> str:
    """Folder holding ``obs`` rendered as the output of scanner ``fmt``."""
    path = f"{_cache_root(spark, sf_dir)}/capture_{fmt}{'_bad' if bad_ports else ''}"
    if path_exists(spark, f"{path}/_SUCCESS"):
        return path
    o = obs(spark, sf_dir)
    lines = render_rustscan_lines(o) if fmt == "rustscan" else render_scanner_lines(o, fmt, bad_ports)
    return _write_lines_once(spark, path, lines)


def resolution_capture(spark: SparkSession, sf_dir: str) -> str:
    path = f"{_cache_root(spark, sf_dir)}/resolutions"
    lines = render_resolution_lines(res(spark, sf_dir)).withColumn("key", F.xxhash64("value"))
    return _write_lines_once(spark, path, lines)


def domain_list_capture(spark: SparkSession, sf_dir: str) -> str:
    path = f"{_cache_root(spark, sf_dir)}/domain_list"
    lines = res(spark, sf_dir).select(F.col("domain").alias("value")).withColumn("key", F.xxhash64("value"))
    return _write_lines_once(spark, path, lines)


def concatenated_xml(spark: SparkSession, sf_dir: str, form: str = "plain") -> str:
    """Every host's XML report, concatenated into a few files (S14's input).

    In form ``repeated``, hosts whose last octet is 1 modulo 4 have three; in form ``broken``, each such host is followed by a
    copy whose last element isn't closed.
    """
    path = f"{_cache_root(spark, sf_dir)}/concat_xml_{form}"
    if path_exists(spark, f"{path}/_SUCCESS"):
        return path
    frags = host_fragment(svc(spark, sf_dir))
    some = frags.where(F.substring_index("ip", ".", -1).cast("int") % 4 == 1)
    if form == "repeated":
        frags = frags.unionByName(some).unionByName(some)
    elif form == "broken":
        frags = frags.unionByName(some.withColumn("host_xml", F.replace(F.col("host_xml"), F.lit("</os>"), F.lit(""))))
    lines = xml_document(frags).select(ip_num("ip").alias("key"), F.col("doc").alias("value"))
    return _write_lines_once(spark, path, lines)


def report_set(spark: SparkSession, sf_dir: str) -> str:
    """A report folder: ``<ip>.xml|nmap|gnmap`` for every host, ``port<p>.xml|nmap|gnmap`` for every port."""
    path = f"{_cache_root(spark, sf_dir)}/reports"
    marker = f"{path}_done"
    with _LOCK:
        if path_exists(spark, f"{marker}/_SUCCESS"):
            return path
        _write_report_set(spark, sf_dir, path, marker)
    return path


def partial_report_set(spark: SparkSession, sf_dir: str) -> str:
    """A folder with reports of the hosts whose last octet is even; the others count as new (F2)."""
    path = f"{_cache_root(spark, sf_dir)}/partial_reports"
    marker = f"{path}_done"
    with _LOCK:
        if not path_exists(spark, f"{marker}/_SUCCESS"):
            hosts = obs(spark, sf_dir).select("ip").distinct().where(F.substring_index("ip", ".", -1).cast("int") % 2 == 0)
            write_named_files(hosts.select(F.concat("ip", F.lit(".nmap")).alias("name"), F.col("ip").alias("content")), path)
            spark.createDataFrame([(1,)], "ok int").write.mode("overwrite").parquet(marker)
    return path


def _write_report_set(spark: SparkSession, sf_dir: str, path: str, marker: str) -> None:
    s = svc(spark, sf_dir)
    frags = host_fragment(s)
    xml = xml_document(frags).select(F.concat("ip", F.lit(".xml")).alias("name"), F.col("doc").alias("content"))

    def text_files(lines, suffix):
        g = lines.groupBy("ip").agg(F.array_sort(F.collect_list(F.struct("n", "line"))).alias("ls"))
        return g.select(F.concat("ip", F.lit(suffix)).alias("name"),
                        F.concat(F.array_join(F.transform("ls", lambda x: x["line"]), "\n"), F.lit("\n")).alias("content"))

    nm = text_files(text_report_lines(s), ".nmap")
    gn = text_files(grepable_report_lines(s), ".gnmap")
    # port reports: every host seen on the port, one document per port
    by_port = host_fragment(s).select("ip", "host_xml").join(s.select("ip", "port").distinct(), "ip")
    pg = by_port.groupBy("port").agg(F.array_sort(F.collect_list(F.struct(ip_num("ip").alias("k"), "host_xml"))).alias("hs"))
    port_xml = pg.select(
        F.concat(F.lit("port"), F.col("port").cast("string"), F.lit(".xml")).alias("name"),
        F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE nmaprun>\n<nmaprun scanner="nmap" args="nmap -sV -p'),
                 F.col("port").cast("string"),
                 F.lit('" start="1" version="7.94" xmloutputversion="1.05">\n<scaninfo type="syn" protocol="tcp" '
                       'numservices="1" services="'), F.col("port").cast("string"), F.lit('"/>\n'),
                 F.array_join(F.transform("hs", lambda h: h["host_xml"]), "\n"),
                 F.lit("\n<runstats/>\n</nmaprun>")).alias("content"))
    pl = s.groupBy("port").agg(F.array_sort(F.collect_set(F.struct(ip_num("ip").alias("k"), "ip"))).alias("hs"))
    port_nmap = pl.select(F.concat(F.lit("port"), F.col("port").cast("string"), F.lit(".nmap")).alias("name"),
                          F.concat(F.array_join(F.transform("hs", lambda h: F.concat(F.lit("Nmap scan report for "), h["ip"])), "\n"),
                                   F.lit("\n")).alias("content"))
    port_gnmap = pl.select(F.concat(F.lit("port"), F.col("port").cast("string"), F.lit(".gnmap")).alias("name"),
                           F.concat(F.array_join(F.transform("hs", lambda h: F.concat(F.lit("Host: "), h["ip"], F.lit(" ()"))), "\n"),
                                    F.lit("\n")).alias("content"))
    allf = xml.unionByName(nm).unionByName(gn).unionByName(port_xml).unionByName(port_nmap).unionByName(port_gnmap)
    write_named_files(allf.repartition(8), path)
    spark.createDataFrame([(1,)], "ok int").write.mode("overwrite").parquet(marker)


def flat_csv_capture(spark: SparkSession, sf_dir: str, form: str = "plain") -> str:
    """The flat table of every host, exported as CSV (script output quoted).

    In form ``reordered`` the header and the lines have the columns the other way round, but for the empty last one;
    in form ``bad`` each line of a port above 1000 is followed by a copy without a port number.

    The header names all 11 columns, data lines carry the first 10 (one comma
    less), and each line with a script is followed by a broken copy holding an
    extra field, which the reader must drop.
    """
    from scanlake.operators.graph import flat_table
    from scanlake.schema import FLAT_COLUMNS
    from scanlake.sources.reports import parse_hosts, read_host_elements

    path = f"{_cache_root(spark, sf_dir)}/flat_csv_{form}"
    if path_exists(spark, f"{path}/_SUCCESS"):
        return path
    flat = flat_table(parse_hosts(read_host_elements(spark, concatenated_xml(spark, sf_dir))))
    def field(c):
        v = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
        return F.concat(F.lit('"'), v, F.lit('"')) if c == "NSE Script Output" else v

    names = FLAT_COLUMNS[:-1][::-1] if form == "reordered" else FLAT_COLUMNS[:-1]
    fields = [field(c) for c in names]
    key = F.pmod(F.xxhash64("IP", "Port", "Proto"), F.lit(1 << 40))
    rows = flat.select((key * 2).alias("key"), F.concat_ws(",", *fields).alias("value"))
    broken = flat.where(F.col("`NSE Script ID`").isNotNull()).select(
        (key * 2 + 1).alias("key"), F.concat(F.concat_ws(",", *fields), F.lit(',"extra"')).alias("value"))
    if form == "bad":
        odd = [F.lit("http") if c == "Port" else f for c, f in zip(names, fields)]
        rows = rows.unionByName(flat.where("Port > 1000").select((key * 2).alias("key"), F.concat_ws(",", *odd).alias("value")))
    head = spark.createDataFrame([(-(1 << 62), ",".join([*names, FLAT_COLUMNS[-1]]))], "key bigint, value string")
    return _write_lines_once(spark, path, head.unionByName(rows).unionByName(broken), files=1)


def big_capture(spark: SparkSession, sf_dir: str, fmt: str = "masscan") -> str:
    """The ``big`` volume fixture rendered as scanner output (bench input)."""
    path = f"{_cache_root(spark, sf_dir)}/big_capture_{fmt}"
    if path_exists(spark, f"{path}/_SUCCESS"):
        return path
    b = big(spark, sf_dir).withColumn("service", F.lit("unknown"))
    # l_orderkey repeats across an order's lines, so number lines by their position instead
    b = b.withColumn("seq", F.monotonically_increasing_id())
    return _write_lines_once(spark, path, render_scanner_lines(b, fmt), files=8)


def selectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``token`` rows that select about a third of the hosts: a /28 by nation, an address by supplier."""

    def ip(k):
        return F.concat(F.lit("10."), (k % 3).cast("string"), F.lit("."), (k % 8).cast("string"), F.lit("."), (k % 256).cast("string"))

    nets = table(spark, sf_dir, "nation").select(F.concat(ip(F.col("n_nationkey")), F.lit("/28")).alias("token"))
    return nets.unionByName(table(spark, sf_dir, "supplier").select(ip(F.col("s_suppkey") * 4).alias("token")))


def selector_file(spark: SparkSession, sf_dir: str) -> str:
    """``selectors`` as a selector file, with a second selector after a comma on every line (S20's file form)."""
    path = f"{_cache_root(spark, sf_dir)}/selectors"
    lines = selectors(spark, sf_dir).select(F.xxhash64("token").alias("key"),
                                            F.concat(F.lit(" "), F.col("token"), F.lit(" ,"), F.col("token")).alias("value"))
    return _write_lines_once(spark, path, lines, files=1)
