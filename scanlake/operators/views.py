"""Groupings and listings of the inventory.

Per-host port sets (A1) are bounded (65,536 ports at most) and collected with
partial aggregation.  Per-port host sets (A2) are not bounded – one port may
hold a third of all hosts – so the primary form is long (``port, ip``) and
array or text forms have *blocks*.  Hosts are gathered by cell, a /16 or, for what is
not IPv4, a share of the hash space; a port's cells, in address order, fill blocks of about
``BLOCK_HOSTS`` hosts.  A port with fewer is one line, as a listing prints it;
none is gathered into one row or task whatever its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanlake.functions import fill
from scanlake.functions.ip import ip_num
from scanlake.operators.domains import host_names, latest_domains
from scanlake.operators.select import limit_hosts

BLOCK_HOSTS = 1 << 16       # a block ends with the cell that fills it, so it has less than this and one cell (a /16) more
NAME_CELLS = 1 << 16        # cells of a port's hosts that aren't IPv4

# The texts of the listings.  Braces are filled in.
HOST_LINE = "IP {ip} ({n}) -> [{ports}]"
HOST_DOMAINS_LINE = "IP {ip}, Domains [{domains}] ({n}) -> [{ports}]"
PORT_LINE = "Port {port} ({n}) -> [{ips}]"


def _ports_text(c):
    return F.array_join(F.transform(c, lambda p: p.cast("string")), ",")


# ---------------------------------------------------------------------- A1
def host_ports(df: DataFrame, *extra) -> DataFrame:
    """A1: ``ip, ip_num, ports array<int> (ascending, distinct), n_ports``, and ``extra`` aggregates of the host's rows."""
    g = df.groupBy("ip").agg(F.array_sort(F.collect_set("port")).alias("ports"), *extra)
    more = [c for c in g.columns if c not in ("ip", "ports")]
    return g.select("ip", ip_num("ip").alias("ip_num"), "ports", F.size("ports").alias("n_ports"), *more)


# ---------------------------------------------------------------------- A2
def port_hosts(df: DataFrame) -> DataFrame:
    """A2 long form: distinct ``port, ip, ip_num``."""
    return df.select("port", "ip").distinct().withColumn("ip_num", ip_num("ip"))


def port_host_blocks(df: DataFrame, block_hosts: int = BLOCK_HOSTS) -> DataFrame:
    """A2 array form: ``port, block, ips`` (address order), ``n_block``, and the port's ``n_hosts`` and ``n_blocks``.

    ``block`` counts from 0 within the port.
    """
    number = ip_num("ip")
    cell = F.coalesce(F.shiftright(number, 16), F.pmod(F.xxhash64("ip"), F.lit(NAME_CELLS)) + (1 << 16))
    host = F.struct(F.coalesce(number, F.lit(1 << 40)).alias("k"), "ip")
    cells = df.select("port", cell.alias("cell"), host.alias("h")).groupBy("port", "cell").agg(F.collect_set("h").alias("hosts"))
    by_port = Window.partitionBy("port")                    # cells of a port: 2 * 65,536 at most
    before = F.coalesce(F.sum("n").over(by_port.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = cells.select("port", "cell", F.size("hosts").alias("n")).select(
        "port", "cell", F.floor(before / block_hosts).alias("filled"), F.sum("n").over(by_port).alias("n_hosts"))
    numbered = numbered.withColumn("block", F.dense_rank().over(by_port.orderBy("filled")) - 1) \
        .withColumn("n_blocks", F.max("block").over(by_port) + 1)
    blocks = cells.join(numbered, ["port", "cell"]).groupBy("port", "block", "n_hosts", "n_blocks").agg(
        F.array_sort(F.flatten(F.collect_list("hosts"))).alias("s"))
    return blocks.select("port", "block", F.transform("s", lambda x: x["ip"]).alias("ips"),
                         F.size("s").cast("long").alias("n_block"), "n_hosts", "n_blocks")


# ------------------------------------------------------------------ A5, A6
def count_hosts(df: DataFrame, approx: bool = False) -> DataFrame:
    """A5: distinct addresses (``approx_count_distinct`` on request)."""
    f = F.approx_count_distinct("ip") if approx else F.countDistinct("ip")
    return df.agg(f.alias("n_hosts"))


def total_targets(df: DataFrame, by: str = "ip") -> DataFrame:
    """Number of hosts (or ports) selected, before the host limit."""
    return df.agg(F.countDistinct(by).alias("total"))


# ------------------------------------------------------------------- P1, P2
def host_listing_raw(df: DataFrame, dns: bool = False, max_ports_exclusive: int | None = None,
                     domains_mode: str = "latest", delta: DataFrame | None = None) -> DataFrame:
    """``ip:port`` per port, and with ``dns`` a ``domain:port`` line after each.

    Columns ``ip, ip_num, port, k, line``; order by the last four for the printed listing.
    ``domains_mode`` is ``latest`` (the host's last row) or ``union`` (all its rows); ``delta`` has names added later.
    """
    hp = limit_hosts(host_ports(df), max_ports_exclusive).select("ip", "ip_num", F.explode("ports").alias("port"))
    rows = hp.select("ip", "ip_num", "port", F.lit(0).alias("k"), F.col("ip").alias("name"))
    if dns:
        names = host_names(df, delta, domains_mode).withColumnRenamed("domain", "name")
        rows = rows.unionByName(hp.join(names, "ip").select(rows.columns))
    return rows.select("ip", "ip_num", "port", "k", F.concat("name", F.lit(":"), F.col("port").cast("string")).alias("line"))


def host_listing(df: DataFrame, dns: bool = False, max_ports_exclusive: int | None = None,
                 domains_mode: str = "latest", delta: DataFrame | None = None) -> DataFrame:
    """``IP {ip} ({n}) -> [{ports}]``; with ``dns``, ``IP {ip}, Domains [{d}] ({n}) -> [..]``."""
    one = dns and domains_mode == "latest" and delta is None        # then ports and names come from one grouping
    extra = [F.max_by("domains", "seq").alias("domains")] if one else []
    hp = limit_hosts(host_ports(df, *extra), max_ports_exclusive)
    if dns and not one:
        hp = hp.join(latest_domains(df, domains_mode, delta), "ip", "left")
    values = {"ip": F.col("ip"), "n": F.col("n_ports"), "ports": _ports_text(F.col("ports"))}
    if dns:
        values["domains"] = F.array_join(F.coalesce("domains", F.array().cast("array<string>")), ",")
    return hp.select("ip", "ip_num", "n_ports", fill(HOST_DOMAINS_LINE if dns else HOST_LINE, values).alias("line"))


# ------------------------------------------------------------------- P3, P4
def port_listing(df: DataFrame, block_hosts: int = BLOCK_HOSTS) -> DataFrame:
    """``Port {p} ({n}) -> [{ips}]`` per (port, block) with that block's hosts, ordered by (port, block)."""
    b = port_host_blocks(df, block_hosts)
    line = fill(PORT_LINE, {"port": F.col("port"), "n": F.col("n_block"), "ips": F.array_join("ips", ",")})
    return b.select("port", "block", "n_block", "n_hosts", line.alias("line"))


def port_listing_raw(df: DataFrame) -> DataFrame:
    """One address per line, by port then address (``port, ip_num, line``)."""
    return port_hosts(df).select("port", "ip_num", F.col("ip").alias("line"))


# ------------------------------------------------------------------- P5, P6
def host_worklist(df: DataFrame, max_ports_exclusive: int | None = None) -> DataFrame:
    """P5: per host, the report stem and the comma list of ports to scan."""
    hp = limit_hosts(host_ports(df), max_ports_exclusive)
    return hp.select(F.col("ip").alias("stem"), "ip", "ip_num", _ports_text(F.col("ports")).alias("ports_csv"),
                     "n_ports")


def port_worklist(df: DataFrame, block_hosts: int = BLOCK_HOSTS) -> DataFrame:
    """Per port and block, the hosts and the report stem: ``port<p>``, or ``port<p>_<block>`` where a port has several."""
    b = port_host_blocks(df, block_hosts)
    stem = F.concat(F.lit("port"), F.col("port").cast("string"),
                    F.when(F.col("n_blocks") > 1, F.concat(F.lit("_"), F.col("block").cast("string"))).otherwise(F.lit("")))
    return b.select(stem.alias("stem"), "port", "block", F.array_join("ips", ",").alias("hosts_csv"), "n_block", "n_hosts")
