"""Flat port table and the subnet-to-host graph.

Every grouping here is per ``(IP, Port)`` or per ``IP``; both are bounded by the
number of ports of one host, and all are aggregates with a map-side partial
step (``min_by``, ``collect_list`` of structs), never windows over a whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.functions.ip import subnet
from scanlake.schema import FLAT_COLUMNS

# The columns a host's row takes from its first port, and those it lists.
_REST = ["Proto", "Service FP", "NSE Script ID", "NSE Script Output", "Notes"]
_LISTS = ["Port", "Service", "Host", "OS", "Product"]


# --------------------------------------------------------------------- S18
def flat_table(hosts: DataFrame) -> DataFrame:
    """Parsed host elements → the 11-column flat table, one row per port and
    script (a port without scripts gives one row), with an order key ``seq``."""
    h = hosts.select(
        "ip", "source_file", "block_start", "row_id",
        F.try_element_at(F.col("h.hostnames.hostname"), F.lit(1))["_name"].alias("host"),
        F.try_element_at(F.col("h.os.osmatch"), F.lit(1))["_name"].alias("os"),
        F.posexplode("h.ports.port").alias("pos", "p"))
    s = h.select("*", F.posexplode_outer("p.script").alias("spos", "s"))
    return s.select(
        F.struct("source_file", "block_start", "row_id", "pos", F.coalesce("spos", F.lit(0)).alias("spos")).alias("seq"),
        F.col("ip").alias("IP"), F.col("host").alias("Host"), F.col("os").alias("OS"),
        F.col("p._protocol").alias("Proto"), F.col("p._portid").alias("Port"),
        F.col("p.service._name").alias("Service"), F.col("p.service._product").alias("Product"),
        F.col("p.service._servicefp").alias("Service FP"), F.col("s._id").alias("NSE Script ID"),
        F.col("s._output").alias("NSE Script Output"), F.lit(None).cast("string").alias("Notes"))


# --------------------------------------------------------------------- S19
def _csv_lines(spark: SparkSession, paths, header: list[str] | None) -> DataFrame:
    """Lines with their place, their file's column names (``cols``), and ``ok``: whether the line is data."""
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("r"))
    names = F.transform(F.split(F.replace(F.col("head"), F.lit('"'), F.lit("")), ",", -1), lambda c: F.trim(c))
    if header is None:      # each file's first line
        heads = lines.where("b = 0").groupBy("f").agg(F.min_by("value", "r").alias("head"))
        lines = lines.join(heads.select("f", names.alias("cols")), "f")
    else:
        lines = lines.withColumn("cols", F.array(*[F.lit(c) for c in header]))
    commas = F.length("value") - F.length(F.replace(F.col("value"), F.lit(","), F.lit("")))
    data = (commas == F.size("cols") - 2) & (F.col("value").contains("tcp,") | F.col("value").contains("udp,"))
    return lines.where(data).select(F.struct("f", "b", "r").alias("seq"), "value", "cols",
                                    F.split(F.replace(F.col("value"), F.lit('"'), F.lit("")), ",", -1).alias("fields"))


def _csv_field(name: str):
    """The field under the file's column of that name; null where it is empty, or the file has no such column."""
    at = F.array_position("cols", name)
    return F.when(at > 0, F.nullif(F.get("fields", (at - 1).cast("int")), F.lit("")))


def read_flat_csv(spark: SparkSession, paths, header: list[str] | None = None, mode: str = "strict") -> DataFrame:
    """Read exported flat CSVs, keeping only data lines, with columns by each file's own header.

    A line is data when it has one comma less than its file's header and holds
    ``tcp,`` or ``udp,``; quotes are removed and ``Port`` is an integer: a line with another port fails
    the job (``strict``) or goes to ``bad_flat_lines`` (``quarantine``).  Fields missing at the end are
    null.  ``header`` names the columns of files without a header.  Adds ``seq`` (file order).
    """
    if mode not in ("strict", "quarantine"):
        raise ValueError(mode)
    lines = _csv_lines(spark, paths, header)
    port = _csv_field("Port").try_cast("int")
    bad = port.isNull()
    ok = ~bad if mode == "quarantine" else F.when(bad, F.raise_error(F.concat(F.lit("no port number: "), F.col("value")))) \
        .otherwise(F.lit(True))
    return lines.where(ok).select("seq", *[(port if c == "Port" else _csv_field(c)).alias(c) for c in FLAT_COLUMNS])


def bad_flat_lines(spark: SparkSession, paths, header: list[str] | None = None) -> DataFrame:
    """The side table of ``read_flat_csv(mode="quarantine")``: ``source_file, value, reason``."""
    return _csv_lines(spark, paths, header).where(_csv_field("Port").try_cast("int").isNull()).select(
        F.col("seq.f").alias("source_file"), "value", F.lit("no port number").alias("reason"))


# -------------------------------------------------------------- A11, A8, F10
def first_per_ip_port(flat: DataFrame) -> DataFrame:
    """The first row (by ``seq``) of each (IP, Port); protocol is not in the key."""
    cols = [c for c in flat.columns if c not in ("IP", "Port")]
    g = flat.groupBy("IP", "Port").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in cols]), "seq").alias("r"))
    return g.select("IP", "Port", *[F.col("r").getField(c).alias(c) for c in cols])


def all_ports(flat: DataFrame) -> DataFrame:
    """Distinct ports, ascending."""
    return flat.select("Port").distinct().orderBy("Port")


def flat_by_ports(flat: DataFrame, ports) -> DataFrame:
    """rows of the chosen ports; no choice means all rows."""
    if not ports:
        return flat
    return flat.where(F.col("Port").isin([int(p) for p in ports]))


# --------------------------------------------------------------------- A7
def _field(name: str):
    return lambda r: r[name]


def host_profile(flat: DataFrame) -> DataFrame:
    """Per IP, aligned lists ``Port, Service, Host, OS, Product`` in row order
    and the first row's ``Proto, Service FP, NSE Script ID, NSE Script Output, Notes``."""
    rows = F.array_sort(F.collect_list(F.struct("seq", *[F.col(f"`{c}`") for c in _LISTS])))
    g = flat.groupBy("IP").agg(rows.alias("rows"),
                              F.min_by(F.struct(*[F.col(f"`{c}`") for c in _REST]), "seq").alias("first"),
                              F.min("seq").alias("seq"))
    return g.select("IP", *[F.transform("rows", _field(c)).alias(c) for c in _LISTS],
                    *[F.col("first").getField(c).alias(c) for c in _REST], "seq")


# ------------------------------------------------------------------ G1, G2
def graph_edges(flat: DataFrame) -> DataFrame:
    """G1: one edge per host from its subnet, carrying the host profile."""
    prof = host_profile(first_per_ip_port(flat))
    return prof.select(subnet("IP").alias("subnet"), F.col("IP").alias("ip"),
                       *[c for c in prof.columns if c not in ("IP",)])


def _py_list(arr, quote: bool):
    """Text of a Python list literal: ``[80, 443]`` or ``['http', 'https']``."""
    item = (lambda x: F.coalesce(F.concat(F.lit("'"), x, F.lit("'")), F.lit("nan"))) if quote else \
        (lambda x: x.cast("string"))
    return F.concat(F.lit("["), F.array_join(F.transform(arr, item), ", "), F.lit("]"))


def graph_vertices(edges: DataFrame) -> DataFrame:
    """Host vertices with their port and service lists, port count and hover
    text; subnet vertices with no lists and count 0.

    One pass over the edges: each edge emits its host vertex and its subnet
    vertex, and one partial aggregate per id keeps the host vertex when an id
    is both (as merging graph nodes does).  A subnet id repeats at most 256
    times, once per host of the /24.
    """
    fields = ["kind", "ports", "services", "n_ports", "hover"]
    host = F.struct(F.col("ip").alias("id"), F.lit(1).alias("_rank"), F.lit("host").alias("kind"),
                    F.col("Port").alias("ports"), F.col("Service").alias("services"),
                    F.size("Port").alias("n_ports"),
                    F.concat(_py_list(F.col("Port"), False), F.lit("<br>"),
                             _py_list(F.col("Service"), True)).alias("hover"))
    sub = F.struct(F.col("subnet").alias("id"), F.lit(0).alias("_rank"), F.lit("subnet").alias("kind"),
                   F.lit(None).cast("array<int>").alias("ports"), F.lit(None).cast("array<string>").alias("services"),
                   F.lit(0).alias("n_ports"), F.lit("").alias("hover"))
    rows = edges.select(F.inline(F.array(host, sub)))
    best = rows.groupBy("id").agg(F.max_by(F.struct(*fields), "_rank").alias("v"))
    return best.select("id", *[F.col("v").getField(f).alias(f) for f in fields])


def graph_for_ports(flat: DataFrame, ports) -> tuple[DataFrame, DataFrame]:
    """F10 then G1 and G2."""
    e = graph_edges(flat_by_ports(flat, ports))
    return e, graph_vertices(e)
