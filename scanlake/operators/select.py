"""Selections over observations.

Address and port selection (F3, F4) have one plan for any number of selectors,
and never expand a CIDR into addresses:

* at most ``COVER_RANGES`` ranges that cover all selectors become a disjunction
  that Catalyst pushes into the Parquet scan (row-group pruning, no shuffle);
* selectors become disjoint sorted intervals of 16 bits: a block with a prefix of up
  to 16 bits is an interval of first halves, a longer one an interval of second
  halves under its first half, and so on for IPv6.  What lies under one head is a *slice*
  of at most 32,768 intervals, however many selectors there are;
* a row meets the one slice of its address's head (one join per prefix class in use: two
  for IPv4, eight for IPv6 at most) and is looked up there by binary search.  No row is
  multiplied.  Spark broadcasts the slices below its size threshold and merges beyond.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scanlake.functions import pin
from scanlake.functions.ip import ip6_key, ip_num
from scanlake.functions.ranges import covers, within
from scanlake.session import materialized
from scanlake.sources.selectors import host_ranges, host_ranges6, is_path, port_list, selector_keyword, selector_tokens

_STEPS = [1 << k for k in range(15, -1, -1)]


def _slices(pieces: DataFrame) -> DataFrame:
    """``level, head, slice`` from ``level, head, first, last``: each head's intervals, merged, sorted and disjoint."""
    w = Window.partitionBy("level", "head").orderBy("first", "last")
    before = F.max("last").over(w.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    merged = pieces.withColumn("new", F.when(F.col("first") <= before + 1, 0).otherwise(1)).withColumn("island", island) \
        .groupBy("level", "head", "island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return merged.groupBy("level", "head").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("slice"))


def _pieces4(ranges: DataFrame) -> DataFrame:
    """Level 0: prefixes of up to 16 bits, by the address's first half; level 1: the others, by its second half."""
    short = F.col("prefix") <= 16
    return ranges.select(
        F.when(short, 0).otherwise(1).alias("level"), F.when(short, "").otherwise(F.shiftright("lo", 16).cast("string")).alias("head"),
        F.when(short, F.shiftright("lo", 16)).otherwise(F.col("lo") % 65536).cast("int").alias("first"),
        F.when(short, F.shiftright("hi", 16)).otherwise(F.col("hi") % 65536).cast("int").alias("last"), "lo", "hi")


def _pieces6(ranges: DataFrame) -> DataFrame:
    """Level k + 2 (after IPv4's): prefixes of 16 k + 1 to 16 k + 16 bits, by the address's k-th group of four digits."""
    level = F.greatest(F.floor((F.col("prefix") - 1) / 16), F.lit(0)).cast("int")
    r = ranges.select(level.alias("level"), "key", (16 * (level + 1) - F.col("prefix")).alias("free"))
    group = F.conv(F.expr("substring(key, 4 * level + 1, 4)"), 16, 10).cast("int")
    size = F.expr("shiftleft(1, free)")
    return r.select((F.col("level") + 2).alias("level"), F.expr("substring(key, 1, 4 * level)").alias("head"),
                    (group - group % size).alias("first"), (group - group % size + size - 1).alias("last"),
                    F.lit(None).cast("bigint").alias("lo"), F.lit(None).cast("bigint").alias("hi"))


def _found(slice_: Column, x: Column) -> Column:
    """Whether ``x`` lies in one of the slice's intervals: the last one that begins at or before it, by binary search."""
    n = F.size(slice_)
    last = F.aggregate(F.array(*[F.lit(s) for s in _STEPS]), F.lit(0), lambda at, step: F.when(
        (at + step <= n) & (F.get(slice_, at + step - 1)["first"] <= x), at + step).otherwise(at))
    return F.exists(F.array(last), lambda at: F.get(slice_, at - 1)["last"] >= x)


def select_cidr(df: DataFrame, ranges: DataFrame, ip_col: str = "ip", ranges6: DataFrame | None = None,
                listed: bool = False) -> DataFrame:
    """Rows whose address lies in any ``(prefix, lo, hi)`` range, or IPv6 ``(prefix, key)`` (F3); each row at most once.

    ``listed`` says that the caller gave the selectors one by one, so they fit the driver they came from; else
    they are written once, as three passes read them.
    """
    pieces = _pieces4(ranges)
    pieces = pieces if ranges6 is None else pieces.unionByName(_pieces6(ranges6))
    pieces = df.sparkSession.createDataFrame(pieces.toArrow()) if listed else materialized(pieces, "selectors")
    low, high, levels = pieces.agg(F.min("lo"), F.max("lo"), F.collect_set("level")).first()     # ten levels at most
    if not levels:
        return df.where(F.lit(False))
    stored = ip_col == "ip" and "ip_num" in df.columns      # a stored key: the cover reaches the Parquet scan
    number = "ip_num" if stored else "_sel_n"
    keyed = df if stored else pin(df, _sel_n=ip_num(ip_col))
    cover = covers(pieces, low, high)
    near = within(F.col(number), cover) if cover else F.lit(False)
    if max(levels) > 1:
        rows = pin(keyed.where(near | F.col(number).isNull()), _sel_6=ip6_key(ip_col))
    else:
        rows = keyed.where(near)
    slices = _slices(pieces)
    hits = []
    for level in sorted(levels):
        if level < 2:
            head = F.lit("") if level == 0 else F.shiftright(number, 16).cast("string")
            x = (F.shiftright(number, 16) if level == 0 else F.col(number) % 65536).cast("int")
            head = F.when(F.col(number).isNotNull(), head)
        else:
            head = F.substring("_sel_6", 1, 4 * (level - 2))
            x = F.conv(F.substring("_sel_6", 4 * (level - 2) + 1, 4), 16, 10).cast("int")
        of_level = slices.where(F.col("level") == level).select(F.col("head").alias(f"_head{level}"),
                                                                F.col("slice").alias(f"_slice{level}"))
        rows = rows.join(of_level, head == F.col(f"_head{level}"), "left")
        hits.append(F.col(f"_slice{level}").isNotNull() & _found(F.col(f"_slice{level}"), x))
    return rows.where(reduce(lambda a, b: a | b, hits)).select(df.columns)


def select_ports(df: DataFrame, ports: DataFrame, port_col: str = "port") -> DataFrame:
    """Rows whose port is listed."""
    ranges = ports.select(F.col("port").alias("lo"), F.col("port").alias("hi"))
    cover = covers(ranges, *ranges.agg(F.min("lo"), F.max("lo")).first())
    if not cover:
        return df.where(F.lit(False))
    listed = ports.select(F.col("port").alias("_p")).distinct()
    return df.where(within(F.col(port_col), cover)).join(listed, F.col(port_col) == F.col("_p"), "left_semi")


def new_hosts(df: DataFrame, catalog: DataFrame, ip_col: str = "ip") -> DataFrame:
    """rows whose address has no report file of any suffix."""
    stems = catalog.select(F.col("stem").alias("_stem")).distinct()
    return df.join(stems, df[ip_col] == stems["_stem"], "left_anti")


def select_hosts(spark: SparkSession, df: DataFrame, hosts, catalog: DataFrame | None = None) -> DataFrame:
    """``-hosts``: F1 (``all``), F2 (``new``, needs the report catalog) or F3."""
    kw = selector_keyword(spark, hosts)
    if kw == "all":
        return df
    if kw == "new":
        if catalog is None:
            raise ValueError("'new' needs the report catalog")
        return new_hosts(df, catalog)
    return select_spec(spark, df, hosts)


def select_spec(spark: SparkSession, df: DataFrame, hosts, ip_col: str = "ip") -> DataFrame:
    """F3 over a selector string, list or file, of IPv4 and IPv6 selectors."""
    tokens, six, listed = selector_tokens(spark, hosts), F.col("token").contains(":"), not is_path(spark, hosts)
    ranges6 = None if listed and ":" not in str(hosts) else host_ranges6(tokens.where(six))
    return select_cidr(df, host_ranges(tokens if ranges6 is None else tokens.where(~six)), ip_col, ranges6, listed)


def select_by_ports(spark: SparkSession, df: DataFrame, ports) -> DataFrame:
    """``-ports``: F1 (``all``) or F4."""
    if selector_keyword(spark, ports) == "all":
        return df
    return select_ports(df, port_list(selector_tokens(spark, ports)))


def limit_hosts(host_ports: DataFrame, max_ports_exclusive: int | None) -> DataFrame:
    """keep hosts with fewer than ``max_ports_exclusive`` distinct ports."""
    if max_ports_exclusive is None:
        return host_ports
    return host_ports.where(F.col("n_ports") < max_ports_exclusive)
