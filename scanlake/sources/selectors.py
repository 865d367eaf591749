"""Selector source (S20): a comma list, or a file of one selector per line.

A file's lines are joined with commas before the keyword test, so a file
holding only ``all`` means all.  Tokens are trimmed and blank ones dropped.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.functions import pin
from scanlake.functions.ip import ip6_key, ip_num

_ADDRESS6 = re.compile(r"[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*(/.*)?")


def is_path(spark: SparkSession, spec) -> bool:
    """Whether the selector names a file; an IPv6 selector is no path, though a URI parser takes its colons for one."""
    from scanlake.session import path_exists

    return isinstance(spec, str) and spec not in ("all", "new") and not _ADDRESS6.fullmatch(spec.split(",")[0].strip()) and path_exists(spark, spec)


def selector_tokens(spark: SparkSession, spec) -> DataFrame:
    """``token string`` rows from a comma string, a list, or a path to a selector file."""
    if isinstance(spec, (list, tuple)):
        df = spark.createDataFrame([(str(t),) for t in spec], "token string")
    elif is_path(spark, spec):
        df = spark.read.text(spec).select(F.explode(F.split("value", ",")).alias("token"))
    else:
        df = spark.createDataFrame([(t,) for t in str(spec).split(",")], "token string")
    return df.select(F.trim("token").alias("token")).where(F.col("token") != "")


def keyword(tokens: DataFrame) -> str | None:
    """``'all'`` or ``'new'`` when the selector is exactly that word (reads two rows at most)."""
    first = [r.token for r in tokens.limit(2).collect()]
    if len(first) == 1 and first[0] in ("all", "new"):
        return first[0]
    return None


def selector_keyword(spark: SparkSession, spec) -> str | None:
    """:func:`keyword` for a selector spec: a string or list is decided on the driver,
    without a job; only a selector file is read (two tokens at most)."""
    if isinstance(spec, (list, tuple)):
        words = [str(t).strip() for t in spec]
    elif not is_path(spark, spec):
        words = [t.strip() for t in str(spec).split(",")]
    else:
        return keyword(selector_tokens(spark, spec))
    words = [w for w in words if w]
    return words[0] if len(words) == 1 and words[0] in ("all", "new") else None


def host_ranges(tokens: DataFrame) -> DataFrame:
    """Address selectors → ``prefix int, lo bigint, hi bigint``; a bad token fails the job.

    Parsed in stages (text → address and prefix → bounds) so each expression
    reads the previous stage's columns instead of repeating its parsing.
    """
    parts = tokens.select("token", F.split("token", "/", -1).alias("_p"))
    t = parts.select(
        "token", F.try_element_at("_p", F.lit(1)).alias("_addr"),
        F.when(F.size("_p") == 1, F.lit(32))
         .when(F.size("_p") == 2, F.try_element_at("_p", F.lit(2)).try_cast("int")).alias("prefix"),
        F.when(F.size("_p") == 2, F.try_element_at("_p", F.lit(2))).alias("_mask"))
    n = pin(t.select("token", "prefix", "_addr", "_mask"), _n=ip_num("_addr"), _m=ip_num("_mask")).drop("_addr", "_mask")
    # a netmask is a run of ones: its complement plus one is a power of two
    wild = F.lit((1 << 32) - 1) - F.col("_m")
    n = n.withColumn("prefix", F.when(F.col("_m").isNotNull() & (wild.bitwiseAND(wild + 1) == 0), 32 - F.bit_count(wild))
                     .otherwise(F.col("prefix"))).drop("_m")
    ok = F.coalesce(F.col("_n").isNotNull() & F.col("prefix").between(0, 32), F.lit(False))
    checked = n.where(F.when(~ok, F.raise_error(F.concat(F.lit("not an IPv4 address or CIDR: "), F.col("token"))))
                      .otherwise(F.lit(True)))
    block = F.expr("shiftleft(1L, 32 - prefix)")
    lo = F.col("_n") - F.col("_n") % block
    return checked.select("prefix", lo.alias("lo"), (lo + block - 1).alias("hi")).distinct()


def host_ranges6(tokens: DataFrame) -> DataFrame:
    """IPv6 selectors (``addr`` or ``addr/p``) → ``prefix int, key string`` (32 hex digits, host bits still set);
    a bad token fails the job."""
    parts = F.split("token", "/", -1)
    p = F.when(F.size(parts) == 1, F.lit(128)).when(F.size(parts) == 2, F.get(parts, F.lit(1)).try_cast("int"))
    n = pin(tokens.select("token"), prefix=p, key=ip6_key(F.get(parts, F.lit(0))))
    ok = F.coalesce(F.col("key").isNotNull() & F.col("prefix").between(0, 128), F.lit(False))
    return n.where(F.when(~ok, F.raise_error(F.concat(F.lit("not an IPv6 address or CIDR: "), F.col("token"))))
                   .otherwise(F.lit(True))).select("prefix", "key").distinct()


def port_list(tokens: DataFrame) -> DataFrame:
    """Port selectors → ``port int``; a non-integer fails the job."""
    p = F.col("token").try_cast("int")
    return (tokens.where(F.when(p.isNull(), F.raise_error(F.concat(F.lit("not a port: "), F.col("token"))))
                         .otherwise(F.lit(True)))
            .select(p.alias("port")).distinct())
