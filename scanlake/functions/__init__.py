"""Column expressions shared by the operators."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pin(df, keep=None, **cols):
    """Add computed columns that later filters read as values.

    Catalyst pushes a filter below the projection that computes a column and
    substitutes the expression, so a filter mentioning the column several
    times (an OR of address ranges) re-evaluates it each time.  Emitting the
    row through ``inline`` of a one-element array computes it once.
    """
    carried = [F.col(f"`{c}`") for c in (df.columns if keep is None else keep)]
    return df.select(F.inline(F.array(F.struct(*carried, *[e.alias(k) for k, e in cols.items()]))))


def fill(template: str, values: dict) -> Column:
    """The template as a ``concat`` of its literal parts and, for its ``{names}``, the given columns."""
    parts = []
    for literal, name in re.findall(r"([^{]*)(?:\{(\w+)\})?", template):
        if literal:
            parts.append(F.lit(literal))
        if name:
            parts.append(values[name].cast("string"))
    return F.concat(*parts)


def order(*cols):
    """Ascending sort keys with nulls last: addresses that are not IPv4 (a null
    key) come after every IPv4 address, in the text order of the next key."""
    return [as_col(c).asc_nulls_last() for c in cols]


def number_rows(df, keys, out: str = "i"):
    """Number rows 1, 2, ... in the order of ``keys`` (nulls last), without a single-partition window.

    The range-sorted rows are written once with their place in their partition; the partitions' counts (one row
    each) give every partition its offset.
    """
    from scanlake.session import materialized

    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialized(df.repartitionByRange(n, *order(*keys)).sortWithinPartitions(*order(*keys))
                          .withColumn("_place", F.monotonically_increasing_id()), "numbered")
    part, within = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).orderBy("_part").collect()   # n rows at most
    offsets, total = [], 0
    for r in counts:
        offsets.append((r._part, total))
        total += r.n
    first = spark.createDataFrame(offsets, "_part long, _first long")
    return placed.withColumn("_part", part).join(F.broadcast(first), "_part") \
        .select(*df.columns, (F.col("_first") + within + 1).alias(out))
