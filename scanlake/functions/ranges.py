"""Range filters that cover many values: few enough to be pushed into a scan or a file listing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COVER_RANGES = 64


def covers(ranges: DataFrame, low: int | None, high: int | None) -> list[tuple[int, int]]:
    """At most ``COVER_RANGES`` ranges that hold all ``lo``..``hi`` ranges, whose ``lo`` span ``low``..``high``: one for each
    equal cell of that span that has any."""
    if low is None:
        return []
    width = (high - low) // COVER_RANGES + 1
    cells = ranges.where(F.col("lo").isNotNull()).groupBy(F.floor((F.col("lo") - low) / width).alias("cell")) \
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("cell").collect()
    return [(r.lo, r.hi) for r in cells]


def within(column: Column, cover: list[tuple[int, int]]) -> Column:
    single = [lo for lo, hi in cover if lo == hi]
    wide = [column.between(lo, hi) for lo, hi in cover if lo < hi]
    return reduce(lambda a, b: a | b, ([column.isin(single)] if single else []) + wide)
