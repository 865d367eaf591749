"""Domain lists and recorded resolutions.

Punycode conversion is the one piece of per-row Python: an Arrow-batched
``pandas_udf`` in the same pass as all else, which gets a name only where one needs it
(non-ASCII names going out, ``xn--`` labels coming back) and null otherwise.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanlake.functions import pin


@F.pandas_udf(T.StringType())
def _to_ascii(s: pd.Series) -> pd.Series:
    return s.map(lambda d: d.encode("idna").decode("ascii"), na_action="ignore")


@F.pandas_udf(T.StringType())
def _to_unicode(s: pd.Series) -> pd.Series:
    return s.map(lambda d: d.encode("ascii").decode("idna"), na_action="ignore")


def read_domain_list(spark: SparkSession, paths) -> DataFrame:
    """Distinct non-empty lines of a domain list (``domain string``)."""
    return spark.read.text(paths).select(F.col("value").alias("domain")).where(F.col("domain") != "").distinct()


def _where(df: DataFrame, col: str, needed, convert) -> DataFrame:
    """``col`` converted where ``needed``; the function sees null elsewhere."""
    c = F.col(col)
    return df.withColumn(col, F.coalesce(convert(F.when(needed, c)), c))


def to_ascii(df: DataFrame, col: str = "domain") -> DataFrame:
    """Punycode ``col`` where it holds non-ASCII characters."""
    return _where(df, col, F.col(col).rlike("[^\\x00-\\x7F]"), _to_ascii)


def to_unicode(df: DataFrame, col: str = "domain") -> DataFrame:
    """Decode punycode labels of ``col`` where it holds an ``xn--`` label."""
    return _where(df, col, F.lower(F.col(col)).contains("xn--"), _to_unicode)


def resolver_input(domains: DataFrame) -> DataFrame:
    """Distinct domains in ASCII form (``domain_ascii string``), one per line."""
    return to_ascii(domains.select("domain").distinct()).select(F.col("domain").alias("domain_ascii"))


def parse_resolutions(lines: DataFrame) -> DataFrame:
    """S13 over lines: ``domain [ip]`` → ``domain, ip``; a line not of two fields fails the job."""
    tok = pin(lines, keep=["value"], _t=F.array_remove(F.split("value", r"\s+"), ""))
    t = F.col("_t")
    ok = F.size(t) == 2
    parsed = (tok.where(F.when(~ok, F.raise_error(F.concat(F.lit("not 'domain [ip]': "), F.col("value"))))
                        .otherwise(F.lit(True)))
              .select(F.try_element_at(t, F.lit(1)).alias("domain"),
                      F.translate(F.try_element_at(t, F.lit(2)), "[]", "").alias("ip")))
    return to_unicode(parsed)


def read_resolutions(spark: SparkSession, paths) -> DataFrame:
    """Read resolver answer lines (blank lines skipped)."""
    return parse_resolutions(spark.read.text(paths).where(F.trim("value") != ""))
