"""Domains of hosts.

Names are kept and joined in long form, one row per (address, domain), so an address with
millions of names spreads over many tasks.  Arrays are made where a listing prints them:
last, or, for the listings of rows (T4, T5), once per address before the rows get them.

Adding names (T4, T5) to the stored inventory writes what is new alone: a *delta* of
``ip, domain, upto`` rows says that an address's observations up to batch ``upto`` also
have that name.  ``host_names`` merges it on reading, so a rescan after it hides it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ADDED = 1 << 30             # place of a name that no row holds, behind all that one holds


def _empty():
    return F.array().cast("array<string>")


# ---------------------------------------------------------------------- A3
def host_names(df: DataFrame, delta: DataFrame | None = None, mode: str = "latest") -> DataFrame:
    """A3 in long form: ``ip, domain, k``, the names of each host's last inserted row (``mode="latest"``) or of all its
    rows (``"union"``), and those of ``delta``; ``k`` is a name's place in that row, order by ``k, domain``."""
    if mode not in ("latest", "union"):
        raise ValueError(mode)
    if mode == "union":
        own = df.select("ip", F.explode("domains").alias("domain"), F.lit(ADDED).alias("k"))
        last = df.groupBy("ip").agg(F.min("batch_id").alias("batch")) if delta is not None else None
    else:
        kept = F.struct("domains", "batch_id") if delta is not None else F.struct("domains")
        row = df.groupBy("ip").agg(F.max_by(kept, "seq").alias("r"))
        own = row.select("ip", F.posexplode("r.domains").alias("p", "domain")).select("ip", "domain", (F.col("p") + 1).alias("k"))
        last = row.select("ip", F.col("r.batch_id").alias("batch")) if delta is not None else None
    if delta is not None:
        added = delta.join(last, "ip").where("upto >= batch").select("ip", "domain", F.lit(ADDED).alias("k"))
        own = own.unionByName(added)
    return own.groupBy("ip", "domain").agg(F.min("k").alias("k"))


def listed_names(names: DataFrame) -> DataFrame:
    """``ip, domains`` for a listing: the names of ``host_names`` in their order."""
    rows = names.groupBy("ip").agg(F.array_sort(F.collect_list(F.struct("k", "domain"))).alias("s"))
    return rows.select("ip", F.transform("s", lambda x: x["domain"]).alias("domains"))


def latest_domains(df: DataFrame, mode: str = "latest", delta: DataFrame | None = None) -> DataFrame:
    """A3 as a listing: per ``ip``, the array of its names (see ``host_names``); empty for a host without any."""
    if mode == "latest" and delta is None:
        return df.groupBy("ip").agg(F.max_by("domains", "seq").alias("domains"))
    return df.select("ip").distinct().join(listed_names(host_names(df, delta, mode)), "ip", "left") \
        .select("ip", F.coalesce("domains", _empty()).alias("domains"))


# ---------------------------------------------------------------------- A4
def resolved_names(resolutions: DataFrame) -> DataFrame:
    """A4 in long form: distinct ``ip, domain``."""
    return resolutions.select("ip", "domain").distinct()


def domains_by_ip(resolutions: DataFrame) -> DataFrame:
    """A4 as a listing: ``ip, domains`` – the sorted set of domains resolved to each address."""
    return resolutions.groupBy("ip").agg(F.array_sort(F.collect_set("domain")).alias("domains"))


# ------------------------------------------------------------------ T4, T5
def gained_names(df: DataFrame, resolutions: DataFrame) -> DataFrame:
    """``seq, ip, domain``: the resolved names that a row's address has and the row lacks."""
    return df.select("seq", "ip", "domains").join(resolved_names(resolutions), "ip") \
        .where(~F.array_contains(F.coalesce("domains", _empty()), F.col("domain"))).select("seq", "ip", "domain")


def _with_resolved(df: DataFrame, resolutions: DataFrame, merged) -> DataFrame:
    """``domains`` merged with the names of the row's address.  A listing prints them in each of its rows, so they are
    joined as one array per address: a row is shuffled once and never multiplied by its names."""
    names = resolved_names(resolutions).groupBy("ip").agg(F.array_sort(F.collect_list("domain")).alias("_new"))
    return df.join(names, "ip", "left").withColumn("domains", F.when(F.col("_new").isNotNull(), merged(
        F.coalesce("domains", _empty()), F.col("_new"))).otherwise(F.col("domains"))).select(*df.columns)


def add_domains(df: DataFrame, resolutions: DataFrame) -> DataFrame:
    """T4 as a listing of rows: each row's names and, behind them, the resolved names it lacks."""
    out = _with_resolved(df, resolutions, lambda own, new: F.concat(own, F.array_except(new, own)))
    return out.withColumn("domains", F.coalesce("domains", _empty()))


def update_domains(df: DataFrame, resolutions: DataFrame) -> DataFrame:
    """T5 as a listing of rows: rows of a resolved address get the sorted union of their and the resolved names."""
    return _with_resolved(df, resolutions, lambda own, new: F.array_sort(F.array_union(own, new)))


# ---------------------------------------------------------------------- T6
def unmatched_domains(df: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Resolved domains none of whose addresses is in the inventory."""
    hosts = df.select("ip").distinct()
    hits = resolutions.join(hosts, "ip", "left_semi").select("domain").distinct()
    return resolutions.select("domain").distinct().join(hits, "domain", "left_anti")


def hosts_updated(df: DataFrame, resolutions: DataFrame) -> DataFrame:
    """A10: distinct inventory addresses that have a resolution (changed or not)."""
    res_ips = resolutions.select("ip").distinct()
    return df.select("ip").join(res_ips, "ip", "left_semi").agg(F.countDistinct("ip").alias("n_hosts"))


def host_domain_pairs(df: DataFrame, resolutions: DataFrame | None = None) -> DataFrame:
    """T5 in long form: distinct ``ip, domain`` pairs from the stored names, plus the
    resolved names of addresses in the inventory.  No row holds a list, so an address
    with millions of names spreads over many tasks."""
    stored = df.select("ip", F.explode("domains").alias("domain"))
    if resolutions is None:
        return stored.distinct()
    hosts = df.select("ip").distinct()
    resolved = resolutions.select("ip", "domain").join(hosts, "ip", "left_semi")
    return stored.unionByName(resolved).distinct()
