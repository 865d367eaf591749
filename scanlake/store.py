"""The observation inventory: folders of plain Parquet.

Layout under ``root``::

    v=<N>/batch_id=<B>/part=<name>/*.parquet     observations of version N
    names/v=<N>/part=<name>/*.parquet            names added later: ip, domain, upto (a batch id)

Appending (T1) writes one more part to the greatest version, replacing (T2) the first part of the
next.  A part is one Spark write into a folder of its own: Spark's committer makes it visible as a whole, a
failed write leaves nothing to read, and appends that run at the same time are all kept (they
may share a batch id).  Adding names (T4, T5) writes those names alone, never the
observations.  Files are sorted by ``ip_num`` so that Parquet's statistics prune address ranges.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.functions.ip import ip_num
from scanlake.schema import OBSERVATION
from scanlake.session import path_exists
from scanlake.sources.scanners import parse_lines, read_scan_lines

_COLUMNS = ["seq", "ip", "ip_num", "port", "domains", "source_file"]
_NAMES = "ip string, domain string, upto long"


def observations(lines_parsed: DataFrame) -> DataFrame:
    """Parsed lines (with S1 position columns) → observation rows without a batch id."""
    cols = lines_parsed.columns
    fname = F.col("file_name") if "file_name" in cols else F.lit(None).cast("string")
    block = F.col("block_start") if "block_start" in cols else F.lit(0).cast("bigint")
    rid = F.col("row_id") if "row_id" in cols else F.monotonically_increasing_id()
    dom = F.col("domains") if "domains" in cols else F.array().cast("array<string>")
    return lines_parsed.select(
        F.struct(F.lit(None).cast("bigint").alias("batch_id"), fname.alias("file_name"),
                 block.alias("block_start"), rid.alias("row_id")).alias("seq"),
        F.col("ip"), ip_num("ip").alias("ip_num"), F.col("port").cast("int").alias("port"),
        dom.alias("domains"), fname.alias("source_file"))


def ingest(spark: SparkSession, paths, scanner: str, mode: str = "strict") -> DataFrame:
    """Read captured output of ``scanner`` and parse it into observations (S1 + S2..S10)."""
    return observations(parse_lines(read_scan_lines(spark, paths), scanner, mode))


class Inventory:
    """One named inventory."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _parts(self) -> list[tuple[int, int, str]]:
        """(version, batch id, name) of the parts written to their end: a listing of folders, no job."""
        jvm = self.spark.sparkContext._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.root}/v=*/batch_id=*/part=*/_SUCCESS")
        fs = pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        listed = " ".join(f.getPath().toString() for f in fs.globStatus(pattern) or [])
        return [(int(v), int(b), name) for v, b, name in re.findall(r"/v=(\d+)/batch_id=(\d+)/part=([^/]*)/_SUCCESS", listed)]

    def _state(self):
        """(current version, next batch id)."""
        parts = self._parts()
        return max((v for v, _, _ in parts), default=None), max((b for _, b, _ in parts), default=0) + 1

    def version(self) -> int | None:
        return self._state()[0]

    def read(self) -> DataFrame:
        """Observations of the current version (empty when none)."""
        v, _ = self._state()
        if v is None:
            return self.spark.createDataFrame([], OBSERVATION).select(*_COLUMNS, "batch_id")
        # the declared schema, so a capture without a matching line reads as no rows
        return self.spark.read.schema(OBSERVATION).parquet(f"{self.root}/v={v}").select(*_COLUMNS, "batch_id")

    def names(self) -> DataFrame:
        """Names added later: ``ip, domain, upto``."""
        folder = f"{self.root}/names/v={self._state()[0]}"
        if not path_exists(self.spark, folder):
            return self.spark.createDataFrame([], _NAMES)
        return self.spark.read.schema(_NAMES).parquet(folder).select("ip", "domain", "upto")

    def append(self, obs: DataFrame, replace: bool = False, op: str | None = None) -> int:
        """T1 (append) or T2 (``replace=True``: the new batch becomes the whole table); returns the batch id.

        ``op`` names the part: an append whose name is there already is skipped and returns -1, and one that did not
        come to its end is written anew.
        """
        name = re.sub("[^A-Za-z0-9]+", "-", op) if op else uuid.uuid4().hex
        if op and name in {p for _, _, p in self._parts()}:
            return -1
        v, b = self._state()
        version = 1 if v is None else v + bool(replace)
        (obs.withColumn("seq", F.col("seq").withField("batch_id", F.lit(b).cast("bigint"))).select(*_COLUMNS)
         .sortWithinPartitions("ip_num").write.mode("overwrite").parquet(f"{self.root}/v={version}/batch_id={b}/part={name}"))
        return b

    def add_names(self, names: DataFrame) -> None:
        """T4, T5: the addresses of ``names`` (distinct ``ip, domain``) have these names too, in all batches so far."""
        v, b = self._state()
        (names.select("ip", "domain").withColumn("upto", F.lit(b - 1).cast("bigint"))
         .write.parquet(f"{self.root}/names/v={v}/part={uuid.uuid4().hex}"))


def add_scan(spark: SparkSession, inv: Inventory, paths, scanner: str, rm: bool = False,
             mode: str = "strict") -> tuple[int, int]:
    """``add``: parse a capture into the inventory; returns (batch id, hosts added) (T1/T2 + A5)."""
    obs = ingest(spark, paths, scanner, mode)
    batch = inv.append(obs, replace=rm)
    return batch, _hosts(inv, batch)


def _hosts(inv: Inventory, batch: int) -> int:
    return inv.read().where(F.col("batch_id") == batch).agg(F.countDistinct("ip")).first()[0]


def create_generic(spark: SparkSession, inv: Inventory, scan_paths, resolution_paths=None) -> int:
    """A strict ``ip:port`` capture replaces the inventory, and resolved domains become its names.

    Every line must be ``ip:port``; any other line fails the job.  Returns the
    number of distinct hosts (A5).
    """
    from scanlake.operators.domains import resolved_names
    from scanlake.sources.domains import read_resolutions

    lines = read_scan_lines(spark, scan_paths)
    p = F.split(F.col("value"), ":", -1)
    port = F.try_element_at(p, F.lit(2)).try_cast("int")
    bad = (F.size(p) != 2) | port.isNull()
    # the check is a filter so that column pruning can never drop it
    parsed = (lines.where(F.when(bad, F.raise_error(F.concat(F.lit("not ip:port: "), F.col("value"))))
                          .otherwise(F.lit(True)))
              .select("*", F.try_element_at(p, F.lit(1)).alias("ip"), port.alias("port")))
    batch = inv.append(observations(parsed), replace=True)
    if resolution_paths is not None:
        inv.add_names(resolved_names(read_resolutions(spark, resolution_paths)))
    return _hosts(inv, batch)
