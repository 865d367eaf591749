"""Continuous ingest: scanner captures landing in a folder flow into the inventory.

The same parse plan as the batch ``add`` runs on each micro-batch of new
files.  The stream's checkpoint records which files were taken; each
micro-batch commits to the inventory with the tag ``stream:<id>:<epoch>``, so
a micro-batch replayed after a failure (lost executor, restarted driver) is
not appended twice, and its quarantine partition is rewritten, not duplicated.  Lines that fail the port conversion go to a quarantine
table instead of stopping the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scanlake.sources.scanners import parse_lines, quarantine
from scanlake.store import Inventory, observations


def capture_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New files in ``landing_dir`` as lines with their file name (S1 as a stream)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(landing_dir).select(
        "value", F.col("_metadata.file_path").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"))


def start_ingest(spark: SparkSession, landing_dir: str, scanner: str, inventory: str, checkpoint: str,
                 quarantine_path: str | None = None, stream_id: str = "ingest",
                 available_now: bool = False, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; ``available_now=True`` processes what is there and stops."""
    inv = Inventory(spark, inventory)

    def each(batch: DataFrame, epoch: int) -> None:
        lines = batch.withColumn("row_id", F.monotonically_increasing_id())
        inv.append(observations(parse_lines(lines, scanner, mode="quarantine")),
                   op=f"stream:{stream_id}:{epoch}")
        if quarantine_path:
            # one partition per micro-batch, replaced (not appended) when a batch is replayed
            (quarantine(lines, scanner).withColumn("epoch", F.lit(epoch))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("epoch").parquet(quarantine_path))

    w = capture_stream(spark, landing_dir, max_files_per_trigger).writeStream.foreachBatch(each) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
