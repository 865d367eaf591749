"""Session helpers: a tuned local session for tests/bench and the scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "scanlake") -> SparkSession:
    """Session used by tests and ``bench.py``.  On a cluster, use the cluster's own."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Settings for a large cluster (100 TB of captures and reports).  They are
# advice for the cluster's own session, never forced by the library.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",   # shuffle output per task
    "spark.sql.adaptive.skewJoin.enabled": "true",                # split a hot address's partition
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.shuffle.partitions": "8000",                       # upper bound; AQE coalesces
    "spark.sql.files.maxPartitionBytes": "256m",                  # capture splits per task
    "spark.sql.files.openCostInBytes": "1m",                      # many small report files per task
    "spark.sql.autoBroadcastJoinThreshold": "64m",                # the only size gate for broadcasts
    "spark.sql.parquet.compression.codec": "zstd",
}


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``; only when it is unset (tests,
    a bare local session) a folder of our own is created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect: no SparkContext on the client
            d = None
    if not d:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="scanlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        try:
            spark.sparkContext.setCheckpointDir(d)
        except Exception:  # Spark Connect
            pass
    return d.rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system the session uses; its errors are not taken for absence."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def new_path(spark: SparkSession, kind: str) -> str:
    """A fresh, never reused location below the scratch folder."""
    return f"{scratch_dir(spark)}/scanlake/{kind}/{uuid.uuid4().hex}"


def materialized(df: DataFrame, kind: str) -> DataFrame:
    """``df`` as a Parquet table below the scratch folder: computed once, the same in every later pass."""
    path = new_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
