"""Written intermediate tables, marks by number, and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.session import new_path


def written(df: DataFrame, kind: str, *partition: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and no lineage to lose with an executor."""
    path = new_path(df.sparkSession, f"llm_{kind}")
    df.write.partitionBy(*partition).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables of ``written`` whose successors are written; nothing may read them any more."""
    for t in tables:
        jvm = t.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.written_to)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


SHIFT = 15              # 1 << SHIFT numbers are one of Spark's bitmaps, of 4 KB
HELD = 64 << 20         # bytes of bitmaps that each executor may hold


def marked(df: DataFrame, number: str, marks: DataFrame, name: str) -> DataFrame:
    """``df`` with ``name``: whether the row's ``number`` (long, 0 or more) is one of ``marks``, a table of one column.

    A number is one bit, so bitmaps of up to ``HELD`` bytes (about 500 million dense numbers) are held by each executor
    and wide rows stay where they are read.  Beyond that rows meet the bitmaps by a join.  Marks are dealt by bitmap
    before they are put into it, so no task sends a bitmap of a few marks.
    """
    free = "bitmap"
    while any(c.lower().startswith(free) for c in df.columns):
        free += "_"
    bucket, bits = f"{free}_bucket", f"{free}_bits"
    low = F.lit((1 << SHIFT) - 1)
    of = F.col(marks.columns[0])
    maps = written(marks.select(F.shiftright(of, SHIFT).alias(bucket), of.bitwiseAND(low).alias("at")).repartition(bucket)
                   .groupBy(bucket).agg(F.bitmap_construct_agg("at").alias(bits)), "bitmaps")
    if maps.count() << SHIFT - 3 <= HELD:
        maps = F.broadcast(maps)
    at = F.col(number).bitwiseAND(low)
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    has = byte.bitwiseAND(F.expr(f"shiftleft(1, cast(`{number}` & 7 as int))")) != 0
    return df.withColumn(bucket, F.shiftright(F.col(number), SHIFT)).join(maps, bucket, "left") \
        .withColumn(name, F.coalesce(has, F.lit(False))).drop(bucket, bits)


def components(edges: DataFrame) -> DataFrame:
    """(node, component, ...) of the undirected graph with edges (a, b): the least node it reaches.

    Each round takes the least label among a node's neighbours and then the
    label of that label, so a path of n nodes needs about log n rounds.  Labels
    are written once a round; only a count comes to the driver.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    label = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component"))
                    .select(F.col("a").alias("node"), "component"), "labels")
    while True:
        near = both.join(label.select(F.col("node").alias("b"), "component"), "b") \
            .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        step = label.join(near, "node").select("node", F.col("component").alias("was"),
                                               F.least("component", "near").alias("now"))
        jump = step.select(F.col("node").alias("now"), F.col("now").alias("next"))
        new = written(step.join(jump, "now").select(
            "node", "was", F.least("now", "next").alias("component")), "labels")
        dropped(label)
        label = new
        if new.filter("component < was").isEmpty():
            dropped(both)
            return new
