"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Every stage but the last returns the columns of its input and sees all rows its
predecessor kept:

toxicity     documents scored 1/2 or more go
near_copies  of each group of linked documents the row with the least id (nulls last) stays
benchmark    documents that hold a benchmark item go
pii          found spans are replaced by ``[kind]``; n_chars follows the text
packing      what is left, tokenised and packed into sequences

near_copies decides by row: copies without a doc_id or under one id go too.  Rows
without words are linked with none; those that repeat an id and its text count
as one document.  Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.llm import op3_toxicity, op5_pii, op7_decontaminate, op8_pack, op10_jaccard_join
from scanlake.llm.components import marked, written


def _unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = op3_toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    column = _unused(docs, "toxicity")
    scored = op3_toxicity.score(docs, model, column)
    return scored.filter(F.col(column)["score"] < 0.5).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    column = _unused(docs, "row")
    numbered = docs.withColumn(column, F.monotonically_increasing_id())     # of a written table: the same in every pass
    groups = op10_jaccard_join.jaccard_components(numbered.select("doc_id", "text", F.col(column).alias("row")), row=True)
    # no words: linked with nothing, but what repeats an id and its text is one document
    blank = numbered.filter("doc_id is not null").filter(F.coalesce("text", F.lit("")).rlike(r"^[\x20\x09-\x0D]*+$")) \
        .select(F.col(column).alias("row"), F.struct("doc_id", "text").alias("same"))
    first = blank.groupBy("same").agg(F.min("row").alias("first"))
    again = blank.join(first, blank["same"].eqNullSafe(first["same"])).filter("row > first").select("row")
    gone = groups.filter("not stays").select("row").union(again)
    mark = _unused(numbered, "gone")
    return marked(numbered, column, gone, mark).filter(~F.col(mark)).select(docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    column = _unused(docs, "matches")
    found = op7_decontaminate.search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), column)
    return found.filter(F.size(column) == 0).select(docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op5_pii.redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op8_pack.pack_documents(docs)


STAGES = [("toxicity", toxicity), ("near_copies", near_copies), ("benchmark", benchmark), ("pii", pii), ("packing", packing)]

ORACLE_SQL = None       # no SQL for a learned field, a latent space or a tokenizer; tests compare each stage with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
