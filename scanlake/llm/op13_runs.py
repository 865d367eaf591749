"""Operator 13: periodic runs of words by dyadic square catching.

A run is a maximal stretch of words with smallest period q and at least
``max(6, 4 q)`` words.

* Level k has a catcher for each completed block of L = 2**k words that starts
  at a multiple of L.  It holds the block's hash and listens for periods L to
  2L - 1: as words are appended, the hash of the last L words is compared with
  the one catcher whose period range that window falls into.  A window's hash
  follows from those of its halves, so a word costs one comparison a level.
* A block seen again p words later, and the next block too, is a square of
  period p.  Every run holds such a pair for its period: its first block starts
  within L words of it, and four periods leave room for the second.
* The square's suffix comparisons go on word by word to both sides, on the words
  themselves, which settles the run (and drops what only hashes had equal).
  Later squares of the same run, and those of multiples of its period, lie in it
  and are merged; with a multiple of the smallest period a run has the same ends.

The appended words of a document are compared level by level as arrays.  Memory
is a few arrays of one document.

Defined cases: a null or blank text has no words and no run.  Repeated rows give
repeated results, a null doc_id stays null.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import collections

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.llm.blocks import mix

LEAST_WORDS = 6
LEAST_POWERS = 4
U = np.uint64

RUN = "struct<start: bigint, length: bigint, period: bigint>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


def numbered(words: list[bytes]) -> np.ndarray:
    """Each word's number: that of its first occurrence among the distinct words."""
    seen: collections.defaultdict = collections.defaultdict()
    seen.default_factory = seen.__len__
    return np.fromiter(map(seen.__getitem__, words), np.int64, len(words))


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements agree; compared in stretches that double."""
    n, at, step = min(len(a), len(b)), 0, 32
    while at < n:
        differ = a[at: at + step][: n - at] != b[at: at + step][: n - at]
        if differ.any():
            return at + int(differ.argmax())
        at += step
        step *= 2
    return n


def squares(h: np.ndarray, size: int) -> np.ndarray:
    """Ends of windows whose catcher, and then the next one, sees its block again: first of each chain, as window starts."""
    j = np.arange(size, len(h))
    seen = h[size:] == h[(j // size - 1) * size]
    chain = seen[:-size] & seen[size:]                      # block i, and block i + size, both p later
    chain[size:] &= ~seen[: max(0, len(chain) - size)]      # the block before belongs to the same chain
    return j[: len(chain)][chain]


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    n, size = len(ids), 1
    found: dict[tuple[int, int], int] = {}
    h = mix(ids.astype(U) + U(1))
    while n >= LEAST_WORDS and LEAST_POWERS * size <= n:
        known = np.array([(s, e, q) for (s, e), q in found.items()], np.int64).reshape(-1, 3).T     # of shorter periods
        for j in squares(h, size).tolist():
            i = (j // size - 1) * size
            p = j - i
            if ((known[0] <= i) & (known[1] >= j + size) & (p % known[2] == 0)).any():
                continue
            end = j + _agree(ids[i:], ids[j:])
            start = i - _agree(ids[:i][::-1], ids[:j][::-1])
            if end - start >= max(LEAST_WORDS, LEAST_POWERS * p):
                found[start, end] = min(p, found.get((start, end), p))
        h = mix(h[:-size] * U(0x9E3779B97F4A7C15) + h[size:])
        size *= 2
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period: start + length] = False
    return b" ".join(w for w, k in zip(words, keep.tolist()) if k)


def _find(batches):
    for batch in batches:
        texts = batch["text"].cast(pa.binary())
        for at in range(0, len(texts), 64):                 # what goes back at a time: collapsed texts are as long as texts
            part = batch.slice(at, 64)
            cols = {f.name: [] for f in _OUT}
            cols["doc_id"] = part["doc_id"]
            for text in texts.slice(at, 64):
                words = (text.as_py() or b"").split()       # bytes split at space and 0x09-0x0D
                runs = runs_of(numbered(words))
                cols["n_words"].append(len(words))
                cols["runs"].append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                cols["collapsed"].append(collapsed(words, runs).decode())
            yield pa.record_batch([pa.array(cols[f.name], f.type) if isinstance(cols[f.name], list) else cols[f.name]
                                   for f in _OUT], schema=_OUT)


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (by start, then period), collapsed (text without the repetitions): one row per row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_find, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def with_loops(docs: DataFrame) -> DataFrame:
    """The query's input: with h = crc32(doc_id), words of documents with h % 10 = 0 repeat from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = docs.select("doc_id", "text", (h % 10 == 0).alias("looped"), g.alias("g"), F.when(
        h % 10 == 0, F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")).alias("w"))
    n = F.size("w")
    sized = words.withColumn("n", n).withColumn("a", F.expr("if(n > 0, g % n, 0)")) \
        .withColumn("p", F.expr("1 + floor((n - a) / (3 + g % 8))"))
    looped = F.expr("array_join(transform(sequence(0, n - 1), i -> w[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    return sized.select("doc_id", F.when(F.coalesce("looped", F.lit(False)) & (F.col("n") > 0), looped)
                        .otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """One row per row of ``find_runs``: the run of greatest exponent, and digests of all runs and of what is left."""
    power = F.array_sort("runs", lambda a, b: F.when(a["length"] * b["period"] > b["length"] * a["period"], -1)
                         .when(a["length"] * b["period"] < b["length"] * a["period"], 1)
                         .when(a["start"] != b["start"], F.signum(a["start"] - b["start"]).cast("int"))
                         .otherwise(F.signum(a["period"] - b["period"]).cast("int")))
    best = found.withColumn("best", F.get(power, F.lit(0)))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    all_lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(all_lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(find_runs(with_loops(spark.read.parquet(f"{sf_dir}/documents.parquet"))))
