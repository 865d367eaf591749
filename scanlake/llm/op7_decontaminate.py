"""Operator 7: benchmark decontamination by latent semantic retrieval.

1. Document frequencies of the benchmark's words are counted over all documents.
2. Terms are the benchmark's rarer words (``COMMON`` and less of the documents),
   and of each item its ``LEAST_TERMS`` rarest ones in any case.  A randomised
   SVD of TF-IDF passages (the items, and all passages of all documents) gives
   the latent space: a scan writes the passages' term counts once, products
   X'(X Q) of them are summed over Spark tasks; the matrices on the driver are
   terms x ``RANK``.
3. Every document is searched whole: a window begins at each term, holds another
   one and is as long as the items of a length class; windows whose latent cosine
   with an item is at least ``COSINE`` are candidates.  Items of one word are a
   class of their own, whose windows are single terms.
4. A candidate's words around the window are compared with the item's: the
   longest common subsequence must hold ``LCS`` of the item, or ``LCS_ANSWER``
   if also the answer (the last quarter of the item) is there in order.

The benchmark is the stated query set.  It is read in slices of ``SLICE`` items,
each searched against all documents, so what tasks are sent has a bound.

Defined cases: null or empty texts and items match nothing; repeated rows match
each by its own text; a null doc_id is searched like any other; without
documents or items there are no rows.  Only doc_id, text, item_id are read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.llm import blocks as B
from scanlake.llm.components import dropped, written
from scanlake.llm.op3_toxicity import GAP

SLICE = 5000
COMMON = 0.02
LEAST_TERMS = 8
RANK = 128
POWER = 2                       # products X'(X Q) of the range finder
FIT_WORDS = 64                  # words of a passage that the space is fitted on
ITEM_WEIGHT = 10.0              # of an item's row against a passage's: the space has to tell the items apart,
ITEM_DOCUMENTS = 4000           # of so many documents: more of them weigh together as these, or the items were lost among them
_SUMMED = 4                     # terms of a product in a row
COSINE = 0.4
LCS = 0.6
LCS_ANSWER = 0.45
ANSWER = 0.25                   # of an item's words, at its end
ANSWER_LCS = 0.8
U = np.uint64
_BITS = 20                      # of a hash, for a first look whether a word can be a term


def word_hashes(dat: np.ndarray, off: np.ndarray):
    start, end, doc = B.words(dat, off, GAP)
    return B.span_hash(B.prefix_hash(dat, B.FOLD), start, end), doc


def of_texts(texts: list[str]) -> list[np.ndarray]:
    data = [t.encode() for t in texts]
    off = np.append(0, np.cumsum([len(d) for d in data])).astype(np.int64)
    h, doc = word_hashes(np.frombuffer(b"".join(data), np.uint8), off)
    return np.split(h, np.searchsorted(doc, np.arange(1, len(texts))))


class Terms:
    """Sorted term hashes with a bit table in front."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[(hashes >> U(64 - _BITS)).astype(np.int64)] = True

    def find(self, h: np.ndarray):
        """Positions in ``h`` that are terms, and which."""
        at = np.flatnonzero(self.maybe[(h >> U(64 - _BITS)).astype(np.int64)])
        if not len(at):
            return at, at
        k = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        hit = self.hashes[k] == h[at]
        return at[hit], k[hit]


def document_counts(docs: DataFrame, terms: Terms) -> tuple[np.ndarray, int]:
    """Documents that have each term, and all documents."""
    m = len(terms.hashes)

    def count(batches):
        df, n = np.zeros(m, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, dat, off in B.chunks(batch["text"]):
                h, doc = word_hashes(dat, off)
                at, k = terms.find(h)
                df += np.bincount(np.unique(doc[at] * m + k) % m, minlength=m)
        hit = np.flatnonzero(df)
        yield pa.record_batch({"term": np.append(hit, -1), "df": np.append(df[hit], n)})

    rows = docs.select("text").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(m + 1, np.int64)
    for r in rows:
        df[r.term] = r.df
    return df[:m], int(df[m])


def _cells(k: np.ndarray, row: np.ndarray, m: int):
    """Row, term and count of the distinct cells, ordered by row."""
    cell, n = np.unique(row * m + k, return_counts=True)
    return cell // m, cell % m, n


def _product(row: np.ndarray, term: np.ndarray, n: np.ndarray, idf: np.ndarray, q: np.ndarray) -> np.ndarray:
    """X'(X q) of the TF-IDF rows (length one) with these cells."""
    z = np.zeros((len(idf), q.shape[1]))
    if not len(row):
        return z
    v = (1 + np.log(n)) * idf[term]
    first = np.flatnonzero(np.diff(row, prepend=-1))
    of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(row))))
    v /= np.sqrt(np.add.reduceat(v * v, first))[of]
    y = np.add.reduceat(v[:, None] * q[term], first)
    order = np.argsort(term, kind="stable")
    first = np.flatnonzero(np.diff(term[order], prepend=-1))
    z[term[order][first]] = np.add.reduceat((v[:, None] * y[of])[order], first)
    return z


def passages(docs: DataFrame, terms: Terms) -> DataFrame:
    """Cells (row, term, n: packed int32) of all documents' passages, a part of a batch in each row."""
    m = len(terms.hashes)

    def run(batches):
        for batch in batches:
            for _, dat, off in B.chunks(batch["text"]):
                h, doc = word_hashes(dat, off)
                at, k = terms.find(h)
                if len(at):
                    first = np.searchsorted(doc, np.arange(len(off) - 1))
                    _, row = np.unique(doc[at] * len(h) + (at - first[doc[at]]) // FIT_WORDS, return_inverse=True)
                    cells = _cells(k, row, m)
                    yield pa.record_batch({c: pa.array([x.astype(np.int32).tobytes()], pa.binary())
                                           for c, x in zip(("row", "term", "n"), cells)})

    return docs.select("text").mapInArrow(run, "row binary, term binary, n binary")


def latent_space(docs: DataFrame, n_docs: int, terms: Terms, idf: np.ndarray, items: list[np.ndarray]) -> np.ndarray:
    """Orthonormal basis (terms x rank) of the leading subspace of the items and all passages of all documents."""
    m = len(idf)
    rank = min(RANK, m)
    cells = written(passages(docs, terms), "passages")
    item_rows = [terms.find(h)[1] for h in items]
    own = _cells(np.concatenate(item_rows), np.repeat(np.arange(len(items)), [len(x) for x in item_rows]), m)
    q = np.random.default_rng(7).standard_normal((m, rank))
    for _ in range(POWER):
        now = q

        def product(batches):
            z = np.zeros((m, rank))
            for batch in batches:
                for packed in zip(*(batch[c].to_pylist() for c in ("row", "term", "n"))):
                    z += _product(*(np.frombuffer(x, np.int32) for x in packed), idf, now)
            at = np.unique(np.flatnonzero(z.any(1)) // _SUMMED)
            yield pa.record_batch({"at": pa.array(at, pa.int64()),
                                   "z": pa.array([z[a * _SUMMED: (a + 1) * _SUMMED].tobytes() for a in at], pa.binary())})

        def add(batches):
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for a, z in zip(batch["at"].to_pylist(), batch["z"].to_pylist()):
                    sums[a] = sums.get(a, 0) + np.frombuffer(z)
            yield pa.record_batch({"at": pa.array(list(sums), pa.int64()),
                                   "z": pa.array([z.tobytes() for z in sums.values()], pa.binary())})

        # the tasks' matrices are summed by terms, so the driver gets one
        sums = cells.mapInArrow(product, "at long, z binary").repartition(8, "at").mapInArrow(add, "at long, z binary").collect()
        z = np.zeros((m, rank))
        for r in sums:
            z[r["at"] * _SUMMED: (r["at"] + 1) * _SUMMED] = np.frombuffer(r["z"]).reshape(-1, rank)
        q, _ = np.linalg.qr(min(1.0, ITEM_DOCUMENTS / max(1, n_docs)) * z + ITEM_WEIGHT * _product(*own, idf, q))
    dropped(cells)
    return q


def common(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, with the rows of the table as bits of a number."""
    at: dict[int, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        u = v & at.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def same_passage(item: list[int], near: list[int]) -> tuple[float, bool]:
    """Share of the item in the longest common subsequence, and whether its answer is there."""
    n = len(item)
    tail = item[n - max(1, int(np.ceil(n * ANSWER))):]
    return common(item, near) / n, common(tail, near) >= ANSWER_LCS * len(tail)


class Index:
    """Items in the latent space, by length class."""

    def __init__(self, ids: list, items: list[np.ndarray], terms: Terms, idf: np.ndarray, basis: np.ndarray):
        self.ids, self.items, self.terms = ids, items, terms
        self.vectors = (idf[:, None] * basis).astype(np.float32)        # of one occurrence of a term
        self.bags = [Counter(h.tolist()) for h in items]
        self.classes: list[tuple[int, int, np.ndarray, np.ndarray]] = []    # words and terms of a window, items, their vectors
        vec = np.zeros((len(items), basis.shape[1]), np.float32)
        for i, h in enumerate(items):
            _, k = terms.find(h)
            vec[i] = self.vectors[np.unique(k)].sum(0)
        norm = np.sqrt((vec * vec).sum(1, keepdims=True))
        vec /= np.maximum(norm, 1e-9)
        sizes = np.array([len(h) for h in items])
        below, size = 0, 1
        while len(sizes) and below < sizes.max():
            own = np.flatnonzero((sizes <= size) & (sizes > below) & (norm[:, 0] > 1e-9))
            if len(own):
                self.classes.append((size + size // 8, min(size, 2), own, vec[own]))
            below, size = size, max(16, size * 3 // 2)

    def search(self, dat: np.ndarray, off: np.ndarray) -> list[dict]:
        """Matches of each document: {item: (cosine, lcs, answer)}."""
        h, doc = word_hashes(dat, off)
        out: list[dict] = [{} for _ in range(len(off) - 1)]
        at, k = self.terms.find(h)
        if not len(at):
            return out
        first = np.searchsorted(doc, np.arange(len(off))).tolist()
        words = h.tolist()
        after = np.array(first, np.int64)[doc[at] + 1]
        sums = np.zeros((len(at) + 1, self.vectors.shape[1]), np.float64)
        np.cumsum(self.vectors[k], axis=0, out=sums[1:])
        for length, least, own, vec in self.classes:
            end = np.searchsorted(at, np.minimum(at + length, after))
            start = np.flatnonzero(end - np.arange(len(at)) >= least)
            bins: dict[tuple[int, int, int], list[tuple[int, float]]] = {}
            for s in range(0, len(start), 8192):
                w = start[s: s + 8192]
                v = (sums[end[w]] - sums[w]).astype(np.float32)
                v /= np.maximum(np.sqrt((v * v).sum(1, keepdims=True)), 1e-9)
                cos = v @ vec.T
                for r, c in zip(*np.nonzero(cos >= COSINE)):
                    p = int(at[w[r]])
                    bins.setdefault((int(doc[p]), int(own[c]), p // max(1, length // 2)), []).append((p, float(cos[r, c])))
            for (d, item, _), windows in bins.items():
                self._check(words, first[d], first[d + 1], windows, length, item, out[d])
        return out

    def _check(self, words, begin, end, windows, length, item, out):
        """Compares the words around windows that begin within half a window of each other; the best one stands for them.

        What all of them cover bounds each, so most bins cost one comparison.
        """
        own, bag = self.items[item].tolist(), self.bags[item]
        around = lambda p, q: words[max(begin, p - length // 2): min(end, q + length)]
        near = around(windows[0][0], windows[-1][0])
        if sum(map(bag.__getitem__, bag.keys() & set(near))) < min(LCS, LCS_ANSWER) * len(own):
            return                                        # not even that many words are there, in any order
        share, answer = same_passage(own, near)
        if not (share >= LCS or (share >= LCS_ANSWER and answer)):
            return
        bound = share
        for p, cos in windows:
            share, answer = same_passage(own, around(p, p))
            if share >= LCS or (share >= LCS_ANSWER and answer):
                had = out.get(item)
                if had is None or share > had[1]:
                    out[item] = (cos, share, answer)
                if share == bound:
                    return                                # no other has more


def build(docs: DataFrame, ids: list, texts: list[str]) -> Index | None:
    items = of_texts(texts)
    keep = [i for i, h in enumerate(items) if len(h)]
    ids, items = [ids[i] for i in keep], [items[i] for i in keep]
    if not items:
        return None
    every = Terms(np.unique(np.concatenate(items)))
    df, n = document_counts(docs, every)
    idf = np.log((n + 1) / (df + 1)) + 0.1
    chosen = df <= COMMON * n
    for h in items:
        _, k = every.find(np.unique(h))
        chosen[k[np.argsort(-idf[k], kind="stable")[:LEAST_TERMS]]] = True
    terms, idf = Terms(every.hashes[chosen]), idf[chosen]
    return Index(ids, items, terms, idf, latent_space(docs, n, terms, idf, items))


RESULT = "array<struct<item_id: long, cosine: double, lcs: double, answer: boolean>>"
_MATCHES = pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs", pa.float64()), ("answer", pa.bool_())]))


def search(docs: DataFrame, benchmark: DataFrame, column: str = "matches") -> DataFrame:
    """``docs`` with the benchmark items that each document holds added; no shuffle."""
    if column in docs.columns:
        raise ValueError(f"documents already have a column {column}")
    n = benchmark.count()
    slices = max(1, -(-n // SLICE))
    out = docs
    for k in range(slices):
        part = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")) \
            .filter(f"pmod(xxhash64(item_id, text), {slices}) = {k}").orderBy("item_id", "text").collect()
        index = build(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), [r.item_id for r in part], [r.text for r in part])
        out = _searched(out, index, column, k > 0)
    return out


def _searched(docs: DataFrame, index: Index | None, column: str, more: bool) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = []
            for _, dat, off in B.chunks(batch["text"]):
                if index is None:
                    found += [[]] * (len(off) - 1)
                    continue
                found += [[{"item_id": index.ids[i], "cosine": c, "lcs": s, "answer": bool(a)} for i, (c, s, a) in sorted(m.items())]
                          for m in index.search(dat, off)]
            names, columns = list(batch.schema.names), list(batch.columns)
            if more:
                found = [a + b for a, b in zip(columns.pop(names.index(column)).to_pylist(), found)]
                names.remove(column)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, _MATCHES)], names=[*names, column])

    plain = docs.drop(column) if more else docs
    return docs.mapInArrow(run, plain.withColumn(column, F.lit(None).cast(RESULT)).schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that it holds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.item_id", "m.cosine", "m.lcs", "m.answer")
