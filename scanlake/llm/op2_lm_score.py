"""Operator 2: language-model scores by deleted interpolation.

    P(w | v) = l2(b) c(v w) / c(v) + l1(b) c(w) / N + l0(b) / (V + 1),   b the bucket of c(v)

Counts come from all training documents (crc32(doc_id as text) mod 5 is not 1).
The weights of each context-frequency bucket are learned by
expectation-maximisation: part of the training documents (remainder 4) is
deleted from the counts, and its tokens are explained with the counts of the
rest.  Every iteration is a Spark aggregate; the driver sees three sums a
bucket.

Counting: blocks of documents send their distinct words and word pairs with
counts to buckets of the hash space, which answer with the corpus' counts
(``blocks``).  No count is dropped and no vocabulary is held in one place.

Defined cases: null text is empty (one token: the end); a null id counts as the
empty text, so it trains; repeated rows count each time; with no training
document all probabilities are uniform.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.llm import blocks as B
from scanlake.llm.components import written

ITERATIONS = 8
BUCKETS = 20                    # 0: unseen context, b: 2**(b-1) <= c(v) < 2**b, the last has all above
HELD_OUT, DELETED = 1, 4        # remainders of crc32(doc_id) mod 5
REMAINDER = "cast(crc32(coalesce(cast(doc_id as string), '')) % 5 as int) as fold"
CUT = np.uint64(8)              # low bits of a hash that aren't sent
U = np.uint64
START, END = U(0x243F6A8885A308D3), U(0x13198A2E03707345)

_ASK = pa.schema([("bucket", pa.int32()), ("blk", pa.int32()), ("keys", pa.binary()), ("all", pa.binary()),
                  ("gone", pa.binary())])
_TELL = pa.schema([("blk", pa.int32()), ("bucket", pa.int32()), ("all", pa.binary()), ("gone", pa.binary()),
                   ("v_all", pa.int64()), ("v_kept", pa.int64())])
_STATS = pa.schema([("kind", pa.string()), ("doc_id", pa.int64()), ("fold", pa.int32()), ("n_tokens", pa.int64()),
                    ("n_known", pa.int64()), ("logs", pa.float64()), ("counts", pa.binary()), ("v_all", pa.int64()),
                    ("v_kept", pa.int64())])
_TYPES = {pa.int32(): "int", pa.int64(): "long", pa.float64(): "double", pa.string(): "string", pa.binary(): "binary"}


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"`{f.name}` {_TYPES[f.type]}" for f in schema)


def tokens(dat: np.ndarray, off: np.ndarray):
    """Hashes of each token and of the pair it forms with the one before, and each document's first token.

    Word hashes are odd, pair hashes even (after ``CUT``).
    """
    start, end, doc = B.words(dat, off)
    h = B.span_hash(B.prefix_hash(dat, B.FOLD), start, end)
    n_docs = len(off) - 1
    n = np.bincount(doc, minlength=n_docs) + 1
    first = np.cumsum(n) - n
    tok = np.full(int(n.sum()), END, U)
    tok[np.arange(len(h)) + doc] = h
    before = np.empty_like(tok)
    before[1:] = tok[:-1]
    before[first] = START
    pair = B.mix(before * U(0x9FB21C651E98DF25) + tok)
    return (tok >> CUT) | U(1), (pair >> CUT) & ~U(1), first, n


def _runs(table: pa.Table):
    return [tokens(dat, off) for _, dat, off in B.chunked(table["text"])]


def _ask(nb: int):
    edges = B.bounds(nb) >> CUT

    def ask(table: pa.Table) -> pa.Table:
        table = B.block_rows(table)
        fold = table["fold"].to_numpy()
        out = {f.name: [] for f in _ASK}
        found, i = [], 0
        for tok, pair, first, n in _runs(table):
            f = np.repeat(fold[i: i + len(n)], n)
            i += len(n)
            for x in (tok, pair):
                keys, place = np.unique(x, return_inverse=True)
                found.append((keys, np.bincount(place, weights=f != HELD_OUT),
                              np.bincount(place, weights=f == DELETED)))
        keys, place = B.merged([k for k, _, _ in found])
        total = np.bincount(place, weights=np.concatenate([a for _, a, _ in found])).astype(np.int64)
        gone = np.bincount(place, weights=np.concatenate([k for _, _, k in found])).astype(np.int64)
        cut = np.append(np.searchsorted(keys, edges), len(keys))
        for k in np.flatnonzero(np.diff(cut)):
            s = slice(cut[k], cut[k + 1])
            for name, v in zip(out, (k, table["blk"][0].as_py(), B.pack_keys(keys[s], edges[k]),
                                     B.pack_counts(total[s]), B.pack_counts(gone[s]))):
                out[name].append(v)
        return B.rows_table(_ASK, out)

    return ask


def _tell(nb: int):
    edges = B.bounds(nb) >> CUT

    def tell(table: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        rows = table.to_pylist()
        keys = [B.unpack_keys(r["keys"], edges[r["bucket"]]) for r in rows]
        u, place = B.merged(keys)
        cut = np.cumsum([len(k) for k in keys])[:-1]
        out = {"blk": [r["blk"] for r in rows] + [-1], "bucket": [r["bucket"] for r in rows] + [rows[0]["bucket"]]}
        sums = []
        for name in ("all", "gone"):
            own = np.concatenate([B.unpack_counts(r[name], len(k)) for r, k in zip(rows, keys)])
            sums.append(np.bincount(place, weights=own).astype(np.int64))
            parts = zip(np.split(sums[-1][place], cut), np.split(own, cut))
            # deleted tokens are explained with kept counts, so a block needs deleted counts of its own deleted keys only
            out[name] = [B.pack_counts(x if name == "all" else x[o > 0]) for x, o in parts] + [None]
        word = (u & U(1)) > 0
        for name, c in (("v_all", sums[0]), ("v_kept", sums[0] - sums[1])):
            out[name] = [None] * len(rows) + [int(np.count_nonzero(c[word]))]
        return B.rows_table(_TELL, out)

    return tell


def _stats(nb: int):
    edges = B.bounds(nb) >> CUT

    def stats(table: pa.Table, told: pa.Table) -> pa.Table:
        """kind doc: a document's sums and its tokens' counts; held: counts of deleted tokens; size: vocabularies."""
        table = B.block_rows(table)
        rows = told.to_pylist()
        out = {f.name: [] for f in _STATS}

        def put(**row):
            for name in out:
                out[name].append(row.get(name))

        if not table.num_rows:
            for r in rows:
                put(kind="size", v_all=r["v_all"], v_kept=r["v_kept"])
            return B.rows_table(_STATS, out)
        rows.sort(key=lambda r: r["bucket"])
        runs = _runs(table)
        keys = B.distinct(np.concatenate([B.distinct(np.concatenate(r[:2])) for r in runs]))
        runs = [(B.places(keys, tok), B.places(keys, pair), first, size) for tok, pair, first, size in runs]
        ids, fold = table["doc_id"].to_pylist(), table["fold"].to_pylist()
        deleted = np.zeros(len(keys), bool)
        i = 0
        for tok, pair, _, size in runs:
            out_of = np.repeat(np.array(fold[i: i + len(size)]) == DELETED, size)
            deleted[tok[out_of]] = deleted[pair[out_of]] = True
            i += len(size)
        cut = np.append(np.searchsorted(keys, edges), len(keys))
        n = np.diff(cut)
        total = np.concatenate([B.unpack_counts(r["all"], n[r["bucket"]]) for r in rows])
        n = np.diff(np.searchsorted(np.flatnonzero(deleted), cut))
        kept = total.copy()                     # right for the keys of deleted tokens
        kept[deleted] -= np.concatenate([B.unpack_counts(r["gone"], n[r["bucket"]]) for r in rows])
        start = np.searchsorted(keys, (END >> CUT) | U(1))
        held = []
        i = 0
        for tok, pair, first, size in runs:
            c1, c2 = total[tok], total[pair]
            for a, z in zip(first, size):
                s = slice(a, a + z)
                put(kind="doc", doc_id=ids[i], fold=fold[i], n_tokens=int(z), n_known=int(np.count_nonzero(c1[s])),
                    logs=float(np.log10(c1[s] + 0.5).sum()), counts=pack_tokens(c1[s], c2[s]))
                if fold[i] == DELETED:
                    k = kept[tok[s]]
                    held.append(np.stack([kept[pair[s]], np.append(kept[start], k[:-1]), k], 1))
                i += 1
        if held:
            cells = np.concatenate(held)
            _, pick, n = np.unique(B.mix(B.mix(B.mix(cells[:, 0].astype(U)) + cells[:, 1].astype(U)) + cells[:, 2].astype(U)),
                                   return_index=True, return_counts=True)
            put(kind="held", n_tokens=len(pick), counts=pack_tokens(*cells[pick].T, n))
        return B.rows_table(_STATS, out)

    return stats


def pack_tokens(*counts: np.ndarray) -> bytes:
    """Counts of one length, byte by byte of equal weight, compressed."""
    raw = b"".join(c.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in counts)
    return pa.compress(raw, codec="zstd", asbytes=True)


def unpack_tokens(blob: bytes, n: int, columns: int = 2):
    raw = np.frombuffer(pa.decompress(blob, decompressed_size=8 * columns * n, codec="zstd", asbytes=True), np.uint8)
    return (np.ascontiguousarray(x.reshape(8, -1).T).view("<u8").ravel().astype(np.int64) for x in np.split(raw, columns))


def bucket_of(c: np.ndarray) -> np.ndarray:
    return np.minimum(BUCKETS - 1, np.where(c > 0, np.floor(np.log2(np.maximum(c, 1))) + 1, 0)).astype(np.int64)


def parts_of(c2, cv, c1, n: int, v: int, weights: np.ndarray):
    """Each token's bucket and the weighted terms of its probability."""
    b = bucket_of(cv)
    return b, np.stack([weights[b, 0] * c2 / np.maximum(cv, 1), weights[b, 1] * c1 / max(n, 1), weights[b, 2] / (v + 1)])


def start_weights() -> np.ndarray:
    w = np.tile([0.6, 0.3, 0.1], (BUCKETS, 1))
    w[0] = [0, 0.8, 0.2]
    return w


def learn(held: DataFrame, n: int, v: int, iterations: int = ITERATIONS) -> np.ndarray:
    """Mixture weights by context bucket, from the deleted tokens' counts in the kept part."""
    weights = start_weights()
    if n == 0:
        weights[:] = [0, 0, 1]
        return weights
    for _ in range(iterations):
        now = weights.copy()

        def expect(batches):
            for batch in batches:
                for blob, size in zip(batch["counts"], batch["n_tokens"].to_pylist()):
                    c2, cv, c1, k = unpack_tokens(blob.as_py(), size, 4)
                    b, p = parts_of(c2, cv, c1, n, v, now)
                    p = p / p.sum(0) * k
                    s = np.stack([np.bincount(b, x, BUCKETS) for x in p], 1)
                    yield pa.record_batch({"b": np.arange(BUCKETS), "s2": s[:, 0], "s1": s[:, 1], "s0": s[:, 2]})

        sums = held.mapInArrow(expect, "b long, s2 double, s1 double, s0 double").groupBy("b") \
            .agg(F.sum("s2"), F.sum("s1"), F.sum("s0")).collect()
        for b, *s in sums:
            if sum(s) > 0:
                weights[b] = np.array(s) / sum(s)
    # a floor keeps every probability above zero where the deleted part had nothing unseen
    weights = np.maximum(weights, [0, 1e-6, 1e-6])
    return weights / weights.sum(1, keepdims=True)


def lm_scores(docs: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; one row per document."""
    nb = B.parts(docs.sparkSession, B.text_bytes(docs))
    t = B.blocked(docs, nb, F.expr(REMAINDER))
    told = t.groupBy("blk").applyInArrow(_ask(nb), ddl(_ASK)) \
        .repartition(nb, "bucket").groupBy("bucket").applyInArrow(_tell(nb), ddl(_TELL))
    stats = written(t.groupBy("blk").cogroup(told.groupBy("blk")).applyInArrow(_stats(nb), ddl(_STATS)), "lm", "kind")
    doc = stats.filter("kind = 'doc'")
    size = stats.filter("kind = 'size'").agg(F.sum("v_all"), F.sum("v_kept")).first()
    v_all, v_kept = (x or 0 for x in size)
    total = doc.agg(F.sum(F.when(F.col("fold") != HELD_OUT, F.col("n_tokens"))),
                    F.sum(F.when(~F.col("fold").isin(HELD_OUT, DELETED), F.col("n_tokens"))),
                    F.count(F.when(F.col("fold") != HELD_OUT, 1))).first()
    n_all, n_kept, n_docs = (x or 0 for x in total)
    weights = learn(stats.filter("kind = 'held'").select("n_tokens", "counts"), n_kept, v_kept, iterations)

    def score(batches):
        for batch in batches:
            got = []
            for blob, n in zip(batch["counts"], batch["n_tokens"].to_pylist()):
                c1, c2 = unpack_tokens(blob.as_py(), n)
                _, p = parts_of(c2, np.append(n_docs, c1[:-1]), c1, n_all, v_all, weights)
                got.append(float(np.log10(p.sum(0)).sum()))
            base = batch["logs"].to_numpy() - batch["n_tokens"].to_numpy() * np.log10(n_all + 0.5 * (v_all + 1))
            fold = batch["fold"].to_numpy()
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "held_out": pa.array(fold == HELD_OUT), "n_tokens": batch["n_tokens"],
                "n_known": batch["n_known"], "train_tokens": pa.array(np.full(len(fold), n_all, np.int64)),
                "base_score": pa.array(base), "score": pa.array(got, pa.float64())})

    return doc.select("doc_id", "fold", "n_tokens", "n_known", "logs", "counts").mapInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
               "score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
