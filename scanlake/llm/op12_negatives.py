"""Operator 12: hard negatives by an inverted multi-index, exact.

For each anchor its first positives (same label, by score) are found, and for each
positive the first rows of other labels whose score lies in the window from
``LOW`` percent of the positive's score up to it.

* Index: vectors are cut in two halves; each half space has a codebook, fitted by
  k-means on a bounded sample.  A row's cell is its pair of codes, and every row is
  in a cell.  A cell keeps how far its rows lie from its codes at most (radii).
* Cells go to shards of bounded size; a cell with more rows than a shard spreads over
  several, by row.  Anchors go in groups of bounded size.  A group meets a shard in one
  task, so no task holds more than one of each and no anchor's rows gather.
* Bound: a row of cell (i, j) scores q1.c1 + |q1| r1 + q2.c2 + |q2| r2 at most.  In
  a shard, a heap over the two sorted lists of half bounds visits cells by falling
  sum (multi-sequence).  It stops once the bound is below what is still needed:
  the fifth positive, or for each window its fifth hit or its lower end.  Ties go on.
* Rounds: the anchor's most promising shard gives a fifth positive; only shards with a
  bound that reaches it are searched next.  Then windows are known, and shards whose
  bound reaches the lowest window are searched for negatives.  Hits of all shards are
  ranked per window, so results are those of brute force.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no
part.  A shorter vector counts as filled up with zeros.  Scaled components are clipped to an int,
scores to a long.  A null vec_id is no anchor and comes last in ties.  Rows that repeat a vec_id are
rows of their own, each other's "other rows".  Empty tables and anchors without positives give no row.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scanlake.llm.components import written

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100         # percent of the positive's score that a negative's may have
CODES = 32                  # of each half: at most CODES**2 cells
SAMPLE = 20_000             # rows that the codebooks are fitted on; every row is indexed
SHARD_ROWS = 1 << 16        # rows of a shard, at most (on average, where a cell is split by a hash)
GROUP_ANCHORS = 1 << 14     # anchors that meet a shard in one task
NO_ID = np.iinfo(np.int64).max

_INT = (-(1 << 31), (1 << 31) - 1)
_VECTOR = "rid long, vec_id long, label long, anchor boolean, vec array<int>"
_CELLS = pa.schema([("rid", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int64()), ("anchor", pa.bool_()),
                    ("vec", pa.list_(pa.int32())), ("c1", pa.int32()), ("c2", pa.int32()), ("d1", pa.float64()), ("d2", pa.float64())])
CELLS = _VECTOR + ", c1 int, c2 int, d1 double, d2 double"
_WINDOW = pa.list_(pa.struct([("rid", pa.int64()), ("id", pa.int64()), ("score", pa.int64())]))
_ROUTED = pa.schema([("shard", pa.int32()), ("grp", pa.int32()), ("rid", pa.int64()), ("vec_id", pa.int64()),
                     ("label", pa.int64()), ("vec", pa.list_(pa.int32())), ("positives", _WINDOW)])
ROUTED = ("shard int, grp int, rid long, vec_id long, label long, vec array<int>, "
          "positives array<struct<rid: bigint, id: bigint, score: bigint>>")
_POS = pa.schema([("arid", pa.int64()), ("rid", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])
_NEG = pa.schema([("arid", pa.int64()), ("anchor_id", pa.int64()), ("prid", pa.int64()), ("positive_id", pa.int64()),
                  ("positive_score", pa.int64()), ("rid", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])


def scaled(vectors: DataFrame, anchor: F.Column) -> DataFrame:
    """vec_id, label, anchor, vec of the rows that take part."""
    x = F.col("embedding")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    ints = F.transform(x, lambda v: F.least(F.greatest(F.floor(v.cast("double") * SCALE), F.lit(_INT[0])), F.lit(_INT[1])).cast("int"))
    return vectors.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(fine).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), ints.alias("vec"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors as rows, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if (size == dim).all():
        return flat.reshape(len(column), dim).astype(np.int64)
    out = np.zeros((len(column), dim), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def dots(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products: as doubles while they are exact, else as Python's integers, clipped to a long."""
    top = (int(np.abs(x).max()) if x.size else 0) * (int(np.abs(q).max()) if q.size else 0) * max(1, x.shape[1])
    if top < 1 << 53:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    exact = x.astype(object) @ q.astype(object)
    return np.array([min(max(int(v), -(1 << 63)), (1 << 63) - 1) for v in exact], np.int64)


def codebook(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means; begins with rows evenly spread over the sorted first principal direction."""
    x = np.unique(x, axis=0).astype(np.float64)
    k = min(k, len(x))
    axis = np.linalg.svd((x - x.mean(0))[:: max(1, len(x) // 2000)], full_matrices=False)[2][0] if x.shape[1] else np.zeros(0)
    c = x[np.argsort(x @ axis, kind="stable")[(np.arange(k) * 2 + 1) * len(x) // (2 * k)]]
    for _ in range(rounds):
        own = nearest(x, c)[0]
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest code, and how far it is."""
    far = (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)
    own = far.argmin(1)
    return own, np.sqrt(((x - c[own]) ** 2).sum(1))


class Books:
    """The codebooks of both halves."""

    def __init__(self, sample: np.ndarray, codes: int):
        self.dim = sample.shape[1]
        self.cut = self.dim // 2
        self.first, self.second = codebook(sample[:, : self.cut], codes), codebook(sample[:, self.cut:], codes)

    def halves(self, x: np.ndarray):
        return x[:, : self.cut].astype(np.float64), x[:, self.cut:].astype(np.float64)

    def half_bounds(self, q: np.ndarray):
        """For each row: products with the codes of either half, and the halves' lengths."""
        a, b = self.halves(q)
        return a @ self.first.T, b @ self.second.T, np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)


def slack(bound):
    """Sums of doubles may be this much too small."""
    return bound + 1e-9 * np.abs(bound) + 1e-3


def _cells(books: Books):
    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                (a, b), out = books.halves(matrix(batch["vec"], books.dim)), {n: batch[n] for n in batch.schema.names}
                for half, book, k in ((a, books.first, "1"), (b, books.second, "2")):
                    own, far = nearest(half, book)
                    out["c" + k], out["d" + k] = pa.array(own, pa.int32()), pa.array(far, pa.float64())
                yield pa.record_batch([out[f.name] for f in _CELLS], schema=_CELLS)

    return assign


class Shards:
    """Which shards hold each cell, from the cells' counts and radii."""

    def __init__(self, cells, rows: int):
        """``cells``: (c1, c2, n, r1, r2), at most CODES**2 of them."""
        self.cells = np.array([(c.c1, c.c2, c.n) for c in cells], np.int64).reshape(-1, 3)
        self.radii = np.array([(c.r1, c.r2) for c in cells], np.float64).reshape(-1, 2)
        place, filled, spread = 0, 0, []
        for _, _, n in self.cells.tolist():
            if filled and filled + n > rows:
                place, filled = place + 1, 0
            parts = -(-n // rows)
            spread.append((place, parts))
            filled = rows if parts > 1 else filled + n
            place += parts - 1
        self.spread, self.count = np.array(spread, np.int64).reshape(-1, 2), place + 1

    def bounds(self, books: Books, q: np.ndarray) -> np.ndarray:
        """For each row of q and each shard, what a row of the shard scores at most."""
        a, b, la, lb = books.half_bounds(q)
        c1, c2, _ = self.cells.T
        by_cell = slack(a[:, c1] + b[:, c2] + la[:, None] * self.radii[:, 0] + lb[:, None] * self.radii[:, 1])
        out = np.full((len(q), self.count), -np.inf)
        for k, (first, parts) in enumerate(self.spread):
            s = slice(first, first + parts)
            out[:, s] = np.maximum(out[:, s], by_cell[:, k: k + 1])
        return out


class Shard:
    """A shard's rows by cell, and the heap that visits cells by falling bound."""

    def __init__(self, table: pa.Table, books: Books):
        cell = table["c1"].to_numpy().astype(np.int64) * CODES + table["c2"].to_numpy()
        order = np.lexsort((table["rid"].to_numpy(), cell))
        table, cell = table.take(pa.array(order)), cell[order]
        self.books, self.x = books, matrix(table["vec"], books.dim)
        self.rid, self.label = table["rid"].to_numpy(), table["label"].to_numpy()
        self.id = table["vec_id"].fill_null(NO_ID).to_numpy()
        cut = np.append(np.flatnonzero(np.diff(cell, prepend=-1)), len(cell))
        self.rows = {int(cell[i]): slice(int(i), int(j)) for i, j in zip(cut[:-1], cut[1:])}
        self.codes, self.radii = [], []
        for k in "12":
            c, d = table["c" + k].to_numpy(), table["d" + k].to_numpy()
            present = np.unique(c)
            self.codes.append(present)
            self.radii.append(np.array([d[c == p].max() for p in present]))

    def visits(self, q: np.ndarray):
        """(bound, rows) of each cell of the shard that has rows; no row of a later cell scores above its bound."""
        a, b, la, lb = self.books.half_bounds(q[None])
        u = a[0, self.codes[0]] + la[0] * self.radii[0]
        v = b[0, self.codes[1]] + lb[0] * self.radii[1]
        by_u, by_v = np.argsort(-u, kind="stable"), np.argsort(-v, kind="stable")
        u, v = u[by_u].tolist(), v[by_v].tolist()
        first, second = self.codes[0][by_u].tolist(), self.codes[1][by_v].tolist()
        heap = [(-(u[0] + v[0]), 0, 0)] if u and v else []
        while heap:
            bound, i, j = heapq.heappop(heap)
            rows = self.rows.get(first[i] * CODES + second[j])
            if rows is not None:
                yield float(slack(-bound)), rows
            if j + 1 < len(v):
                heapq.heappush(heap, (-(u[i] + v[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(u):           # each pair comes from one other: no pair twice
                heapq.heappush(heap, (-(u[i + 1] + v[0]), i + 1, 0))

    def hits(self, q: np.ndarray, rows: slice, allowed: np.ndarray):
        """(-score, vec_id, rid) of the allowed rows, unsorted."""
        k = np.flatnonzero(allowed) + rows.start
        return k, dots(self.x[k], q)

    def positives(self, rid: int, label: int, q: np.ndarray) -> list[tuple[int, int, int]]:
        best: list[tuple[int, int, int]] = []
        for bound, rows in self.visits(q):
            if len(best) == POSITIVES and bound < -best[-1][0]:
                break
            k, score = self.hits(q, rows, (self.label[rows] == label) & (self.rid[rows] != rid))
            if len(k):
                best = heapq.nsmallest(POSITIVES, best + list(zip((-score).tolist(), self.id[k].tolist(), self.rid[k].tolist())))
        return best

    def negatives(self, label: int, q: np.ndarray, positives: list[dict]) -> list[list[tuple[int, int, int]]]:
        """For each positive, the shard's first hits of its window."""
        tops = [p["score"] for p in positives]
        found: list[list[tuple[int, int, int]]] = [[] for _ in tops]
        open_ = [w for w, top in enumerate(tops) if top >= 0]      # below zero a window is empty
        for bound, rows in self.visits(q):
            open_ = [w for w in open_ if HIGH * bound >= LOW * tops[w] and not (
                len(found[w]) == NEGATIVES and bound < -found[w][-1][0])]
            if not open_:
                break
            k, score = self.hits(q, rows, self.label[rows] != label)
            if not len(k) or HIGH * int(score.max()) < LOW * min(tops[w] for w in open_):
                continue
            hits = list(zip((-score).tolist(), self.id[k].tolist(), self.rid[k].tolist()))
            for w in open_:
                inside = [h for h in hits if h[0] >= -tops[w] and -HIGH * h[0] >= LOW * tops[w]]
                if inside:
                    found[w] = heapq.nsmallest(NEGATIVES, found[w] + inside)
        return found


def _id(x: int):
    return None if x == NO_ID else x


def _search_positives(books: Books):
    def search(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and anchors.num_rows:
            shard = Shard(rows, books)
            for a, q in zip(anchors.select(["rid", "label"]).to_pylist(), matrix(anchors["vec"], books.dim)):
                out += [(a["rid"], rid, _id(i), -s) for s, i, rid in shard.positives(a["rid"], a["label"], q)]
        return pa.table([list(c) for c in zip(*out)] or [[]] * len(_POS), schema=_POS)

    return search


def _search_negatives(books: Books):
    def search(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and anchors.num_rows:
            shard = Shard(rows, books)
            for a, q in zip(anchors.drop_columns(["vec"]).to_pylist(), matrix(anchors["vec"], books.dim)):
                for p, hits in zip(a["positives"], shard.negatives(a["label"], q, a["positives"])):
                    out += [(a["rid"], a["vec_id"], p["rid"], p["id"], p["score"], rid, _id(i), -s) for s, i, rid in hits]
        return pa.table([list(c) for c in zip(*out)] or [[]] * len(_NEG), schema=_NEG)

    return search


def _route(books: Books, shards: Shards, which: str):
    """An anchor's shards: the best one; the others that reach its fifth positive; those that reach its lowest window."""

    def route(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            bound = shards.bounds(books, matrix(batch["vec"], books.dim))
            best = bound.argmax(1)
            if which == "best":
                wanted = np.zeros(bound.shape, bool)
                wanted[np.arange(len(best)), best] = True
            else:
                scores = [[p["score"] for p in ps or []] for ps in batch["positives"].to_pylist()]
                if which == "others":
                    least = np.array([min(s) if len(s) == POSITIVES else -np.inf for s in scores])
                    wanted = bound >= least[:, None]
                    wanted[np.arange(len(best)), best] = False
                else:
                    low = np.array([min((x for x in s if x >= 0), default=np.inf) for s in scores], np.float64)
                    wanted = HIGH * bound >= LOW * low[:, None]
            row, shard = np.nonzero(wanted)
            part = batch.take(pa.array(row))
            cols = {n: part[n] for n in part.schema.names} | {"shard": pa.array(shard, pa.int32())}
            yield pa.record_batch([cols[f.name] for f in _ROUTED], schema=_ROUTED)

    return route


def _ranked(hits: DataFrame, keys: list[str], most: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"), "rid")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)


def mine(vectors: DataFrame, anchor: F.Column, codes: int = CODES, shard_rows: int = SHARD_ROWS,
         group_anchors: int = GROUP_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ``anchor`` says which rows are anchors."""
    spark = vectors.sparkSession
    rows = scaled(vectors, anchor)
    sample = rows.select("vec").orderBy(F.xxhash64("vec_id", "vec")).limit(SAMPLE).toArrow()["vec"]      # bounded: SAMPLE rows
    n, dim, n_anchors = rows.agg(F.count("*"), F.max(F.size("vec")), F.count_if("anchor")).first()
    if not n_anchors:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
                                         "negative_score long")
    books = Books(matrix(sample, dim), codes)
    index = written(rows.withColumn("rid", F.monotonically_increasing_id()).select("rid", "vec_id", "label", "anchor", "vec")
                    .mapInArrow(_cells(books), CELLS), "cells")
    cells = index.groupBy("c1", "c2").agg(F.count("*").alias("n"), F.max("d1").alias("r1"), F.max("d2").alias("r2")) \
        .orderBy("c1", "c2").collect()                                                  # bounded: codes ** 2 rows
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = Shards(cells, max(1, min(shard_rows, max(2048, -(-n // parts)))))
    where = spark.createDataFrame([(int(c1), int(c2), int(f), int(k)) for (c1, c2, _), (f, k) in zip(shards.cells, shards.spread)],
                                  "c1 int, c2 int, first int, spread int")
    groups = -(-n_anchors // group_anchors)
    group = F.pmod(F.xxhash64("rid"), F.lit(groups)).cast("int")
    dealt = index.join(F.broadcast(where), ["c1", "c2"]) \
        .withColumn("shard", (F.col("first") + F.pmod(F.xxhash64("rid", F.lit(7)), F.col("spread"))).cast("int")) \
        .withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))) \
        .select("shard", "grp", "rid", "vec_id", "label", "vec", "c1", "c2", "d1", "d2")
    anchors = index.filter("anchor").select("rid", "vec_id", "label", "vec", group.alias("grp"))

    def searched(with_positives: DataFrame, which: str, search, schema: pa.Schema, kind: str) -> DataFrame:
        routed = with_positives.mapInArrow(_route(books, shards, which), ROUTED)
        ddl = ", ".join(f"{f.name} long" for f in schema)
        return dealt.groupBy("shard", "grp").cogroup(routed.groupBy("shard", "grp")).applyInArrow(search, ddl)

    none = F.lit(None).cast("array<struct<rid: bigint, id: bigint, score: bigint>>")

    def of(hits: DataFrame) -> DataFrame:
        """The anchors with their positives so far."""
        best = _ranked(hits, ["arid"], POSITIVES).groupBy("arid").agg(F.collect_list(F.struct("rid", "id", "score")).alias("positives"))
        return anchors.join(best.withColumnRenamed("arid", "rid"), "rid", "left")

    home = written(searched(anchors.withColumn("positives", none), "best", _search_positives(books), _POS, "home"), "positives")
    rest = searched(of(home), "others", _search_positives(books), _POS, "rest")
    known = written(of(home.unionByName(rest)).filter("positives is not null"), "windows")
    hits = searched(known, "windows", _search_negatives(books), _NEG, "hits")
    return _ranked(hits, ["arid", "prid"], NEGATIVES).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = given.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(moved, F.col("vec_id") % 100 == 0)


ORACLE = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    [floor(256 * cast(x as double)) for x in embedding] as vec
  from embeddings
  where label is not null and embedding is not null
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0),
scored as (
  select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same,
    cast(list_dot_product(a.vec, b.vec) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
positives as (
  select anchor_id, other as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other) <= 5),
found as (
  select p.anchor_id, positive_id, other as negative_id, positive_score, score as negative_score,
    cast(row_number() over (partition by p.anchor_id, positive_id order by score desc, other) as int) as rank
  from positives p join scored s on p.anchor_id = s.anchor_id and not same
    and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from found where rank <= 5
"""
