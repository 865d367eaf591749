"""Operator 10: n-gram Jaccard join as a blocked sparse matrix product.

The matrix has a row per document and a column per distinct shingle of five
words.  Two documents link when 100 * overlap >= 75 * union.

1. Blocks of rows send their columns to buckets, which answer how many rows
   each column has (``blocks``).  A document links with none if fewer than
   three quarters of its shingles occur elsewhere: size bound, no pair made.
2. Rows with equal sets become one class; the class goes on, its copies don't.
3. A row's entries are ordered rarest column first.  Linked rows share a column
   among the first n - ceil(0.75 n) + 1 entries, so only these are multiplied.
   Partial products are dropped by size (4 * smaller < 3 * larger) and by what
   the entries after the shared one could add at most.  Columns that stand in the same
   rows' prefixes (the shingles of a passage, as a rule) are one column:
   what a passage's documents have in common is met once, not once a word.
4. Overlaps of the surviving pairs are counted on whole rows.  Each row first
   meets one other, which joins the bulk of a large group in as many products
   as it has rows; then a column's rows meet those of other components among
   2, 8, 32 and 128 of its rows, and at last among all.  Columns of one component or of no more
   rows than were met go no further.  So no link between components is missed and a
   group of copies isn't expanded into all its pairs.

Defined cases: no text, no words: empty set, linked with nothing, its own
component (a null id has a null component).  Fewer than five words: one shingle
of all.  Repeated rows are copies.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.llm import blocks as B
from scanlake.llm.components import components, dropped, marked, written

WORDS = 5
SHARE = (75, 100)
CUT = np.uint64(24)             # low bits of a shingle's hash that aren't sent to count its rows
MET = (2, 8, 32, 128)           # how many of a column its rows meet in each round, about, before they meet all
U = np.uint64

_ASK = pa.schema([("bucket", pa.int32()), ("blk", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_TELL = pa.schema([("blk", pa.int32()), ("bucket", pa.int32()), ("codes", pa.binary())])
_ROWS = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("cid", pa.string()),
                   ("feats", pa.list_(pa.int64())), ("shingles", pa.binary()), ("row", pa.int64())])
ROWS = "doc_id long, n_shingles long, cid string, feats array<long>, shingles binary, row long"


def shingle_sets(dat: np.ndarray, off: np.ndarray, width: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document."""
    start, end, doc = B.words(dat, off)
    h = B.span_hash(B.prefix_hash(dat, B.FOLD), start, end)
    n_words = np.bincount(doc, minlength=len(off) - 1)
    first = np.cumsum(n_words) - n_words
    mult = [U(pow(0x5851F42D4C957F2D, k, 1 << 64)) for k in range(width)]
    sums = np.zeros(max(0, len(h) - width + 1), U)
    for k in range(width if len(sums) else 0):
        sums += h[k: k + len(sums)] * mult[k]
    sums = B.mix(sums)
    out = []
    for i, n in zip(first, n_words):
        if n >= width:
            out.append(B.distinct(sums[i: i + n - width + 1]))
        elif n:
            out.append(B.mix(np.array([sum(int(h[i + k]) * int(mult[k]) for k in range(n)) + int(n) & (1 << 64) - 1], U)))
        else:
            out.append(np.zeros(0, U))
    return out


def _block(table: pa.Table):
    """The rows' sets, and the block's distinct columns with the rows that have each.

    Columns are counted by the upper bits of their hashes: one that meets another counts too many rows, which
    only weakens a bound.  Overlaps are counted on whole hashes.
    """
    sets = []
    for _, dat, off in B.chunked(table["text"]):
        sets += shingle_sets(dat, off)
    keys, counts = np.unique(np.concatenate(sets) >> CUT, return_counts=True) if sets else (np.zeros(0, U),) * 2
    return sets, keys, counts


def _ask(nb: int):
    edges = B.bounds(nb)

    def ask(table: pa.Table) -> pa.Table:
        table = B.block_rows(table)
        _, keys, counts = _block(table)
        cut = np.append(np.searchsorted(keys, edges >> CUT), len(keys))
        out = {f.name: [] for f in _ASK}
        for k in np.flatnonzero(np.diff(cut)):
            s = slice(cut[k], cut[k + 1])
            for name, v in zip(out, (k, table["blk"][0].as_py(), B.pack_keys(keys[s], edges[k] >> CUT),
                                     B.pack_counts(counts[s]))):
                out[name].append(v)
        return B.rows_table(_ASK, out)

    return ask


def _tell(nb: int):
    edges = B.bounds(nb)

    def tell(table: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        rows = table.to_pylist()
        base = edges[rows[0]["bucket"]] >> CUT
        keys = [B.unpack_keys(r["keys"], base) for r in rows]
        counts = np.concatenate([B.unpack_counts(r["counts"], len(k)) for r, k in zip(rows, keys)])
        _, place = B.merged(keys)
        total = np.bincount(place, weights=counts)
        code = np.minimum(255, np.floor(8 * np.log2(np.maximum(total, 1)))).astype(np.uint8)   # 0: one row only
        cut = np.cumsum([len(k) for k in keys])[:-1]
        return B.rows_table(_TELL, {"blk": [r["blk"] for r in rows], "bucket": [r["bucket"] for r in rows],
                                    "codes": [c.tobytes() for c in np.split(code[place], cut)]})

    return tell


def _rows(table: pa.Table, told: pa.Table) -> pa.Table:
    """One row per document; feats and shingles only where enough shingles occur elsewhere."""
    table = B.block_rows(table)
    out = {f.name: [] for f in _ROWS}
    if table.num_rows:
        sets, keys, _ = _block(table)
        code = np.concatenate([np.zeros(0, np.uint8)] + [
            np.frombuffer(r["codes"], np.uint8) for r in sorted(told.to_pylist(), key=lambda r: r["bucket"])])
        rows = table["row"].to_pylist() if "row" in table.column_names else [None] * len(sets)
        for doc_id, row, s in zip(table["doc_id"].to_pylist(), rows, sets):
            n = len(s)
            c = code[np.searchsorted(keys, s >> CUT)]
            live = n > 0 and np.count_nonzero(c) * SHARE[1] >= n * SHARE[0]
            feats = None
            if live:
                prefix = n - -(-n * SHARE[0] // SHARE[1]) + 1
                order = np.lexsort((s, c))[:prefix]
                feats = s[order[c[order] > 0]].view(np.int64)
                unshared = int(np.count_nonzero(c[order] == 0))
                feats = np.append(np.int64(unshared), feats)       # their count comes first, see ``_entries``
            cid = "%016x%016x%x" % (int(s.sum()), int(B.mix(s ^ U(0xA0761D6478BD642F)).sum()), n)
            for name, v in zip(out, (doc_id, n, cid if live else None, feats, s.tobytes() if live else None, row)):
                out[name].append(v)
    return B.rows_table(_ROWS, out)


def _overlap(batches):
    for batch in batches:
        a, b = batch["shingles_a"], batch["shingles_b"]
        same = [len(np.intersect1d(np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U), True))
                for x, y in zip(a, b)]
        yield pa.record_batch({"a": batch["a"], "b": batch["b"], "overlap": pa.array(same, pa.int64()),
                               "n_a": batch["n_a"], "n_b": batch["n_b"]})


def _linked(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of classes that link; only rows that stand in a pair are shuffled."""
    pairs = written(pairs, "pairs")
    sets = marked(classes.select("cid", "n_shingles", "shingles"), "cid", pairs.select("a").union(pairs.select("b")), "met").filter("met")
    side = {x: sets.select(F.col("cid").alias(x), F.col("n_shingles").alias(f"n_{x}"),
                           F.col("shingles").alias(f"shingles_{x}")) for x in "ab"}
    links = written(pairs.join(side["a"], "a").join(side["b"], "b").select("a", "b", "n_a", "n_b", "shingles_a", "shingles_b")
                    .mapInArrow(_overlap, "a long, b long, overlap long, n_a long, n_b long")
                    .filter(F.col("overlap") * SHARE[1] >= (F.col("n_a") + F.col("n_b") - F.col("overlap")) * SHARE[0])
                    .select("a", "b"), "links")
    dropped(pairs)
    return links


#: What is left of both rows after the shared entry must allow the overlap that a link needs, and sizes must be close.
_SIZES = f"least(n_a, n_b) * {SHARE[1]} >= greatest(n_a, n_b) * {SHARE[0]}"
_CLOSE = (f"{_SIZES} and "
          f"least(n_a - pos_a, n_b - pos_b) * {SHARE[0] + SHARE[1]} >= (n_a + n_b) * {SHARE[0]}")


def _joined(label: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component) after more links; only links between components found so far go round.  Drops what it replaces."""
    if label is None:
        out = components(links)
        dropped(links)
        return out
    now = {x: label.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}")) for x in "ab"}
    between = links.join(now["a"], "a", "left").join(now["b"], "b", "left") \
        .select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b")).filter("a <> b").distinct()
    moved = components(between)
    alone = moved.select("node").join(label, "node", "left_anti").withColumn("component", F.col("node"))
    out = written(label.select("node", "component").unionByName(alone).join(
        moved.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
        .select("node", F.coalesce("to", "component").alias("component")), "labels")
    dropped(label, moved, links)
    return out


def _columns(classes: DataFrame) -> DataFrame:
    """f, cid, n, pos: entries of classes in columns of two rows or more.

    Columns with equal rows are one, at their first position (positions in the whole row: entries of columns with one
    row stand before all others).
    """
    each = written(classes.select("cid", "n_shingles", F.col("feats")[0].alias("unshared"),
                                  F.posexplode(F.expr("slice(feats, 2, greatest(size(feats) - 1, 0))")))
                   .select(F.col("col").alias("f"), "cid", F.col("n_shingles").alias("n"),
                           (F.col("pos") + F.col("unshared")).alias("pos")), "entries")
    rows = each.groupBy("f").agg(F.count("*").alias("k"), F.bit_xor(F.xxhash64("cid")).alias("x"),
                                 F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("y")).filter("k > 1") \
        .select("f", F.xxhash64("k", "x", "y").alias("g"))
    out = written(each.join(rows, "f").groupBy("g", "cid").agg(
        F.first("n").alias("n"), F.min("pos").alias("pos"))
        .withColumnRenamed("g", "f"), "columns")
    dropped(each)
    return out


def _open(entries: DataFrame, label: DataFrame, done: int) -> DataFrame:
    """f, cid, n, pos, component, k: entries of columns of more than ``done`` rows (k), not all in one component."""
    at = label.select(F.col("node").alias("cid"), "component")
    own = entries.select("f", "cid", "n", "pos").join(at, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    split = own.groupBy("f").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("k")) \
        .filter((F.col("x") != F.col("y")) & (F.col("k") > done)).select("f", "k")
    return written(own.join(split, "f"), "open")


def jaccard_components(docs: DataFrame, row: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per document.

    With ``row``, docs number their rows there: row, stays (it is its component's first by doc_id, nulls last, and row).
    """
    nb = B.parts(docs.sparkSession, B.text_bytes(docs))
    t = B.blocked(docs, nb, keep=["row"] if row else [])
    told = t.groupBy("blk").applyInArrow(_ask(nb), "bucket int, blk int, keys binary, counts binary") \
        .repartition(nb, "bucket").groupBy("bucket").applyInArrow(_tell(nb), "blk int, bucket int, codes binary")
    full = written(t.groupBy("blk").cogroup(told.groupBy("blk")).applyInArrow(_rows, ROWS), "rows")
    rows = written(full.select("doc_id", "n_shingles", "cid", "row"), "heads")

    classes = written(full.filter("cid is not null").groupBy("cid").agg(
        F.min("doc_id").alias("rep"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("least"),
        F.first("n_shingles").alias("n_shingles"), F.first("feats").alias("feats"),
        F.first("shingles").alias("shingles")).withColumnRenamed("cid", "key")
        .withColumn("cid", F.monotonically_increasing_id()), "classes")           # from here on, a class is its number
    dropped(full)
    entries = _columns(classes)

    side_a = [F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("pos").alias("pos_a")]
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]

    # first, each row meets one other, of its last such column: as many products as rows
    met = entries.groupBy("f").agg(F.min_by(F.struct("n", "pos", "cid"), F.xxhash64("cid", F.lit(1))).alias("p")) \
        .select("f", F.col("p.cid").alias("b"), F.col("p.n").alias("n_b"), F.col("p.pos").alias("pos_b"))
    pairs = entries.select("f", *side_a).join(met, "f").filter("a <> b").filter(_CLOSE) \
        .groupBy("a").agg(F.max_by("b", F.struct("pos_a", "b")).alias("b"))
    label = _joined(None, _linked(pairs.select(*ordered).distinct(), classes))

    # then, a column's rows meet more and more of those that are still in other components, at last all
    done = 1
    for salt, many in enumerate((*MET, None)):
        still = _open(entries, label, done)
        dropped(entries)
        entries = still
        if entries.isEmpty():
            break
        chosen = F.lit(True) if many is None else F.pmod(F.xxhash64("cid", F.lit(salt)), F.lit(1 << 31)) * F.col("k") < F.lit(many << 31)
        own = entries.withColumn("chosen", chosen)
        side = {x: own.select("f", F.col("cid").alias(x), F.col("n").alias(f"n_{x}"), F.col("pos").alias(f"pos_{x}"),
                              F.col("component").alias(f"c_{x}"), F.col("chosen").alias(f"chosen_{x}")) for x in "ab"}
        # a pair that links passes _CLOSE at the first column that it shares, so later columns, where many more meet, needn't pass
        pairs = side["a"].join(side["b"].filter("chosen_b"), "f").filter("c_a <> c_b and not (chosen_a and a > b)").filter(_CLOSE)
        label = _joined(label, _linked(pairs.select(*ordered).distinct(), classes))
        done = many
    dropped(entries)

    of_class = classes.select("key", "cid", "rep", "least").join(label.select(F.col("node").alias("cid"), "component"), "cid", "left") \
        .withColumn("component", F.coalesce("component", "cid"))
    if row:
        one = of_class.groupBy("component").agg(F.min("least").alias("least")).select("component", F.col("least.row").alias("first"))
        firsts = written(of_class.join(one, "component").select(F.col("key").alias("cid"), "first"), "firsts")
        dropped(classes, label)
        return rows.select("row", "cid").join(firsts, "cid", "left") \
            .select("row", F.coalesce(F.col("row") == F.col("first"), F.lit(True)).alias("stays"))
    least = of_class.groupBy("component").agg(F.min("rep").alias("component_id"))
    ids = written(of_class.join(least, "component").select(F.col("key").alias("cid"), "component_id"), "ids")
    dropped(classes, label)
    return rows.select("doc_id", "n_shingles", "cid").join(ids, "cid", "left") \
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
