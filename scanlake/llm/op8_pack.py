"""Operator 8: hierarchical residual packing of tokenised documents into sequences.

Documents are tokenised, ended with one id and cut into pieces of at most
``SIZE`` tokens.  Full pieces are sequences at once.  The others are packed in
rounds: each partition packs its items best-fit (largest first) and emits bins
that are nearly full; underfull bins go on *as items* to a round of fewer
partitions, with more slack, until one partition (or, for very many, a few) is
left.  No task holds more than about ``ITEMS`` items.

Defined cases: null or empty text is a piece of the end id alone; rows with one
id are separate documents with the same name; an empty table gives no row.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.llm import blocks as B
from scanlake.llm.components import written

TOKENIZER = "word_bpe_49k.json"
SIZE = 4096
END = 1
ITEMS = 20_000                  # items of one task
FAN_IN = 8                      # partitions merged into one by a round
SLACK = (16, 64, 256, 1024)     # tokens that a nearly full bin may lack, by round; the last round emits all
WORDS_OF = 1 << 20              # bytes of text whose distinct words are looked up together
WORD_CACHE = 400_000            # words in each of a Python worker's two tables
ENCODED = 8192                  # words that the tokenizer encodes at once

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))])
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"
_MEMBER = "struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long,offset:long>"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: Signs at a word's end that the tokenizer takes as a run of their own after an ASCII letter.
_TAIL = np.zeros(256, bool)
_TAIL[[ord(c) for c in ".,!?;:%&*$#"]] = True


def units(dat: np.ndarray, off: np.ndarray):
    """Start, end and document of what can be tokenised alone: words, and signs at the end of a word."""
    start, end, doc = B.words(dat, off)
    stem = end.copy()
    open_ = np.arange(len(end))
    while len(open_):
        open_ = open_[_TAIL[dat[stem[open_] - 1]] & (stem[open_] - 1 > start[open_])]
        stem[open_] -= 1
    stem = np.where(_LETTER[dat[stem - 1]], stem, end) if len(stem) else stem
    edge = np.stack([start, stem, end], 1)
    s, e, d = edge[:, :2].ravel(), edge[:, 1:].ravel(), np.repeat(doc, 2)
    keep = e > s
    return s[keep], e[keep], d[keep]


class Kept(NamedTuple):
    """Words by the hash of their bytes, ascending, and where each one's ids begin in ``flat`` and how many they are."""

    keys: np.ndarray
    first: np.ndarray
    n: np.ndarray
    flat: np.ndarray


EMPTY = Kept(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4"))


class WordTokenizer:
    """Ids of whole texts, word by word: the tokenizer drops white space, so words are independent of each other.

    Ids are kept per word; ASCII letters alone are looked up in lower case, as the tokenizer has it.  Of the two
    tables of kept words the older goes when the newer is full, so frequent words stay.  They are arrays of about 30
    bytes a word, since a Python worker keeps them through the stages that follow.  Words are told apart by 64-bit hashes.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.new = self.old = EMPTY

    def ids(self, keys: np.ndarray, word) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each of the words with these (ascending) hashes, and all ids; ``word(k)`` is the k-th one's text."""
        begin, n = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        todo, flats, base = np.ones(len(keys), bool), [], 0
        for table in (self.new, self.old):
            at = np.searchsorted(table.keys, keys)
            at[at == len(table.keys)] = 0
            hit = todo & (table.keys[at] == keys) if len(table.keys) else np.zeros(len(keys), bool)
            begin[hit], n[hit] = base + table.first[at[hit]], table.n[at[hit]]
            todo &= ~hit
            flats.append(table.flat)
            base += len(table.flat)
            if table is self.new:
                fresh = todo.copy()
        missing = np.flatnonzero(todo)
        for i in range(0, len(missing), ENCODED):
            part = missing[i: i + ENCODED]
            got = [enc.ids for enc in self.tok.encode_batch_fast([word(k) for k in part.tolist()], add_special_tokens=False)]
            flat = np.fromiter(chain.from_iterable(got), "<u4")
            n[part] = [len(g) for g in got]
            begin[part] = base + np.cumsum(n[part]) - n[part]
            flats.append(flat)
            base += len(flat)
        flat = B.take_spans(np.concatenate(flats), begin, n)
        first = np.cumsum(n) - n
        if len(self.new.keys) + len(keys) > WORD_CACHE:
            self.old, self.new = self.new, Kept(keys, first, n, flat)
        else:
            more = np.concatenate([self.new.keys, keys[fresh]])
            order = np.argsort(more, kind="stable")
            n_fresh = n[fresh]
            self.new = Kept(
                more[order], np.append(self.new.first, np.cumsum(n_fresh) - n_fresh + len(self.new.flat))[order],
                np.append(self.new.n, n_fresh)[order], np.append(self.new.flat, B.take_spans(flat, first[fresh], n_fresh)))
        return n, flat

    def documents(self, dat: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        start, end, doc = units(dat, off)
        n_docs = len(off) - 1
        other = np.append(0, np.cumsum(~_LETTER[dat]))
        plain = other[end] == other[start]                       # letters only: folding is safe
        h = np.where(plain, B.span_hash(B.prefix_hash(dat, B.FOLD), start, end),
                     B.span_hash(B.prefix_hash(dat, B.RAW), start, end))
        keys, pick, place = np.unique(h, return_index=True, return_inverse=True)
        raw = dat.tobytes()
        s, e, p = start[pick].tolist(), end[pick].tolist(), plain[pick].tolist()
        n, flat = self.ids(keys, lambda k: (raw[s[k]:e[k]].lower() if p[k] else raw[s[k]:e[k]]).decode())
        first = np.cumsum(n) - n
        ids = B.take_spans(flat, first[place], n[place]) if len(place) else flat
        per_doc = np.bincount(doc, weights=n[place], minlength=n_docs).astype(np.int64) if len(place) else np.zeros(n_docs, np.int64)
        return np.split(ids, np.cumsum(per_doc)[:-1])


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker, so that tasks share the words it keeps."""
    return WordTokenizer(path)


def pieces(docs: DataFrame, path: str, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if wanted, ids of each piece."""

    def cut(batches):
        tok = word_tokenizer(path)
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            for first, dat, off in B.chunks(batch["text"], WORDS_OF):
                out = {f.name: [] for f in _PIECES}
                for k, doc in enumerate(tok.documents(dat, off)):
                    doc = np.append(doc, np.array([END], "<u4"))
                    for i, s in enumerate(range(0, len(doc), size)):
                        part = doc[s: s + size]
                        for name, v in zip(out, (ids[first + k], i, s, len(part), zlib.crc32(part.tobytes()),
                                                 part.astype(np.int32) if with_ids else None)):
                            out[name].append(v)
                yield from B.rows_table(_PIECES, out).to_batches()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def best_fit(items: list[tuple[int, list]], size: int) -> list[tuple[int, list]]:
    """Bins (fill, members) of items (fill, members), largest first, each into the fullest bin that it fits."""
    room: list[tuple[int, int]] = []            # (free tokens, bin), sorted
    bins: list[tuple[int, list]] = []
    for fill, members in sorted(items, key=lambda x: -x[0]):
        k = bisect_left(room, (fill, -1))
        if k == len(room):
            bins.append((fill, list(members)))
            if fill < size:
                insort(room, (size - fill, len(bins) - 1))
            continue
        free, b = room.pop(k)
        had, held = bins[b]
        held.extend({**m, "offset": m["offset"] + had} for m in members)
        bins[b] = (had + fill, held)
        if free > fill:
            insort(room, (free - fill, b))
    return bins


def _round(size: int, slack: int | None):
    def pack(batches):
        items = [(f, m) for b in batches for f, m in zip(b["fill"].to_pylist(), b["members"].to_pylist())]
        bins = best_fit(items, size)
        for i in range(0, len(bins), 1000):
            part = bins[i: i + 1000]
            yield pa.record_batch({
                "fill": pa.array([f for f, _ in part], pa.int64()),
                "members": pa.array([m for _, m in part], pa.list_(pa.struct(
                    [(c, pa.int32() if c == "piece" else pa.int64()) for c in
                     ("doc_id", "piece", "start", "length", "ids_crc32", "offset")]))),
                "done": pa.array([slack is None or f >= size - slack for f, _ in part])})

    return pack


def pack(items: DataFrame, size: int = SIZE) -> DataFrame:
    """sequence_id and offset for each piece."""
    member = F.struct("doc_id", "piece", "start", "length", "ids_crc32", F.lit(0).cast("long").alias("offset"))
    bins = written(items.select(F.col("length").alias("fill"), F.array(member).alias("members")), "pack")
    done = bins.filter(F.col("fill") == size).select("members")
    left = bins.filter(F.col("fill") < size)
    n = left.count()
    tasks = -(-n // ITEMS)
    step = 0
    while n:
        last = tasks <= 1 or step >= len(SLACK)
        slack = None if last else SLACK[step]
        packed = written(left.repartition(max(1, tasks), F.xxhash64("members")).mapInArrow(
            _round(size, slack), f"fill long, members array<{_MEMBER}>, done boolean"), "pack")
        done = done.union(packed.filter("done").select("members"))
        if last:
            break
        left = packed.filter("not done").select("fill", "members")
        n = left.count()
        tasks = max(-(-tasks // FAN_IN), -(-n // ITEMS))
        step += 1
    return done.withColumn("sequence_id", F.monotonically_increasing_id()) \
        .select("sequence_id", F.explode("members").alias("m")) \
        .select("m.doc_id", "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id", "m.offset")


def pack_documents(docs: DataFrame, path: str | None = None, size: int = SIZE) -> DataFrame:
    return pack(pieces(docs, path or tokenizer_path(), size).drop("ids"), size)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
