"""Blocks of documents and buckets of hashed keys.

Several operators need, for every key of a document (a word, a shingle, a
50-byte window), a number that only the whole corpus knows.  Documents are
dealt into *blocks* by a hash, each block sends its distinct keys once to the
*bucket* that owns that range of the hash space, and the bucket answers in the
same order.  A hot key is thus one entry per block however often it occurs, and
both sides stay bounded: a block holds about ``BLOCK_BYTES`` of text, a bucket
about as many keys.

The functions on numpy arrays below work on the concatenated UTF-8 bytes of
many documents at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20       # text of one block; raise it where Python workers have more than 400 MB each
CHUNK_BYTES = 1 << 18       # text whose arrays are held at one time

U = np.uint64
_MULT = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INV = pow(_MULT, -1, 1 << 64)


def mix(h):
    """Finalizer of splitmix64: spreads every input bit over all output bits."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


#: One random-looking number per byte; ``FOLD`` gives A-Z those of a-z.
RAW = mix(np.arange(1, 257, dtype=U) * U(_MULT))
FOLD = RAW.copy()
FOLD[65:91] = RAW[97:123]
#: White space that parts words: space and 0x09-0x0D.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

_pow = [np.ones(1, U), np.ones(1, U)]


def _powers(n: int):
    if len(_pow[0]) < n:
        size = max(n, CHUNK_BYTES)
        for k, base in enumerate((_MULT, _INV)):
            p = np.full(size, base, U)
            p[0] = 1
            _pow[k] = np.cumprod(p, dtype=U)
    return _pow[0], _pow[1]


def prefix_hash(data: np.ndarray, table: np.ndarray):
    """Prefix sums from which ``span_hash`` takes the hash of any byte span."""
    power, _ = _powers(len(data) + 1)
    cum = np.zeros(len(data) + 1, U)
    np.cumsum(table[data] * power[: len(data)], out=cum[1:])
    return cum


def span_hash(cum, start, end):
    """64-bit hash of bytes [start, end), the same wherever these bytes stand."""
    _, inverse = _powers(len(cum))
    return mix((cum[end] - cum[start]) * inverse[start] + (end - start).astype(U) * U(0xD6E8FEB86659FD93))


def gram_hash(cum, size: int):
    """``span_hash`` of every span of ``size`` bytes."""
    _, inverse = _powers(len(cum))
    return mix((cum[size:] - cum[:-size]) * inverse[: len(cum) - size] + U(size * 0xD6E8FEB86659FD93 % (1 << 64)))


def take_spans(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The spans' elements, one span after the other; index arrays are held for a part of them at a time."""
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, data.dtype)
    i = 0
    while i < len(size):
        base = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, side="right")))
        n = size[i:j]
        out[base: ends[j - 1]] = data[np.repeat(begin[i:j] - (ends[i:j] - n - base), n) + np.arange(ends[j - 1] - base)]
        i = j
    return out


def words(data: np.ndarray, offs: np.ndarray, space: np.ndarray = SPACE):
    """Start, end and document index of each word, by default ``[^\\x20\\x09-\\x0D]+``; ``offs`` bounds the documents."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    ink = ~space[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = ink[:-1]
    inner = offs[(offs > 0) & (offs < n)]
    before[inner] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = ink[1:]
    after[inner - 1] = False
    start = np.flatnonzero(ink & ~before)
    end = np.flatnonzero(ink & ~after) + 1
    return start, end, np.searchsorted(offs, start, side="right") - 1


def chunks(column: pa.Array, size: int = CHUNK_BYTES):
    """(first row, bytes, offsets) of runs of rows of a string column, about ``size`` bytes each; null is empty."""
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        part = part.cast(pa.large_binary()).fill_null(b"")
        if not len(part):
            continue
        _, off, dat = part.buffers()
        off = np.frombuffer(off, np.int64)[part.offset: part.offset + len(part) + 1]
        dat = np.frombuffer(dat, np.uint8) if dat is not None else np.zeros(0, np.uint8)
        i = 0
        while i < len(part):
            j = max(i + 1, int(np.searchsorted(off, off[i] + size, side="right")) - 1)
            yield i, dat[off[i]: off[j]], off[i: j + 1] - off[i]
            i = j


def chunked(column: pa.ChunkedArray):
    """``chunks`` over all pieces of a table's column, with row numbers of the table."""
    base = 0
    for part in column.chunks:
        for first, dat, off in chunks(part):
            yield base + first, dat, off
        base += len(part)


# ---- sorted keys -----------------------------------------------------------

def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; for large arrays much cheaper than a hash table."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def merged(runs: list[np.ndarray]):
    """Distinct keys of sorted runs, and the place of each entry of the runs among them."""
    x = np.concatenate(runs)
    order = np.argsort(x, kind="stable")        # merges what is already sorted
    x = x[order]
    new = np.append(True, x[1:] != x[:-1])[: len(x)]
    place = np.empty(len(x), np.int64)
    place[order] = np.cumsum(new) - 1
    return x[new], place


def places(keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The place of each value among the sorted keys; in sorted order, so neighbours read the same memory."""
    order = np.argsort(x)
    out = np.empty(len(x), np.int64)
    out[order] = np.searchsorted(keys, x[order])
    return out


# ---- packing -------------------------------------------------------------

def bounds(n: int) -> np.ndarray:
    """First hash of each of ``n`` buckets."""
    return np.array([(b << 64) // n for b in range(n)], U)


def pack_keys(keys: np.ndarray, base) -> bytes:
    """Sorted keys as differences of the fewest whole bytes."""
    if not len(keys):
        return b"\x01"
    d = np.diff(keys, prepend=U(base))
    w = max(1, (int(d.max()).bit_length() + 7) // 8)
    return bytes([w]) + d.view(np.uint8).reshape(-1, 8)[:, :w].tobytes()


def unpack_keys(blob: bytes, base) -> np.ndarray:
    a = np.frombuffer(blob, np.uint8, offset=1).reshape(-1, blob[0])
    out = np.zeros((len(a), 8), np.uint8)
    out[:, : blob[0]] = a
    return np.cumsum(out.view(U).ravel(), dtype=U) + U(base)


def pack_counts(c: np.ndarray) -> bytes:
    """Counts as bytes; those of 255 and more follow in eight bytes each."""
    big = c >= 255
    return (np.where(big, 255, c).astype(np.uint8).tobytes() + c[big].astype(np.int64).tobytes())


def unpack_counts(blob: bytes, n: int) -> np.ndarray:
    c = np.frombuffer(blob, np.uint8, count=n).astype(np.int64)
    c[c == 255] = np.frombuffer(blob, np.int64, offset=n)
    return c


def pack_ints(a: np.ndarray) -> bytes:
    """Integers in any order, each in the fewest bytes that hold them all above their least."""
    if not len(a):
        return b""
    low = a.min()
    d = (a.astype(U) - low.astype(U))
    w = max(1, (int(d.max()).bit_length() + 7) // 8)
    return bytes([w]) + low.astype(np.int64).tobytes() + d.view(np.uint8).reshape(-1, 8)[:, :w].tobytes()


def unpack_ints(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.int64)
    a = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, blob[0])
    out = np.zeros((len(a), 8), np.uint8)
    out[:, : blob[0]] = a
    return (out.view(U).ravel() + np.frombuffer(blob, np.int64, count=1, offset=1).astype(U)).astype(np.int64)


# ---- blocks in Spark -----------------------------------------------------

def parts(spark: SparkSession, n_bytes: int) -> int:
    """Number of blocks (and of buckets): by size, at least the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-n_bytes // BLOCK_BYTES))


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def blocked(docs: DataFrame, n: int, *extra, keep=()) -> DataFrame:
    """(blk, rows): documents (doc_id, text, columns to keep..., extra...) dealt into ``n`` blocks; null text is empty.

    What a task sends to a block travels as one compressed Arrow stream, which ``block_rows`` reads: much smaller
    than single rows, and a block is shuffled once however many passes read it.
    """
    schema = "blk int, rows binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *keep) \
        .select(F.expr(f"cast(pmod(xxhash64(doc_id, text), {n}) as int)").alias("blk"), "doc_id", "text", *keep, *extra) \
        .mapInArrow(_to_blocks, schema).repartition(n, "blk")


def _to_blocks(batches):
    option = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        blk = batch["blk"].to_numpy()
        order = np.argsort(blk, kind="stable")
        rows = batch.select(batch.schema.names[1:]).take(pa.array(order))
        cut = np.flatnonzero(np.diff(blk[order], prepend=-1))
        out = []
        for i, j in zip(cut, np.append(cut[1:], len(blk))):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=option) as w:
                w.write_batch(rows.slice(i, j - i))
            out.append(sink.getvalue().to_pybytes())
        if out:
            yield pa.record_batch({"blk": pa.array(blk[order][cut], pa.int32()), "rows": pa.array(out, pa.binary())})


def block_rows(table: pa.Table) -> pa.Table:
    """The documents of a block's streams, with blk; the streams' order varies, so sort where order matters."""
    pa.default_memory_pool().release_unused()
    if not table.num_rows:
        return pa.table({"blk": pa.array([], pa.int32()), "doc_id": pa.array([], pa.int64()),
                         "text": pa.array([], pa.string()), "fold": pa.array([], pa.int32())})
    rows = pa.concat_tables([pa.ipc.open_stream(b.as_buffer()).read_all() for b in table["rows"]])
    return rows.append_column("blk", pa.array(np.full(rows.num_rows, table["blk"][0].as_py(), np.int32)))


def rows_table(schema: pa.Schema, cols: dict) -> pa.Table:
    return pa.table({f.name: pa.array(cols[f.name], f.type) for f in schema}, schema=schema)
