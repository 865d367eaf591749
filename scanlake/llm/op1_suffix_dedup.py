"""Operator 1: removal of repeated substrings with suffix arrays built by linear grouping.

A byte goes if some ``length``-byte string covering it also starts in a
document with a smaller id.  All of it is judged on the input.

How the work is cut up.  Every ``length``-byte window has an *anchor*: the
q-gram inside it with the least hash.  The windows of one anchor form a *piece*
(at most ``2 * length - q`` bytes).  Equal windows have equal anchors, so a
window can only be repeated among the pieces with its anchor's hash.  It also
has one of two *cores*: the anchor with half of the window's other bytes before
it, or with the rest behind it.

1. Blocks send the hashes of their distinct cores, a few bytes each, to buckets,
   which answer whether another block has it too.  Windows whose core stands in
   documents of one id only aren't repeated; pieces are cut down to the others.
2. Blocks send (anchor hash, piece hash, least id), and buckets answer whether
   the same piece is in a smaller document and whether other pieces share the
   anchor.
3. Of the latter, blocks send the bytes.  A bucket joins the pieces of one
   anchor into a string, sorts its suffixes (``grouping.suffix_arrays``), and
   windows next to each other with a common prefix of ``length`` give the least
   id.  An anchor with more than ``HOT_PIECES`` different pieces is dealt on as
   single windows, each by its own 64-bit hash and without its bytes, so no
   anchor fills a task.
4. Blocks remove what was found.

What a round sends is at most a few bytes for each byte of text, however often
anchors repeat; blocks grow with the corpus (``dealing``), so that the cells of
(block, bucket) stay few.

Defined cases: null text is empty; a null id is larger than every other; rows
with one id don't remove from each other; shorter texts than ``length`` stay.
Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.llm import blocks as B
from scanlake.llm.grouping import suffix_arrays

LENGTH = 50
QGRAM = 20
HOT_PIECES = 64
SORT_SYMBOLS = 1 << 18          # symbols sorted at one time
LAST_ID = np.iinfo(np.int64).max
CUT = np.uint64(24)             # low bits of an anchor's hash that aren't sent; a piece's own hash has all 64
LARGEST = 4                     # a block holds at most so many times ``blocks.BLOCK_BYTES``
LEVEL = 3                       # of zstd
U = np.uint64

RESULT = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                     ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     ("kept", pa.binary())])
_DEALT = pa.schema([("blk", pa.int32()), ("ids", pa.binary()), ("nulls", pa.binary()), ("lens", pa.binary()),
                    ("text", pa.binary())])
_CORES = pa.schema([("bucket", pa.int32()), ("blk", pa.int32()), ("cores", pa.binary())])
_SHARED = pa.schema([("blk", pa.int32()), ("bucket", pa.int32()), ("shared", pa.binary())])
_ASK = pa.schema([("bucket", pa.int32()), ("blk", pa.int32()), ("keys", pa.binary()), ("pieces", pa.binary()),
                  ("ids", pa.binary()), ("own", pa.binary())])
_TELL = pa.schema([("blk", pa.int32()), ("bucket", pa.int32()), ("flags", pa.binary()), ("own", pa.binary())])
_SEND = pa.schema([("bucket", pa.int32()), ("blk", pa.int32()), ("keys", pa.binary()), ("ids", pa.binary()),
                   ("lens", pa.binary()), ("bytes", pa.binary()), ("hot", pa.binary()), ("hot_ids", pa.binary()),
                   ("own", pa.binary())])
_BACK = pa.schema([("blk", pa.int32()), ("bucket", pa.int32()), ("masks", pa.binary()), ("hot", pa.binary()),
                   ("own", pa.binary())])


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'binary'}" for f in schema)


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays of integers, each in the fewest bytes, as one compressed string."""
    blobs = [B.pack_ints(x) for x in arrays]
    raw = np.array([len(x) for x in blobs], np.int64).tobytes() + b"".join(blobs)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=LEVEL).compress(raw, asbytes=True)


def unpack_arrays(blob: bytes, n: int) -> list[np.ndarray]:
    raw = pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    cut = np.append(0, np.cumsum(np.frombuffer(raw, np.int64, count=n))) + 8 * n
    return [B.unpack_ints(raw[i:j]) for i, j in zip(cut[:-1], cut[1:])]


def pack_bits(x: np.ndarray) -> bytes:
    return np.packbits(x).tobytes()


def unpack_bits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


def dealing(spark: SparkSession, n_bytes: int) -> int:
    """Number of blocks: of ``blocks.BLOCK_BYTES``, from 4 GB of text on of more.

    The cells of (block, bucket), of which each exchange has a row, grow with the square of this number.
    """
    more = min(LARGEST, max(1, int((n_bytes / (1 << 30)) ** 0.5)))
    return B.parts(spark, -(-n_bytes // more))


def _deal(batches):
    codec = pa.Codec("zstd", compression_level=LEVEL)
    for batch in batches:
        blk = batch["blk"].to_numpy()
        order = np.argsort(blk, kind="stable")
        ids = batch["doc_id"].take(pa.array(order))
        nulls = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        text = batch["text"].cast(pa.large_binary()).take(pa.array(order))
        _, off, dat = text.buffers()
        off = np.frombuffer(off, np.int64)[text.offset: text.offset + len(text) + 1]
        cut = np.flatnonzero(np.diff(blk[order], prepend=-1))
        out = {f.name: [] for f in _DEALT}
        for i, j in zip(cut, np.append(cut[1:], len(blk))):
            body = dat.slice(off[i], off[j] - off[i]) if off[j] > off[i] else b""
            for name, v in zip(out, (blk[order[i]], B.pack_ints(ids[i:j]), pack_bits(nulls[i:j]) if nulls[i:j].any() else None,
                                     B.pack_ints(np.diff(off[i: j + 1])), codec.compress(body, asbytes=True))):
                out[name].append(v)
        if len(blk):
            yield from B.rows_table(_DEALT, out).to_batches()


def dealt(docs: DataFrame, n: int) -> DataFrame:
    """``blocks.blocked`` for doc_id and text alone: a task's rows of a block as packed ids and compressed text, which
    stay small where there are so many blocks that these are a row or two."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .select(F.expr(f"cast(pmod(xxhash64(doc_id, text), {n}) as int)").alias("blk"), "doc_id", "text") \
        .mapInArrow(_deal, ddl(_DEALT)).repartition(n, "blk")


def in_order(table: pa.Table) -> pa.Table:
    """The block's documents in an order that is the same in every pass."""
    pa.default_memory_pool().release_unused()
    codec, ids, nulls, lens, text = pa.Codec("zstd"), [], [], [], []
    for k in range(table.num_rows):
        row = {name: table[name][k] for name in ("ids", "nulls", "lens", "text")}
        ids.append(B.unpack_ints(row["ids"].as_py()))
        lens.append(B.unpack_ints(row["lens"].as_py()))
        nulls.append(unpack_bits(row["nulls"].as_py(), len(ids[-1])) if row["nulls"].is_valid else np.zeros(len(ids[-1]), bool))
        text.append(codec.decompress(row["text"].as_buffer(), int(lens[-1].sum()), asbytes=True))
    if not ids:
        return pa.table({"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.large_binary())})
    off = np.append(0, np.cumsum(np.concatenate(lens)))
    text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(off) - 1, [None, pa.py_buffer(off), pa.py_buffer(b"".join(text))])
    table = pa.table({"doc_id": pa.array(np.concatenate(ids), mask=np.concatenate(nulls)), "text": text})
    return table.take(pc.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")]))


def ids_of(table: pa.Table) -> np.ndarray:
    return table["doc_id"].fill_null(LAST_ID).to_numpy().astype(np.int64)


def anchors(dat: np.ndarray, off: np.ndarray, length: int, q: int):
    """Per anchor of a run of documents: its hash, place, document, first and last window start; and prefix hashes."""
    n, w = len(dat), length - q + 1
    cum = B.prefix_hash(dat, B.RAW)
    none = np.zeros(0, np.int64)
    if n < length:
        return none.astype(U), none, none, none, none, cum
    h = B.gram_hash(cum, q)
    bits = max(24, int(n - 1).bit_length())
    least = ((h >> U(bits)) << U(bits)) | np.arange(n - q + 1, dtype=U)     # hash, then the leftmost
    span = 1
    while span * 2 <= w:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if w > span:
        least = np.minimum(least[: len(least) - (w - span)], least[w - span:])
    anchor = (least & U((1 << bits) - 1)).astype(np.int64)
    ends = np.zeros(n + 1, np.int32)
    ends[off[1:-1]] = 1
    ends = np.cumsum(ends)
    anchor[ends[length - 1: n] > ends[: len(anchor)]] = -1      # windows that reach into the next document
    cut = np.flatnonzero(np.diff(anchor, prepend=-2))           # documents share no anchor
    last = np.append(cut[1:], len(anchor)) - 1
    inside = anchor[cut] >= 0
    a, b = cut[inside], last[inside]
    at = anchor[a]
    return B.mix(h[at]) >> CUT << CUT, at, np.searchsorted(off, a, side="right") - 1, a, b, cum


def runs_of(table: pa.Table, ids: np.ndarray, length: int, q: int, shift):
    """Per run of documents its first row, bytes, offsets and anchors; the distinct cores of all; each anchor's place
    of its cores there, -1 where it has none; and which cores stand in documents of several ids of this block."""
    half = (length - q) // 2
    runs, cores = [], []
    for first, dat, off in B.chunked(table["text"]):
        h, at, d, a, b, cum = anchors(dat, off, length, q)
        left, right = a <= at - half, b > at - half
        key = np.zeros((2, len(h)), U)
        key[0, left] = B.span_hash(cum, at[left] - half, at[left] + q)
        key[1, right] = B.span_hash(cum, at[right], at[right] - half + 1 + length)
        runs.append((first, dat, off, h, at, d, a, b))
        cores.append((key >> shift, np.stack([left, right]), np.broadcast_to(ids[first + d], key.shape)))
    if not runs:
        return [], np.zeros(0, U), [], np.zeros(0, bool)
    has = np.concatenate([x[1] for x in cores], 1)
    key, own = (np.concatenate([x[k] for x in cores], 1)[has] for k in (0, 2))
    del cores
    o = np.argsort(key, kind="stable")
    new = np.flatnonzero(np.append(True, key[o][1:] != key[o][:-1])) if len(o) else o
    place = np.full(has.shape, -1)
    inner = np.empty(len(o), np.int64)
    inner[o] = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(o))))
    place[has] = inner
    own = own[o]
    several = np.minimum.reduceat(own, new) != np.maximum.reduceat(own, new) if len(o) else np.zeros(0, bool)
    places = np.split(place, np.cumsum([len(r[3]) for r in runs])[:-1], axis=1)
    return runs, key[o][new], places, several


def cut_down(run, place: np.ndarray, shared: np.ndarray, length: int, q: int):
    """A run's anchors with a shared core: hash, piece's hash, document, first and last start of windows with one."""
    _, dat, _, h, at, d, a, b = run
    left, right = ((k >= 0) & shared[k] for k in place) if len(shared) else (np.zeros(len(h), bool),) * 2
    half = (length - q) // 2
    a, b = np.where(left, a, np.maximum(a, at - half + 1)), np.where(right, b, np.minimum(b, at - half))
    s = np.flatnonzero(left | right)
    return h[s], B.span_hash(B.prefix_hash(dat, B.RAW), a[s], b[s] + length), d[s], a[s], b[s]


def _distinct(h, p, ids):
    """Sorted distinct (anchor, piece) with the least id, and each row's place there."""
    o = np.lexsort((ids, p, h))
    new = np.ones(len(o), bool)
    new[1:] = (h[o][1:] != h[o][:-1]) | (p[o][1:] != p[o][:-1])
    place = np.empty(len(o), np.int64)
    place[o] = np.cumsum(new) - 1
    f = o[new]
    return h[f], p[f], ids[f], place


def merged(spans: np.ndarray) -> np.ndarray:
    """(document, start, end) rows with those that meet made one."""
    if not len(spans):
        return spans.reshape(0, 3)
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    far = spans[:, 0] * (1 << 40)
    reach = np.maximum.accumulate(far + spans[:, 2])
    cut = np.flatnonzero(np.append(True, (far + spans[:, 1])[1:] > reach[:-1]))
    return np.stack([spans[cut, 0], spans[cut, 1], reach[np.append(cut[1:], len(spans)) - 1] - far[cut]], 1)


def _cores(nb: int, length: int, q: int, shift):
    edges = B.bounds(nb)

    def cores(table: pa.Table) -> pa.Table:
        blk = table["blk"][0].as_py()
        table = in_order(table)
        _, key, _, _ = runs_of(table, ids_of(table), length, q, shift)
        out = {f.name: [] for f in _CORES}
        cut = np.append(np.searchsorted(key, edges >> shift), len(key))
        for k in np.flatnonzero(np.diff(cut)):
            for name, v in zip(out, (k, blk, B.pack_keys(key[cut[k]: cut[k + 1]], edges[k] >> shift))):
                out[name].append(v)
        return B.rows_table(_CORES, out)

    return cores


def _share(nb: int, shift):
    edges = B.bounds(nb)

    def share(table: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        rows = table.to_pylist()
        keys = [B.unpack_keys(r["cores"], edges[r["bucket"]] >> shift) for r in rows]
        _, place = B.merged(keys)
        shared = np.bincount(place)[place] > 1
        ends = np.cumsum([len(x) for x in keys])
        return B.rows_table(_SHARED, {"blk": [r["blk"] for r in rows], "bucket": [r["bucket"] for r in rows],
                                      "shared": [pack_bits(x) for x in np.split(shared, ends[:-1])]})

    return share


def _ask(nb: int, length: int, q: int, shift):
    edges = B.bounds(nb)

    def ask(table: pa.Table, told: pa.Table) -> pa.Table:
        out = {f.name: [] for f in _ASK}
        if not table.num_rows:
            return B.rows_table(_ASK, out)
        blk = table["blk"][0].as_py()
        table = in_order(table)
        ids = ids_of(table)
        runs, key, places, shared = runs_of(table, ids, length, q, shift)
        if len(key):
            cut = np.append(np.searchsorted(key, edges >> shift), len(key))
            for r in told.to_pylist():
                s = slice(cut[r["bucket"]], cut[r["bucket"] + 1])
                shared[s] |= unpack_bits(r["shared"], s.stop - s.start)
            found = [cut_down(r, p, shared, length, q)[:3] for r, p in zip(runs, places)]
            h, p, d, _ = _distinct(*(np.concatenate(x) for x in (
                [x[0] for x in found], [x[1] for x in found], [ids[r[0] + x[2]] for r, x in zip(runs, found)])))
            cut = np.append(np.searchsorted(h, edges), len(h))
            for k in np.flatnonzero(np.diff(cut)):
                s = slice(cut[k], cut[k + 1])
                for name, v in zip(out, (k, blk, B.pack_keys(h[s] >> CUT, edges[k] >> CUT), p[s].tobytes(),
                                         B.pack_ints(d[s]), None)):
                    out[name].append(v)
            for name, v in zip(out, (blk % nb, blk, None, None, None, pack_bits(shared))):
                out[name].append(v)
        return B.rows_table(_ASK, out)

    return ask


def _tell(nb: int):
    edges = B.bounds(nb)

    def tell(table: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        rows = table.to_pylist()
        out = {"blk": [r["blk"] for r in rows], "bucket": [r["bucket"] for r in rows], "flags": [None] * len(rows),
               "own": [r["own"] for r in rows]}
        base = edges[rows[0]["bucket"]]
        asked = [i for i, r in enumerate(rows) if r["own"] is None]
        if asked:
            hs = [B.unpack_keys(rows[i]["keys"], base >> CUT) << CUT for i in asked]
            h = np.concatenate(hs)
            p = np.concatenate([np.frombuffer(rows[i]["pieces"], U) for i in asked])
            d = np.concatenate([B.unpack_ints(rows[i]["ids"]) for i in asked])
            uh, _, least, place = _distinct(h, p, d)
            new = np.ones(len(uh), bool)
            new[1:] = uh[1:] != uh[:-1]
            which = np.cumsum(new) - 1
            n_pieces = np.bincount(which)[which]
            flags = ((least[place] < d).astype(np.uint8) | ((n_pieces > 1)[place] * np.uint8(2))
                     | ((n_pieces > HOT_PIECES)[place] * np.uint8(4)))
            for i, x in zip(asked, np.split(flags, np.cumsum([len(x) for x in hs])[:-1])):
                out["flags"][i] = x.tobytes()
        return B.rows_table(_TELL, out)

    return tell


def windows(a: np.ndarray, n: np.ndarray):
    """Starts of ``n`` windows from each ``a`` on, and whose they are."""
    s = np.repeat(np.arange(len(a)), n)
    return a[s] + np.arange(len(s)) - np.repeat(np.cumsum(n) - n, n), s


def _send(ns: int, length: int, q: int, shift):
    edges = B.bounds(ns)

    def send(table: pa.Table, told: pa.Table) -> pa.Table:
        out = {f.name: [] for f in _SEND}
        if not table.num_rows:
            return B.rows_table(_SEND, out)
        blk = table["blk"][0].as_py()
        table = in_order(table)
        ids = ids_of(table)
        runs, key, places, _ = runs_of(table, ids, length, q, shift)
        if len(key):
            told = sorted(told.to_pylist(), key=lambda r: r["bucket"])
            shared = next(unpack_bits(r["own"], len(key)) for r in told if r["own"] is not None)
            flags = np.frombuffer(b"".join(r["flags"] for r in told if r["own"] is None), np.uint8)
            found = [cut_down(r, p, shared, length, q) for r, p in zip(runs, places)]
            h, p, least, place = _distinct(*(np.concatenate(x) for x in (
                [x[0] for x in found], [x[1] for x in found], [ids[r[0] + x[2]] for r, x in zip(runs, found)])))
            known, pieces, hot = [], [], []
            i = 0
            for (first, dat, off, *_), (rh, rp, d, a, b) in zip(runs, found):
                u = place[i: i + len(rh)]
                i += len(rh)
                row, local = first + d, off[d]
                gone = (ids[row] > least[u]) | (flags[u] & 1 > 0)
                known.append(np.stack([row, a - local, b + length - local], 1)[gone])
                s = np.flatnonzero(~gone & (flags[u] & 6 == 2))
                pieces.append((rh[s], rp[s], ids[row[s]], (b - a)[s] + length, row[s], (a - local)[s],
                               B.take_spans(dat, a[s], (b - a)[s] + length)))
                s = np.flatnonzero(~gone & (flags[u] & 6 == 6))         # single windows, by their own hash
                at, of = windows(a[s], (b - a + 1)[s])
                hashes = B.span_hash(B.prefix_hash(dat, B.RAW), at, at + length) if len(s) else np.zeros(0, U)
                hot.append((hashes, ids[row[s]][of], row[s], (a - local)[s], (b - a + 1)[s]))
            del runs, found
            # one of each (key, bytes); what else has these bytes shares the answer
            ph, pp, pid, size, row, at, byte = (np.concatenate(x) for x in zip(*pieces))
            begin = np.cumsum(size) - size
            kk, _, dd, place = _distinct(ph, pp, pid)
            pick = np.empty(len(kk), np.int64)
            pick[place[::-1]] = np.arange(len(place))[::-1]
            own = pid == dd[place]
            known.append(np.stack([row, at, at + size], 1)[~own])
            used = [np.diff(row[own], prepend=0), at[own], place[own]]
            wh, wid, row, at, n = (np.concatenate(x) for x in zip(*hot))
            used += [np.diff(row, prepend=0), at, n]
            starts, of = windows(at, n)
            wk, _, wd, place = _distinct(wh, wh, wid)
            late = wid > wd[place]
            known.append(np.stack([row[of], starts, starts + length], 1)[late])
            cut, hot_cut = np.append(np.searchsorted(kk, edges), len(kk)), np.append(np.searchsorted(wk, edges), len(wk))
            for k in np.flatnonzero(np.diff(cut) + np.diff(hot_cut)):
                s, t = slice(cut[k], cut[k + 1]), slice(hot_cut[k], hot_cut[k + 1])
                z = size[pick[s]]
                body = pa.Codec("zstd").compress(B.take_spans(byte, begin[pick[s]], z), asbytes=True)
                for name, v in zip(out, (k, blk, B.pack_keys(kk[s] >> CUT, edges[k] >> CUT), B.pack_ints(dd[s]),
                                         B.pack_ints(z), body, B.pack_keys(wk[t], edges[k]), B.pack_ints(wd[t]), None)):
                    out[name].append(v)
            row, at, end = merged(np.concatenate(known)).T
            own = pack_arrays(np.diff(row, prepend=0), at, end - at, *used)
            for name, v in zip(out, (blk % ns, blk, None, None, None, None, None, None, own)):
                out[name].append(v)
        return B.rows_table(_SEND, out)

    return send


def least_in_windows(data: np.ndarray, size: np.ndarray, key: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """Bit ``k`` of a piece's mask: its window at ``k`` is also in a piece of the same key with a smaller id.

    Pieces come sorted by key, without equal ones under a key.
    """
    masks = np.zeros(len(size), np.uint64)
    begin = np.cumsum(size) - size
    lane_first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    lane_n = np.diff(np.append(lane_first, len(key)))
    lane_len = np.add.reduceat(size, lane_first) + lane_n if len(key) else lane_n
    todo = np.flatnonzero(lane_n > 1)
    todo = todo[np.argsort(lane_len[todo], kind="stable")]     # lanes of like length advance together
    i = 0
    while i < len(todo):
        j = i + max(1, int(np.searchsorted(np.cumsum(lane_len[todo[i:]]), SORT_SYMBOLS, side="right")))
        lanes, i = todo[i:j], j
        n = lane_n[lanes]
        piece = np.repeat(lane_first[lanes] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        z = size[piece]
        to = np.cumsum(z + 1) - (z + 1)                          # each piece, then a separator
        text = np.ones(int((z + 1).sum()), np.int16)
        ends = np.cumsum(z)
        inner = np.arange(ends[-1]) - np.repeat(ends - z, z)
        text[np.repeat(to, z) + inner] = data[np.repeat(begin[piece], z) + inner].astype(np.int16) + 2
        lane_end = np.cumsum(lane_len[lanes])
        text[lane_end - 1] = 0                                   # the last separator ends the lane
        sa = suffix_arrays(text, np.append(0, lane_end))
        owner = np.repeat(np.arange(len(piece)), z + 1)
        at = np.arange(len(text)) - np.repeat(to, z + 1)
        window = sa[(at + length <= np.repeat(z, z + 1))[sa]]
        lane_of = np.repeat(np.repeat(np.arange(len(lanes)), n), z + 1)
        same = np.zeros(len(window), bool)
        for s in range(1, len(window), 1 << 15):
            x, y = window[s: s + (1 << 15)], window[s - 1: s - 1 + min(1 << 15, len(window) - s)]
            span = np.arange(length)
            same[s: s + len(x)] = (text[x[:, None] + span] == text[y[:, None] + span]).all(1)
        same[1:] &= lane_of[window[1:]] == lane_of[window[:-1]]
        run = np.flatnonzero(~same)
        own = ids[piece[owner[window]]]
        least = np.repeat(np.minimum.reduceat(own, run), np.diff(np.append(run, len(own))))
        hit = least < own
        np.bitwise_or.at(masks, piece[owner[window[hit]]], U(1) << at[window[hit]].astype(U))
    return masks


def _sort(ns: int, length: int, q: int):
    edges, wide = B.bounds(ns), (length - q) // 8 + 1       # bytes of a mask

    def sort(table: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        rows = table.to_pylist()
        sent = [r for r in rows if r["own"] is None]
        out = {"blk": [], "bucket": [], "masks": [], "hot": [], "own": []}
        for r in rows:
            if r["own"] is not None:
                for name, v in zip(out, (r["blk"], -1, None, None, r["own"])):
                    out[name].append(v)
        if sent:
            base = edges[sent[0]["bucket"]]
            ids = [B.unpack_ints(r["ids"]) for r in sent]
            cut = np.cumsum([len(x) for x in ids])
            ids = np.concatenate(ids)
            key = np.concatenate([B.unpack_keys(r["keys"], base >> CUT) << CUT for r in sent])
            sizes = [B.unpack_ints(r["lens"]) for r in sent]
            size = np.concatenate(sizes)
            data, piece = [], []
            for r, z in zip(sent, sizes):
                end = np.cumsum(z)
                body = pa.Codec("zstd").decompress(r.pop("bytes"), int(z.sum()), asbytes=True) if len(z) else b""
                data.append(np.frombuffer(body, np.uint8))
                piece.append(B.span_hash(B.prefix_hash(data[-1], B.RAW), end - z, end))
            data = np.concatenate(data)
            begin = np.cumsum(size) - size
            uk, _, least, place = _distinct(key, np.concatenate(piece), ids)
            pick = np.empty(len(uk), np.int64)
            pick[place[::-1]] = np.arange(len(place))[::-1]
            z = size[pick]
            body = B.take_spans(data, begin[pick], z)
            masks = least_in_windows(body, z, uk, least, length)[place]
            whole = U(0xFFFFFFFFFFFFFFFF) >> (63 - (size - length)).astype(U)
            masks = np.where(least[place] < ids, whole, masks)
            masks = masks.view(np.uint8).reshape(-1, 8)[:, :wide]
            # single windows
            hot = [B.unpack_keys(r["hot"], base) for r in sent]
            hot_cut = np.cumsum([len(x) for x in hot])
            ids = np.concatenate([B.unpack_ints(r["hot_ids"]) for r in sent])
            hot = np.concatenate(hot)
            _, _, least, place = _distinct(hot, hot, ids)
            hit = least[place] < ids
            for r, m, w in zip(sent, np.split(masks, cut[:-1]), np.split(hit, hot_cut[:-1])):
                for name, v in zip(out, (r["blk"], r["bucket"], m.tobytes(), pack_bits(w), None)):
                    out[name].append(v)
        return B.rows_table(_BACK, out)

    return sort


def _remove(ns: int, length: int, q: int):
    edges, wide = B.bounds(ns), (length - q) // 8 + 1

    def remove(table: pa.Table, back: pa.Table) -> pa.Table:
        table = in_order(table)
        rows = sorted(back.to_pylist(), key=lambda r: r["bucket"])
        own = [r["own"] for r in rows if r["own"] is not None]
        rows = [r for r in rows if r["own"] is None]
        gone = []
        if own:
            row, at, size, of, begin, place, hot_row, hot_at, hot_n = unpack_arrays(own[0], 9)
            row, of, hot_row = np.cumsum(row), np.cumsum(of), np.cumsum(hot_row)
            gone.append(np.stack([row, at, at + size], 1))
            masks = np.frombuffer(b"".join(r["masks"] for r in rows), np.uint8).reshape(-1, wide)[place]
            for k in range(length - q + 1):
                hit = masks[:, k >> 3] >> np.uint8(k & 7) & np.uint8(1) > 0
                gone.append(np.stack([of[hit], begin[hit] + k, begin[hit] + k + length], 1))
            if len(hot_row):                            # the windows again, in the order of their hashes
                hashes, starts, of = [], [], []
                for first, dat, off in B.chunked(table["text"]):
                    i, j = np.searchsorted(hot_row, [first, first + len(off) - 1])
                    at, k = windows(hot_at[i:j], hot_n[i:j])
                    row = hot_row[i:j][k]
                    begin = at + off[row - first]
                    if len(at):
                        hashes.append(B.span_hash(B.prefix_hash(dat, B.RAW), begin, begin + length))
                        starts.append(at), of.append(row)
                key, place = np.unique(np.concatenate(hashes), return_inverse=True)
                starts, of = np.concatenate(starts), np.concatenate(of)
                cut = np.append(np.searchsorted(key, edges), len(key))
                told = np.zeros(len(key), bool)
                for r in rows:
                    k = slice(cut[r["bucket"]], cut[r["bucket"] + 1])
                    told[k] = unpack_bits(r["hot"], k.stop - k.start)
                hit = told[place]
                gone.append(np.stack([of[hit], starts[hit], starts[hit] + length], 1))
        gone = np.concatenate(gone) if gone else np.zeros((0, 3), np.int64)
        gone = gone[np.argsort(gone[:, 0], kind="stable")]
        out = {f.name: [] for f in _RESULT}
        ids = table["doc_id"].to_pylist()
        for first, dat, off in B.chunked(table["text"]):
            i, j = np.searchsorted(gone[:, 0], [first, first + len(off) - 1])
            cover = np.zeros(len(dat) + 1, np.int32)
            base = off[gone[i:j, 0] - first]
            np.add.at(cover, base + gone[i:j, 1], 1)
            np.add.at(cover, base + gone[i:j, 2], -1)
            cover = np.cumsum(cover[:-1]) > 0
            for k in range(len(off) - 1):
                c, d = cover[off[k]: off[k + 1]], dat[off[k]: off[k + 1]]
                edge = np.flatnonzero(np.diff(c.astype(np.int8), prepend=0, append=0))
                out["doc_id"].append(ids[first + k])
                out["n_bytes"].append(len(d))
                out["spans"].append([{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2])])
                out["kept"].append((d[~c] if len(edge) else d).tobytes())
        return B.rows_table(_RESULT, out)

    return remove


def remove_repeats(docs: DataFrame, length: int = LENGTH, qgram: int = QGRAM) -> DataFrame:
    """doc_id, n_bytes, spans (removed runs of bytes), kept (the bytes that remain); one row per document."""
    if not qgram < length <= qgram + 63:
        raise ValueError("length must exceed qgram by 1 to 63")
    n_bytes = B.text_bytes(docs)
    nb = dealing(docs.sparkSession, n_bytes)
    ns = B.parts(docs.sparkSession, -(-n_bytes // LARGEST))       # buckets that sort: little of a block goes there
    shift = U(max(0, 64 - max(32, n_bytes.bit_length() + 5)))     # a core's hash is cut to bits of which few agree by chance
    t = dealt(docs, nb)
    shared = t.groupBy("blk").applyInArrow(_cores(nb, length, qgram, shift), ddl(_CORES)) \
        .repartition(nb, "bucket").groupBy("bucket").applyInArrow(_share(nb, shift), ddl(_SHARED))
    told = t.groupBy("blk").cogroup(shared.groupBy("blk")).applyInArrow(_ask(nb, length, qgram, shift), ddl(_ASK)) \
        .repartition(nb, "bucket").groupBy("bucket").applyInArrow(_tell(nb), ddl(_TELL))
    sent = t.groupBy("blk").cogroup(told.groupBy("blk")).applyInArrow(_send(ns, length, qgram, shift), ddl(_SEND))
    back = sent.repartition(ns, "bucket").groupBy("bucket").applyInArrow(_sort(ns, length, qgram), ddl(_BACK))
    return t.groupBy("blk").cogroup(back.groupBy("blk")).applyInArrow(_remove(ns, length, qgram), RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return r.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                    F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
