"""Operators 11 to 13 against brute force, on small tables that hold the awkward cases."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from scanlake.llm import op11_warc as op11
from scanlake.llm import op12_negatives as op12
from scanlake.llm import op13_runs as op13
from scanlake.session import new_path


# ---------------------------------------------------------------- op11
def b32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def awkward_pages():
    """Copies, payloads of separators and record headers, nulls, ties, repeated rows and one long page."""
    r = random.Random(2)
    junk = lambda n: "".join(r.choice(["\r\n", "\r", "\n", "\r\n\r\n", "WARC/1.1\r\n", "é", "x", "Content-Length: 3\r\n\r\n"])
                             for _ in range(n))
    rows = [(i, r.choice([None, f"http://h/{i}", "http://h/\r\nWARC-Type: x"]),
             r.choice([None, "", junk(r.randint(0, 30)), junk(2), "\r\n\r\n", "a\r\n"])) for i in range(150)]
    return rows + [(5, "u", "same"), (5, "u", "same"), (None, "u", "same"), (None, None, None), (700, "u", "z" * 2_000_000)]


@pytest.mark.parametrize("least", [0, 3])
def test_op11(spark, least):
    rows = awkward_pages()
    pages = spark.createDataFrame([(p, u, h, "a", 1) for p, u, h in rows],
                                  "page_id long, url string, html string, payload_digest string, row int")
    folder = op11.write_archives(op11.records(pages), new_path(spark, "warc"), least_bytes=least)
    read = op11.read_archives(spark, folder, payload=True)
    got = op11.resolved(read.drop("payload")).collect()
    assert collections.Counter((g.page_id, g.payload_bytes, g.payload_digest) for g in got) == \
        collections.Counter((p, len((h or "").encode()), b32(h)) for p, _, h in rows)
    group = collections.defaultdict(list)
    for p, _, h in rows:
        group[b32(h)].append(p)
    size = {b32(h): len((h or "").encode()) for _, _, h in rows}
    told = collections.defaultdict(list)
    for g in got:
        told[g.payload_digest].append(g)
    for digest, ids in group.items():
        kinds = collections.Counter(g.record_type for g in told[digest])
        if size[digest] < least:
            assert kinds == {"response": len(ids)}
            continue
        assert kinds["response"] == 1 and kinds["revisit"] == len(ids) - 1
        first = min(ids, key=lambda p: (p is None, p))
        assert [g.page_id for g in told[digest] if g.record_type == "response"] == [first]
        assert all(g.refers_to == (first if g.record_type == "revisit" else None) for g in told[digest])
    back = read.collect()
    assert len({x.record_id for x in back}) == len(rows)
    assert {(x.payload_digest, bytes(x.payload)) for x in back if x.record_type == "response"} == \
        {(b32(h), (h or "").encode()) for _, _, h in rows}
    assert all(x.payload is None and x.refers_to_id for x in back if x.record_type == "revisit")
    assert not any("\n" in (x.url or "") for x in back)


def test_op11_a_revisit_without_its_response_stays(spark):
    folder = new_path(spark, "warc")
    head = ("WARC/1.1\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:uuid:1>\r\nX-Page-ID: 4\r\n"
            "WARC-Payload-Digest: sha1:ABC\r\nWARC-Refers-To: <urn:uuid:9>\r\nContent-Length: 0\r\n\r\n")
    spark.createDataFrame([(head,)], "value string").write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(folder)
    got = op11.resolved(op11.read_archives(spark, folder)).first()
    assert (got.page_id, got.payload_bytes, got.payload_digest, got.record_type, got.refers_to) == (4, None, "ABC", "revisit", None)


def test_op11_a_cut_archive_is_an_error(spark):
    folder = new_path(spark, "warc")
    spark.createDataFrame([("WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 99\r\n\r\nshort",)], "value string") \
        .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(folder)
    with pytest.raises(Exception, match="ends within a record"):
        op11.read_archives(spark, folder).collect()


def test_op11_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = op11.write_archives(op11.records(pages), new_path(spark, "warc"))
    assert op11.resolved(op11.read_archives(spark, folder)).collect() == []


# ---------------------------------------------------------------- op12
def brute_negatives(rows):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of (vec_id, embedding, label, anchor)."""
    live = []
    for i, v, label, anchor in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        live.append((i, [min(max(math.floor(256 * x), -(1 << 31)), (1 << 31) - 1) for x in v], label, anchor))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for n, (i, v, label, anchor) in enumerate(live):
        if not anchor:
            continue
        dot = [(sum(a * b for a, b in zip(v, w)), k, m, j) for j, (k, w, m, _) in enumerate(live) if j != n]
        dot = [(max(min(s, (1 << 63) - 1), -(1 << 63)), k, m, j) for s, k, m, j in dot]
        for ps, pid, _, _ in sorted((d for d in dot if d[2] == label), key=order)[:5]:
            fits = sorted((d for d in dot if d[2] != label and 80 * ps <= 100 * d[0] <= 100 * ps), key=order)[:5]
            out += [(i, pid, rank, d[1], ps, d[0]) for rank, d in enumerate(fits, 1)]
    return out


def vectors(seed, n, dim, spread):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, dim))
    rows = []
    for i in range(n):
        v = centres[r.integers(6)] + r.normal(size=dim) * spread
        rows.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v)], int(r.integers(4)), i % 10 == 0))
    return rows


@pytest.mark.parametrize("seed,spread,shard,group", [(1, 0.2, 16, 3), (2, 1.0, 1 << 16, 1 << 14), (3, 0.01, 40, 5)])
def test_op12(spark, seed, spread, shard, group):
    rows = vectors(seed, 200, 8, spread)
    same = rows[3][1]
    rows += [(300 + i, same, i % 3, i < 2) for i in range(60)]                      # one hot cell, all ties
    rows += [(400, None, 1, True), (401, [0.5, None] * 4, 1, True), (402, [float("nan")] * 8, 1, True), (403, same, None, True),
             (404, [float("inf")] + [0.0] * 7, 1, False), (405, [], 2, True), (406, [0.9], 1, True), (407, [0.0] * 8, 1, True),
             (None, same, 2, False), (300, same, 0, False), (300, same, 0, True)]
    df = spark.createDataFrame([(i, v, m, a, "x") for i, v, m, a in rows], "vec_id long, embedding array<float>, label int, a boolean, rid string")
    got = op12.mine(df, F.col("a"), codes=6, shard_rows=shard, group_anchors=group).collect()
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert collections.Counter(tuple(g[c] for c in names) for g in got) == collections.Counter(brute_negatives(rows))
    assert len(got) > 100


def test_op12_huge_components(spark):
    rows = [(i, [1e6 * (i + 1), -3e7, float(i)], i % 2, i < 2) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, a boolean")
    rows = [(i, [float(np.float32(x)) for x in v], m, a) for i, v, m, a in rows]
    got = op12.mine(df, F.col("a")).collect()
    assert collections.Counter(tuple(g[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
                               for g in got) == collections.Counter(brute_negatives(rows))


def test_op12_visits_few_cells_of_clustered_rows():
    """On clustered rows the heap stops long before the last cell, and its bounds hold."""
    r = np.random.default_rng(5)
    x = np.repeat(r.normal(size=(40, 16)) * 200, 50, axis=0) + r.normal(size=(2000, 16)) * 3
    x = np.floor(x).astype(np.int64)
    books = op12.Books(x, 16)
    (a, d1), (b, d2) = (op12.nearest(h, c) for h, c in zip(books.halves(x), (books.first, books.second)))
    import pyarrow as pa
    table = pa.table({"rid": np.arange(2000), "vec_id": np.arange(2000), "label": np.arange(2000) % 5,
                      "vec": pa.array(x.tolist(), pa.list_(pa.int32())), "c1": pa.array(a, pa.int32()), "c2": pa.array(b, pa.int32()),
                      "d1": d1, "d2": d2})
    shard, seen = op12.Shard(table, books), 0
    for q in range(0, 2000, 100):
        score, last, rows = shard.x @ x[q], math.inf, 0
        for bound, s in shard.visits(x[q]):
            assert bound <= last + 1e-6 and score[np.arange(2000)[s]].max() <= bound
            last, rows = bound, rows + s.stop - s.start
        assert rows == 2000
        fifth = shard.positives(q, int(shard.label[q]), x[q])[-1]
        seen += sum(1 for bound, _ in shard.visits(x[q]) if bound >= -fifth[0])
    assert seen < 20 * len(shard.rows) / 4


def test_op12_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert op12.mine(df, F.col("vec_id") % 100 == 0).collect() == []


# ---------------------------------------------------------------- op13
def brute_runs(w):
    n, best = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i > s and i + q - s >= max(6, 4 * q):
                best.setdefault((s, i + q), q)          # shorter periods come first
            i = max(i, s + 1)
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def test_op13_runs_of_random_words():
    r = random.Random(1)
    for _ in range(4000):
        n, k = r.randint(0, 60), r.choice([1, 2, 2, 3])
        w = [r.randrange(k) for _ in range(n)]
        if n and r.random() < 0.5:
            a = r.randrange(n)
            p = r.randint(1, max(1, (n - a) // 4))
            w = [w[x] if x < a else w[a + (x - a) % p] for x in range(n)] + [r.randrange(k) for _ in range(r.randint(0, 9))]
        assert op13.runs_of(np.array(w, np.int64)) == brute_runs(w), w


def test_op13_hashes_that_meet_make_no_run(monkeypatch):
    monkeypatch.setattr(op13, "mix", lambda h: h * np.uint64(0))
    assert op13.runs_of(np.arange(50)) == []
    assert op13.runs_of(np.array([1, 2] * 5 + [3])) == [(0, 10, 2)]


def texts():
    r = random.Random(4)
    out = [(i, " ".join(r.choice(["a", "b", "ü", "c d"]) for _ in range(r.randint(0, 50)))) for i in range(120)]
    out += [(200 + i, "x " * 20 + "y") for i in range(5)]
    return out + [(300, None), (301, ""), (302, " \t\n\x0b\x0c\r "), (303, "na " * 30_000 + "end"), (304, "q r s " * 9), (304, "q r s " * 9),
                  (None, "z z z z z z"), (None, None), (-7, "1 2 1 2 1 2 1 2"), (305, "\x1c \x85 \x1c \x85 \x1c \x85 \x1c \x85")]


def expected(doc_id, text):
    w = re.findall("[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w) if n < 1000 else op13.runs_of(op13.numbered(w))
    keep = [True] * n
    for s, size, q in runs:
        keep[s + q: s + size] = [False] * (size - q)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[1] * 1000 // best[2] if runs else None,
            sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(" ".join(x for x, k in zip(w, keep) if k)))


def test_op13(spark, tmp_path):
    rows = texts()
    spark.createDataFrame([(i, t, "en", 1) for i, t in rows], "doc_id long, text string, runs string, n int") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    got = op13.query(spark, str(tmp_path)).collect()
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert collections.Counter(tuple(g[c] for c in names) for g in got) == collections.Counter(expected(*r) for r in rows)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 and t for i, t in rows if i is not None)
    found = {r.doc_id: r for r in op13.find_runs(spark.createDataFrame(rows[-6:-3], "doc_id long, text string")).collect()}
    assert found[304].collapsed == "q r s" and [tuple(x) for x in found[304].runs] == [(0, 27, 3)]


def test_op13_empty(spark):
    assert op13.digests(op13.find_runs(spark.createDataFrame([], "doc_id long, text string"))).collect() == []


# ------------------------------------------------------------ oracle SQL
@pytest.mark.parametrize("op,table", [(op11, "pages"), (op12, "embeddings")])
def test_oracle_sql(spark, op, table):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    rel = con.sql(op.ORACLE)
    got = op.query(spark, sf)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got.columns) == sorted(rel.columns)
    assert sorted((tuple(r[c] for c in rel.columns) for r in got.collect()), key=key) == sorted(rel.fetchall(), key=key)
