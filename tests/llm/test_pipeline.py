"""The pipeline's stages on a small table."""

import random

import pytest

import corpus_pipeline as P
from scanlake.llm import components as C
from scanlake.llm import op5_pii as op5


def test_stages(spark, tmp_path):
    r = random.Random(4)
    vocab = ["".join(r.choice("abcdefg") for _ in range(4)) for _ in range(300)]
    prose = lambda k: " ".join(r.choice(vocab) for _ in range(k))
    item = prose(30)
    rows, labels = [], []
    for i in range(160):
        toxic = i % 5 == 0
        w = prose(40).split()
        for _ in range(3 if toxic else 0):
            w.insert(r.randrange(len(w)), r.choice(["scum", "moron", "idiot"]))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    base = prose(80).split()
    rows += [(200 + k, " ".join(base[:k] + ["new"] + base[k + 1:])) for k in range(10, 14)]
    rows += [(300, prose(10) + " " + item + " " + prose(10)), (301, "mail me at a.b@c.example.org today"), (302, None), (303, ""), (303, "")]
    sf = str(tmp_path)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 0.5) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, toxicity string, matches double")
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    held = [docs]
    for name, stage in P.STAGES:
        out = P.written(stage(spark, held[-1], sf), "test_stage")
        if name != "packing":
            assert out.columns == docs.columns
        held.append(out)
    ids = [sorted(x.doc_id for x in d.select("doc_id").collect()) for d in held]
    assert {i for i in range(160) if i not in ids[1]} == {i for i in range(160) if i % 5 == 0}
    assert [i for i in ids[2] if 200 <= i < 300] == [200 + 10] and ids[2].count(303) == 1
    assert 300 in ids[2] and 300 not in ids[3] and set(ids[2]) - set(ids[3]) == {300}
    masked = {x.doc_id: (x.text, x.n_chars) for x in held[4].collect()}
    assert masked[301] == ("mail me at [email] today", 24) and masked[302][0] is None
    assert set(ids[5]) == set(ids[4])
    assert P.run(spark, sf).count() == held[5].count()


def test_near_copies_decides_by_row(spark, tmp_path):
    r = random.Random(6)
    prose = lambda: " ".join("".join(r.choice("abcdefg") for _ in range(4)) for _ in range(60))
    a, b, c, d = (prose() for _ in range(4))
    rows = [(3, b), (5, a), (5, b + " end"), (None, c), (None, c), (None, c + " end"), (7, d), (7, d + " end"), (None, a),
            (8, ""), (8, ""), (9, None), (9, None), (None, ""), (None, "")]
    docs = P.written(spark.createDataFrame(rows, "doc_id long, text string"), "test_rows")
    got = sorted(((x.doc_id, x.text) for x in P.near_copies(spark, docs, str(tmp_path)).collect()), key=str)
    kept = {i: [t for j, t in got if i == j] for i in (3, 5, 7, 8, 9)}
    assert kept[3] == [b] and kept[5] == [a] and len(kept[7]) == 1 and kept[8] == [""] and kept[9] == [None]
    assert sum(i is None and t in (c, c + " end") for i, t in got) == 1 and got.count((None, a)) == 0 and got.count((None, "")) == 2


@pytest.mark.parametrize("held", [C.HELD, 0])
def test_marks_by_number(spark, monkeypatch, held):
    monkeypatch.setattr(C, "HELD", held)
    numbers = [*range(20), 32767, 32768, 65535, 65536, (1 << 33) - 1, 1 << 33, (5 << 33) + 3, (1 << 60) + 7]
    df = spark.createDataFrame([(n, f"t{n}") for n in numbers], "n long, bitmap_bits string")
    marks = spark.createDataFrame([(n,) for n in numbers[::3] * 2], "m long")
    got = C.marked(df, "n", marks, "hit")
    assert got.columns == ["n", "bitmap_bits", "hit"]
    assert {(x.n, x.bitmap_bits, x.hit) for x in got.collect()} == {(n, f"t{n}", n in numbers[::3]) for n in numbers}
    assert not any(x.hit for x in C.marked(df, "n", marks.limit(0), "hit").collect())


def _shuffled(df):
    """The plan's text, and how many of its joins deal out both sides by a key."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan, ["SortMergeJoin" in x for x in plan.splitlines()].count(True)


def test_texts_stay_where_they_are_read(spark, tmp_path):
    """However many rows go, near_copies shuffles no text at its end, and redaction only those that may hold spans."""
    r = random.Random(8)
    prose = lambda: " ".join("".join(r.choice("abcdefg") for _ in range(4)) for _ in range(30))
    rows = [(i, prose()) for i in range(60)]
    rows += [(100 + i, t + " end") for i, t in rows[:20]] + [(200, "mail me at a.b@c.example.org today"), (201, None)]
    docs = P.written(spark.createDataFrame(rows, "doc_id long, text string"), "test_rows")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # as on tables too large to be broadcast
    try:
        kept = P.near_copies(spark, docs, str(tmp_path))
        plan, joins = _shuffled(kept)
        assert joins == 0 and "hashpartitioning" not in plan
        assert sorted(x.doc_id for x in kept.collect()) == [*range(60), 200, 201]
        red = op5.redacted(docs)
        branches = red._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter")
        assert _shuffled(red)[1] == 1 and len(branches) == 4 and "Union" in branches[0]
        assert {x.doc_id: x.text for x in red.collect()} == dict(rows) | {200: "mail me at [email] today"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
