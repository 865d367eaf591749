"""The ten operators against brute force, on small tables that hold the awkward cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanlake.llm import grouping
from scanlake.llm import op1_suffix_dedup as op1
from scanlake.llm import op2_lm_score as op2
from scanlake.llm import op3_toxicity as op3
from scanlake.llm import op4_fingerprint as op4
from scanlake.llm import op5_pii as op5
from scanlake.llm import op6_html as op6
from scanlake.llm import op7_decontaminate as op7
from scanlake.llm import op8_pack as op8
from scanlake.llm import op9_chat as op9
from scanlake.llm import op10_jaccard_join as op10

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, blk string, rows int, fold string, row int, key string"


def words(text):
    return re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def corpus(seed=3, n=60):
    """(id, text): copies, near copies, shared passages, one long text, nulls, ties and repeated rows."""
    r = random.Random(seed)
    vocab = ["".join(r.choice(["th", "er", "on", "an", "é", "ß"]) for _ in range(r.randint(1, 4))) for _ in range(300)]
    prose = lambda k: " ".join(r.choice(vocab) for _ in range(k)).capitalize() + "."
    shared, base = prose(30), prose(120).split(" ")
    out = [(i, prose(r.randint(1, 80))) for i in range(n)]
    out += [(100 + i, out[3][1]) for i in range(8)]
    for i in range(8):
        near = list(base)
        near[r.randrange(len(near))] = "edited"
        out.append((200 + i, " ".join(near)))
        out.append((300 + i, prose(20) + "\n" + shared + " " + prose(20)))
    out += [(400, None), (401, ""), (402, " \t\n "), (403, prose(4000)), (404, "x"), (404, "x"), (405, "é" * 70), (406, "é" * 90)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "b", 1, "f", 2, "k") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs():
    return corpus()


def by_id(rows):
    out = collections.defaultdict(list)
    for r in rows:
        out[r["doc_id"]].append(r)
    return out


def test_grouping_sorts_suffixes():
    r = np.random.default_rng(1)
    for _ in range(60):
        lanes = [np.append(r.integers(1, 4, size=r.integers(0, 30)), 0) for _ in range(5)]
        offs = np.append(0, np.cumsum([len(x) for x in lanes]))
        got = grouping.suffix_arrays(np.concatenate(lanes), offs)
        for k, x in enumerate(lanes):
            assert (got[offs[k]:offs[k + 1]] - offs[k]).tolist() == sorted(range(len(x)), key=lambda i: x[i:].tolist())


@pytest.mark.parametrize("hot", [1, 64])
def test_op1(spark, docs, monkeypatch, hot):
    monkeypatch.setattr(op1, "HOT_PIECES", hot)
    got = by_id(op1.remove_repeats(frame(spark, docs)).collect())
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        for s in range(len(b) - 49):
            first[b[s:s + 50]] = min(i, first.get(b[s:s + 50], i))
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 49):
            if first[b[s:s + 50]] < i:
                gone[s:s + 50] = b"\1" * 50
        for g in got[i]:
            assert (g.n_bytes, bytes(g.kept)) == (len(b), bytes(x for x, k in zip(b, gone) if not k)), i
            assert sum(s.end - s.start for s in g.spans) == sum(gone)
    assert len(got[404]) == 2 and got[406][0].kept != got[405][0].kept
    assert sum(len(b"".join([g.kept])) for rows in got.values() for g in rows) < sum(len((t or "").encode()) for _, t in docs)


def shuffled(df):
    """Rows of ``df``, and the bytes that its exchanges wrote."""
    rows, seen, todo = df.collect(), {}, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec") or kind == "ReusedExchangeExec":
            todo.append(node.child() if kind == "ReusedExchangeExec" else node.plan())
        else:
            if kind == "ShuffleExchangeExec":
                seen[node.id()] = node.metrics().apply("shuffleBytesWritten").value()
            todo += [node.children().apply(k) for k in range(node.children().size())]
    return rows, sum(seen.values())


def test_op1_sends_little(spark):
    """Passages in many documents, each time between other words: their anchors have many different pieces."""
    r = random.Random(7)
    prose = lambda k: "".join(r.choice("abcdefgh ") for _ in range(k))
    lines = [prose(70) for _ in range(3)]
    docs = [(i, "".join(prose(120) + x for x in r.sample(lines, 3))) for i in range(400)]
    rows, sent = shuffled(op1.remove_repeats(frame(spark, docs)))
    first = {}
    for i, t in docs:
        for s in range(len(t) - 49):
            first.setdefault(t[s:s + 50], i)
    for g in rows:
        t = dict(docs)[g.doc_id]
        gone = {k for s in range(len(t) - 49) if first[t[s:s + 50]] < g.doc_id for k in range(s, s + 50)}
        assert bytes(g.kept).decode() == "".join(c for k, c in enumerate(t) if k not in gone)
    assert len(rows) == 400 and 0 < sent < 4 * sum(len(t) for _, t in docs), sent


def test_op2(spark, docs):
    got = by_id(op2.lm_scores(frame(spark, docs), iterations=3).collect())
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in docs}
    count = collections.Counter(w for i, t in docs if not held[i] for w in words(t) + ["\n"])
    n, v = sum(count.values()), len(count)
    for i, t in docs:
        tok = words(t) + ["\n"]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tok)
        for g in got[i]:
            assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (held[i], len(tok), sum(count[w] > 0 for w in tok), n)
            assert g.base_score == pytest.approx(base, rel=1e-9) and g.score < 0


def test_op2_mixture_is_a_distribution():
    w = op2.start_weights()
    c1 = np.array([5, 3, 2])                      # all words of a corpus of ten tokens; the fourth is unseen
    c2 = np.array([2, 1, 0])
    _, p = op2.parts_of(np.append(c2, 0), np.full(4, 3), np.append(c1, 0), 10, 3, w)
    assert p.sum() == pytest.approx(1.0)


def test_op3(spark):
    r = random.Random(5)
    plain = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(200)]
    rows, labels = [], []
    for i in range(240):
        w = [r.choice(plain) for _ in range(r.randint(5, 60))]
        toxic = i % 4 == 0
        for _ in range(3 if toxic else 0):
            w.insert(r.randrange(len(w)), r.choice(["IDIOT!", "scum", "moron,"]))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    rows += [(900, None), (901, ""), (902, "é" * 50_000 + " scum"), (902, "again")]
    d = frame(spark, rows)
    model = op3.train(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = by_id(op3.score(d, model).collect())
    test = [i for i in range(240) if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((got[i][0].toxicity.score >= 0.5) == (i % 4 == 0) for i in test)
    assert right >= 0.95 * len(test)
    text = dict(rows[:240])
    marked = {text[i][s.start:s.end].lower() for i in range(240) for s in got[i][0].toxicity.spans}
    assert marked == {"idiot", "scum", "moron"}
    assert got[900][0].toxicity.score < 0.5 and got[901][0].toxicity.score < 0.5
    assert [(s.start, s.end) for s in got[902][0].toxicity.spans] in ([], [(50_001, 50_005)])


def test_op3_learns_from_short_texts():
    r = random.Random(6)
    plain = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(150)]
    texts, labels = [], []
    for i in range(600):
        w = [r.choice(plain) for _ in range(r.randint(17, 20))]
        if i % 3 == 0:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(["idiot", "scum", "moron"]))
        texts.append(" ".join(w))
        labels.append(int(i % 3 == 0))
    model = op3.fit(texts[:500], np.array(labels[:500]))
    data = [t.encode() for t in texts[500:]]
    score, spans = op3.score_texts(model, np.frombuffer(b"".join(data), np.uint8), np.append(0, np.cumsum([len(d) for d in data])))
    assert ((score >= 0.5) == (np.array(labels[500:]) == 1)).all()
    marked = {t[s["start"]:s["end"]] for t, of in zip(texts[500:], spans) for s in of}
    assert marked == {"idiot", "scum", "moron"}


def test_op3_learns_an_insult_that_stands_only_in_a_phrase():
    r = random.Random(7)
    plain = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(150)] + ["of"] * 8
    texts, labels = [], []
    for i in range(400):
        w = [r.choice(plain) for _ in range(r.randint(20, 60))]
        if i % 2 == 0:
            w.insert(r.randrange(1, len(w)), "piece of trash")
        texts.append(" ".join(w))
        labels.append(int(i % 2 == 0))
    texts += [" ".join(f"unique{k}" for k in range(40))] * 30       # copies of one toxic text give no toxic word
    labels += [1] * 30
    model = op3.fit(texts, np.array(labels))
    data = [t.encode() for t in texts[:400]]
    _, spans = op3.score_texts(model, np.frombuffer(b"".join(data), np.uint8), np.append(0, np.cumsum([len(d) for d in data])))
    marked = {t[s["start"]:s["end"]] for t, of in zip(texts, spans) for s in of}
    assert {"piece", "trash"} <= marked and not any(m.startswith("unique") or m in plain[:150] for m in marked)
    assert all(bool(of) == (k == 1) for of, k in zip(spans, labels))


def test_op3_marginals_are_exact():
    r = np.random.default_rng(2)
    n_words = np.array([3, 0, 70, 33])
    emit, trans = r.normal(size=n_words.sum()), r.normal(size=(2, 2))
    got, at = op3.marginals(emit, n_words, trans), 0
    for n in n_words:
        e = emit[at:at + n]
        step = np.exp(trans)[None] * np.stack([np.ones(n), np.exp(e)], 1)[:, None, :]
        fore, back = [np.array([1.0, 0])], [np.ones(2)]
        for t in range(n):
            fore.append(fore[-1] @ step[t] / (fore[-1] @ step[t]).sum())
            back.append(step[n - 1 - t] @ back[-1] / (step[n - 1 - t] @ back[-1]).sum())
        for t in range(n):
            p = fore[t + 1] * back[n - 1 - t]
            assert got[at + t] == pytest.approx(p[1] / p.sum())
        at += n


def test_op4(spark, docs):
    rows = [(i, t) for i, t in docs if i != 404]
    got = by_id(op4.fingerprints(frame(spark, rows)).collect())
    cut = re.compile(op4.PARAGRAPH)
    pieces = lambda t: {m.group() for m in cut.finditer(t)}
    order = sorted(rows, reverse=True, key=lambda x: x[0])
    prints = collections.defaultdict(set)
    for k, (i, t) in enumerate(order):
        t, follow, g = t or "", order[(k + 1) % len(order)][1] or "", got[i][0]
        half = len(t) // 2
        edited = t[:len(t) - half] + follow[:half]
        assert (g.n_chars, g.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        for other, near in ((edited, g.near_edited), (follow, g.near_next)):
            a, b = pieces(t), pieces(other)
            total = sum(map(len, a)) + sum(map(len, b))
            assert near == pytest.approx(1.0 if not total else 1 - sum(map(len, a ^ b)) / total), i
        prints[t].add(g.fingerprint)
        prints[edited].add(g.edited_fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_op5_base_and_learned(spark):
    rows = [(i, f"write to mail user{i}@host.example.com now, call +1 (555) 000-{1000 + i} please.") for i in range(12)]
    rows += [(50, "write to mail user12[at]host99887766 now"), (51, "the number 12345678 stands alone"),
             (52, "a@b.c_d@e.f 1.2.3.4.5 999.1.1.1 4111 1111 1111 1111 4111111111111112 +12345"), (53, None), (54, ""),
             (55, "1" * 30_000 + " x@y.zz " + "a" * 30_000), (56, "x@y.zz"), (56, "x@y.zz"), (57, "card 4111 1111 1111 1111 or x4111111111111112")]
    got = by_id(op5.found_spans(frame(spark, rows)).collect())
    spans = lambda i, c="spans": [(s.kind, s.start, s.end) for s in got[i][0][c]]
    at = rows[0][1].index("+")
    assert spans(0, "base") == [("email", 14, 36), ("phone", at, at + len("+1 (555) 000-1000"))]
    assert spans(50) == [("email", 14, 36)] and spans(50, "base") == [] and spans(51) == []
    assert spans(52, "base") == [("email", 0, 5), ("email", 5, 11), ("ip", 12, 19)]
    assert spans(57, "base") == [("card", 5, 24)]
    assert spans(53) == spans(54) == [] and ("email", 30_001, 30_007) in spans(55) and len(got[56]) == 2
    red = {(r.doc_id, r.text) for r in op5.redacted(frame(spark, rows)).collect()}
    assert (0, "write to mail [email] now, call [phone] please.") in red
    assert (53, None) in red and op5.redacted(frame(spark, rows)).columns == frame(spark, rows).columns


def test_op5_learns_phrases(spark):
    rows = [(i, f"write to mail user{i}@host.example.com now, call +1 (555) 000-{1000 + i} please.") for i in range(40)]
    rows += [(50, "you may call 0171 234 5678, or not"), (51, "you may call (555) 000-1000 today"), (52, "so mail jane [at] host.org today"),
             (53, "so mail jane(at)host.org today"), (54, "so mail me or call 3 times"), (55, "they saw 0171 234 5678 and well.known things"),
             (56, "you may call 1.2.3.4 0171 234 5678 then"), (57, "call" + " " * 100 + "0171 234 5678"),
             (58, "call 0171 234 5678 " + "z" * 300), (59, "recall" + "l" * 90 + "call 0171 234 5678")]
    red = {r.doc_id: r.text for r in op5.redacted(frame(spark, rows)).collect()}
    assert red[50] == "you may call [phone], or not" and red[51] == "you may call [phone] today"
    assert red[52] == red[53] == "so mail [email] today"
    assert [red[i] for i in (54, 55, 59)] == [dict(rows)[i] for i in (54, 55, 59)]
    assert red[56] == "you may call [ip] 0171 234 5678 then"
    assert red[57] == "call" + " " * 100 + "[phone]" and red[58] == "call [phone] " + "z" * 300


def test_op5_found_identifiers_seed_patterns(spark):
    """Numbers found after 'call' make 'hotline' a pattern and those after it 'desk'; 'seen' has too many that nobody knows."""
    number = lambda i: f"0171 234 {5000 + i}"
    rows = [(i, f"call +1 (555) 000-{1000 + i}") for i in range(40)]
    rows += [(100 + i, f"call {number(i)}") for i in range(10)] + [(200 + i, f"hotline {number(i)}") for i in range(18)]
    rows += [(300 + i, f"desk {number(i)}") for i in range(10, 19)]
    rows += [(400 + i, f"seen {number(i)}") for i in range(5)] + [(450 + i, f"seen {number(i)}") for i in range(100, 110)]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in op5.found_spans(frame(spark, rows)).collect()}
    assert got[205] == [("phone", 8, 21)] and got[217] == [("phone", 8, 21)]        # hop 2: no base span after 'hotline'
    assert got[318] == [("phone", 5, 18)]                                           # hop 3: known by 'desk' only
    assert all(got[i] == [] for i in (*range(400, 405), *range(550, 560)))
    clash = frame(spark, rows[:3]).selectExpr("*", "1 as __spans", "2 as __id", "3 as _found_id", "4 as __Found_hash")
    red = op5.redacted(clash)
    assert red.columns == clash.columns and {(r.text, r._found_id) for r in red.collect()} == {("call [phone]", 3)}


def test_op6():
    page = ("<html><head><title>t</title></head><body class='x'><nav><a href='a>b'>menu</a></nav><!-- <p>no</p> -->"
            "<div class='cookie-notice'>Cookies</div><article><h1>Head &amp; more</h1><p><b>Bo</b>ld<br>next"
            "<p class=ad>buy<p>tail\n  end<form>x</form><aside>y</aside></article><section id='comments'>hey</section>"
            "<footer>f</footer><script>var a='</p>'</script>")
    p = op6.Page(page)
    assert op6.extract(p, None) == "Head & more Bold next tail end"
    assert op6.extract(op6.Page(None), None) == op6.extract(op6.Page(""), "/html") == ""
    assert op6.extract(op6.Page("a < b"), None) == "a < b"
    assert op6.grouped(list("abcbcbcd")) == ["a", "(b c)+", "d"]
    assert op6.aligned(["a", "b", "d"], ["a", "c", "d"]) == ["a", "b?", "c?", "d"]


def test_op6_wrapper_finds_the_container(spark):
    rows = [(i, f"http://u@h.example.com:80/{i}", f"<body><div class='top'>Same here</div><div class='cell'><p>Text {i} "
             f"{'word ' * (i + 5)}</p></div><div class='links'>all pages</div></body>") for i in range(9)]
    rows += [(20, None, None), (21, "odd", "plain"), (22, "odd", "plain"), (22, "odd", "plain")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r.text for r in op6.main_text(pages).collect()}
    assert got[3] == "Text 3 " + " ".join(["word"] * 8) and got[20] == "" and got[21] == "plain"
    assert op6.main_text(pages).count() == len(rows)
    w = {r.host: r for r in op6.wrappers(pages).collect()}
    assert w["h.example.com"].main.endswith("div.cell") and w["h.example.com"].n_pages == 9


def test_op6_constant_text_of_the_main_container_is_template(spark):
    def page(i, extra=""):
        return (f"<body><article id='slug-{'abcdefghij'[i % 10]}'><p>Read our terms before you go on.</p><p>Story {i} "
                f"{'word ' * (i + 5)}</p>{extra}<p class=note>Ask the desk.</p></article><div>Same {i} here</div></body>")

    rows = [(i, f"http://a.example.com/{i}", page(i, "<p>Told by nobody.</p>" * (i % 2))) for i in range(10)]
    rows += [(20 + i, f"http://a.example.com/copy{i}", page(3)) for i in range(30)]
    rows += [(60, "http://two.example.com/1", page(1)), (61, "http://two.example.com/2", page(2))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in op6.main_text(pages).collect()}
    story = lambda i: " ".join(["Story", str(i)] + ["word"] * (i + 5))
    assert got[4] == story(4) and got[5] == story(5) + " Told by nobody." and got[25] == story(3)
    assert got[60] == "Read our terms before you go on. " + story(1) + " Ask the desk."     # too few pages to tell
    w = {r.host: r for r in op6.wrappers(pages).collect()}
    assert w["a.example.com"].main == "/body/article.slug" and w["a.example.com"].n_pages == 40
    assert w["a.example.com"].wrapper == "(/body/article.slug/p=#)+ /body/article.slug/p.note= /body/div#"


def test_op6_wrapper_aligns_the_streams_of_all_pages(spark, monkeypatch):
    monkeypatch.setattr(op6, "FOLD", 2)
    # the advice stands before the table in some pages and is missing in others, sections repeat as wholes
    page = lambda i: ("<body><main>" + f"<h2>Part {i}</h2><p>{'said ' * (i + 3)}</p>" * (1 + i % 3)
                      + f"<p(>Advice {i}</p(>" * (i % 2) + f"<table><tr><td>{i}</td></tr></table></main></body>")
    rows = [(i, f"http://a.example.com/{i}", page(i)) for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    w = op6.wrappers(pages).first().wrapper
    assert w == "(/body/main/h2# /body/main/p#)+ /body/main/p%0028#? /body/main/table/tr/td#"
    # a page's text is that of the wrapper's slots
    assert op6.slots_of(w) == {"/body/main/h2", "/body/main/p", "/body/main/p%0028", "/body/main/table/tr/td"}
    assert op6.extract(op6.Page(page(1)), "/body/main", slots=op6.slots_of(w.replace("p#", "p="))) == "Part 1 Part 1 Advice 1 1"
    got = {r.page_id: r.text for r in op6.main_text(pages).collect()}
    assert got[3] == "Part 3 said said said said said said Advice 3 3"


def test_op7(spark):
    r = random.Random(9)
    vocab = ["w" + "".join(r.choice("abcdefghij") for _ in range(3)) for _ in range(400)]
    prose = lambda k: [r.choice(vocab) for _ in range(k)]
    items = [prose(k) for k in (16, 25, 40, 60)]
    rows = [(i, " ".join(prose(r.randint(5, 200)))) for i in range(80)]
    for k, it in enumerate(items):
        rows.append((100 + k, " ".join(prose(30) + it + prose(30))))
        edited = [w if j % 7 else "other" for j, w in enumerate(it)]
        rows.append((200 + k, " ".join(prose(10)) + ". " + ", ".join(edited).upper() + " " + " ".join(prose(10))))
    rows += [(300, None), (301, ""), (302, " ".join(items[0])), (302, " ".join(items[0]))]
    bench = spark.createDataFrame([(k, " ".join(it)) for k, it in enumerate(items)] + [(9, None)], "item_id long, text string")
    got = op7.search(frame(spark, rows), bench).select("doc_id", F.explode("matches").alias("m")).collect()
    found = {(g.doc_id, g.m.item_id) for g in got}
    want = {(b + k, k) for b in (100, 200) for k in range(4)} | {(302, 0)}
    assert found == want and sum(g.doc_id == 302 for g in got) == 2
    # every match that comparing all positions finds, is found: recall of the latent search
    assert op7.search(frame(spark, rows).limit(0), bench).count() == 0


def test_op7_recall(spark):
    r = random.Random(5)
    vocab = ["w" + "".join(r.choice("abcdefghij") for _ in range(3)) for _ in range(500)]
    prose = lambda k: [r.choice(vocab) for _ in range(k)]
    items = [prose(k) for k in (16, 24, 30, 40, 50, 60) for _ in range(2)]
    rows = []
    for i in range(240):
        w = []
        for x in items[i % 12]:                 # a paraphrase: words left out, put in and replaced
            u, thin = r.random(), 0.1 + 0.3 * (i // 12) / 20
            w += [] if u < thin / 2 else prose(1) if u < thin else [x] + (prose(1) if u > 0.9 else [])
        rows.append((i, " ".join(prose(r.randint(0, 60)) + w + prose(r.randint(0, 60)))))
    bench = spark.createDataFrame([(k, " ".join(it)) for k, it in enumerate(items)], "item_id long, text string")
    got = {g.doc_id: {m.item_id for m in g.matches} for g in op7.search(frame(spark, rows), bench).select("doc_id", "matches").collect()}
    # all positions are compared, without the latent space
    want = set()
    for i, text in rows:
        w = text.split()
        for k, it in enumerate(items):
            if len(set(w) & set(it)) < min(op7.LCS, op7.LCS_ANSWER) * len(set(it)):
                continue
            below = 16
            while below < len(it):
                below = below * 3 // 2
            n = below + below // 8
            for p in range(len(w)):
                share, answer = op7.same_passage(it, w[max(0, p - n // 2): p + n])
                if share >= op7.LCS or (share >= op7.LCS_ANSWER and answer):
                    want.add((i, k))
                    break
    found = {(i, k) for i, ks in got.items() for k in ks}
    print("recall", len(found & want), len(want), len(found - want))
    assert found <= want and len(found) >= 0.9 * len(want) and len(want) > 100


def test_op7_space_is_fitted_on_all_documents(spark, monkeypatch):
    monkeypatch.setattr(op7, "RANK", 6)
    r = random.Random(4)
    vocab = [f"w{k}" for k in range(40)]
    # 10,000 documents, of which a few in many have the words that make a direction of their own
    rows = [(i, " ".join(r.choice(vocab[:20] if i % 50 else vocab[20:]) for _ in range(r.randint(1, 70)))) for i in range(9000)]
    rows += [(10_000 + i, None if i % 2 else "") for i in range(1000)]
    docs = frame(spark, rows)
    items = op7.of_texts([" ".join(vocab[:6]), " ".join(vocab[30:34])])
    terms = op7.Terms(np.unique(np.concatenate(op7.of_texts(vocab))))
    df, n = op7.document_counts(docs.select("doc_id", "text"), terms)
    assert n == 10_000
    idf = np.log((n + 1) / (df + 1)) + 0.1
    got = op7.latent_space(docs.select("doc_id", "text"), n, terms, idf, items)

    def matrix(rows):
        x = np.zeros((len(rows), 40))
        for i, h in enumerate(rows):
            np.add.at(x[i], np.searchsorted(terms.hashes, h), 1)
        x = np.where(x > 0, 1 + np.log(np.maximum(x, 1)), 0) * idf
        return x / np.sqrt((x * x).sum(1, keepdims=True))

    each = op7.of_texts([t for _, t in rows if t])
    x, y = matrix([h[s: s + op7.FIT_WORDS] for h in each for s in range(0, len(h), op7.FIT_WORDS)]), matrix(items)
    gram = x.T @ x * op7.ITEM_DOCUMENTS / n + op7.ITEM_WEIGHT * y.T @ y
    q = np.random.default_rng(7).standard_normal((40, 6))
    for _ in range(op7.POWER):
        q, _ = np.linalg.qr(gram @ q)
    assert np.allclose(got @ got.T, q @ q.T, atol=1e-8)


def test_op7_items_of_one_word_and_a_very_long_text(spark):
    r = random.Random(8)
    vocab = ["w" + "".join(r.choice("abcdefghij") for _ in range(3)) for _ in range(400)]
    prose = lambda k: [r.choice(vocab) for _ in range(k)]
    items = [["zebra"], ["yak", "yak"], ["pale", "fox"], prose(30)]
    rows = [(i, " ".join(prose(60))) for i in range(40)]
    rows += [(100, "Zebra"), (101, " ".join(prose(20) + ["zebra"] + prose(20))), (102, "yak"), (103, "a yak, yak"),
             (104, "pale"), (105, "a pale fox"), (None, "zebra"), (106, " ".join(prose(60000) + items[3] + ["zebra"] + prose(60000)))]
    bench = spark.createDataFrame([(k, " ".join(it)) for k, it in enumerate(items)], "item_id long, text string")
    got = op7.search(frame(spark, rows), bench).select("doc_id", F.explode("matches").alias("m")).collect()
    assert {(g.doc_id, g.m.item_id) for g in got} == {(100, 0), (101, 0), (103, 1), (105, 2), (None, 0), (106, 0), (106, 3)}


def test_op7_the_best_window_of_a_bin_is_compared():
    item = [f"item{k}" for k in range(16)]
    text = ["other"] * 80
    for at, w in zip((30, 31, 32, 33, 36, 37, 38, 39, 40, 41, 44, 46, 48, 50, 54, 55), item):
        text[at] = w
    h = op7.of_texts([" ".join(item)])[0]
    index = op7.Index([1], [h], op7.Terms(np.unique(h)), np.ones(16), np.eye(16))
    dat = np.frombuffer(" ".join(text).encode(), np.uint8)
    # the words around the first window of each half window (18 // 2 words) leave out an end of the item
    assert index.search(dat, np.array([0, len(dat)]))[0][0][1:] == (1.0, True)


def test_op7_common_subsequence():
    r = random.Random(1)
    for _ in range(50):
        a, b = ([r.randrange(4) for _ in range(r.randint(1, 12))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert op7.common(a, b) == t[-1][-1]


def test_op8(spark, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(op8.tokenizer_path())
    rows = docs + [(500, "it's <|endoftext|>, don't... a,b É, x y 12,3 Ok&&& <|x|>."), (501, "word " * 9000)]
    got = op8.pack_documents(frame(spark, rows), size=512).collect()
    want = collections.Counter()
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for k, s in enumerate(range(0, len(ids), 512)):
            part = ids[s:s + 512]
            want[i, k, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert collections.Counter((g.doc_id, g.piece, g.start, g.length, g.ids_crc32) for g in got) == want
    seqs = collections.defaultdict(list)
    for g in got:
        seqs[g.sequence_id].append((g.offset, g.length))
    for held in seqs.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 512
    assert len(seqs) <= 1.05 * math.ceil(sum(g.length for g in got) / 512) + 1
    assert op8.pack_documents(frame(spark, docs).limit(0)).count() == 0


def test_op8_rounds_merge_underfull_bins(spark, monkeypatch):
    monkeypatch.setattr(op8, "ITEMS", 40)
    items = spark.createDataFrame([(i, 0, 0, 1 + i * 37 % 300, i) for i in range(400)],
                                  "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = op8.pack(items, 512).collect()
    assert len(got) == 400 and len({g.sequence_id for g in got}) <= 1.1 * sum(g.length for g in got) / 512 + 2


def test_op8_kept_words_are_small_and_right(monkeypatch):
    """A worker's tables hold few bytes a word, and ids are those of the tokenizer whether kept, promoted or new."""
    monkeypatch.setattr(op8, "WORD_CACHE", 300)
    monkeypatch.setattr(op8, "ENCODED", 7)
    r = random.Random(5)
    tok = op8.WordTokenizer(op8.tokenizer_path())
    vocab = ["".join(r.choice("abcdeXYZ\u00e9,.7") for _ in range(r.randint(1, 9))) for _ in range(900)]
    for _ in range(40):
        texts = [" ".join(r.choices(vocab, [1 / (k + 1) for k in range(900)], k=r.randint(0, 80))) for _ in range(4)]
        dat = np.frombuffer("".join(texts).encode(), np.uint8)
        off = np.cumsum([0] + [len(t.encode()) for t in texts])
        for t, ids in zip(texts, tok.documents(dat, off)):
            assert ids.tolist() == tok.tok.encode(t, add_special_tokens=False).ids, t
        for table in (tok.new, tok.old):
            assert np.all(np.diff(table.keys.astype(object)) > 0)
            assert sum(a.nbytes for a in table) <= 24 * len(table.keys) + 4 * table.n.sum()
    assert len(tok.old.keys)


def test_op9(spark):
    rows = [(1, 2, "assistant", " Hé <|endoftext|>\\ </s>[INST]"), (1, 1, "user", "[/INST]<s>\\<"), (1, 3, "assistant", "\n"),
            (2, 1, None, None), (3, 1, "assistant", ""), (3, 1, "assistant", "same"), (3, 1, "assistant", "same"),
            (None, 1, "user", "x"), (4, None, "system", "first"), (4, 1, "assistant", "日本語 " * 3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    out = op9.format_chats(df)
    got = {r.conv_id: r for r in op9.read_back(out).collect()}
    for conv in (1, 2, 3, 4, None):
        turns = sorted(((-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv))
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in out.collect():
        assert [a <= b for a, b in zip(r.token_start, r.token_end)].count(False) == 0
    for text in ("", "\\", "<|endoftext|>", "<\\|endoftext|>", "\\\\</s>", "[\\INST]"):
        assert op9.unescape(op9.escape(text)) == text and op9.MARK not in op9.escape(text)


def test_op10(spark, docs):
    got = by_id(op10.jaccard_components(frame(spark, docs)).collect())
    sets = {}
    for i, t in docs:
        w = words(t)
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    least = {i: i for i in sets}
    ids = sorted(sets)
    for _ in ids:
        before = dict(least)
        for a in ids:
            for b in ids:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                    least[a] = min(least[a], least[b])
        if before == least:
            break
    for i in ids:
        for g in got[i]:
            assert (g.n_shingles, g.component_id) == (len(sets[i]), least[i]), i
    assert len(got[404]) == 2 and len(set(least.values())) < len(ids)


def test_op10_a_large_group_near_the_threshold(spark):
    """Documents of shared passages and own words: many share columns, some pairs link and most of them don't."""
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghijkl") for _ in range(6))
    passages = [[word() for _ in range(30)] for _ in range(6)]
    rows = []
    for i in range(700):
        parts = r.sample(passages, r.choice([2, 3, 3, 4])) + [[word() for _ in range(r.choice([0, 4, 9]))]]
        rows.append((i, " ".join(w for p in parts for w in p)))
    base = [word() for _ in range(80)]
    for i in range(700, 1300):                          # copies with one to four edits: similarity about 0.6 to 0.9
        w = list(base)
        for _ in range(r.randint(1, 4)):
            w[r.randrange(80)] = word()
        rows.append((i, " ".join(w)))
    sets = [{hash(tuple(w[k:k + 5])) for k in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    least = list(range(len(sets)))

    def root(a):
        while least[a] != a:
            a = least[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 175 * both >= 75 * (len(sets[a]) + len(sets[b])):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    got = {g.doc_id: g.component_id for g in op10.jaccard_components(frame(spark, rows)).collect()}
    assert got == {i: root(i) for i in range(len(sets))}
    assert 3 < len(set(got.values())) < 1200


def test_empty_tables(spark):
    none = frame(spark, corpus()).limit(0)
    assert op1.remove_repeats(none).count() == op2.lm_scores(none).count() == op10.jaccard_components(none).count() == 0
    assert op4.fingerprints(none).count() == op5.found_spans(none).count() == op5.redacted(none).count() == 0
    model = op3.train(none, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert op3.score(none, model).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert op6.main_text(pages).count() == 0
    chats = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert op9.read_back(op9.format_chats(chats)).count() == 0


def test_null_ids(spark):
    d = frame(spark, [(None, "alpha beta gamma delta epsilon zeta " * 4), (1, "alpha beta gamma delta epsilon zeta " * 4), (None, None)])
    kept = {(r.doc_id, bytes(r.kept) == b"") for r in op1.remove_repeats(d).collect()}
    assert kept == {(None, True), (1, False)}
    assert op2.lm_scores(d).count() == op4.fingerprints(d).count() == op5.found_spans(d).count() == 3
    assert {r.component_id for r in op10.jaccard_components(d).collect()} == {1, None}
