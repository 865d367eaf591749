"""Operator 3: toxic spans by a linear-chain conditional random field.

Two tags, clean and toxic, over the words of a document.  Features of a word:
itself (a learned vocabulary), unknown, all capitals.

Token labels come from the documents' labels: in the training sample a word is
toxic where it is far more frequent in toxic documents and stands in many
different contexts (copies of one document repeat contexts, insults don't); a word
with one neighbour only has the contexts of the phrase that they begin.
The weights maximise the conditional likelihood of these tags (forward-backward
gradient).  Marginals then score whole documents: a logistic function of the
highest marginal and the expected number of toxic words; words with a marginal
of at least 1/2 are the offending spans.

The field is fitted in one task on a bounded sample: ``SAMPLE`` labelled
training documents of each label of at most ``SAMPLE_CHARS`` characters, chosen
by a hash of their ids; only these texts leave the scan.  Its words are the ``VOCABULARY``
most telling of them, all others are one feature.  Training cuts texts into segments of ``SEGMENT``
words, the last of which may be shorter.  Scoring reads whole texts in the order of the scan,
without a shuffle.

Defined cases: a text without words (null, empty) scores as a document with no
toxic word; a null id counts as the empty text; rows of one id are scored each by
its own text; without labelled rows every score is that of a clean document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.llm import blocks as B

SAMPLE = 1000
SAMPLE_CHARS = 10_000
FOLD = "crc32(coalesce(cast({}doc_id as string), '')) % 5"
TEST_FOLD = 0
MIN_CONTEXTS = 4                # a toxic word stands in so many different contexts at least,
CONTEXT_SHARE = 1 / 150         # and in one for so many toxic documents,
MIN_ODDS = 8.0                  # and is so many times as frequent in toxic documents
PHRASE = 4                      # words with one neighbour only that are followed to find a phrase's contexts
VOCABULARY = 4000
SEGMENT = 32
ROUNDS = 40

#: Bytes that part words: ASCII but letters, digits and apostrophe; all of a letter in UTF-8 stays together.
GAP = np.ones(256, bool)
GAP[128:] = False
GAP[[*range(48, 58), *range(65, 91), *range(97, 123), 39]] = False
_CAPS = np.zeros(256, bool)
_CAPS[65:91] = True

U = np.uint64


@dataclass
class Model:
    """Sorted word hashes, and weights of the toxic tag against the clean one."""

    words: np.ndarray           # uint64, sorted
    weight: np.ndarray          # per word, then unknown, then all capitals
    trans: np.ndarray           # 2 x 2 log weights, from tag to tag
    doc: np.ndarray             # logistic weights: highest marginal, log(1 + expected toxic words), one


def word_spans(dat: np.ndarray, off: np.ndarray):
    start, end, doc = B.words(dat, off, GAP)
    h = B.span_hash(B.prefix_hash(dat, B.FOLD), start, end)
    big = np.append(0, np.cumsum(_CAPS[dat]))
    caps = (big[end] - big[start] == end - start) & (end - start > 1)
    return start, end, doc, h, caps


def emissions(words: np.ndarray, weight: np.ndarray, h: np.ndarray, caps: np.ndarray):
    """Log weight of the toxic tag for each word, and its feature (the last but one is unknown)."""
    f = np.full(len(h), len(words))
    if len(words):
        k = np.minimum(np.searchsorted(words, h), len(words) - 1)
        f = np.where(words[k] == h, k, len(words))
    return weight[f] + caps * weight[-1], f


def _scaled(a):
    return a / a.sum(axis=tuple(range(1, a.ndim)), keepdims=True)


def marginals(emit: np.ndarray, n_words: np.ndarray, trans: np.ndarray):
    """Probability of the toxic tag of each word; documents' words follow each other.

    Documents are cut into segments whose 2 x 2 transfer matrices are
    multiplied side by side; the vectors at their edges follow document by
    document, and then all words of all segments at once.
    """
    total = int(n_words.sum())
    if not total:
        return np.zeros(0)
    n_seg = -(-n_words // SEGMENT)
    seg_first = np.cumsum(n_seg) - n_seg
    word_first = np.cumsum(n_words) - n_words
    place = np.arange(total) - np.repeat(word_first, n_words) + np.repeat(seg_first * SEGMENT, n_words)
    n = int(n_seg.sum())
    step = np.broadcast_to(np.eye(2), (n * SEGMENT, 2, 2)).copy()
    top = np.exp(trans - trans.max())
    e = np.clip(emit, -30, 30)
    step[place, :, 0] = top[:, 0] * np.exp(-np.maximum(e, 0))[:, None]
    step[place, :, 1] = top[:, 1] * np.exp(np.minimum(e, 0))[:, None]
    step = step.reshape(n, SEGMENT, 2, 2)

    whole = step[:, 0].copy()
    for t in range(1, SEGMENT):
        whole = _scaled(whole @ step[:, t])
    into, out = np.zeros((n, 2)), np.ones((n, 2))
    into[seg_first[n_seg > 0]] = [1.0, 0.0]                     # before the first word: clean
    order = np.argsort(-n_seg, kind="stable")
    sizes = -n_seg[order]
    for k in range(1, int(n_seg.max())):
        d = order[: np.searchsorted(sizes, -k, side="left")]      # documents of more than k segments
        s = seg_first[d] + k
        into[s] = _scaled(np.einsum("ni,nij->nj", into[s - 1], whole[s - 1]))
        s = seg_first[d] + n_seg[d] - 1 - k
        out[s] = _scaled(np.einsum("nij,nj->ni", whole[s + 1], out[s + 1]))
    fore, back = np.empty((n, SEGMENT, 2)), np.empty((n, SEGMENT, 2))
    a, b = into, out
    for t in range(SEGMENT):
        a = _scaled(np.einsum("ni,nij->nj", a, step[:, t]))
        fore[:, t] = a
        u = SEGMENT - 1 - t
        back[:, u] = b
        b = _scaled(np.einsum("nij,nj->ni", step[:, u], b))
    both = (fore * back).reshape(-1, 2)[place]
    return both[:, 1] / both.sum(1)


def _pairs(emit, trans, tags, live):
    """Expected and seen transitions, and marginals, of segments (n, length) of tags; places that aren't live are padding."""
    n, length = emit.shape
    step = np.exp(trans)[None, None] * np.stack([np.ones_like(emit), np.exp(np.clip(emit, -30, 30))], -1)[:, :, None, :]
    step = np.where(live[..., None, None], step, np.eye(2))
    fore, back = np.empty((n, length + 1, 2)), np.empty((n, length + 1, 2))
    fore[:, 0], back[:, length] = [1.0, 0.0], 1.0
    for t in range(length):
        fore[:, t + 1] = _scaled(np.einsum("ni,nij->nj", fore[:, t], step[:, t]))
        u = length - 1 - t
        back[:, u] = _scaled(np.einsum("nij,nj->ni", step[:, u], back[:, u + 1]))
    pair = fore[:, :-1, :, None] * step * back[:, 1:, None, :]
    pair /= pair.sum((2, 3), keepdims=True)
    pair *= live[..., None, None]
    seen = np.zeros((2, 2))
    before = np.concatenate([np.zeros((n, 1), np.int64), tags[:, :-1]], 1)
    np.add.at(seen, (before[live], tags[live]), 1)
    return pair.sum((0, 1)), seen, pair[..., 1].sum(2)


def _logistic(x, y, rounds=300):
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ w))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        d = np.linalg.solve(h, x.T @ (y - p) - 1e-3 * w)
        w += d
        if np.abs(d).max() < 1e-6:
            break
    return w


def _document_features(m: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    top, some = np.zeros(n_docs), np.zeros(n_docs)
    np.maximum.at(top, doc, m)
    np.add.at(some, doc, np.where(m >= 0.05, m, 0))       # faint marginals of long texts don't add up
    return np.stack([top, np.log1p(some), np.ones(n_docs)], 1)


def fit(texts: list[str], labels: np.ndarray) -> Model:
    """The field and the document weights from a bounded list of labelled texts."""
    empty = Model(np.zeros(0, U), np.array([-5.0, 0.0]), np.array([[0.0, 0.0], [0.0, 0.0]]), np.array([6.0, 0.0, -3.0]))
    if not len(texts) or labels.min() == labels.max():
        return empty
    data = [t.encode() for t in texts]
    off = np.append(0, np.cumsum([len(d) for d in data]))
    dat = np.frombuffer(b"".join(data), np.uint8)
    _, _, doc, h, caps = word_spans(dat, off)
    if not len(h):
        return empty
    n_docs = len(texts)
    words, word = np.unique(h, return_inverse=True)
    first = np.append(True, doc[1:] != doc[:-1])
    left = np.where(first, -1, np.roll(word, 1))
    right = np.where(np.append(first[1:], True), -1, np.roll(word, -1))
    n_lab = np.bincount(labels, minlength=2)
    y = labels[doc] == 1

    def different(other, rows):
        """Number of different values of ``other`` beside each word, in these rows."""
        span = int(other.max()) + 2
        return np.bincount(np.unique(word[rows] * span + other[rows] + 1) // span, minlength=len(words))

    def contexts_beside(other):
        """Different neighbours in toxic documents; those of the phrase where a word has one neighbour only."""
        n, only, at = different(other, y), np.full(len(words), -1), np.arange(len(words))
        only[word[y]] = other[y]
        for _ in range(PHRASE):
            at = np.where((n[at] == 1) & (only[at] >= 0), only[at], at)
        return n[at]

    docs_with = [different(doc, ~y), different(doc, y)]
    odds = (docs_with[1] + 0.1) / n_lab[1] / ((docs_with[0] + 1) / n_lab[0])
    contexts = np.minimum(contexts_beside(left), contexts_beside(right))
    toxic = (odds >= MIN_ODDS) & (contexts >= max(MIN_CONTEXTS, CONTEXT_SHARE * n_lab[1])) & (contexts >= 0.5 * docs_with[1])
    tag = (toxic[word] & y).astype(np.int8)

    # vocabulary: toxic words, then the words that tell most, then the most frequent
    n_with = docs_with[0] + docs_with[1]
    rank = np.lexsort((-n_with, -toxic.astype(int)))[:VOCABULARY]
    rank = np.sort(rank[n_with[rank] >= 2])
    vocab = words[rank]
    # training segments: every one with a toxic word and as many again, evenly spread
    starts = np.flatnonzero(first)
    n_words = np.diff(np.append(starts, len(word)))
    pos = np.arange(len(word)) - np.repeat(starts, n_words)
    seg_id = np.cumsum((pos % SEGMENT == 0)) - 1
    seg_start = np.flatnonzero(pos % SEGMENT == 0)
    seg_size = np.diff(np.append(seg_start, len(word)))
    hot = np.flatnonzero(np.bincount(seg_id, weights=tag) > 0)
    cold = np.flatnonzero(np.bincount(seg_id, weights=tag) == 0)
    cold = cold[:: max(1, len(cold) // (len(hot) + 1000))]
    pick = np.sort(np.concatenate([hot, cold]))
    weight, trans = np.zeros(len(vocab) + 2), np.zeros((2, 2))
    weight[-2] = -4.0
    if len(pick):
        live = np.arange(SEGMENT) < seg_size[pick][:, None]
        at = np.where(live, seg_start[pick][:, None] + np.arange(SEGMENT), 0)
        tags, cap = tag[at].astype(np.int64) * live, caps[at] & live
        _, f = emissions(vocab, weight, h, caps)
        f = f[at]
        moment, scale = [np.zeros(len(weight) + 4) for _ in range(2)]
        for r in range(1, ROUNDS + 1):
            expected, seen, m = _pairs(weight[f] + cap * weight[-1], trans, tags, live)
            d = tags - m
            g = np.bincount(f.ravel(), weights=d.ravel(), minlength=len(weight))
            g[-1] = (d * cap).sum()
            g = np.append(g - 0.05 * weight, (seen - expected - 0.05 * trans).ravel())
            moment = 0.9 * moment + 0.1 * g
            scale = 0.99 * scale + 0.01 * g * g
            go = 0.3 * (moment / (1 - 0.9 ** r)) / (np.sqrt(scale / (1 - 0.99 ** r)) + 1e-8)
            weight, trans = weight + go[:-4], trans + go[-4:].reshape(2, 2)
    model = Model(vocab, weight, trans, np.zeros(3))
    features = []
    for i in range(0, n_docs, 100):                           # a few texts at a time
        part = off[i: i + 101]
        features.append(_features(model, dat[part[0]: part[-1]], part - part[0])[0])
    model.doc = _logistic(np.concatenate(features), labels.astype(float))
    return model


def _features(model: Model, dat: np.ndarray, off: np.ndarray):
    """Features of each document, and the words' spans, documents and marginals."""
    n_docs = len(off) - 1
    start, end, doc, h, caps = word_spans(dat, off)
    e, _ = emissions(model.words, model.weight, h, caps)
    m = marginals(e, np.bincount(doc, minlength=n_docs), model.trans)
    return _document_features(m, doc, n_docs), start, end, doc, m


def score_texts(model: Model, dat: np.ndarray, off: np.ndarray):
    """Score of each document, and its offending spans (code points) with their marginals."""
    n_docs = len(off) - 1
    features, start, end, doc, m = _features(model, dat, off)
    score = 1 / (1 + np.exp(-features @ model.doc))
    spans: list[list] = [[] for _ in range(n_docs)]
    hit = np.flatnonzero(m >= 0.5)
    if len(hit):
        point = np.append(0, np.cumsum((dat & 0xC0) != 0x80))
        for k in hit:
            d = doc[k]
            base = point[off[d]]
            spans[d].append({"start": int(point[start[k]] - base), "end": int(point[end[k]] - base), "p": float(m[k])})
    return score, spans


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` training rows of each label."""
    short = docs.filter(F.length("text") <= SAMPLE_CHARS)
    ids = short.select("doc_id").join(
        labels.filter(f"{FOLD.format('')} <> {TEST_FOLD}").filter("toxic in (0, 1)").select("doc_id", "toxic"), "doc_id") \
        .select("doc_id", "toxic", F.xxhash64("doc_id").alias("h"))
    chosen = ids.filter("toxic = 0").orderBy("h").limit(sample).union(ids.filter("toxic = 1").orderBy("h").limit(sample)) \
        .select("doc_id", "toxic").distinct()                   # bounded: 2 * sample rows
    rows = short.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").orderBy("doc_id", "text", "toxic").limit(2 * sample)

    def learn(batches):
        texts, toxic = [], []
        for batch in batches:
            texts += batch["text"].to_pylist()
            toxic += batch["toxic"].to_pylist()
        m = fit(texts, np.array(toxic, np.int64))
        yield pa.record_batch({"words": pa.array([m.words.view(np.int64)]), "weight": pa.array([m.weight]),
                               "trans": pa.array([m.trans.ravel()]), "doc": pa.array([m.doc])})

    # the bounded sample is one task's work; the driver sees the weights only
    got = rows.select("text", F.col("toxic").cast("long").alias("toxic")).coalesce(1).mapInArrow(
        learn, "words array<long>, weight array<double>, trans array<double>, doc array<double>").first()
    if got is None:
        return fit([], np.zeros(0, np.int64))
    return Model(np.array(got.words, np.int64).view(U), np.array(got.weight), np.array(got.trans).reshape(2, 2), np.array(got.doc))


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))
RESULT = "struct<score: double, spans: array<struct<start: long, end: long, p: double>>>"


def score(docs: DataFrame, model: Model, column: str = "toxicity") -> DataFrame:
    """``docs`` with a struct (score, spans) added; no shuffle."""

    def run(batches):
        for batch in batches:
            scores, spans = np.zeros(0), []
            for _, dat, off in B.chunks(batch["text"]):
                s, p = score_texts(model, dat, off)
                scores = np.append(scores, s)
                spans += p
            got = pa.StructArray.from_arrays([pa.array(scores), pa.array(spans, _SPANS)], names=["score", "spans"])
            yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, column])

    if column in docs.columns:
        raise ValueError(f"documents already have a column {column}")
    return docs.mapInArrow(run, docs.withColumn(column, F.lit(None).cast(RESULT)).schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.expr(f"{FOLD.format('')} = {TEST_FOLD}").alias("held_out"),
        F.col("toxicity.score").alias("score"), F.when(F.col("toxicity.score") >= 0.5, 1).otherwise(0).alias("predicted"),
        F.col("toxicity.spans").alias("spans"))
