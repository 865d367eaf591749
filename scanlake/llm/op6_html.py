"""Operator 6: main text of HTML pages with wrappers inferred per host as union-free regular expressions.

A page is a stream of texts by place: the path of a text's elements, each with
those attribute words that are stable on the host (a word of few of its pages,
such as an article's own id, is none).  Neighbouring repeats fold into groups
``(...)+``, and the streams of all different pages of a host are aligned with
each other, ``FOLD`` at a time and then what came of them: what only one side has
is optional.  The one stream left is the wrapper.  A text that most different
pages with the place have there is constant (``=``), which is the template's; a
node with any other text is a slot (``#``).

The main container is the ``article`` or ``main`` element that holds most text
in slots, else the innermost container that holds most of it.  A page is matched
with its host's wrapper: its text is that of the wrapper's slots inside the main
container.  Only then the fixed lists leave out menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments.

Words, places and constant texts are counted by Spark's aggregates, and what a
host keeps of them is a share of its pages, so no task holds a host's pages and
the result doesn't depend on how pages lie in files.

Defined cases: null, empty or tagless pages: their text, or none; a page that
lacks its host's container falls back to its own ``article``, ``main`` or whole
body; a null or odd url is a host of its own ('').  Pages of a host with equal
text count once, so copies of an article are no template; below
``TEMPLATE_PAGES`` different pages nothing is constant.  A page that holds
constant text only has none.  Only page_id, url and html are read.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import defaultdict
from difflib import SequenceMatcher
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.llm.components import dropped, written

LONGEST_GROUP = 12              # tokens of a repeated group
STABLE_SHARE = 0.02             # of the different pages of a host that have a word, and TEMPLATE_PAGES at least (or all): it is stable
TEMPLATE_PAGES = 3              # different pages, and
TEMPLATE_SHARE = 0.7            # of the different pages with the place: a text there is constant
FOLD = 32                       # streams aligned by one task at a time, about
SHARE = 0.7                     # of a container's text that an inner one must hold to be chosen instead

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
CONTAINERS = frozenset("html body article main section div nav aside header footer form table".split())
DROPPED = frozenset("nav aside header footer form menu dialog button head".split()) | RAW
#: Words of a class, id or role that mark what isn't the article.
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb "
    "breadcrumbs header masthead footer sidebar aside widget widgets complementary contentinfo search cookie cookies consent "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended comment comments discussion replies respond disqus pagination pager toolbar skip".split())
MAIN_WORDS = frozenset("article main content post entry story articlebody".split())
#: A start tag of these ends an open element of the others.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTR = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")
_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW}


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def tokens(page: str):
    """('text', text) | ('open', name, words of class, id and role) | ('close', name); raw elements and comments are left out."""
    at, n = 0, len(page)
    while at < n:
        i = page.find("<", at)
        if i < 0:
            yield "text", page[at:]
            return
        if i > at:
            yield "text", page[at:i]
        if page.startswith("<!--", i):
            j = page.find("-->", i + 4)
            at = n if j < 0 else j + 3
            continue
        if page.startswith(("<!", "<?"), i):
            j = page.find(">", i)
            at = n if j < 0 else j + 1
            continue
        m = _TAG.match(page, i) or _LOOSE.match(page, i)
        if not m:
            yield "text", "<"
            at = i + 1
            continue
        at, name = m.end(), m[2].lower()
        if m[1]:
            yield "close", name
        elif name in RAW:
            e = _END[name].search(page, at)
            at = e.end() if e else n
        else:
            words = []
            if m[3] and "=" in m[3]:
                for _, v in _ATTR.findall(m[3]):
                    words += re.split(r"[^a-z0-9]+", v.strip("\"'").lower())
            yield "open", name, words


@lru_cache(1 << 14)
def hashed(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


class Page:
    """Blocks of text (place, dropped, text) in page order, and the attribute words (key) of the page.

    ``stable``: keys of the words that places keep; None: all.
    """

    def __init__(self, page: str | None, stable=None):
        self.blocks: list[tuple[str, bool, str]] = []
        self.words: set[int] = set()
        stack: list[tuple[str, str, int, str]] = []     # name, path inside it, dropped elements open, path without words
        path, drop, run, bare = "", 0, [], ""

        def flush():
            if run:
                text = " ".join(html_lib.unescape("".join(run)).split())
                run.clear()
                if text:
                    self.blocks.append((path, drop > 0, text))

        def pop_to(k):
            nonlocal path, drop, bare
            del stack[k:]
            path, drop, bare = stack[-1][1:] if stack else ("", 0, "")

        for kind, *t in tokens(page or ""):
            if kind == "text":
                run.append(t[0])
                continue
            name = t[0]
            if name not in INLINE:
                flush()
            if kind == "open":
                words = t[1]
                if name not in INLINE:
                    ends = CLOSES.get(name, ())
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k][0] == "p" or stack[k][0] in ends:
                            pop_to(k)
                            break
                        if stack[k][0] not in INLINE:
                            break
                if name in VOID:
                    continue
                bad = name in DROPPED or (bool(words) and name not in ("html", "body") and not DROPPED_WORDS.isdisjoint(words)
                                          and not (name in ("article", "main") and not MAIN_WORDS.isdisjoint(words)))
                if bad and name in INLINE:
                    flush()
                if name not in INLINE:
                    bare = f"{bare}/{name}"
                    path = f"{path}/{name}"
                    for w in words:
                        if w and not w.isdigit():
                            key = hashed(f"{bare} {w}")
                            self.words.add(key)
                            if stable is None or key in stable:
                                path = f"{path}.{w}"
                drop += bad
                stack.append((name, path, drop, bare))
            else:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        if name in INLINE and drop > (stack[k - 1][2] if k else 0):
                            flush()
                        pop_to(k)
                        break
        flush()


# ---- wrappers --------------------------------------------------------------

def grouped(keys: list[str]) -> list[str]:
    """Equal neighbouring runs folded into repeated groups ``(...)+``."""
    out: list[str] = []
    for key in keys:
        out.append(key)
        folded = True
        while folded:
            folded = False
            for p in range(1, min(LONGEST_GROUP, len(out)) + 1):
                tail = out[-p:]
                group = "(" + " ".join(tail) + ")+"
                if len(out) > p and out[-p - 1] == group:
                    del out[-p:]
                    folded = True
                    break
                if len(out) >= 2 * p and out[-2 * p: -p] == tail and not (p == 1 and tail[0].endswith(")+")):
                    out[-2 * p:] = [group]
                    folded = True
                    break
                if p == 1 and len(out) > 1 and tail[0].endswith(")+") and out[-2] == tail[0]:
                    del out[-1]
                    folded = True
                    break
    return out


def aligned(a: list[str], b: list[str]) -> list[str]:
    """The wrapper of both: common parts, and optional groups where one has something else."""
    if a == b:
        return a
    plain = lambda s: [k[:-1] if k.endswith("?") else k for k in s]
    pa_, pb = plain(a), plain(b)
    out: list[str] = []
    for op, i, j, k, m in SequenceMatcher(None, pa_, pb, autojunk=False).get_opcodes():
        if op == "equal":
            out += [x if x == y else p + "?" for x, y, p in zip(a[i:j], b[k:m], pa_[i:j])]
        else:
            out += [x + "?" for x in pa_[i:j] + pb[k:m]]
    return grouped(out)


def container(place: str) -> str:
    """The innermost container on a place's path."""
    steps = place.split("/")
    while len(steps) > 1 and steps[-1].split(".", 1)[0] not in CONTAINERS:
        steps.pop()
    return "/".join(steps)


def main_container(slots: dict[str, int], chars: dict[str, int]) -> str:
    """Path of the main container, from the slots' characters by place (all text's, where there are no slots)."""
    inside: dict[str, int] = defaultdict(int)
    for place, n in (slots if any(slots.values()) else chars).items():
        steps = container(place).split("/")
        for k in range(2, len(steps) + 1):
            inside["/".join(steps[:k])] += n
    named = {p: c for p, c in inside.items() if re.match(r"(article|main)\b", p.rsplit("/", 1)[1])}
    if named:
        best = max(named.values())
        # the outermost of those that hold nearly all of it, so several articles in a main stay together
        return min((p for p, c in named.items() if c >= SHARE * best), key=lambda p: (p.count("/"), p))
    at = ""
    while True:
        inner = {p: c for p, c in inside.items() if p.rpartition("/")[0] == at}
        if not inner:
            return at
        p = max(inner, key=lambda p: (inner[p], p))
        if inner[p] < SHARE * (inside[at] if at else sum(inner.values())):
            return at
        at = p


def node_key(place: str) -> str:
    """A place without the signs of the expression, which odd tag names may have; ``.`` outside all elements."""
    return re.sub(r"[()+?=#%\s]", lambda m: f"%{ord(m[0]):04x}", place) or "."


def stream(places: list[str]) -> str:
    """The wrapper of one page, from its texts' places in page order."""
    return " ".join(grouped([node_key(p) for p in places]))


def nodes_of(wrapper: str) -> list[str]:
    """A wrapper's items: single nodes and whole groups."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(wrapper + " "):
        depth += (c == "(") - (c == ")")
        if c == " " and not depth:
            if i > at:
                out.append(wrapper[at:i])
            at = i + 1
    return out


def expression(wrapper: str, nodes: list[dict]) -> str:
    """The wrapper with what its nodes hold: ``#`` a slot, ``=`` a constant text."""
    marks = {node_key(x["place"]): "=" * (x["constant"] > 0) + "#" * (x["slot"] > 0) for x in nodes}
    return re.sub(r"[^()+?\s]+", lambda m: m[0] + marks.get(m[0], ""), wrapper)


@lru_cache(256)
def slots_of(wrapper: str | None) -> frozenset:
    """Nodes of the wrapper that are slots."""
    return frozenset(x.rstrip("=#") for x in re.findall(r"[^()+?\s]+", wrapper or "") if x.endswith("#"))


def constant_key(host: str, place: str, text: int) -> int:
    return hashed(f"{host} {place} {text}")


def extract(page: Page, main: str | None, host: str = "", template=frozenset(), slots=None) -> str:
    """Text in slots (None: at all places) of the main container, or of the page's own article, main or body."""
    good = [(p, t) for p, drop, t in page.blocks
            if not drop and (slots is None or node_key(p) in slots) and not (template and constant_key(host, p, hashed(t)) in template)]
    if main and any(p == main or p.startswith(main + "/") for p, drop, _ in page.blocks if not drop):
        # every container of the main one's path, as a page may hold several articles
        return " ".join(t for p, t in good if p == main or p.startswith(main + "/"))
    for name in ("article", "main"):
        if any(re.search(rf"/{name}(\.|/|$)", p) for p, drop, _ in page.blocks if not drop):
            return " ".join(t for p, t in good if re.search(rf"/{name}(\.|/|$)", p))
    return " ".join(t for _, t in good)


def packed(keys) -> bytes:
    return np.sort(np.array(keys, np.int64)).tobytes()


@lru_cache(256)
def unpacked(blob: bytes | None) -> frozenset:
    return frozenset(np.frombuffer(blob or b"", np.int64).tolist())


def _read(batches):
    """One row per page: its host, a key of its text, its words, and its texts (paths with all words, hashes, sizes)."""
    for batch in batches:
        out = {f.name: [] for f in _READ}
        for url, body in zip(batch["url"].to_pylist(), batch["html"]):
            page = Page(body.as_py())
            good = [(p, hashed(t), len(t)) for p, drop, t in page.blocks if not drop]
            paths, texts, sizes = (list(x) for x in zip(*good)) if good else ([], [], [])
            for name, v in zip(out, (host_of(url), hashed(" ".join(map(str, texts))), sorted(page.words), paths, texts, sizes)):
                out[name].append(v)
        yield pa.record_batch(out, _READ)


_READ = pa.schema([("host", pa.string()), ("key", pa.int64()), ("words", pa.list_(pa.int64())), ("paths", pa.list_(pa.string())),
                   ("texts", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32()))])
_PLACED = pa.schema([("host", pa.string()), ("place", pa.string()), ("node", pa.int64()), ("chars", pa.int64()), ("keys", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))])


@lru_cache(1 << 14)
def placed(path: str, stable: frozenset) -> str:
    """A path with all words as ``Page`` gives it with the stable ones."""
    bare, out = "", ""
    for step in path.split("/")[1:]:
        name, *words = step.split(".")
        bare = f"{bare}/{name}"
        out += "/" + ".".join([name, *(w for w in words if hashed(f"{bare} {w}") in stable)])
    return out


def _place(batches):
    """One row for each place of a page: its texts' keys, and their characters."""
    for batch in batches:
        out = {f.name: [] for f in _PLACED}
        for host, paths, texts, sizes, stable in zip(*(batch[c].to_pylist() for c in ("host", "paths", "texts", "sizes", "stable"))):
            stable, by = unpacked(stable), {}
            for path, text, size in zip(paths, texts, sizes):
                by.setdefault(placed(path, stable), []).append((text, size))
            for place, found in by.items():
                each = {constant_key(host, place, text): 0 for text, _ in found}
                for text, size in found:
                    each[constant_key(host, place, text)] += size
                for name, v in zip(out, (host, place, hashed(f"{host} {place}"), sum(each.values()),
                                         list(each), list(each.values()))):
                    out[name].append(v)
        yield pa.record_batch(out, _PLACED)


def _streams(batches):
    """host and the stream of places of each page."""
    for batch in batches:
        texts = [stream([placed(path, unpacked(s)) for path in paths])
                 for paths, s in zip(batch["paths"].to_pylist(), batch["stable"].to_pylist())]
        yield pa.record_batch({"host": batch["host"], "stream": pa.array(texts, pa.string())})


def in_groups(nodes: list[str], others: list[str]) -> list[str]:
    """``nodes`` with single runs of what ``others`` has as a repeated group taken for that group."""
    groups = {}
    for g in others:
        if g.startswith("("):
            g = g.rstrip("?")
            groups[g] = nodes_of(g[1:-2])
    for g, inner in sorted(groups.items(), key=lambda x: -len(x[1])):
        out, i = [], 0
        while i < len(nodes):
            if nodes[i: i + len(inner)] == inner:
                out.append(g)
                i += len(inner)
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return grouped(nodes)


def _merged(table: pa.Table) -> pa.Table:
    """The wrapper of a host's streams, aligned from the shortest on."""
    streams = sorted((nodes_of(x) for x in table["stream"].to_pylist()), key=lambda x: (len(x), x))
    out = streams[0]
    for x in streams[1:]:
        out = aligned(in_groups(out, x), in_groups(x, out))
    return pa.table({"host": table["host"][:1], "stream": pa.array([" ".join(out)], pa.string())})


def inferred(different: DataFrame) -> DataFrame:
    """host, stream: the wrapper that aligning the streams of all of a host's pages gives."""
    left = written(different.mapInArrow(_streams, "host string, stream string").distinct(), "html_streams")
    while True:
        most = left.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return left
        parts = -(-most // FOLD)
        fewer = written(left.groupBy("host", F.pmod(F.xxhash64("stream"), F.lit(parts)).alias("part"))
                        .applyInArrow(_merged, "host string, stream string"), "html_streams")
        dropped(left)
        left = fewer


def wrappers(pages: DataFrame) -> DataFrame:
    """host, n_pages, wrapper (the regular expression), main (path of the main container), stable, template (packed keys)."""
    read = pages.select("url", "html").mapInArrow(
        _read, "host string, key long, words array<long>, paths array<string>, texts array<long>, sizes array<int>")
    different = written(read.groupBy("host", "key").agg(F.min(F.struct("paths", "texts", "sizes", "words")).alias("p"),
                                                        F.count("*").alias("n")).select("host", "n", "p.*"), "html_different")
    hosts = written(different.groupBy("host").agg(F.sum("n").alias("n_pages"), F.count("*").alias("n_different")), "html_hosts")
    # the words of a host's only page say what its places are
    words = different.select("host", F.explode("words").alias("word")).groupBy("host", "word").agg(F.count("*").alias("n")) \
        .join(hosts, "host").filter((F.col("n") >= F.least(F.lit(TEMPLATE_PAGES), "n_different")) & (F.col("n") >= STABLE_SHARE * F.col("n_different")))
    stable = written(words.groupBy("host").agg(F.array_sort(F.collect_list("word")).alias("stable"))
                     .mapInArrow(lambda batches: (pa.record_batch({
                         "host": b["host"], "stable": pa.array([packed(k) for k in b["stable"].to_pylist()], pa.binary())}) for b in batches),
                                 "host string, stable binary"), "html_stable")
    different = different.filter(F.size("texts") > 0).join(stable, "host", "left").select("host", "paths", "texts", "sizes", "stable")
    places = written(different.mapInArrow(
        _place, "host string, place string, node long, chars long, keys array<long>, sizes array<long>"),
        "html_places")
    nodes = written(places.groupBy("node").agg(
        F.min("host").alias("host"), F.min("place").alias("place"), F.count("*").alias("n"), F.sum("chars").alias("chars")), "html_nodes")
    constant = written(places.select("node", F.explode(F.arrays_zip("keys", "sizes")).alias("t"))
                       .groupBy(F.col("t.keys").alias("key"), "node").agg(F.count("*").alias("k"), F.sum("t.sizes").alias("size"))
                       .filter(F.col("k") >= TEMPLATE_PAGES).join(nodes, "node").filter(F.col("k") >= TEMPLATE_SHARE * F.col("n"))
                       .select("node", "host", "key", "size"), "html_constant")
    nodes = nodes.join(constant.groupBy("node").agg(F.sum("size").alias("constant")), "node", "left") \
        .withColumn("constant", F.coalesce("constant", F.lit(0))).withColumn("slot", F.col("chars") - F.col("constant"))
    template = constant.groupBy("host").agg(F.array_sort(F.collect_list("key")).alias("template"))
    shown = nodes.groupBy("host").agg(F.collect_list(F.struct("place", "chars", "constant", "slot")).alias("nodes"))

    def show(batches):
        for b in batches:
            nodes = [x or [] for x in b["nodes"].to_pylist()]
            main = [main_container({x["place"]: x["slot"] for x in ns}, {x["place"]: x["chars"] for x in ns}) for ns in nodes]
            yield pa.record_batch({
                "host": b["host"], "n_pages": b["n_pages"],
                "wrapper": pa.array([expression(w or "", ns) for w, ns in zip(b["stream"].to_pylist(), nodes)], pa.string()),
                "main": pa.array(main, pa.string()), "stable": b["stable"],
                "template": pa.array([packed(t or []) for t in b["template"].to_pylist()], pa.binary())})

    return hosts.join(stable, "host", "left").join(inferred(different), "host", "left").join(shown, "host", "left").join(template, "host", "left") \
        .mapInArrow(show, "host string, n_pages long, wrapper string, main string, stable binary, template binary")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text: one row per page."""

    def run(batches):
        for batch in batches:
            texts = [extract(Page(b.as_py(), unpacked(s)), m, h, unpacked(t), slots_of(w)) for b, m, h, s, t, w in zip(
                batch["html"], *(batch[c].to_pylist() for c in ("main", "host", "stable", "template", "wrapper")))]
            yield pa.record_batch({"page_id": batch["page_id"], "url": batch["url"], "text": pa.array(texts, pa.string())})

    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    ids = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    # written, so that its size is known and pages needn't be shuffled
    known = written(wrappers(pages).select("host", "wrapper", "main", "stable", "template"), "html_wrappers")
    return ids.withColumn("host", host).join(known, "host", "left").select("page_id", "url", "html", "host", "wrapper", "main", "stable", "template") \
        .mapInArrow(run, "page_id long, url string, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumn("n_chars", F.length("text").cast("long"))
