"""Operator 5: personal data by bootstrapped contextual extraction.  DataFrame operations only.

1. Base spans: addresses, numbers and phones by four patterns, each checked
   (parts of an IP, Luhn sum, digits of a phone).  They are the seeds.
2. Candidates: other phrases.  Runs of digit groups and signs over spaces, or
   words, with at least ``MIN_DIGITS`` digits; words with an ``@``; and, beside
   patterns of addresses only, words with a sign inside and words joined by
   an "at" in brackets, or by a plain one before a name with a dot.
3. A lexical pattern is the word left, or the word right, of an identifier.
   Patterns and instances form a graph.  Spark scores it in rounds: a pattern's
   confidence is the mean score of its instances (seeds have 1, candidates
   start at 0) over at least ``MIN_SEEDS`` different seeds, a candidate's score the confidence that its best
   pattern gives it.
4. Candidates beside patterns of at least ``CONFIDENCE`` become spans of the
   kind that most of the pattern's seeds have.  Base spans always stay.
5. Found candidates are seeds of the next hop: words beside them become
   patterns where no base span stands.  Such a seed counts with its score, one
   found as another kind with nothing, and all others start at 0 again, so
   confidence falls with each hop.  Hops end when no pattern is new.

A pattern of very many instances is one row per task before it is shuffled; no
text is shuffled to find spans.

Defined cases: null text is empty; a null id is kept; repeated rows are found
each alike; where spans overlap, all are listed and redaction covers their
union.  Only ``doc_id`` and ``text`` are read; ``redacted`` keeps the other columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.llm.components import marked, written

# The four base patterns.  Runs are possessive and begin at the start of a run of their signs
# (or where the last match ended), which matches the same and keeps time linear.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

_S, _SIGN, _AT = r"[^\x20\x09-\x0D]", r"[^\p{L}\p{N}\x20\x09-\x0D]", r"[\[({<]\x20*+(?i:at)\x20*+[\])}>]"
_GROUP = rf"[+(]*+[0-9][0-9()./+-]*+(?={_SIGN}*+(?:[\x20\x09-\x0D]|$))"      # a word of digits and signs
_DOT = r"(?:\x20++(?i:dot)\x20++|\x20*+[\[({<]\x20*+(?i:dot)\x20*+[\])}>]\x20*+)"
_JOINED = rf"{_S}++\x20++(?:{_AT}\x20*+{_S}++|(?i:at)\x20++[\p{{L}}\p{{N}}-]++(?:\.(?=[\p{{L}}\p{{N}}])|{_DOT}){_S}++)(?:{_DOT}{_S}++)*+"
#: A run of groups, words joined by an "at", a word with a digit or an @, or with a sign inside.
CANDIDATE = (rf"(?<!{_S})(?:{_GROUP}(?:\x20++{_GROUP})*+|{_JOINED}|{_S}*?[0-9@]{_S}*+|"
             rf"{_SIGN}*+[\p{{L}}]++(?:['’-][\p{{L}}]++)*+{_SIGN}++[\p{{L}}]{_S}*+)")
AT = "at"                       # kind of candidates that only patterns of addresses speak for; '' of others
MIN_DIGITS = 6
MIN_SEEDS = 5                   # different seed values that make a pattern
CONFIDENCE = 0.8
ROUNDS = 3                      # of scores in a hop
HOPS = 4                        # in which found identifiers seed new patterns, at most
FREE = 16                       # bits for each text with spans; one of 16 texts without any is joined for nothing
SPAN = "struct<kind:string,start:int,end:int,value:string>"


def matches(text: Column, pattern: str, kind: str) -> Column:
    """Matches of a pattern as (kind, start, end, value); positions follow from the gaps between them."""
    values, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))
    steps = F.zip_with(values, F.slice(gaps, 1, F.size(values)), lambda v, g: F.struct(v.alias("v"), F.length(g).alias("g")))

    def add(acc, x):
        at = acc["at"] + x["g"]
        end = at + F.length(x["v"])
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(F.struct(
            F.lit(kind).alias("kind"), at.alias("start"), end.alias("end"), x["v"].alias("value")))).alias("spans"))

    return F.aggregate(steps, start, add, lambda acc: acc["spans"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    d = F.reverse(_digits(value))

    def at(i):
        x = F.substring(d, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda a, i: a + at(i)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) <= 3) & (
            F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return n.between(14, 19) & F.when(n.between(14, 19), _luhn(value)).otherwise(False)
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def _tried(kind: str, text: Column) -> Column:
    has = F.contains(text, F.lit(NEEDS[kind])) if NEEDS[kind] else text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}")
    found = F.filter(matches(text, PATTERNS[kind], kind), lambda s: _valid(kind, s["value"]))
    return F.when(has, found).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(text: Column) -> Column:
    return F.concat(*(_tried(k, text) for k in KINDS))


def _word(text: Column, side: str) -> Column:
    """The nearest word on a side, without signs, in lower case."""
    word = F.regexp_extract(text, r"(?<!\S)(\S++)\s++$" if side == "left" else r"^\s++(\S++)", 1)
    return F.lower(F.regexp_replace(word, r"^\W++|(?<!\W)\W++$", ""))


def _beside(text: Column, span: Column, side: str) -> Column:
    """The nearest word on a side; the whole side is searched only where 80 characters don't hold the word and what bounds it."""
    if side == "left":
        near = F.substring(text, F.greatest(span["start"] - 79, F.lit(1)), F.least(F.lit(80), span["start"]))
        whole, bounded, cut = F.substring(text, F.lit(1), span["start"]), near.rlike(r"\s\S++\s++$|\S$"), span["start"] > 80
    else:
        near = F.substring(text, span["end"] + 1, F.lit(80))
        whole, bounded, cut = F.substring(text, span["end"] + 1, F.length(text)), near.rlike(r"^\s++\S++\s|^\S"), F.length(near) == 80
    return F.when(cut & ~bounded, _word(whole, side)).otherwise(_word(near, side))


def _contexts(text: Column, spans: Column) -> Column:
    """Spans with the words around them."""
    return F.transform(spans, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
        _beside(text, s, "left").alias("left"), _beside(text, s, "right").alias("right")))


def _masked(text: Column, base: Column) -> Column:
    """The text with base spans as one letter each sign, so that no run of groups goes over them."""
    put = F.aggregate(
        in_order(base), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.when(s["end"] > a["at"], F.struct(s["end"].alias("at"), F.concat(
            a["out"], F.substring(text, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0))),
            F.repeat(F.lit("x"), s["end"] - F.greatest(s["start"], a["at"]))).alias("out"))).otherwise(a),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(base) > 0, put).otherwise(text)


def candidates(text: Column, base: Column) -> Column:
    """Phrases that look like identifiers and meet no base span, without signs around them."""
    # a bracket stays before digits that one closes
    core = r"^[^\p{L}\p{N}]*?(?=\+?\([0-9]++\).*[\p{L}\p{N}]|\+?[\p{L}\p{N}])"

    def trim(s):
        lead = F.length(F.regexp_extract(s["value"], core, 0))
        value = F.regexp_replace(s["value"], core + r"|(?<![^\p{L}\p{N}])[^\p{L}\p{N}]++$", "")
        start = s["start"] + lead
        sure = F.contains(value, F.lit("@")) | (F.length(_digits(value)) >= MIN_DIGITS)
        return F.struct(F.when(sure, "").otherwise(AT).alias("kind"), start.alias("start"), (start + F.length(value)).alias("end"),
                        value.alias("value"))

    return F.filter(F.transform(matches(_masked(text, base), CANDIDATE, ""), trim), lambda s: (
        (s["kind"] == "") | s["value"].rlike(r"\p{L}[^\p{L}].*\p{L}")) & ~F.exists(
        base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))


def learned_patterns(identifiers: DataFrame) -> DataFrame:
    """(pattern, kind) of high confidence, from identifiers (kind, empty or ``AT`` for a candidate; value; left; right)."""
    edges = identifiers.select("kind", F.sha2("value", 256).alias("value"), F.explode(F.array(
        F.concat(F.lit("L "), "left"), F.concat(F.lit("R "), "right"))).alias("pattern")).filter("length(pattern) > 2")
    edges = written(edges.groupBy("pattern", "kind", "value").agg(F.count("*").alias("n")), "pii_edges")
    base, more = F.col("kind").isin(*KINDS), (F.col("kind") != AT) | (F.col("of") == "email")
    sure, patterns, known = None, None, 0
    for _ in range(HOPS):
        # a pattern enters by its seeds; what was found in earlier hops seeds like a base span
        votes = edges.filter(base).select("pattern", "kind", "value")
        if sure is not None:
            votes = votes.union(edges.filter(~base).join(sure.select("value", "of"), "value").filter(more)
                                .select("pattern", F.col("of").alias("kind"), "value").distinct())
        seeds = votes.groupBy("pattern", "kind").agg(F.count("*").alias("k")).groupBy("pattern").agg(
            F.sum("k").alias("seeds"), F.max_by("kind", F.struct("k", "kind")).alias("of")).filter(F.col("seeds") >= MIN_SEEDS)
        graph = edges.join(seeds.select("pattern", "of"), "pattern").filter(more).select(
            "pattern", "of", F.when(F.col("kind") == AT, "").otherwise(F.col("kind")).alias("kind"), "value")
        if sure is not None:
            graph = graph.join(sure.select("value", F.col("of").alias("was"), F.col("score").alias("had")), "value", "left")
        else:
            graph = graph.withColumn("was", F.lit(None).cast("string")).withColumn("had", F.lit(None).cast("double"))
        # what was found as another kind speaks against the pattern, as a candidate that no pattern knows does
        graph = written(graph.select("pattern", "of", "kind", "value", F.when(F.col("was") == F.col("of"), F.col("had")).alias("had")), "pii_graph")
        score = None
        for _ in range(ROUNDS):
            own = graph.withColumn("score", F.lit(0.0)) if score is None else graph.join(score, ["value", "of"], "left")
            patterns = own.groupBy("pattern", "of").agg(F.avg(F.when(F.col("kind") != "", 1.0).otherwise(
                F.greatest(F.coalesce("had", F.lit(0.0)), F.coalesce("score", F.lit(0.0))))).alias("confidence"))
            # an instance's best pattern speaks for it: what the pattern's seeds share, held back by what it has no seed for
            score = written(graph.filter("kind = ''").join(patterns.select("pattern", "confidence"), "pattern")
                            .groupBy("value", "of").agg(F.max("confidence").alias("score")), "pii_scores")
        patterns = written(patterns.filter(F.col("confidence") >= CONFIDENCE).select("pattern", F.col("of").alias("kind")), "pii_patterns")
        sure = score.filter(F.col("score") >= CONFIDENCE).groupBy("value").agg(
            F.max("score").alias("score"), F.max_by("of", F.struct("score", "of")).alias("of"))
        if (n := patterns.count()) == known:
            break
        known = n
    return patterns


def found_spans(docs: DataFrame) -> DataFrame:
    """row, doc_id, text_hash, base, spans: base spans and all spans (sorted) of each document."""
    text = F.coalesce("text", F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("base", base_spans(F.col("text")))
    d = d.withColumn("more", candidates(F.col("text"), F.col("base")))
    d = written(d.select("doc_id", F.xxhash64("text").alias("text_hash"), _contexts(F.col("text"), F.col("base")).alias("base"),
                         _contexts(F.col("text"), F.col("more")).alias("more")), "pii") \
        .withColumn("row", F.monotonically_increasing_id())     # of a written table: the same in every pass
    one = d.select("row", F.explode(F.concat("base", "more")).alias("s")).select("row", "s.*")
    patterns = learned_patterns(one.select("kind", "value", "left", "right"))
    hits = one.filter(~F.col("kind").isin(*KINDS)).select("row", "start", "end", "value", F.col("kind").alias("form"), F.explode(F.array(
        F.concat(F.lit("L "), "left"), F.concat(F.lit("R "), "right"))).alias("pattern")).join(patterns, "pattern") \
        .filter((F.col("form") != AT) | (F.col("kind") == "email")).groupBy("row", "start", "end", "value").agg(F.min("kind").alias("kind")) \
        .groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end", "value")).alias("new"))
    plain = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                                   s["value"].alias("value")))
    return d.select("row", "doc_id", "text_hash", plain.alias("base")).join(hits, "row", "left").select(
        "row", "doc_id", "text_hash", in_order(F.col("base")).alias("base"),
        in_order(F.concat("base", F.coalesce("new", F.array().cast(f"array<{SPAN}>")))).alias("spans"))


def in_order(spans: Column) -> Column:
    """Spans by start, then kind as listed."""
    keyed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("a"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("b"), s["end"].alias("c"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda k: k["s"])


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with each found span of ``text`` replaced by ``[kind]`` (spans that meet: the first's kind); n_chars follows."""
    found = found_spans(docs).filter(F.size("spans") > 0).groupBy("doc_id", "text_hash").agg(F.first("spans").alias("spans"))
    sign = "_"
    while any(c.lower().startswith(f"{sign}found_") for c in docs.columns):
        sign += "_"
    of_id, of_hash, of_spans = (f"{sign}found_{x}" for x in ("id", "hash", "spans"))     # names that docs don't have
    found = written(found, "pii_found").select(F.col("doc_id").alias(of_id), F.col("text_hash").alias(of_hash),
                                               F.col("spans").alias(of_spans))
    text = F.col("text")
    cut = F.aggregate(
        of_spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.when(s["start"] >= a["at"], F.struct(s["end"].alias("at"), F.concat(
            a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit("["), s["kind"], F.lit("]")).alias("out")))
        .otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    # texts that can't have spans, by a bit of their hash, aren't shuffled
    of_bit, may = f"{sign}found_bit", f"{sign}found_may"
    bit = lambda i, h: F.pmod(F.xxhash64(i, h), F.lit(FREE * found.count() + 1)).alias(of_bit)
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    own = marked(docs.select("*", bit(F.col("doc_id").cast("long"), text_hash)), of_bit,
                 found.select(bit(F.col(of_id), F.col(of_hash))), may)
    out = own.filter(may).join(found, F.col("doc_id").cast("long").eqNullSafe(F.col(of_id)) & (
        text_hash == F.col(of_hash)), "left").drop(of_id, of_hash)
    out = out.unionByName(own.filter(~F.col(may)).withColumn(of_spans, F.lit(None).cast(f"array<{SPAN}>"))) \
        .withColumn("text", F.when(F.col(of_spans).isNull(), text).otherwise(cut)).drop(of_spans, of_bit, may)
    if "n_chars" in out.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out.select(docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = found_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *(count(k) for k in KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
