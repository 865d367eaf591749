"""Captured port-scanner output → ``(ip, port)`` rows.

Every parser is a pure column plan over a DataFrame of text lines (``value``),
so a capture of any size is read split by split, parsed inside one codegen
stage and never gathered in one place.  A parser returns the shape-matching
lines as ``ip string, port_raw string`` (plus the input's other columns);
:func:`parse_lines` then converts the port in one of three modes:

* ``strict``     – a line of the right shape whose port is not an integer fails
                   the job, as one bad line aborts the whole import;
* ``quarantine`` – such lines are dropped here and listed by :func:`quarantine`;
* ``skip``       – such lines are dropped silently.

Lines of the wrong shape are always skipped.  A live capture starts with a
``# <command>`` line, which is dropped before parsing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ParserFn = Callable[[DataFrame], DataFrame]

_PARSERS: dict[str, ParserFn] = {}

# A terminal colour/style escape sequence (ESC [ params letter).
_ANSI = "\u001b\\[[0-9;]*[A-Za-z]"


def register_parser(name: str):
    """Decorator: make ``fn(lines) -> DataFrame[ip, port_raw, ...]`` available by name."""

    def deco(fn: ParserFn) -> ParserFn:
        _PARSERS[name] = fn
        return fn

    return deco


def get_parser(name: str) -> ParserFn:
    try:
        return _PARSERS[name]
    except KeyError:
        raise ValueError(f"unknown scanner format {name!r}; known: {sorted(_PARSERS)}") from None


def parser_names() -> list[str]:
    return sorted(_PARSERS)


# --------------------------------------------------------------------------- S1
def read_scan_lines(spark: SparkSession, paths, line_sep: str | None = None) -> DataFrame:
    """Read captured output as lines with their position.

    ``file_name``, ``block_start`` and ``row_id`` together give insertion order:
    the id grows within a split and the block start orders the splits of a file.
    """
    reader = spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    if isinstance(paths, str):
        paths = [paths]
    df = reader.text(list(paths))
    return df.select(
        "value",
        F.col("_metadata.file_path").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
    )


def line_numbers(lines: DataFrame, file_col: str = "file_name", block_col: str = "block_start",
                 row_col: str = "row_id", out: str = "line_no") -> DataFrame:
    """Number lines within each file (1, 2, ...) from their read position.

    Ids are consecutive within one file split, so a line's number is its
    offset in the split plus the lines of the file's earlier splits.  Only a
    small table with one row per split is aggregated and windowed; a file of
    any size is numbered by many tasks.
    """
    splits = lines.groupBy(file_col, block_col).agg(F.count("*").alias("_n"), F.min(row_col).alias("_first"))
    from pyspark.sql import Window

    w = Window.partitionBy(file_col).orderBy(block_col).rowsBetween(Window.unboundedPreceding, -1)
    offs = splits.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    j = lines.join(offs.select(file_col, block_col, "_off", "_first"), [file_col, block_col])
    return j.withColumn(out, F.col("_off") + F.col(row_col) - F.col("_first") + 1).drop("_off", "_first")


# ------------------------------------------------------------------- helpers
def _at(arr: Column, i: int) -> Column:
    """1-based element (negative from the end), null when out of range."""
    return F.try_element_at(arr, F.lit(i))


def _tokens(c: Column) -> Column:
    """``str.split()``: split on whitespace runs, no empty tokens."""
    return F.array_remove(F.split(c, r"\s+"), "")


def _emit(df: DataFrame, stages: list[dict[str, Column]], ok: Column, ip: Column, port_raw: Column) -> DataFrame:
    """Keep the lines where ``ok`` holds, as ``(ip, port_raw)`` plus the input's columns.

    Intermediate values (tokens, split fields) are computed once, in their own
    projection; the result is emitted through ``inline`` of a conditional
    one-element array – a flatMap – so the optimizer cannot push the shape test
    below the projections and re-run the tokenizing for it.
    """
    rest = [c for c in df.columns if c not in ("ip", "port_raw")]
    cur = df
    for st in stages:
        cur = cur.select(*cur.columns, *[v.alias(k) for k, v in st.items()])
    rec = F.when(ok, F.array(F.struct(ip.alias("ip"), port_raw.alias("port_raw"))))
    return cur.select(*rest, F.inline(rec))


# ------------------------------------------------------------------ S2, S3
@register_parser("generic")
def parse_generic(lines: DataFrame) -> DataFrame:
    """``ip:port`` – exactly two fields around ``:`` (S2; naabu S3 is the same)."""
    p = F.col("_p")
    return _emit(lines, [{"_p": F.split("value", ":", -1)}], F.size(p) == 2, _at(p, 1), _at(p, 2))


register_parser("naabu")(parse_generic)


# ------------------------------------------------------------------------ S4
@register_parser("sx")
def parse_sx(lines: DataFrame) -> DataFrame:
    """``ip port`` – exactly two whitespace-separated fields."""
    t = F.col("_t")
    return _emit(lines, [{"_t": _tokens(F.col("value"))}], F.size(t) == 2, _at(t, 1), _at(t, 2))


# ------------------------------------------------------------------- S5, S6
def _nmap_like(lines: DataFrame, tcp_only: bool) -> DataFrame:
    t, pp = F.col("_t"), F.col("_pp")
    ok = (F.size(t) >= 4) & (F.size(pp) == 2)
    if tcp_only:
        ok = ok & (_at(pp, 2) == "tcp")
    stages = [{"_t": _tokens(F.col("value"))}, {"_pp": F.split(_at(t, 4), "/", -1)}]
    return _emit(lines, stages, ok, _at(t, -1), _at(pp, 1))


@register_parser("nmap")
def parse_nmap(lines: DataFrame) -> DataFrame:
    """``Discovered open port 53/udp on 10.0.0.1`` – any protocol."""
    return _nmap_like(lines, tcp_only=False)


@register_parser("masscan")
def parse_masscan(lines: DataFrame) -> DataFrame:
    """``Discovered open port 80/tcp on 10.0.0.1`` – TCP only."""
    return _nmap_like(lines, tcp_only=True)


# ------------------------------------------------------------------------ S7
@register_parser("masscan_import")
def parse_masscan_import(lines: DataFrame) -> DataFrame:
    """Masscan list output: ip is token 4, the last token is ``port/state/proto/...``."""
    t, last = F.col("_t"), F.col("_last")
    ok = (F.size(t) >= 4) & (F.size(last) >= 3) & (_at(last, 3) == "tcp")
    stages = [{"_t": _tokens(F.col("value"))}, {"_last": F.split(_at(t, -1), "/", -1)}]
    return _emit(lines, stages, ok, _at(t, 4), _at(last, 1))


# ------------------------------------------------------------------------ S8
@register_parser("rustscan")
def parse_rustscan(lines: DataFrame) -> DataFrame:
    """``ip -> [p1,p2]`` – one row per listed port.

    A list that does not parse gives one row with a null ``port_raw``, so the
    strict mode fails on it as on a bad port.
    """
    p, ports = F.col("_p"), F.col("_ports")
    stages = [{"_p": F.split("value", " -> ", -1)},
              {"_ports": F.from_json(_at(p, 2), "array<string>")}]
    rest = [c for c in lines.columns if c not in ("ip", "port_raw")]
    cur = lines
    for st in stages:
        cur = cur.select(*cur.columns, *[v.alias(k) for k, v in st.items()])
    ip = _at(p, 1)
    rec = F.when(F.size(p) == 2, F.when(ports.isNull(), F.array(F.struct(
        ip.alias("ip"), F.lit(None).cast("string").alias("port_raw")))).otherwise(
        F.transform(ports, lambda x: F.struct(ip.alias("ip"), x.alias("port_raw")))))
    return cur.select(*rest, F.inline(rec))


# ------------------------------------------------------------------------ S9
@register_parser("nimscan")
def parse_nimscan(lines: DataFrame) -> DataFrame:
    """``==> ip:port [open]`` with terminal colour codes.

    Colour codes are removed as whole escape sequences, so the address stays
    intact (``10.0.0.10`` is not shortened).
    """
    after, t, ipp = F.col("_after"), F.col("_t"), F.col("_ipp")
    stages = [{"_after": F.split(F.regexp_replace("value", _ANSI, ""), "==>", -1)},
              {"_t": _tokens(_at(after, 2))},
              {"_ipp": F.split(_at(t, 1), ":", -1)}]
    ok = (F.size(after) >= 2) & (F.size(t) >= 1) & (F.size(ipp) == 2)
    ip = F.regexp_replace(_at(ipp, 1), r"[^0-9.]", "")
    port = F.regexp_replace(F.substring_index(_at(ipp, 2), "[", 1), r"[^0-9]", "")
    return _emit(lines, stages, ok, ip, port)


# ------------------------------------------------------------- S10 + modes
def _drop_header(lines: DataFrame) -> DataFrame:
    return lines.where(~F.col("value").startswith("# ") | F.col("value").isNull())


def parse_lines(lines: DataFrame, scanner: str, mode: str = "strict") -> DataFrame:
    """Parse lines with the named format (S10 registry) into ``ip, port`` rows."""
    if mode not in ("strict", "quarantine", "skip"):
        raise ValueError(f"mode must be strict, quarantine or skip, not {mode!r}")
    parsed = get_parser(scanner)(_drop_header(lines))
    port = F.col("port_raw").try_cast("int")
    if mode == "strict":
        # a filter, not a projection, so that column pruning can never drop the check
        msg = F.concat(F.lit(f"{scanner}: not a port number in line: "), F.coalesce(F.col("value"), F.lit("")))
        out = (parsed.where(F.when(port.isNull(), F.raise_error(msg)).otherwise(F.lit(True)))
               .withColumn("port", port))
    else:
        out = parsed.withColumn("port", port).where(F.col("port").isNotNull())
    return out.drop("port_raw", "value")


def quarantine(lines: DataFrame, scanner: str) -> DataFrame:
    """Lines of the right shape whose port does not convert: ``source_file, value, reason``."""
    parsed = get_parser(scanner)(_drop_header(lines))
    bad = parsed.where(F.col("port_raw").try_cast("int").isNull())
    src = F.col("file_name") if "file_name" in parsed.columns else F.lit(None).cast("string")
    return bad.select(src.alias("source_file"), F.col("value"),
                      F.concat(F.lit("bad port: "), F.coalesce(F.col("port_raw"), F.lit("<list>"))).alias("reason"))
