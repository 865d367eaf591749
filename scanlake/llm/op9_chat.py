"""Operator 9: chat formatting with offset-aligned loss masks.

A conversation is rendered whole, turn by turn:

    <|endoftext|>{role}<|endoftext|>{text} ... <|endoftext|>

Control strings inside a role or text get a backslash after their first
character, and backslashes are doubled, so rendering is reversible.  The whole
string is encoded once, with offsets; sorted turn spans and token spans are
intersected by binary search.  As the marker is a token of its own, no token
reaches over the edge of a turn.

Defined cases: null role or text is empty; turns are ordered by turn (null
first), then role, then text, and repeated rows stay; a null conv_id is a
conversation of its own.  A conversation is one row, as its mask spans it.
Columns besides conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER = "byte_bpe_50k.json"
MARK = "<|endoftext|>"
CONTROL = (MARK, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LOSS_ROLE = "assistant"
_ESCAPE = re.compile("|".join(map(re.escape, sorted(("\\", *CONTROL), key=len, reverse=True))))

_OUT = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("ids", pa.list_(pa.int32())),
                  ("token_start", pa.list_(pa.int32())), ("token_end", pa.list_(pa.int32())),
                  ("loss", pa.list_(pa.bool_()))])
OUT = ("conv_id long, formatted string, ids array<int>, token_start array<int>, token_end array<int>, "
       "loss array<boolean>")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    """Inverse of ``escape``: doubled backslashes become one, others go."""
    out, i = [], 0
    while (j := text.find("\\", i)) >= 0:
        out.append(text[i:j])
        if text[j + 1: j + 2] == "\\":
            out.append("\\")
            j += 1
        i = j + 1
    return "".join(out) + text[i:]


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The string, and start and end of each turn's text in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = MARK + escape(role) + MARK, escape(text)
        parts += [head, body]
        spans.append((at + len(head), at + len(head) + len(body)))
        at = spans[-1][1]
    return "".join(parts) + MARK, np.array(spans, np.int64).reshape(-1, 2)


def masked(token_start: np.ndarray, token_end: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Tokens that share a character with one of the sorted, disjoint spans."""
    k = np.searchsorted(spans[:, 0], token_end, side="left") - 1        # last span that starts before the token ends
    return (k >= 0) & (token_end > token_start) & (spans[np.maximum(k, 0), 1] > token_start) if len(spans) else np.zeros(len(token_start), bool)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    parts = formatted.split(MARK)[1:-1]
    return [(unescape(r), unescape(t)) for r, t in zip(parts[::2], parts[1::2])]


def loss_texts(formatted: str, start, end, loss) -> list[str]:
    """Unescaped text under the mask, one string per run of masked tokens (a turn)."""
    s, e, m = np.asarray(start), np.asarray(end), np.asarray(loss, bool)
    edge = np.flatnonzero(np.diff(m.astype(np.int8), prepend=0, append=0))
    return [unescape(formatted[s[a]: e[b - 1]]) for a, b in zip(edge[::2], edge[1::2])]


def format_chats(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """formatted, ids, token_start, token_end (code points), loss: one row per conversation."""
    path = path or tokenizer_path()

    def encode(batches):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, processors

        tok = Tokenizer.from_file(path)
        tok.post_processor = processors.ByteLevel(trim_offsets=False)      # offsets with leading spaces
        for batch in batches:
            for conv, turns in zip(batch["conv_id"].to_pylist(), batch["turns"]):
                pairs = [(t["role"] or "", t["text"] or "") for t in turns.as_py()]
                formatted, spans = render(pairs)
                enc = tok.encode(formatted, add_special_tokens=False)
                off = np.array(enc.offsets, np.int64).reshape(-1, 2)
                loss = masked(off[:, 0], off[:, 1], spans[[r == LOSS_ROLE for r, _ in pairs]])
                cols = {"conv_id": [conv], "formatted": [formatted], "ids": [enc.ids], "token_start": [off[:, 0]],
                        "token_end": [off[:, 1]], "loss": [loss]}
                yield pa.record_batch([pa.array(cols[f.name], f.type) for f in _OUT], schema=_OUT)

    turns = F.sort_array(F.collect_list(F.struct("turn", F.col("role").cast("string").alias("role"),
                                                 F.col("text").cast("string").alias("text"))))
    return conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(turns.alias("turns")) \
        .mapInArrow(encode, OUT)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted output says: turns and text under the loss mask."""

    def digest(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                turns = read_turns(r["formatted"])
                texts = loss_texts(r["formatted"], r["token_start"], r["token_end"], r["loss"])
                rows.append({
                    "conv_id": r["conv_id"], "n_turns": len(turns),
                    "turns_sha256": hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest(),
                    "loss_chars": sum(map(len, texts)), "loss_sha256": hashlib.sha256("".join(texts).encode()).hexdigest(),
                    "formatted_chars": len(r["formatted"])})
            if rows:
                yield pa.RecordBatch.from_pylist(rows)

    return formatted.mapInArrow(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                        "loss_sha256 string, formatted_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.sql("select cast(-1 as long) conv_id, cast(t as long) turn, r role, '</s>[INST] ok [/INST]' text "
                    "from values (0, 'user'), (1, 'assistant') as v(t, r)")
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return read_back(format_chats(given.unionByName(own)))
