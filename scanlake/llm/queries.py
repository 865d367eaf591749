"""Registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from scanlake.llm import (op1_suffix_dedup, op2_lm_score, op3_toxicity, op4_fingerprint, op5_pii, op6_html,
                          op7_decontaminate, op8_pack, op9_chat, op10_jaccard_join, op11_warc, op12_negatives, op13_runs)

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup.query,
    "op2_lm_score": op2_lm_score.query,
    "op3_toxicity": op3_toxicity.query,
    "op4_fingerprint": op4_fingerprint.query,
    "op5_pii": op5_pii.query,
    "op6_html": op6_html.query,
    "op7_decontaminate": op7_decontaminate.query,
    "op8_pack": op8_pack.query,
    "op9_chat": op9_chat.query,
    "op10_jaccard_join": op10_jaccard_join.query,
    "op11_warc": op11_warc.query,
    "op12_negatives": op12_negatives.query,
    "op13_runs": op13_runs.query,
}

ORACLE: dict[str, str] = {"op11_warc": op11_warc.ORACLE, "op12_negatives": op12_negatives.ORACLE}
