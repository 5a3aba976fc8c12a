"""The operators' queries over the test tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from orderlens.llm import (
    decontaminate, langid, mixing, pagetext, pii, quality, runs, simhash, substrings, tokens, topk, toxicity, turntrie,
)

QUERIES = {
    "op1_langid": langid.op1_langid,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_tokens": tokens.op4_tokens,
    "op5_quality": quality.op5_quality,
    "op6_pii": pii.op6_pii,
    "op7_simhash": simhash.op7_simhash,
    "op8_substrings": substrings.op8_substrings,
    "op9_mixing": mixing.op9_mixing,
    "op10_pagetext": pagetext.op10_pagetext,
    "op11_runs": runs.op11_runs,
    "op12_topk": topk.op12_topk,
    "op13_turntrie": turntrie.op13_turntrie,
}

ORACLES = {
    "op5_quality": quality.ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op12_topk": topk.ORACLE,
    "op13_turntrie": turntrie.ORACLE,
}
