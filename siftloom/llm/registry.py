"""Queries of the text-corpus operators and their SQL."""

from __future__ import annotations

import corpus_pipeline
from siftloom.llm import op1_language, op2_secrets, op3_probminhash, op4_mixing, op5_toxicity, op6_line_join, op7_fingerprints, op8_packing, op9_token_files, op10_media, op11_prefix_trie, op12_divergence, op13_resampling

MODULES: list = [op1_language, op2_secrets, op3_probminhash, op4_mixing, op5_toxicity, op6_line_join, op7_fingerprints, op8_packing, op9_token_files, op10_media, op11_prefix_trie, op12_divergence, op13_resampling]


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict:
    out = {name: sql for m in MODULES for name, sql in m.SQL.items()}
    return out | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
