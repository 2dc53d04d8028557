"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline

from . import alignment, chat, collocations, fingerprints, html_text, langid, mixing, ngram_join, packing, pii, quality, secret_scan, simhash

QUERIES = {
    "op1_mixing": mixing.op1,
    "op2_ngram_join": ngram_join.op2,
    "op3_html_text": html_text.op3,
    "op4_fingerprints": fingerprints.op4,
    "op5_packing": packing.op5,
    "op6_secret_scan": secret_scan.op6,
    "op7_language_id": langid.op7,
    "op8_quality_rules": quality.op8,
    "op9_chat_format": chat.op9,
    "op10_pii": pii.op10,
    "op11_alignment": alignment.op11,
    "op12_collocations": collocations.op12,
    "op13_simhash": simhash.op13,
    "quality_pooled": quality.pooled,
    "pipeline": corpus_pipeline.run,
}
ORACLE = {
    "op1_mixing": mixing.OP1_SQL,
    "op6_secret_scan": secret_scan.OP6_SQL,
    "op8_quality_rules": quality.OP8_SQL,
    "quality_pooled": quality.POOLED_SQL,
    "op9_chat_format": chat.OP9_SQL,
    "op12_collocations": collocations.OP12_SQL,
}
