"""The queries of this subpackage and the SQL that some of them must equal."""

from __future__ import annotations

from . import (
    chat,
    decontamination,
    html_text,
    jaccard,
    langid,
    lm_scoring,
    merkle,
    mixing,
    negatives,
    quality,
    simhash,
    tokens,
    warc,
)

QUERIES = {
    "op1_chat_formatting": chat.op1_chat_formatting,
    "op2_lm_scoring": lm_scoring.op2_lm_scoring,
    "op3_token_counts": tokens.op3_token_counts,
    "op4_decontamination": decontamination.op4_decontamination,
    "op5_html_extraction": html_text.op5_html_extraction,
    "op6_mixing": mixing.op6_mixing,
    "op7_simhash": simhash.op7_simhash,
    "op8_quality_rules": quality.op8_quality_rules,
    "op9_language_id": langid.op9_language_id,
    "op10_warc": warc.op10_warc,
    "op11_merkle": merkle.op11_merkle,
    "op12_negatives": negatives.op12_negatives,
    "op13_ngram_join": jaccard.op13_ngram_join,
}

ORACLE_SQL = {
    "op1_chat_formatting": chat.OP1_SQL,
    "op2_lm_scoring": lm_scoring.OP2_SQL,
    "op6_mixing": mixing.OP6_SQL,
    "op8_quality_rules": quality.OP8_SQL,
    "op10_warc": warc.OP10_SQL,
    "op11_merkle": merkle.OP11_SQL,
    "op12_negatives": negatives.OP12_SQL,
    "op13_ngram_join": jaccard.OP13_SQL,
}
