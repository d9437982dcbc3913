"""The queries of this subpackage, by name, and their SQL where it can express them."""

from __future__ import annotations

from . import chat, clustering, collocations, line_dedup, minhash, mixing, quality_classifier, quality_rules, sentencepieces, simhash, suffix_dedup, token_counts, toxicity

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_near_dedup": minhash.op2_near_dedup,
    "op3_quality_classifier": quality_classifier.op3_quality_classifier,
    "op4_fingerprints": simhash.op4_fingerprints,
    "op5_mixing": mixing.op5_mixing,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_sentencepieces": sentencepieces.op7_sentencepieces,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_chat_formatting": chat.op10_chat_formatting,
    "op11_suffix_dedup": suffix_dedup.op11_suffix_dedup,
    "op12_collocations": collocations.op12_collocations,
    "op13_clustering": clustering.op13_clustering,
}
ORACLE_SQL = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op2_near_dedup": minhash.OP2_SQL,
    "op5_mixing": mixing.OP5_SQL,
    "op9_quality_rules": quality_rules.OP9_SQL,
    "op10_chat_formatting": chat.OP10_SQL,
    "op11_suffix_dedup": suffix_dedup.OP11_SQL,
    "op12_collocations": collocations.OP12_SQL,
    "op13_clustering": clustering.OP13_SQL,
}
