"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

import corpus_pipeline
from equiscope.llm import bitslice, chat, packing, phrases, pieces, qda, quality, revisits, simhash, spelling, substrings, toxicity, urls

QUERIES = {
    "op1_url_filter": urls.op1_url_filter,
    "op2_bitsliced_topk": bitslice.op2_bitsliced_topk,
    "op3_quality": quality.op3_quality,
    "op4_simhash": simhash.op4_simhash,
    "op5_chat": chat.op5_chat,
    "op6_revisits": revisits.op6_revisits,
    "op7_substrings": substrings.op7_substrings,
    "op8_pieces": pieces.op8_pieces,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_packing": packing.op10_packing,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_collocations": phrases.op12_collocations,
    "op13_quality_classifier": qda.op13_quality_classifier,
    "pipeline": corpus_pipeline.run,
}

#: SQL where it can express the query; the others are tested against
#: brute-force versions in tests/llm.
ORACLE = {
    "op1_url_filter": urls.ORACLE_SQL,
    "op2_bitsliced_topk": bitslice.ORACLE_SQL,
    "op5_chat": chat.ORACLE_SQL,
    "op6_revisits": revisits.ORACLE_SQL,
    "op11_spelling_variants": spelling.ORACLE_SQL,
    "op12_collocations": phrases.ORACLE_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
