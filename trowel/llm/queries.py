"""The operators' queries and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from trowel.llm import bpe, chat, decontaminate, html_text, language, merkle, quality, repair, secrets, sharding, simhash, toxicity, vectors

QUERIES = {
    "op1_secret_scans": secrets.op1_secret_scans,
    "op2_sharding": sharding.op2_sharding,
    "op3_quality_classifier": quality.op3_quality_classifier,
    "op4_approximate_nearest_neighbours": vectors.op4_approximate_nearest_neighbours,
    "op5_html_extraction": html_text.op5_html_extraction,
    "op6_benchmark_decontamination": decontaminate.op6_benchmark_decontamination,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_simhash_near_dedup": simhash.op8_simhash_near_dedup,
    "op9_bpe_encoding_and_decoding": bpe.op9_bpe_encoding_and_decoding,
    "op10_language_id": language.op10_language_id,
    "op11_merkle_dataset_manifest": merkle.op11_merkle_dataset_manifest,
    "op12_chat_formatting": chat.op12_chat_formatting,
    "op13_conversation_structure_repair": repair.op13_conversation_structure_repair,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op2_sharding": sharding.SQL,
    "op6_benchmark_decontamination": decontaminate.SQL,
    "op11_merkle_dataset_manifest": merkle.SQL,
    "op12_chat_formatting": chat.SQL,
    "op13_conversation_structure_repair": repair.SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
