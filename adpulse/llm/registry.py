"""The operators' queries and, where SQL can express them, the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adpulse.llm import queries, sql
from corpus_pipeline import run as pipeline

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_document_fingerprints": queries.op1_document_fingerprints,
    "op2_cross_entropy_difference": queries.op2_cross_entropy_difference,
    "op3_source_mix": queries.op3_source_mix,
    "op4_quality_rules": queries.op4_quality_rules,
    "op5_sentencepiece": queries.op5_sentencepiece,
    "op6_url_filter": queries.op6_url_filter,
    "op7_pii": queries.op7_pii,
    "op8_language_id": queries.op8_language_id,
    "op9_minhash_near_dedup": queries.op9_minhash_near_dedup,
    "op10_warc": queries.op10_warc,
    "op11_tokenizer_alignment": queries.op11_tokenizer_alignment,
    "op12_bpe": queries.op12_bpe,
    "op13_conversation_trie": queries.op13_conversation_trie,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {
    "op6_url_filter": sql.OP6,
    "op9_minhash_near_dedup": sql.OP9,
    "op10_warc": sql.OP10,
    "op13_conversation_trie": sql.OP13,
}
