"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paneltrend.llm import (
    byte_bpe,
    chat_format,
    collision_links,
    conversation_repair,
    exact_dedup,
    html_main,
    language_id,
    mixing,
    sharding,
    simhash_golay,
    toxicity,
    url_filter,
    vector_codes,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": language_id.query,
    "op2_url_filter": url_filter.query,
    "op3_source_mixing": mixing.query,
    "op4_html_main": html_main.query,
    "op5_toxicity": toxicity.query,
    "op6_simhash_golay": simhash_golay.query,
    "op7_byte_bpe": byte_bpe.query,
    "op8_exact_dedup": exact_dedup.query,
    "op9_chat_formatting": chat_format.query,
    "op10_collision_links": collision_links.query,
    "op11_balanced_shards": sharding.query,
    "op12_vector_codes": vector_codes.query,
    "op13_conversation_repair": conversation_repair.query,
}

ORACLES: dict[str, str] = {
    "op2_url_filter": url_filter.SQL,
    "op3_source_mixing": mixing.SQL,
    "op8_exact_dedup": exact_dedup.SQL,
    "op9_chat_formatting": chat_format.SQL,
    "op12_vector_codes": vector_codes.SQL,
    "op13_conversation_repair": conversation_repair.SQL,
}
