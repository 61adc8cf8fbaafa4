"""Registered queries of the corpus operators, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import (chat, collocations, decontaminate, html_extract, language_id, lm_score, merkle, mixing, near_dedup,
                         neighbours, packing, suffix_dedup, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_lm_score": lm_score.op2_lm_score,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_packing": packing.op4_packing,
    "op5_neighbours": neighbours.op5_neighbours,
    "op6_near_dedup": near_dedup.op6_near_dedup,
    "op7_language_id": language_id.op7_language_id,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_html_extract": html_extract.op9_html_extract,
    "op10_chat_format": chat.query,
    "op11_mix_sources": mixing.op11_mix_sources,
    "op12_collocations": collocations.op12_collocations,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {
    "op1_suffix_dedup": suffix_dedup.ORACLE_SQL,
    "op6_near_dedup": near_dedup.ORACLE_SQL,
    "op10_chat_format": chat.ORACLE_SQL,
    "op11_mix_sources": mixing.ORACLE_SQL,
    "op12_collocations": collocations.ORACLE_SQL,
    "op13_merkle_manifest": merkle.ORACLE_SQL,
}
