"""Registered queries of the training-data operators: ``opN_<name>``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cropledger.llm import (
    byte_bpe,
    context_mixing,
    exact_dedup,
    html_extract,
    language_id,
    ngram_join,
    packing,
    pii,
    prefix_trie,
    quality_rules,
    spelling,
    suffix_dedup,
    token_files,
)

MODULES = [ngram_join, html_extract, byte_bpe, packing, context_mixing, exact_dedup, quality_rules, suffix_dedup, token_files, language_id, spelling, pii, prefix_trie]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {m.NAME: m.query for m in MODULES}


def oracle_sql() -> dict[str, str]:
    return {m.NAME: m.ORACLE for m in MODULES if m.ORACLE}
