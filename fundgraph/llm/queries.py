"""Queries of this package over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fundgraph.llm import chat, decontaminate, filter_audit, lexical_search, line_dedup, mixing, quality_model, quality_rules, secrets, simhash, substring_dedup, suffix_dedup, token_files
from fundgraph.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_substring_dedup": lambda spark, d: substring_dedup.digest(table(spark, d, "documents")),
    "op2_secret_scan": lambda spark, d: secrets.digest(table(spark, d, "documents")),
    "op3_decontaminate": lambda spark, d: decontaminate.leaks(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op4_quality_rules": lambda spark, d: quality_rules.digest(table(spark, d, "documents")),
    "op5_chat_format": lambda spark, d: chat.digest(chat.with_control_conversation(spark, table(spark, d, "conversations"))),
    "op6_simhash": lambda spark, d: simhash.digest(table(spark, d, "documents")),
    "op7_mix_sources": lambda spark, d: mixing.digest(table(spark, d, "documents")),
    "op8_quality_classifier": lambda spark, d: quality_model.digest(table(spark, d, "documents"), table(spark, d, "labels")),
    "op9_token_files": lambda spark, d: token_files.digest(table(spark, d, "documents")),
    "op10_suffix_dedup": lambda spark, d: suffix_dedup.digest(table(spark, d, "documents")),
    "op11_line_dedup": lambda spark, d: line_dedup.digest(table(spark, d, "documents")),
    "op12_filter_audit": lambda spark, d: filter_audit.digest(table(spark, d, "documents"), table(spark, d, "labels")),
    "op13_lexical_search": lambda spark, d: lexical_search.digest(table(spark, d, "documents"), table(spark, d, "benchmark")),
}

SQL: dict[str, str] = {
    "op1_substring_dedup": substring_dedup.oracle(),
    "op2_secret_scan": secrets.oracle(),
    "op4_quality_rules": quality_rules.oracle(),
    "op5_chat_format": chat.oracle(),
    "op7_mix_sources": mixing.oracle(),
    "op11_line_dedup": line_dedup.oracle(),
    "op12_filter_audit": filter_audit.oracle(),
    "op13_lexical_search": lexical_search.oracle(),
}
