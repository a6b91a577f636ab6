"""From raw documents to token files in five stages, each applying one operator of ``fundgraph.llm``.

A stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept;
its result is written as Parquet and read again as the next one's ``docs``.  All
but the last return the columns of ``documents``.

No stage but the mix can be said in SQL (boosted trees, bit-wise groups, edit
distance, byte-pair ids), so ORACLE_SQL is None and the tests hold run()
against a brute-force version of all five.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fundgraph.llm import decontaminate, mixing, quality_model, simhash, token_files
from fundgraph.llm.common import table
from fundgraph.session import cut

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality classifier takes for good."""
    return quality_model.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash group: its smallest doc_id. Rows without one stay, unless their texts are near."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents without a benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's words up to its target: documents left out, or repeated."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and gives each document's place in them."""
    return token_files.digest(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("tokens", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
