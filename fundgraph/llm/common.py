"""What the operators of this package share: words, keys, sizes and input tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Words are runs of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

#: Stands for a null doc_id inside an operator: such rows come after every other.
NO_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) alone: other columns, whatever their names, never meet an operator's own."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def total_bytes(docs: DataFrame) -> int:
    """Bytes of all texts: one column-pruned pass that returns one number."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def parts_for(spark: SparkSession, size: int, each: int) -> int:
    """Partitions that hold about ``each`` bytes of ``size``, the session's count at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / each))
