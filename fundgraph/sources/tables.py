"""Readers and writers of the filing, intermediate and score tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.columns import INTEGERS, null_markers, to_int
from ..schema import FILINGS, FUND_SCORES, MANAGER_SCORES, PROVIDER_LINES
from .quoted_csv import read_quoted_csv

#: Doubled quotes inside quoted fields, blanks around a value kept (the CSV writer
#: drops them by default).  The intermediate files are UTF-8.
CSV = {
    "header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}

#: Encoding of the two raw files.
RAW = "ISO-8859-1"


def _read_csv(spark: SparkSession, path: str, schema: T.StructType | None, encoding: str) -> DataFrame:
    """Select the schema's columns by header name; numbers that do not parse become null.

    A quoted field may hold line breaks; a large file is read by many tasks all the same.
    """
    raw = null_markers(read_quoted_csv(spark, path, CSV, encoding))
    if schema is None:
        return raw
    kinds = {f.name: f.dataType for f in schema.fields}
    return raw.select(*[(to_int(c, t.simpleString()) if t.simpleString() in INTEGERS else raw[c].try_cast(t)).alias(c) for c, t in kinds.items()])


def read_table(spark: SparkSession, path: str, schema: T.StructType | None, fmt: str = "csv", encoding: str = "UTF-8") -> DataFrame:
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return df if schema is None else df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    return _read_csv(spark, path, schema, encoding)


def read_filings(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, FILINGS, fmt, RAW)


def read_provider_lines(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, PROVIDER_LINES, fmt, RAW)


def read_strings(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, missing markers as null."""
    return read_table(spark, path, None)


def read_fund_scores(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, FUND_SCORES, fmt)


def read_manager_scores(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, MANAGER_SCORES, fmt)


def write_table(df: DataFrame, path: str, fmt: str = "csv", encoding: str = "UTF-8") -> None:
    """Write with a header and no index; the writer makes the folder."""
    w = df.write.mode("overwrite")
    if fmt == "parquet":
        w.parquet(path)
    else:
        w.options(**CSV, encoding=encoding).csv(path)
