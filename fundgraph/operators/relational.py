"""Projections, renames, filters, de-duplication and joins."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import INTEGERS, normalize_ein, number, to_int
from ..schema import FILINGS
from ..session import cut


def select_filing_cols(df: DataFrame) -> DataFrame:
    return df.select(*FILINGS.fieldNames())


def rename_cols(df: DataFrame, names: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Rename by position (list) or by name (mapping)."""
    if isinstance(names, Mapping):
        return df.withColumnsRenamed(dict(names))
    return df.toDF(*names)


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.filter(reduce(operator.and_, [F.col(c).isNotNull() for c in cols]))


def rejected_eins(df: DataFrame, col: str) -> DataFrame:
    """How many non-null EINs cannot be read as a number."""
    bad = F.col(col).isNotNull() & normalize_ein(col).isNull()
    return df.agg(F.count(F.when(bad, 1)).alias("rejected"), F.count(F.col(col)).alias("present"))


def _ranked(df: DataFrame, key: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First k rows per key.  Spark limits each map task to k rows per key before
    the shuffle (window group limit), so a hot key does not travel whole."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def _cols(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def keep_first(df: DataFrame, key: str | Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """First row per key; row order is not a Spark concept, so it must be named."""
    return _ranked(df, _cols(key), [F.col(c).asc_nulls_last() for c in _cols(order_by)], 1)


def keep_last(df: DataFrame, key: str | Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """Last row per key: the outcome of writing the rows one after the other."""
    return _ranked(df, _cols(key), [F.col(c).desc_nulls_last() for c in _cols(order_by)], 1)


def top_per_group(df: DataFrame, key: str, by: str, k: int = 1, tie: str | None = None) -> DataFrame:
    order = [F.col(by).desc_nulls_last()] + ([F.col(tie)] if tie else [])
    return _ranked(df, [key], order, k)


def nlargest(df: DataFrame, n: int, col: str, tie: str) -> DataFrame:
    return df.orderBy(F.col(col).desc_nulls_last(), F.col(tie)).limit(n)


def head(df: DataFrame, n: int, order_by: str | Sequence[str]) -> DataFrame:
    return df.orderBy(*_cols(order_by)).limit(n)


def drop_self_loops(edges: DataFrame, src: str = "fund_ein", dst: str = "manager_ein") -> DataFrame:
    return edges.filter(F.col(src) != F.col(dst))


def distinct_pairs(edges: DataFrame, src: str = "fund_ein", dst: str = "manager_ein") -> DataFrame:
    return edges.select(src, dst).distinct()


def fill_defaults(df: DataFrame, defaults: Mapping[str, float]) -> DataFrame:
    """Per-column defaults for null and NaN."""
    nan_types = (T.DoubleType, T.FloatType)
    nans = {
        c: F.when(~F.isnan(c), F.col(c))
        for c in defaults
        if isinstance(df.schema[c].dataType, nan_types)
    }
    return df.withColumns(nans).fillna(dict(defaults))


def fill_all(df: DataFrame, value: str) -> DataFrame:
    """The same text for every null of every string column."""
    return df.fillna(value)


def cast_props(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast named columns; values that do not parse become null."""
    return df.withColumns({c: to_int(c, t) if t in INTEGERS else number(c) if t == "double" else F.col(c).try_cast(t) for c, t in types.items()})


def update_from(nodes: DataFrame, patch: DataFrame, key: str) -> DataFrame:
    """Set columns of matching rows: the patch's value wins where it has one."""
    cols = [c for c in patch.columns if c != key]
    renamed = patch.withColumnsRenamed({c: f"_new_{c}" for c in cols})
    joined = nodes.join(renamed, key, "left")
    old = set(nodes.columns)
    values = {
        c: F.coalesce(F.col(f"_new_{c}"), F.col(c)) if c in old else F.col(f"_new_{c}") for c in cols
    }
    return joined.withColumns(values).drop(*[f"_new_{c}" for c in cols])


def attach_fund(lines: DataFrame, filings: DataFrame) -> DataFrame:
    """Lines with their filing's sponsor EIN; null filing ids match each other and
    a repeated filing id fans out."""
    f = filings.select(F.col("ACK_ID").alias("_ack"), "SPONS_DFE_EIN")
    return lines.join(f, lines["ACK_ID"].eqNullSafe(f["_ack"]), "left").drop("_ack")


def with_group_size(df: DataFrame, key: str, name: str = "group_size") -> DataFrame:
    """Rows with the size of their group; the sizes are stored, so a hot group's join is split."""
    return df.join(cut(df.groupBy(key).agg(F.count("*").alias(name)), "sizes"), key, "left")


def lookup(df: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Left join on a mapping with one row per key; AQE broadcasts it when its
    measured size allows."""
    return df.join(mapping, key, "left")


def attach_scores(managers: DataFrame, scores: DataFrame, key: str = "ein") -> DataFrame:
    """One score row per key: the one with the largest score, if a key has several."""
    best = scores.groupBy(key).agg(F.max(F.struct("pagerank_score", "community_id")).alias("s"))
    return managers.join(best.select(key, "s.pagerank_score", "s.community_id"), key, "left")


def assemble_features(funds: DataFrame, *parts: DataFrame, key: str = "ein") -> DataFrame:
    """Left join the per-fund tables; all sides hash on the same key, so each is
    shuffled once and the fund side is not shuffled again between joins."""
    return reduce(lambda left, right: left.join(right, key, "left"), parts, funds)


def valid_edges(
    edges: DataFrame,
    src_nodes: DataFrame,
    dst_nodes: DataFrame,
    src: str = "fund_ein",
    dst: str = "manager_ein",
    key: str = "ein",
) -> DataFrame:
    """Edges whose two ends exist."""
    a = src_nodes.select(F.col(key).alias(src))
    b = dst_nodes.select(F.col(key).alias(dst))
    return edges.join(a, src, "left_semi").join(b, dst, "left_semi").select(*edges.columns)


def swap(edges: DataFrame, a: str = "src", b: str = "dst") -> DataFrame:
    """Exchange the values of two columns."""
    names = {a: b, b: a}
    return edges.select(*[F.col(names.get(c, c)).alias(c) for c in edges.columns])


def to_undirected(edges: DataFrame, src: str = "src", dst: str = "dst", rel: str | None = None) -> DataFrame:
    """Both directions of every edge; ``rel`` adds a column naming the direction."""
    back = swap(edges, src, dst)
    if rel:
        edges = edges.withColumn(rel, F.lit("forward"))
        back = back.withColumn(rel, F.lit("reverse"))
    return edges.unionByName(back)
