"""Rule-based risk score and label of a fund."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clip
from .relational import fill_defaults


class Rule(NamedTuple):
    column: str
    op: str
    limit: float
    points: int


# Signals, limits and points.
DEFAULT_RULES = (
    Rule("top_manager_concentration", ">", 0.70, 2),
    Rule("num_managers", "<=", 2, 1),
    Rule("total_shared_managers", ">", 10, 1),
    Rule("fee_percentile", ">", 0.90, 1),
    Rule("community_concentration", ">=", 0.80, 1),
    Rule("same_parent_fee_ratio", ">", 0.50, 2),
)

#: A fund is risky from this score on.
RISKY_FROM = 4

# Defaults of features a fund has no data for.
FEATURE_DEFAULTS = {
    "num_managers": 0, "total_fees": 0, "top_manager_concentration": 0.0, "fee_percentile": 0.5,
    "total_shared_managers": 0, "betweenness_score": 0.0, "community_concentration": 1.0,
    "same_parent_fee_ratio": 0.0, "in_circular_pattern": 0,
}

_OPS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}


def fill_features(df: DataFrame) -> DataFrame:
    """Limit the parent ratio to [0,1], then put each feature's default for missing values."""
    if "same_parent_fee_ratio" in df.columns:
        df = df.withColumn("same_parent_fee_ratio", clip("same_parent_fee_ratio", 0, 1))
    return fill_defaults(df, {c: v for c, v in FEATURE_DEFAULTS.items() if c in df.columns})


def signal(rule: Rule) -> Column:
    return F.when(_OPS[rule.op](F.col(rule.column), F.lit(rule.limit)), F.lit(rule.points)).otherwise(F.lit(0))


def risk_labels(
    features: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES, risky_from: int = RISKY_FROM
) -> DataFrame:
    """Add has_manager_data, risk_score and label (-1 no data, 0 risky, 1 healthy)."""
    has = (F.col("num_managers") > 0).cast("int")
    score = reduce(operator.add, [signal(r) for r in rules], F.lit(0))
    return (
        features.withColumn("has_manager_data", has)
        .withColumn("risk_score", F.when(F.col("has_manager_data") == 1, score).otherwise(0))
        .withColumn(
            "label",
            F.when(F.col("has_manager_data") == 0, F.lit(-1))
            .when(F.col("risk_score") >= risky_from, F.lit(0))
            .otherwise(F.lit(1)),
        )
    )


def training_rows(labelled: DataFrame) -> DataFrame:
    return labelled.filter(F.col("label") != -1)
