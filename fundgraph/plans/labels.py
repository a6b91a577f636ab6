"""Fund features and risk labels from the graph tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import fund_profile
from ..operators.ranking import pct_rank_avg
from ..operators.relational import assemble_features
from ..operators.risk import fill_features, risk_labels
from ..session import cut


def labelled_funds(
    funds: DataFrame, edges: DataFrame, managers: DataFrame, fund_scores: DataFrame | None = None
) -> DataFrame:
    """One row per fund with features, score and label.

    ``managers``: manager_ein, community_id, same_parent_flag.
    ``fund_scores``: ein plus betweenness_score / in_circular_pattern, when known.
    The fee percentile needs all totals, so the profile is written once and then
    read by both the ranking and the assembly instead of being computed twice.
    """
    profile = cut(fund_profile(edges, managers), "profile")
    ranked = pct_rank_avg(profile, "total_fees", "fee_percentile", stored=True)
    base = funds.select("ein", "plan_name", "fund_type", "num_participants")
    parts = [ranked.drop("manager_community_count")]
    if fund_scores is None:
        extra = {"betweenness_score": F.lit(0.0), "in_circular_pattern": F.lit(0)}
        out = assemble_features(base, *parts).withColumns(extra)
    else:
        parts.append(fund_scores.select("ein", "betweenness_score", "in_circular_pattern"))
        out = assemble_features(base, *parts)
    return risk_labels(fill_features(out))
