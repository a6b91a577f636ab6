"""Raw filings and provider lines to node and edge tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import computed, map_code, norm_name, normalize_ein, null_markers
from ..operators.aggregates import manager_nodes
from ..operators.pairs import fund_fund_edges
from ..operators.relational import (
    attach_fund, drop_self_loops, keep_first, rename_cols, require, select_filing_cols,
)
from ..schema import FUND_COLUMNS, LINE_COLUMNS


class GraphTables(NamedTuple):
    funds: DataFrame
    managers: DataFrame
    fund_manager: DataFrame
    fund_fund: DataFrame


def fund_nodes(filings: DataFrame, order_by: str = "ack_id") -> DataFrame:
    """One fund per sponsor EIN: its first filing."""
    f = rename_cols(null_markers(select_filing_cols(filings)), FUND_COLUMNS)
    f = require(computed(f, {"ein": normalize_ein("ein")}), ["ein"])
    f = f.withColumn("fund_type", map_code("fund_type_code")).withColumn("label", F.lit(-1))
    return keep_first(f, "ein", order_by)


def payments(lines: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Named payment lines with cleaned provider EIN and name."""
    p = rename_cols(null_markers(lines.select(*LINE_COLUMNS, *[c for c in extra if c not in LINE_COLUMNS])), LINE_COLUMNS)
    return require(computed(p, {"ein": normalize_ein("ein"), "name": norm_name("name")}), ["name", "ein"])


def fund_manager_edges(lines: DataFrame, filings: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per payment line between two known, different parties."""
    # EINs are cleaned before the join: once per filing, not once per matched line
    f = null_markers(filings.select("ACK_ID", "SPONS_DFE_EIN"))
    f = require(computed(f, {"SPONS_DFE_EIN": normalize_ein("SPONS_DFE_EIN")}), ["SPONS_DFE_EIN"])
    named = computed(null_markers(lines), {"manager_ein": normalize_ein("PROVIDER_OTHER_EIN")})
    # a line without a fund would be dropped again, and this filter makes the left join an inner one
    joined = require(attach_fund(require(named, ["manager_ein"]), f), ["SPONS_DFE_EIN"])
    return drop_self_loops(
        joined.select(
            F.col("SPONS_DFE_EIN").alias("fund_ein"),
            "manager_ein",
            F.col("PROVIDER_OTHER_NAME").alias("manager_name"),
            F.col("PROVIDER_OTHER_DIRECT_COMP_AMT").alias("fee_paid"),
            *extra,
        )
    )


def ingest(filings: DataFrame, lines: DataFrame) -> GraphTables:
    edges = fund_manager_edges(lines, filings)
    return GraphTables(fund_nodes(filings), manager_nodes(payments(lines)), edges, fund_fund_edges(edges))
