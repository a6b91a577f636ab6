"""Aggregates over payments, graph tables and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import fee_sum, guarded_ratio
from ..session import cut
from .ranking import quantiles


def manager_nodes(lines: DataFrame) -> DataFrame:
    """Per (ein, name): fee total (0 when every fee is null) and number of non-null fees."""
    return lines.groupBy("ein", "name").agg(
        fee_sum("fee_paid").alias("total_fees"), F.count("fee_paid").alias("num_clients")
    )


def fund_manager_fees(edges: DataFrame) -> DataFrame:
    """One row per (fund, manager) with its fee total; every later per-fund aggregate
    starts from this table, which is already combined before its shuffle."""
    return edges.groupBy("fund_ein", "manager_ein").agg(fee_sum("fee_paid").alias("fee_paid"))


def num_managers(edges: DataFrame, approximate: bool = False) -> DataFrame:
    how = F.approx_count_distinct if approximate else F.count_distinct
    return edges.groupBy(F.col("fund_ein").alias("ein")).agg(how("manager_ein").alias("num_managers"))


def manager_sketches(edges: DataFrame, *parts: str, lg: int = 12) -> DataFrame:
    """Per fund and part (a year, a batch): a sketch of its distinct managers, a few kB however many there are.

    Sketches of new parts are stored beside the old ones; :func:`merged_num_managers` unites them
    without the payments they come from.  Their relative error is about 1 / sqrt(2 ** lg).
    Null managers are not counted, as by an exact count.
    """
    sketch = F.hll_sketch_agg("manager_ein", lg).alias("managers")
    return edges.groupBy(F.col("fund_ein").alias("ein"), *parts).agg(sketch)


def merged_num_managers(sketches: DataFrame) -> DataFrame:
    """Estimated number of distinct managers of each fund over all parts stored for it."""
    return sketches.groupBy("ein").agg(F.hll_sketch_estimate(F.hll_union_agg("managers")).alias("num_managers_estimate"))


def per_fund(fees: DataFrame) -> DataFrame:
    """num_managers, total_fees and top_manager_concentration from one row per (fund, manager), in one group-by:
    over a table in buckets of fund_ein without an exchange."""
    out = fees.groupBy(F.col("fund_ein").alias("ein")).agg(
        F.count("manager_ein").alias("num_managers"), fee_sum("fee_paid").alias("total_fees"),
        F.max("fee_paid").alias("_top"), F.sum("fee_paid").alias("_total"),
    )
    return out.withColumn("top_manager_concentration", guarded_ratio("_top", "_total")).drop("_top", "_total")


def total_fees(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("fund_ein").alias("ein")).agg(fee_sum("fee_paid").alias("total_fees"))


def top_manager_concentration(edges: DataFrame) -> DataFrame:
    """Largest per-manager fee total over the fund's total, limited to [0,1]; null for 0/0."""
    per_fund = fund_manager_fees(edges).groupBy(F.col("fund_ein").alias("ein")).agg(
        F.max("fee_paid").alias("_top"), F.sum("fee_paid").alias("_total")
    )
    return per_fund.select("ein", guarded_ratio("_top", "_total").alias("top_manager_concentration"))


def total_shared_managers(ff: DataFrame, mode: str = "sum") -> DataFrame:
    """Per fund: sum of its shared-manager counts.

    ``mode='concat'`` joins the counts as text in partner order and reads the
    result as a number, 0 beyond the double range.  Counts of 0 before the first
    other one only lead with zeros.  From there on a plain sum of lengths gives the
    digits of the number: above 309 it is beyond the double range, and only texts
    of at most that many digits are collected.
    """
    if mode == "sum":
        return ff.groupBy(F.col("fund_a").alias("ein")).agg(F.sum("shared_managers").alias("total_shared_managers"))
    counts = ff.select("fund_a", "fund_b", F.col("shared_managers").cast("string").alias("s"), (F.col("shared_managers") != 0).alias("some"))
    # the counts are made anew each time they are read. One reading gives the first other count, the digits of all of them, and the
    # zeros: only where zeros decide, those behind the first are counted. Stored, so that the joins are plain ones and a fund with
    # very many partners is split
    some = F.col("some")
    lead = cut(
        counts.groupBy("fund_a").agg(
            F.min(F.when(some, F.col("fund_b"))).alias("lead"), F.sum(F.when(some, F.length("s")).otherwise(0)).alias("n"), F.count(F.when(~some, 1)).alias("zeros")
        ),
        "lead",
    )
    small = lead.filter(F.col("n") + F.col("zeros") <= 309).select("fund_a", "lead")
    unsure = lead.filter("n between 1 and 309 and n + zeros > 309").select("fund_a", "lead")
    if not unsure.isEmpty():
        behind = counts.join(unsure, "fund_a").filter("fund_b >= lead")
        small = small.union(cut(behind.groupBy("fund_a", "lead").agg(F.sum(F.length("s")).alias("n")).filter(F.col("n") <= 309).drop("n"), "lead"))
    parts = F.array_sort(F.collect_list(F.struct("fund_b", "s")))
    text = F.array_join(F.transform(parts, lambda x: x["s"]), "")
    value = text.try_cast("double")
    ok = F.when(~F.isnan(value) & (value < float("inf")), value)
    texts = counts.join(small, "fund_a").filter("fund_b >= lead").groupBy("fund_a").agg(ok.alias("value"))
    return lead.join(texts, "fund_a", "left").select(F.col("fund_a").alias("ein"), F.coalesce("value", F.lit(0.0)).alias("total_shared_managers"))


def community_concentration(fm: DataFrame, community: DataFrame) -> DataFrame:
    """1 / number of distinct communities of a fund's managers; 1.0 when none is known.

    ``community``: manager_ein, community_id.
    """
    pairs = fm.select("fund_ein", "manager_ein").distinct().join(community.select("manager_ein", "community_id"), "manager_ein", "left")
    # count per (fund, community) first: the distinct count is then a plain count
    per = pairs.groupBy("fund_ein", "community_id").agg(F.count("*").alias("_m"))
    out = per.groupBy(F.col("fund_ein").alias("ein")).agg(
        F.sum("_m").alias("total_managers"), F.count("community_id").alias("manager_community_count")
    )
    return out.withColumn("community_concentration", concentration("manager_community_count"))


def concentration(count: str) -> Column:
    return F.coalesce(F.try_divide(F.lit(1.0), F.col(count).cast("double")), F.lit(1.0))


def same_parent_fee_ratio(fm: DataFrame, managers: DataFrame) -> DataFrame:
    """Share of a fund's fees that goes to managers flagged as part of a parent group.

    ``managers``: manager_ein, same_parent_flag (null counts as 0).
    """
    flags = managers.select("manager_ein", "same_parent_flag")
    per = fund_manager_fees(fm).join(flags, "manager_ein", "left").groupBy(F.col("fund_ein").alias("ein")).agg(
        F.sum("fee_paid").alias("total_fees"),
        F.sum(F.when(F.col("same_parent_flag") == 1, F.col("fee_paid")).otherwise(0)).alias("_same"),
    )
    ratio = F.when(F.col("total_fees") == 0, F.lit(0.0)).otherwise(
        F.try_divide(F.col("_same").cast("double"), F.col("total_fees").cast("double"))
    )
    return per.select("ein", "total_fees", ratio.alias("same_parent_fee_ratio"))


def fund_profile(fm_edges: DataFrame, managers: DataFrame) -> DataFrame:
    """All per-fund payment features in one pass over the edges.

    ``managers``: manager_ein, community_id, same_parent_flag.  The edges are
    combined once to (fund, manager) and that smaller table is written, as it is
    read twice: for the clients per manager and for the join with them.  Without
    the write both reads would scan and join the payment lines again.
    """
    fees = cut(fund_manager_fees(fm_edges), "fees")
    clients = fees.groupBy("manager_ein").agg(F.count("*").alias("_clients"))
    # stored: the join with a manager of very many funds is a plain one, which the engine splits
    per_manager = cut(clients.join(managers, "manager_ein", "left"), "clients")
    wide = fees.join(per_manager, "manager_ein")
    by_community = wide.groupBy("fund_ein", "community_id").agg(
        F.count("*").alias("_m"),
        F.sum("fee_paid").alias("_fees"),
        F.max("fee_paid").alias("_top"),
        F.sum(F.col("_clients") - 1).alias("_shared"),
        F.sum(F.when(F.col("same_parent_flag") == 1, F.col("fee_paid")).otherwise(0)).alias("_same"),
    )
    per_fund = by_community.groupBy(F.col("fund_ein").alias("ein")).agg(
        F.sum("_m").alias("num_managers"),
        F.sum("_fees").alias("total_fees"),
        F.max("_top").alias("_top"),
        F.sum("_shared").alias("total_shared_managers"),
        F.count("community_id").alias("manager_community_count"),
        F.sum("_same").alias("_same"),
    )
    same = F.when(F.col("total_fees") == 0, F.lit(0.0)).otherwise(
        F.try_divide(F.col("_same").cast("double"), F.col("total_fees").cast("double"))
    )
    return per_fund.select(
        "ein", "num_managers", "total_fees",
        guarded_ratio("_top", "total_fees").alias("top_manager_concentration"),
        "total_shared_managers", "manager_community_count",
        concentration("manager_community_count").alias("community_concentration"),
        same.alias("same_parent_fee_ratio"),
    )


def component_sizes(df: DataFrame, key: str = "component") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("size")).filter("size > 1")


def group_sizes(df: DataFrame, key: str = "parent_group_id", ein: str = "ein") -> DataFrame:
    """Rows and distinct EINs per group (count per (group, EIN) first)."""
    per = df.groupBy(key, ein).agg(F.count("*").alias("_n"))
    return per.groupBy(key).agg(F.sum("_n").alias("group_size"), F.count(ein).alias("distinct_eins"))


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows") for n, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def label_counts(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("label").agg(F.count("*").alias("count"))


def group_summary(managers: DataFrame) -> DataFrame:
    return managers.agg(
        F.sum("same_parent_flag").alias("flagged"), F.count_distinct("parent_group_id").alias("groups")
    )


def value_counts(df: DataFrame, col: str, by_value: bool = False) -> DataFrame:
    counts = df.groupBy(col).agg(F.count("*").alias("count"))
    return counts.orderBy(col) if by_value else counts.orderBy(F.desc("count"), col)


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    y = F.col(label).cast("double")
    return df.agg(
        F.sum(label).alias("positive"),
        F.count(F.when(F.col(label) == 0, 1)).alias("negative"),
        (F.avg(y) * 100).alias("positive_pct"),
        F.avg(y).alias("balance"),
    )


REPORT_FEATURES = (
    "num_managers", "top_manager_concentration", "total_shared_managers",
    "community_concentration", "same_parent_fee_ratio", "betweenness_score",
)


def feature_means_by_label(df: DataFrame, cols: Sequence[str] = REPORT_FEATURES, digits: int = 3) -> DataFrame:
    return df.groupBy("label").agg(*[F.round(F.avg(c), digits).alias(c) for c in cols])


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles, maximum; one row per column."""
    df = cut(df.select(*cols), "describe")
    x = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols]))
    long = df.select(x.alias("x")).select("x.*").filter("v is not null and not isnan(v)")
    base = long.groupBy("column").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"),
    )
    q = quantiles(df, cols)
    return base.join(q, "column").select(
        "column", "count", "mean", "std", "min",
        F.get("quantiles", F.lit(0)).alias("p25"), F.get("quantiles", F.lit(1)).alias("p50"),
        F.get("quantiles", F.lit(2)).alias("p75"), "max",
    )


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Inverse-frequency weight N / n_c; one row per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("count"))
    # one row per class, so the window holds a handful of rows
    total = F.sum("count").over(Window.partitionBy(F.lit(1)))
    return counts.select(label, "count", (total / F.col("count")).alias("weight"))


