"""Feature tables, scaling, splits and neighbour averages for the fund classifier."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clip, to_num
from ..session import cut, held
from .ranking import running_before
from .relational import attach_scores

# Model inputs of the two node types.
FUND_FEATURES = (
    "num_managers", "top_manager_concentration", "fee_percentile", "total_shared_managers",
    "community_concentration", "same_parent_fee_ratio", "betweenness_score", "in_circular_pattern",
)
MANAGER_FEATURES = ("num_clients", "total_fees", "same_parent_flag", "group_size", "pagerank_score")

#: PageRank of a manager without a score: 1 - damping.
DEFAULT_PAGERANK = 0.15


def fund_features(labelled: DataFrame, keep: Sequence[str] = ("ein", "label")) -> DataFrame:
    x = {c: to_num(c, 0) for c in FUND_FEATURES}
    for c in ("total_shared_managers", "betweenness_score"):
        x[c] = clip(x[c], 0, 1e6)
    return labelled.select(*keep, *[v.alias(c) for c, v in x.items()])


def manager_features(managers: DataFrame, scores: DataFrame, keep: Sequence[str] = ("ein",)) -> DataFrame:
    """Scores are joined on the EIN; a manager without a PageRank gets the base value."""
    m = attach_scores(managers.drop("pagerank_score", "community_id"), scores)
    defaults = {c: 0 for c in MANAGER_FEATURES} | {"pagerank_score": DEFAULT_PAGERANK}
    return m.select(*keep, *[to_num(c, v).alias(c) for c, v in defaults.items()])


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """z-scores with the population deviation; a constant column becomes 0.

    Two numbers per column come back to the driver and enter the plan as literals.
    The rows are read for them and again for the result, so they are written first.
    """
    df = cut(df, "features")
    stats = df.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in cols]).first()
    z = {}
    for c in cols:
        mean, std = stats[c]["mean"] or 0.0, stats[c]["std"] or 1.0
        z[c] = (F.col(c) - F.lit(mean)) / F.lit(std)
    return df.withColumns(z)


def stratified_split(
    df: DataFrame, key: str = "ein", label: str = "label", test: float = 0.2, val: float = 0.15, seed: int = 42
) -> DataFrame:
    """Add ``split``: the same share of every class goes to test, then validation.

    Rows are ordered by a seeded hash within their class and cut at exact
    counts; the order comes from the range-partitioned ranks, so a class of any
    size is never in one task.
    """
    hashed = df.select(key, label, F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}"))).alias("_h"))
    ranked = running_before(hashed, ["_h", key], None, [label])
    n = hashed.groupBy(label).agg(F.count("*").alias("_n"))
    n = n.withColumn("_test", F.round(F.col("_n") * test)).withColumn("_val", F.round((F.col("_n") - F.col("_test")) * val))
    part = (
        F.when(F.col("before") < F.col("_test"), "test")
        .when(F.col("before") < F.col("_test") + F.col("_val"), "val")
        .otherwise("train")
    )
    return df.join(ranked.join(n, label).select(key, part.alias("split")), key)


def propagate(funds: DataFrame, managers: DataFrame, edges: DataFrame, k: int) -> DataFrame:
    """Fund rows with their own columns and k hops of neighbour means.

    funds: ein + numeric columns; managers: ein (one row each) + numeric columns;
    edges: fund_ein, manager_ein, repeated pairs counting repeatedly.  Hop i of
    a node is the mean of its neighbours' hop i-1; a node without neighbours gets
    0.  Columns of hop i are named <column>_h<i>.
    """
    # every hop reads these again
    funds, managers = cut(funds, "fund_x"), cut(managers, "manager_x")
    links = edges.groupBy("fund_ein", "manager_ein").agg(F.count("*").alias("n"))
    links = cut(
        links.join(funds.select(F.col("ein").alias("fund_ein")), "fund_ein", "left_semi").join(
            managers.select(F.col("ein").alias("manager_ein")), "manager_ein", "left_semi"
        ),
        "links",
    )

    by = {c: held(links, c) for c in ("fund_ein", "manager_ein")}

    def mean_of(x: DataFrame, at: str, to: str, cols: list[str], names: list[str]) -> DataFrame:
        sent = by[at].join(x.withColumnRenamed("ein", at), at)
        sums = [(F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(o) for c, o in zip(cols, names)]
        return cut(sent.groupBy(F.col(to).alias("ein")).agg(*sums), "hop")

    fund_hop, manager_hop = funds, managers
    fc, mc = [c for c in funds.columns if c != "ein"], [c for c in managers.columns if c != "ein"]
    base_f, base_m = list(fc), list(mc)
    hops = []
    for i in range(1, k + 1):
        # at every hop the two sides swap their columns
        nf = [f"{c}_h{i}" for c in (base_m if i % 2 else base_f)]
        nm = [f"{c}_h{i}" for c in (base_f if i % 2 else base_m)]
        new_f = mean_of(manager_hop.select("ein", *mc), "manager_ein", "fund_ein", mc, nf)
        if i < k:
            manager_hop = mean_of(fund_hop.select("ein", *fc), "fund_ein", "manager_ein", fc, nm)
        fund_hop, fc, mc = new_f, nf, nm
        hops.append(new_f)
    for x in by.values():
        x.unpersist()
    out = reduce(lambda a, b: a.join(b, "ein", "left"), hops, funds)
    return out.fillna(0.0, subset=[c for h in hops for c in h.columns if c != "ein"])


def hop_columns(columns: Sequence[str], k: int) -> list[str]:
    """Own columns and those of hops up to k, out of a propagated table."""
    return [c for c in columns if "_h" not in c or int(c.rsplit("_h", 1)[1]) <= k]


def structure_columns(funds: DataFrame, managers: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Constant and degree only: what is left of a node without its own features."""

    def degree(nodes: DataFrame, key: str) -> DataFrame:
        d = edges.groupBy(F.col(key).alias("ein")).agg(F.count("*").cast("double").alias("degree"))
        return nodes.select("ein").join(d, "ein", "left").select("ein", F.lit(1.0).alias("one"), F.coalesce("degree", F.lit(0.0)).alias("degree"))

    return degree(funds, "fund_ein"), degree(managers, "manager_ein")


def shared_space(funds: DataFrame, managers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both node types in one padded column space, so propagation cannot tell them apart."""
    fc, mc = [c for c in funds.columns if c != "ein"], [c for c in managers.columns if c != "ein"]

    def pad(df: DataFrame, own: list[str], tag: str) -> list:
        return [(F.col(c) if c in own else F.lit(0.0)).alias(f"{tag}{c}") for c in (fc if tag == "f_" else mc)]

    f = funds.select("ein", *pad(funds, fc, "f_"), *[F.lit(0.0).alias(f"m_{c}") for c in mc])
    m = managers.select("ein", *[F.lit(0.0).alias(f"f_{c}") for c in fc], *pad(managers, mc, "m_"))
    return f, m
