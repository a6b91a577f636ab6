"""Ranks, running totals and exact quantiles over a whole table.

A window without a partition would move all rows to one task.  Here the values
are first counted and range-partitioned; each range is ordered on its own and
shifted by the small table of range totals.  Where the ranges are cut has no
influence on the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def running_before(
    counts: DataFrame, order_by: Sequence[str], n: str | None = "n", within: Sequence[str] = ()
) -> DataFrame:
    """Add ``before``: rows that sort ahead of each key, within its group.

    ``counts`` holds one row per distinct non-null key with ``n`` rows behind it
    (``None``: one each).  The range number is written with the rows, so both
    reads below see the same ranges.
    """
    keys = [*within, *order_by]
    weight = F.col(n) if n else F.lit(1)
    ranged = cut(counts.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("before", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    # one row per shuffle partition: one ordered task and a broadcast are safe
    totals = ranged.groupBy("_range").agg(F.sum(weight).alias("_t"))
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.coalesce(F.sum("_t").over(ahead), F.lit(0)).alias("_o"))
    local = local.join(F.broadcast(offsets), "_range").withColumn("before", F.col("before") + F.col("_o")).drop("_o", "_range")
    if within:
        first = local.groupBy(*within).agg(F.min("before").alias("_first"))
        local = local.join(first, list(within)).withColumn("before", F.col("before") - F.col("_first")).drop("_first")
    return local.withColumn("before", F.col("before").cast("bigint"))


def average_ranks(df: DataFrame, col: str, within: Sequence[str] = ()) -> DataFrame:
    """Per distinct value: rows holding it and their average 1-based rank."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(*within, col).agg(F.count("*").alias("n"))
    ranked = running_before(counts, [col], "n", within)
    return ranked.withColumn("avg_rank", F.col("before") + (F.col("n") + 1) / 2)


def pct_rank_avg(
    df: DataFrame, col: str, out: str = "pct_rank", partition: str | None = None, stored: bool = False
) -> DataFrame:
    """Percentile rank with ties averaged; null has no rank and is not counted.

    The input is read for the counts and again for the result, so it is written
    first unless it is ``stored`` already.
    """
    df = df if stored else cut(df, "ranked")
    within = [partition] if partition else []
    ranks = average_ranks(df, col, within)
    if partition:
        totals = ranks.groupBy(partition).agg(F.sum("n").alias("_total"))
        ranks = ranks.join(totals, partition)
    else:
        total = ranks.agg(F.sum("n")).first()[0] or 1
        ranks = ranks.withColumn("_total", F.lit(total))
    pct = ranks.select(*within, col, (F.col("avg_rank") / F.col("_total")).alias(out))
    return df.join(pct, [*within, col], "left")


def dense_index(df: DataFrame, order_by: Sequence[str], out: str = "idx") -> DataFrame:
    """0-based position of each row; ``order_by`` must be unique and non-null."""
    return running_before(df, list(order_by), None).withColumnRenamed("before", out)


def quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Exact linearly interpolated quantiles: one row per column, one array in ``qs`` order.

    The two rows around each position are found by running counts, so no task
    holds all values of a column.
    """
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])).alias("x")).select("x.*").filter("value is not null and not isnan(value)")
    counts = long.groupBy("column", "value").agg(F.count("*").alias("n"))
    ranked = running_before(counts, ["value"], "n", ["column"])
    totals = ranked.groupBy("column").agg(F.sum("n").alias("total"))
    want = totals.select("column", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(float(q)) * (F.col("total") - 1)).alias("pos")) for i, q in enumerate(qs)])).alias("w")).select("column", "w.*")
    covers = (F.col("pos") > F.col("before") - 1) & (F.col("pos") < F.col("before") + F.col("n"))
    near = ranked.join(F.broadcast(want), "column").filter(covers)
    # a value touches [pos_floor, pos_ceil]; weight it by its share of the two
    lo, hi = F.floor("pos"), F.ceil("pos")
    has = lambda p: (p >= F.col("before")) & (p < F.col("before") + F.col("n"))
    part = near.select(
        "column", "i", "pos",
        F.when(has(lo), F.col("value")).alias("lo"),
        F.when(has(hi), F.col("value")).alias("hi"),
    )
    found = part.groupBy("column", "i", "pos").agg(F.max("lo").alias("lo"), F.max("hi").alias("hi"))
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("pos") - F.floor("pos"))
    # one entry per requested quantile: the group is as long as ``qs``
    return found.select("column", "i", value.alias("v")).groupBy("column").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("quantiles")
    )
