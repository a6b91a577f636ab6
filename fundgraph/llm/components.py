"""Smallest reachable id of every linked node, by alternating star rounds over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fundgraph.session import cut, discard


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (u, v), two longs; others are alone.

    A node's larger neighbours, then its smaller ones, are linked to the smallest
    it sees, until nothing changes; there is no limit on rounds.  Both sides of
    every join are stored tables, so a node with very many links is split by the
    engine's skew handling; all groupings combine before the shuffle.
    """
    e = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    now = _state(e)
    while now[0]:
        seen = now
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.least("u", F.min("v")).alias("low")), "links")
        large = cut(both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct(), "links")
        low2 = cut(large.groupBy("u").agg(F.min("v").alias("low")), "links")
        moved = large.join(low2, "u").filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = cut(moved.union(low2.toDF("u", "v")).distinct(), "links")
        discard(e, low, large, low2)
        e, now = small, _state(small)
        if now == seen:
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.toDF("node", "component").union(roots)
