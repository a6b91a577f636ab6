"""Property graph: building, projecting and reading it.

nodes: id, label, properties.   edges: src, dst, type, weight.
An id is the label joined with the EIN, as one EIN may be both a fund and a manager.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import number, to_int
from ..session import cut
from .ranking import dense_index
from .relational import keep_last, swap, to_undirected, valid_edges

FUND, MANAGER = "PensionFund", "AssetManager"
ALLOCATED, SHARES = "ALLOCATED_TO", "SHARES_MANAGER_WITH"

#: Edges of one node that a single join key may hold in the iterative operators.
HUB_ROWS = 500_000


class Graph(NamedTuple):
    nodes: DataFrame
    edges: DataFrame


def node_id(label: str, ein: Column | str) -> Column:
    return F.concat(F.lit(f"{label}:"), F.col(ein) if isinstance(ein, str) else ein)


def build_graph(
    funds: DataFrame,
    managers: DataFrame,
    fund_manager: DataFrame,
    fund_fund: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
    edge_order: Sequence[str] = ("fee_paid",),
    fees: str = "last",
) -> Graph:
    """Load nodes and edges with upsert semantics: one node per label and EIN, one
    edge per pair, the last row winning; edges need both ends.

    ``fees='sum'`` keeps the total of a pair's lines instead of the last one.
    ``fund_fund`` holds both directions; one canonical row per pair is stored.  It may
    be a function: given the payments of loaded funds, it makes the canonical rows, which
    are then edges between loaded funds without being looked up again.
    """
    f = keep_last(funds, "ein", "ack_id")
    m = keep_last(managers, "ein", "name")
    fund_nodes = f.select(
        node_id(FUND, "ein").alias("id"), F.lit(FUND).alias("label"), "ein", F.col("plan_name").alias("name"),
        "sponsor_name", "fund_type", to_int("num_participants").alias("num_participants"),
        "admin_name", "state",
    )
    manager_nodes = m.select(
        node_id(MANAGER, "ein").alias("id"), F.lit(MANAGER).alias("label"), "ein", "name",
        number("total_fees").alias("total_fees"),
        to_int("num_clients").alias("num_clients"),
    )
    # the loaded nodes are a stored table: edges and every algorithm read them again
    nodes = cut(fund_nodes.unionByName(manager_nodes, allowMissingColumns=True), "nodes")
    f, m = (nodes.filter(F.col("label") == x).select("ein") for x in (FUND, MANAGER))
    valid = valid_edges(fund_manager, f, m)
    if fees == "sum":
        paid = valid.groupBy("fund_ein", "manager_ein").agg(F.sum("fee_paid").alias("fee_paid"))
    else:
        paid = keep_last(valid, ["fund_ein", "manager_ein"], list(edge_order))
    rows = [
        paid.select(
            node_id(FUND, "fund_ein").alias("src"), node_id(MANAGER, "manager_ein").alias("dst"),
            F.lit(ALLOCATED).alias("type"), F.col("fee_paid").cast("double").alias("weight"),
        )
    ]
    if fund_fund is not None:
        if callable(fund_fund):
            ff = fund_fund(fund_manager.join(f.withColumnRenamed("ein", "fund_ein"), "fund_ein", "left_semi"))
        else:
            ff = valid_edges(fund_fund.filter("fund_a < fund_b"), f, f, "fund_a", "fund_b")
        rows.append(
            ff.select(
                node_id(FUND, "fund_a").alias("src"), node_id(FUND, "fund_b").alias("dst"),
                F.lit(SHARES).alias("type"), F.col("shared_managers").cast("double").alias("weight"),
            )
        )
    return Graph(nodes, cut(reduce(DataFrame.unionByName, rows), "edges"))


def project(g: Graph, labels: Sequence[str], rels: dict[str, str]) -> Graph:
    """Nodes of the labels and edges of the types, each NATURAL, REVERSE or UNDIRECTED."""
    parts = []
    for rel, orientation in rels.items():
        e = g.edges.filter(F.col("type") == rel)
        if orientation == "REVERSE":
            parts.append(swap(e))
        elif orientation == "UNDIRECTED":
            parts.append(to_undirected(e))
        else:
            parts.append(e)
    return induced(Graph(g.nodes, reduce(DataFrame.unionByName, parts)), labels)


def induced(g: Graph, labels: Sequence[str], types: Sequence[str] | None = None) -> Graph:
    """Sub-graph of some labels and types; edges keep only if both ends remain."""
    nodes = g.nodes.filter(F.col("label").isin(*labels))
    edges = g.edges if types is None else g.edges.filter(F.col("type").isin(*types))
    return Graph(nodes, valid_edges(edges, nodes, nodes, "src", "dst", "id"))


def expand(g: Graph, src_label: str, rel: str, dst_label: str) -> DataFrame:
    """(src)-[rel]->(dst) rows with both nodes' EINs."""
    a = g.nodes.filter(F.col("label") == src_label).select(F.col("id").alias("src"), F.col("ein").alias("src_ein"))
    b = g.nodes.filter(F.col("label") == dst_label).select(F.col("id").alias("dst"), F.col("ein").alias("dst_ein"))
    return g.edges.filter(F.col("type") == rel).join(a, "src").join(b, "dst")


def with_property(nodes: DataFrame, metric: DataFrame, key: str = "id") -> DataFrame:
    """Write a metric back as node columns; nodes without a value get null."""
    return nodes.join(metric, key, "left")


def fund_scores(nodes: DataFrame) -> DataFrame:
    """Score columns of the fund nodes; a score that was not computed is null."""
    return _export(nodes, FUND, {
        "ein": "string", "community_id": "string", "betweenness_score": "double", "total_managers": "bigint",
        "manager_community_count": "bigint", "community_concentration": "double", "total_fees": "double",
        "same_parent_fee_ratio": "double", "in_circular_pattern": "int",
    })


def manager_scores(nodes: DataFrame) -> DataFrame:
    return _export(nodes, MANAGER, {
        "ein": "string", "name": "string", "pagerank_score": "double", "num_clients": "bigint", "total_fees": "double",
        "same_parent_flag": "int", "parent_group_id": "bigint", "group_size": "bigint", "community_id": "string",
    })


def first_fund_scores(nodes: DataFrame) -> DataFrame:
    """What the first of the two metric runs exports of the funds."""
    return _export(nodes, FUND, {"ein": "string", "community_id": "string", "scc_id": "string", "in_circular_pattern": "int"})


def first_manager_scores(nodes: DataFrame) -> DataFrame:
    """What the first of the two metric runs exports of the managers."""
    return _export(nodes, MANAGER, {
        "ein": "string", "name": "string", "pagerank_score": "double", "betweenness_score": "double",
        "community_id": "string", "same_parent_flag": "int", "parent_group_id": "bigint",
    })


def _export(nodes: DataFrame, label: str, cols: dict[str, str]) -> DataFrame:
    have = set(nodes.columns)
    return nodes.filter(F.col("label") == label).select(
        *[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in cols.items()]
    )


def encode(nodes: DataFrame | None, edges: DataFrame, *extra: str) -> tuple[DataFrame, DataFrame]:
    """Replace string ids by dense numbers in id order, for the iterative operators.

    Returns (id, n) and the edges with src, dst as numbers: shuffles and joins of
    every round then move 8 bytes instead of a text.
    """
    raw = cut(edges.select("src", "dst", *extra), "raw")
    ids = raw.select(F.col("src").alias("id")).union(raw.select("dst"))
    ids = (ids if nodes is None else ids.union(nodes.select("id"))).distinct()
    names = cut(dense_index(ids, ["id"], "n"), "names")
    a, b = names.select(F.col("id").alias("src"), F.col("n").alias("_s")), names.select(F.col("id").alias("dst"), F.col("n").alias("_d"))
    coded = raw.join(a, "src").join(b, "dst").select(F.col("_s").alias("src"), F.col("_d").alias("dst"), *extra)
    return names, coded


def split_hubs(edges: DataFrame, key: str, other: str, hub_rows: int = HUB_ROWS) -> tuple[DataFrame, DataFrame]:
    """Number the edges of a node with more than ``hub_rows`` edges into several salts.

    Returns the edges with ``salt`` and the table (id, splits) of those nodes
    only.  A state table joined on (id, salt) repeats a hub ``splits`` times: at
    most one extra row per ``hub_rows`` edges, while no join key holds more than
    about ``hub_rows`` of them.
    """
    hubs = (
        edges.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > hub_rows)
        .select(F.col(key).alias("id"), F.ceil(F.col("_n") / hub_rows).cast("int").alias("splits"))
    )
    marked = edges.join(hubs.withColumnRenamed("id", key), key, "left")
    salt = F.when(F.col("splits").isNotNull(), F.pmod(F.xxhash64(other), F.col("splits")).cast("int")).otherwise(0)
    return marked.withColumn("salt", salt).drop("splits"), hubs


def spread(state: DataFrame) -> DataFrame:
    """One row per salt of each node; ``splits`` is null for all but hubs."""
    return state.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("splits", F.lit(1)) - 1)))
