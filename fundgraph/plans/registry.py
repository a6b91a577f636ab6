"""Registered queries: every operator over the whole tables of a scale folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import names as N
from ..operators import aggregates as A
from ..operators import betweenness as BC
from ..operators import betweenness_blocks as BB
from ..operators import classify as K
from ..operators import components as CC
from ..operators import entity as E
from ..operators import features as FT
from ..operators import graph as G
from ..operators import louvain as LV
from ..operators import merge as MG
from ..operators import metrics as M
from ..operators import pagerank as PR
from ..operators import pairs as P
from ..operators import ranking as W
from ..operators import relational as R
from ..operators import risk as X
from ..operators import similarity as SIM
from ..session import bucketed, cut, scratch_path
from ..sources import star, tables
from ..streaming import incremental as ST
from . import ingest as I
from . import labels as LB
from . import model as MD

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def dbl(*cols: str) -> dict:
    return {c: F.col(c).cast("double") for c in cols}


def rnd(digits: int, *cols: str) -> dict:
    return {c: F.round(F.col(c), digits) for c in cols}


# ---- inputs shared by the queries


def lines_and_filings(spark: SparkSession, d: str, named: bool = False) -> tuple[DataFrame, DataFrame]:
    return star.provider_lines(spark, d, named), star.filings(spark, d)


def edges(spark: SparkSession, d: str, extra: tuple[str, ...] = (), named: bool = False) -> DataFrame:
    return I.fund_manager_edges(*lines_and_filings(spark, d, named), extra)


def funds(spark: SparkSession, d: str) -> DataFrame:
    return I.fund_nodes(star.filings(spark, d))


def managers(spark: SparkSession, d: str) -> DataFrame:
    return A.manager_nodes(I.payments(star.provider_lines(spark, d, named=True)))


def labelled(spark: SparkSession, d: str, e: DataFrame | None = None) -> DataFrame:
    return LB.labelled_funds(funds(spark, d), edges(spark, d) if e is None else e, star.manager_attributes(spark, d))


# ---- flagship


@query
def risk_labels(spark, d):
    out = labelled(spark, d)
    return out.withColumns({**dbl("total_fees"), **rnd(6, "top_manager_concentration", "fee_percentile", "community_concentration", "same_parent_fee_ratio")})


# ---- sources and sinks


def _round_trip(df: DataFrame, reader: Callable, fmt: str = "csv", encoding: str = "UTF-8") -> DataFrame:
    path = scratch_path(df.sparkSession, "file")
    tables.write_table(df, path, fmt, encoding)
    return reader(path)


@query
def read_filings_csv(spark, d):
    return _round_trip(star.filings(spark, d), lambda p: tables.read_filings(spark, p), encoding=tables.RAW)


@query
def read_provider_lines_csv(spark, d):
    out = _round_trip(star.provider_lines(spark, d, named=True), lambda p: tables.read_provider_lines(spark, p), encoding=tables.RAW)
    return out.withColumns(dbl("PROVIDER_OTHER_DIRECT_COMP_AMT"))


@query
def read_strings_csv(spark, d):
    return _round_trip(managers(spark, d), lambda p: tables.read_strings(spark, p))


@query
def read_scores_csv(spark, d):
    e, m = edges(spark, d), star.manager_attributes(spark, d)
    prof = A.fund_profile(e, m).select(
        "ein", F.lit(None).cast("string").alias("community_id"), F.lit(0.0).alias("betweenness_score"),
        F.col("num_managers").alias("total_managers"), "manager_community_count", "community_concentration",
        F.col("total_fees").cast("double").alias("total_fees"), "same_parent_fee_ratio",
        F.lit(0).alias("in_circular_pattern"),
    )
    out = _round_trip(prof, lambda p: tables.read_fund_scores(spark, p))
    return out.withColumns(rnd(6, "community_concentration", "same_parent_fee_ratio"))


@query
def read_manager_scores_csv(spark, d):
    one = R.keep_last(manager_table(spark, d), "ein", "name")
    out = one.join(manager_score_table(spark, d), "ein", "left").select(
        "ein", "name", "pagerank_score", "num_clients", F.col("total_fees").cast("double").alias("total_fees"), "same_parent_flag",
        F.col("ein").cast("bigint").alias("parent_group_id"), "group_size", "community_id",
    )
    return _round_trip(out, lambda p: tables.read_manager_scores(spark, p))


@query
def write_table_parquet(spark, d):
    return _round_trip(funds(spark, d), lambda p: tables.read_table(spark, p, None, "parquet"), "parquet")


@query
def missing_markers(spark, d):
    return C.null_markers(star.filings(spark, d).select("ACK_ID", "ADMIN_NAME"))


# ---- projections, cleaning, filters


@query
def select_and_rename_filings(spark, d):
    return R.rename_cols(R.select_filing_cols(star.filings(spark, d)), I.FUND_COLUMNS)


@query
def rename_by_position(spark, d):
    e = edges(spark, d).groupBy("fund_ein", "manager_ein").agg(F.count("*").alias("n"))
    return R.rename_cols(e, ["payer", "payee", "payments"])


@query
def require_columns(spark, d):
    return R.require(star.filings(spark, d).select("ACK_ID", "SPONS_DFE_EIN"), ["SPONS_DFE_EIN"])


@query
def normalize_eins(spark, d):
    f = star.filings(spark, d)
    return f.select("ACK_ID", C.normalize_ein("SPONS_DFE_EIN").alias("ein"), C.pad_ein(C.normalize_ein("SPONS_DFE_EIN")).alias("ein9"))


@query
def rejected_eins(spark, d):
    return R.rejected_eins(star.filings(spark, d), "SPONS_DFE_EIN")


@query
def map_fund_type(spark, d):
    f = star.filings(spark, d)
    return f.groupBy(C.map_code("TYPE_PLAN_ENTITY_CD").alias("fund_type")).agg(F.count("*").alias("filings"))


@query
def fund_nodes(spark, d):
    return funds(spark, d)


@query
def keep_last_payment(spark, d):
    e = edges(spark, d, ("ACK_ID", "line_no"))
    last = R.keep_last(e, ["fund_ein", "manager_ein"], ["ACK_ID", "line_no", "fee_paid"])
    return last.select("fund_ein", "manager_ein", F.col("fee_paid").cast("double").alias("fee_paid"))


@query
def normalize_names(spark, d):
    li = star.provider_lines(spark, d, named=True)
    return li.groupBy(C.norm_name("PROVIDER_OTHER_NAME").alias("name")).agg(F.count("*").alias("lines"))


@query
def fund_manager_edges(spark, d):
    return edges(spark, d, named=True).withColumns(dbl("fee_paid"))


@query
def distinct_fund_manager_pairs(spark, d):
    return R.distinct_pairs(edges(spark, d))


@query
def number_coercion(spark, d):
    li = star.provider_lines(spark, d, named=True)
    return li.select(
        "ACK_ID", C.as_key("line_no").alias("line_key"),
        C.to_num("PROVIDER_OTHER_EIN", 0).alias("ein_number"),
        C.to_num("PROVIDER_OTHER_NAME", -1).alias("name_number"),
        C.to_num("PROVIDER_OTHER_DIRECT_COMP_AMT", 0).alias("fee"),
    )


@query
def fill_feature_defaults(spark, d):
    f = funds(spark, d).select("ein")
    profile = A.fund_profile(edges(spark, d), star.manager_attributes(spark, d)).drop("manager_community_count")
    out = X.fill_features(R.assemble_features(f, profile))
    return out.withColumns({**dbl("total_fees"), **rnd(6, "top_manager_concentration", "community_concentration", "same_parent_fee_ratio")})


@query
def fill_all_text(spark, d):
    return R.fill_all(star.filings(spark, d).select("ACK_ID", "SPONS_DFE_EIN"), "0")


@query
def clip_values(spark, d):
    li = star.provider_lines(spark, d)
    fee = "PROVIDER_OTHER_DIRECT_COMP_AMT"
    return li.select("ACK_ID", "line_no", C.clip(fee, 0, 1).alias("unit"), C.clip(fee, 0, 1e6).alias("million"))


@query
def cast_properties(spark, d):
    f = star.filings(spark, d).select("ACK_ID", "SPONS_DFE_EIN", "ADMIN_NAME", "ADMIN_EIN")
    return R.cast_props(f, {"SPONS_DFE_EIN": "double", "ADMIN_NAME": "int", "ADMIN_EIN": "bigint"})


@query
def update_managers(spark, d):
    m = managers(spark, d).groupBy("ein").agg(F.count("*").alias("spellings"), F.lit(None).cast("string").alias("community_id"))
    patch = star.manager_attributes(spark, d).withColumnRenamed("manager_ein", "ein")
    return R.update_from(m, patch, "ein")


# ---- joins


@query
def lines_with_fund(spark, d):
    j = R.attach_fund(*lines_and_filings(spark, d))
    return j.select("ACK_ID", "line_no", "PROVIDER_OTHER_EIN", "SPONS_DFE_EIN")


@query
def fund_fund_edges(spark, d):
    return P.fund_fund_edges(edges(spark, d))


@query
def co_client_pairs_per_manager(spark, d):
    return P.co_client_pairs(edges(spark, d)).groupBy("manager_ein").agg(F.count("*").alias("pairs"))


@query
def rows_with_group_size(spark, d):
    return R.with_group_size(managers(spark, d).select("ein", "name"), "ein")


@query
def assemble_fund_features(spark, d):
    # four operators read the payments, which are combined to a row per fund and manager and stored for them
    e = cut(A.fund_manager_fees(edges(spark, d)), "fees")
    f = funds(spark, d).select("ein", "plan_name", "fund_type", "num_participants")
    out = R.assemble_features(f, A.num_managers(e), A.total_fees(e), A.top_manager_concentration(e), P.shared_totals(e))
    return out.withColumns({**dbl("total_fees"), **rnd(6, "top_manager_concentration")})


@query
def assemble_fund_features_stored(spark, d):
    """As assemble_fund_features, from tables stored in buckets of the fund: only the shared totals are shuffled."""
    f = bucketed(funds(spark, d).select("ein", "plan_name", "fund_type", "num_participants"), "ein")
    fees = bucketed(A.fund_manager_fees(edges(spark, d)), "fund_ein")
    out = R.assemble_features(f, A.per_fund(fees), P.shared_totals(fees))
    return out.withColumns({**dbl("total_fees"), **rnd(6, "top_manager_concentration")})


@query
def valid_graph_edges(spark, d):
    m = managers(spark, d).select("ein").distinct()
    return R.valid_edges(R.distinct_pairs(edges(spark, d)), funds(spark, d), m)


@query
def lookup_manager_attributes(spark, d):
    pairs = R.distinct_pairs(edges(spark, d))
    return R.lookup(pairs, star.manager_attributes(spark, d), "manager_ein")


# ---- aggregates


@query
def manager_nodes(spark, d):
    return managers(spark, d).withColumns(dbl("total_fees"))


@query
def managers_per_fund(spark, d):
    return A.num_managers(edges(spark, d))


@query
def managers_per_fund_sketched(spark, d):
    """Distinct managers from sketches by fund and line number (a part of each filing), stored and merged, beside the exact count."""
    e = edges(spark, d, ("line_no",))
    stored = cut(A.manager_sketches(e, "line_no"), "sketches")
    both = A.num_managers(e).join(A.merged_num_managers(stored), "ein", "left")
    near = F.abs(F.col("num_managers_estimate") - F.col("num_managers")) <= 0.05 * F.col("num_managers")
    return both.select("ein", "num_managers", near.alias("within_5_percent"))


@query
def total_fees_per_fund(spark, d):
    return A.total_fees(edges(spark, d)).withColumns(dbl("total_fees"))


@query
def top_manager_concentration(spark, d):
    return A.top_manager_concentration(edges(spark, d)).withColumns(rnd(6, "top_manager_concentration"))


@query
def shared_manager_totals(spark, d):
    """The sum over partner edges and the linear identity, side by side."""
    e = edges(spark, d)
    by_pairs = A.total_shared_managers(P.fund_fund_edges(e))
    return by_pairs.join(P.shared_totals(e).withColumnRenamed("total_shared_managers", "by_clients"), "ein", "full")


@query
def shared_manager_totals_concat(spark, d):
    return A.total_shared_managers(P.fund_fund_edges(edges(spark, d)), mode="concat")


@query
def community_concentration(spark, d):
    out = A.community_concentration(edges(spark, d), star.manager_attributes(spark, d))
    return out.withColumns(rnd(6, "community_concentration"))


@query
def same_parent_fee_ratio(spark, d):
    out = A.same_parent_fee_ratio(edges(spark, d), star.manager_attributes(spark, d))
    return out.withColumns({**dbl("total_fees"), **rnd(6, "same_parent_fee_ratio")})


@query
def same_parent_fee_ratio_last(spark, d):
    """As the loaded graph gives it: each edge holds the last fee of its pair, not their sum."""
    last = R.keep_last(edges(spark, d, ("ACK_ID", "line_no")), ["fund_ein", "manager_ein"], ["ACK_ID", "line_no", "fee_paid"])
    out = A.same_parent_fee_ratio(last, star.manager_attributes(spark, d))
    return out.withColumns({**dbl("total_fees"), **rnd(6, "same_parent_fee_ratio")})


@query
def shared_totals_of_hubs(spark, d):
    """Each of the 25 providers is shared by very many funds."""
    return P.shared_totals(star.nation_lines(spark, d))


@query
def fund_profile(spark, d):
    out = A.fund_profile(edges(spark, d), star.manager_attributes(spark, d))
    return out.withColumns({**dbl("total_fees"), **rnd(6, "top_manager_concentration", "community_concentration", "same_parent_fee_ratio")})


@query
def table_row_counts(spark, d):
    return A.table_counts({
        "filings": star.filings(spark, d), "lines": star.provider_lines(spark, d), "funds": funds(spark, d),
        "managers": managers(spark, d), "edges": edges(spark, d),
    })


@query
def risk_score_distribution(spark, d):
    return A.value_counts(X.training_rows(labelled(spark, d)), "risk_score", by_value=True)


@query
def label_distribution(spark, d):
    return A.value_counts(labelled(spark, d), "label")


@query
def class_balance(spark, d):
    return A.class_balance(X.training_rows(labelled(spark, d))).withColumns(rnd(6, "positive_pct", "balance"))


@query
def feature_means_by_label(spark, d):
    return A.feature_means_by_label(X.training_rows(labelled(spark, d)))


@query
def describe_fund_features(spark, d):
    cols = ["num_managers", "total_fees", "community_concentration", "same_parent_fee_ratio"]
    prof = A.fund_profile(edges(spark, d), star.manager_attributes(spark, d))
    return A.describe(prof, cols).withColumns(rnd(4, "mean", "std", "min", "p25", "p50", "p75", "max"))


@query
def class_weights(spark, d):
    return A.class_weights(X.training_rows(labelled(spark, d))).withColumns(rnd(6, "weight"))


# ---- ranking, sort, top-k


@query
def top_manager_per_fund(spark, d):
    fees = A.fund_manager_fees(edges(spark, d))
    return R.top_per_group(fees, "fund_ein", "fee_paid", 1, "manager_ein").withColumns(dbl("fee_paid"))


@query
def fee_percentile(spark, d):
    t = A.total_fees(edges(spark, d))
    return W.pct_rank_avg(t, "total_fees", "fee_percentile").withColumns({**dbl("total_fees"), **rnd(6, "fee_percentile")})


@query
def fee_percentile_by_fund_type(spark, d):
    t = A.total_fees(edges(spark, d)).join(funds(spark, d).select("ein", "fund_type"), "ein")
    return W.pct_rank_avg(t, "total_fees", "fee_percentile", "fund_type").withColumns({**dbl("total_fees"), **rnd(6, "fee_percentile")})


@query
def largest_managers(spark, d):
    m = managers(spark, d).groupBy("ein").agg(F.sum("total_fees").alias("total_fees"))
    return R.nlargest(m, 10, "total_fees", "ein").withColumns(dbl("total_fees"))


@query
def preview_funds(spark, d):
    return R.head(funds(spark, d).select("ein", "plan_name", "fund_type", "num_participants"), 5, "ein")


@query
def dense_node_index(spark, d):
    return W.dense_index(funds(spark, d).select("ein"), ["ein"])


# ---- entity resolution


def prepared(spark: SparkSession, d: str) -> DataFrame:
    return E.prepare_managers(managers(spark, d))


@query
def clean_names(spark, d):
    li = star.provider_lines(spark, d, named=True)
    # spellings repeat, so they are counted before they are cleaned
    spelt = cut(li.groupBy("PROVIDER_OTHER_NAME").agg(F.count("*").alias("n")))
    clean = cut(spelt.select(N.clean_name("PROVIDER_OTHER_NAME").alias("name_clean"), "n").groupBy("name_clean").agg(F.sum("n").alias("lines")))
    return clean.select("name_clean", N.token_sort("name_clean").alias("sorted_name"), "lines")


@query
def person_names(spark, d):
    return managers(spark, d).select("ein", "name", N.is_person("name").alias("is_person"))


@query
def name_thresholds(spark, d):
    m = managers(spark, d)
    return m.groupBy(N.threshold(N.clean_name("name"), True).alias("by_length"), N.threshold("name").alias("constant")).agg(F.count("*").alias("names"))


@query
def spelling_similarity(spark, d):
    """Similarity of every spelling with the first spelling of the same EIN."""
    m = cut(managers(spark, d).select("ein", "name"))
    first = m.groupBy("ein").agg(F.min("name").alias("first_name"))
    score = N.token_sort_ratio(N.clean_name("name"), N.clean_name("first_name"))
    return m.join(first, "ein").select("ein", "name", F.round(score, 6).alias("score"))


@query
def similar_names(spark, d):
    return E.similar_pairs(prepared(spark, d)).withColumns(rnd(6, "score"))


@query
def enriched_managers(spark, d):
    return E.enrich_managers(managers(spark, d)).withColumns(dbl("total_fees")).drop("is_person")


@query
def parent_group_sizes(spark, d):
    return A.group_sizes(E.enrich_managers(managers(spark, d)))


@query
def parent_group_summary(spark, d):
    return A.group_summary(E.enrich_managers(managers(spark, d)))


@query
def name_component_groups(spark, d):
    rows = prepared(spark, d)
    return E.component_groups(rows, E.similar_pairs(rows))


# ---- graph


def graph(spark: SparkSession, d: str, fees: str = "last", shares: bool = False) -> G.Graph:
    """Funds, managers and payments; ``shares`` adds the edges between funds with common managers."""
    e = edges(spark, d, ("ACK_ID", "line_no"))
    ff = P.shared_manager_counts if shares else None
    return G.build_graph(funds(spark, d), managers(spark, d), e, ff, ("ACK_ID", "line_no", "fee_paid"), fees)


def shared_graph(spark: SparkSession, d: str) -> G.Graph:
    """Funds and their shared-manager edges, one canonical row per pair."""
    e = edges(spark, d)
    nodes = cut(funds(spark, d).select(G.node_id(G.FUND, "ein").alias("id"), F.lit(G.FUND).alias("label"), "ein"))
    ff = P.shared_manager_counts(e).select(
        G.node_id(G.FUND, "fund_a").alias("src"), G.node_id(G.FUND, "fund_b").alias("dst"),
        F.lit(G.SHARES).alias("type"), F.col("shared_managers").cast("double").alias("weight"),
    )
    return G.Graph(nodes, ff)


@query
def graph_nodes(spark, d):
    return graph(spark, d).nodes


@query
def graph_edges(spark, d):
    return graph(spark, d, shares=True).edges


@query
def graph_label_counts(spark, d):
    return A.label_counts(graph(spark, d).nodes)


@query
def project_reverse(spark, d):
    return G.project(graph(spark, d), [G.FUND, G.MANAGER], {G.ALLOCATED: "REVERSE"}).edges


@query
def induced_manager_subgraph(spark, d):
    """Managers only: no payment edge keeps both ends."""
    sub = G.induced(graph(spark, d), [G.MANAGER], [G.ALLOCATED])
    return A.table_counts({"nodes": sub.nodes, "edges": sub.edges})


@query
def expand_allocations(spark, d):
    return G.expand(graph(spark, d), G.FUND, G.ALLOCATED, G.MANAGER).select("src_ein", "dst_ein", "weight")


@query
def undirected_edges(spark, d):
    e = R.distinct_pairs(edges(spark, d))
    return R.to_undirected(e, "fund_ein", "manager_ein", rel="rel")


def chained_managers(spark: SparkSession, d: str, g: G.Graph) -> DataFrame:
    """Manager nodes with their PageRank, name groups and (stored) community."""
    both = G.project(g, [G.FUND, G.MANAGER], {G.ALLOCATED: "UNDIRECTED"})
    groups = E.enrich_managers(managers(spark, d)).groupBy("ein").agg(*[F.max(c).alias(c) for c in ("parent_group_id", "group_size", "same_parent_flag")])
    community = star.manager_attributes(spark, d).select(G.node_id(G.MANAGER, "manager_ein").alias("id"), "community_id")
    nodes = G.with_property(g.nodes, PR.pagerank(both.nodes, both.edges))
    nodes = G.with_property(nodes, groups.select(G.node_id(G.MANAGER, "ein").alias("id"), "parent_group_id", "group_size", "same_parent_flag"))
    return cut(G.manager_scores(G.with_property(nodes, community)), "scores")


def chained_funds(spark: SparkSession, d: str, g: G.Graph, scored_managers: DataFrame, sample: int | None = None) -> DataFrame:
    """Fund nodes with their (stored) community, betweenness, cycle flag and what follows from the managers' scores.

    The betweenness on the payments is exact; ``sample`` is for the queries whose SQL names so many pivots.
    """
    attrs = scored_managers.select(F.col("ein").alias("manager_ein"), "community_id", "same_parent_flag")
    metrics = A.fund_profile(edges(spark, d), attrs).select(
        G.node_id(G.FUND, "ein").alias("id"), F.col("num_managers").alias("total_managers"), "manager_community_count",
        "community_concentration", "total_fees", "same_parent_fee_ratio",
    )
    community = star.fund_communities(spark, d).select(G.node_id(G.FUND, "ein").alias("id"), "community_id")
    nodes = G.with_property(G.with_property(g.nodes.drop("total_fees"), metrics), community)
    between = BC.betweenness(g.nodes, g.edges, sample=sample) if sample else BB.exact_betweenness(g.nodes, g.edges)
    nodes = G.with_property(nodes, between)
    nodes = G.with_property(nodes, CC.circular_flag(CC.strongly_connected_components(g.edges, g.nodes)).drop("component"))
    return cut(G.fund_scores(nodes), "scores")


@query
def fund_score_export(spark, d):
    g = graph(spark, d)
    out = scores_off_ties(chained_funds(spark, d, g, chained_managers(spark, d, g)))
    return out.withColumns(rnd(6, "community_concentration", "same_parent_fee_ratio"))


@query
def manager_score_export(spark, d):
    return chained_managers(spark, d, graph(spark, d)).withColumns(rnd(5, "pagerank_score"))


@query
def first_fund_score_export(spark, d):
    """The first metric run: strong components of the payments, as id and as flag, beside the (stored) community."""
    g = graph(spark, d)
    scc = CC.circular_flag(CC.strongly_connected_components(g.edges, g.nodes)).withColumnRenamed("component", "scc_id")
    community = star.fund_communities(spark, d).select(G.node_id(G.FUND, "ein").alias("id"), "community_id")
    return G.first_fund_scores(G.with_property(G.with_property(g.nodes, scc), community))


@query
def first_manager_score_export(spark, d):
    """The first metric run: PageRank and exact betweenness on the managers alone, whose graph keeps no payment edge."""
    g = graph(spark, d)
    alone = G.induced(g, [G.MANAGER], [G.ALLOCATED])
    groups = E.enrich_managers(managers(spark, d)).groupBy("ein").agg(*[F.max(c).alias(c) for c in ("parent_group_id", "same_parent_flag")])
    community = star.manager_attributes(spark, d).select(G.node_id(G.MANAGER, "manager_ein").alias("id"), "community_id")
    nodes = G.with_property(g.nodes, PR.pagerank(alone.nodes, alone.edges))
    nodes = G.with_property(nodes, BC.betweenness(alone.nodes, alone.edges))
    nodes = G.with_property(nodes, groups.select(G.node_id(G.MANAGER, "ein").alias("id"), "parent_group_id", "same_parent_flag"))
    return G.first_manager_scores(G.with_property(nodes, community)).withColumns(rnd(5, "pagerank_score"))


#: Pivots of the betweenness that the SQL of risk_labels_chained, fund_feature_matrix_chained and propagate_two_hops_chained names.
SQL_PIVOTS = 16


def chained_labels(spark: SparkSession, d: str, sample: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Labelled funds and the managers' scores, both from the exported scores of one loaded graph."""
    g = graph(spark, d)
    m = chained_managers(spark, d, g)
    f = chained_funds(spark, d, g, m, sample)
    attrs = m.select(F.col("ein").alias("manager_ein"), "community_id", "same_parent_flag")
    return scores_off_ties(LB.labelled_funds(funds(spark, d), edges(spark, d), attrs, f)), m


@query
def risk_labels_chained(spark, d):
    """Labels from the exported scores: name groups, PageRank, betweenness and cycles of the loaded graph."""
    out, _ = chained_labels(spark, d, SQL_PIVOTS)
    return out.withColumns({**dbl("total_fees"), **rnd(6, "top_manager_concentration", "fee_percentile", "community_concentration", "same_parent_fee_ratio")})


# ---- batches merged into stored tables, and the stream of lines

#: Batches that the test tables are replayed in.
BATCHES = 3


def batch_of(df: DataFrame, i: int) -> DataFrame:
    """Every row is in just one batch; lines of one filing, fund or manager come in all of them."""
    return df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(BATCHES)) == i)


@query
def merged_fund_nodes(spark, d):
    """Filings that come in batches: the stored funds are those of one load."""
    path = scratch_path(spark, "funds")
    for i in range(BATCHES):
        MG.merge_funds(path, I.fund_nodes(batch_of(star.filings(spark, d), i)))
    return MG.stored(spark, path).drop(MG.BUCKET)


@query
def merged_graph_edges(spark, d):
    """Filings and lines that come in batches: the stored graph's edges are those of one load."""
    nodes, paid = scratch_path(spark, "funds"), scratch_path(spark, "paid")
    lines, f = lines_and_filings(spark, d)
    for i in range(BATCHES):
        MG.merge_funds(nodes, I.fund_nodes(batch_of(f, i)))
        MG.merge_payments(paid, I.fund_manager_edges(batch_of(lines, i), f, ("ACK_ID", "line_no")), ("ACK_ID", "line_no", "fee_paid"))
    return MG.stored_graph(spark, nodes, paid, managers(spark, d)).edges


#: The id by which the stream knows a line again.
LINE = ("line_key",)


def replayed(lines: DataFrame, folder: str) -> None:
    """The lines as four deliveries an hour apart: one line in seven comes an hour late, one in five twice."""
    hour, late, again = (F.pmod(F.xxhash64(F.lit(n), "line_key"), F.lit(n)).cast("int") for n in (4, 7, 5))
    late, again = late == 0, again == 0
    first = F.when(late, hour + 1).otherwise(hour)
    came = F.array_compact(F.array(first, F.when(again, first + 1)))
    rows = lines.withColumn("received", F.timestamp_seconds(F.lit(1_700_000_000) + 3600 * hour)).withColumn("delivery", F.explode(came))
    rows = cut(rows, "replay")
    for i in range(6):
        rows.filter(F.col("delivery") == i).drop("delivery").repartition(4).write.parquet(f"{folder}/{i}")


def streamed(spark: SparkSession, d: str, keys: list[str], clean: Callable, result: Callable) -> DataFrame:
    folder, store = scratch_path(spark, "deliveries"), scratch_path(spark, "store")
    replayed(star.provider_lines(spark, d, named=True, extra=(star.LINE_KEY,)), folder)
    stream = ST.line_stream(spark, f"{folder}/*", spark.read.parquet(f"{folder}/0").schema, delay="6 hours", files_per_batch=8, line_id=LINE)
    ST.keep_current(stream, store, keys, clean, result, LINE, buckets=16)
    return ST.current(spark, store)


@query
def streamed_manager_nodes(spark, d):
    """Fee totals of managers from lines that stream in, with repeats and late lines."""
    out = streamed(spark, d, ["ein", "name"], lambda lines: I.payments(lines, LINE), A.manager_nodes)
    return out.withColumns(dbl("total_fees"))


@query
def streamed_total_fees(spark, d):
    """Fee totals of funds from the same stream."""
    f = star.filings(spark, d)
    out = streamed(spark, d, ["fund_ein"], lambda lines: I.fund_manager_edges(lines, f, LINE), lambda e: A.total_fees(e).withColumnRenamed("ein", "fund_ein"))
    return out.withColumnRenamed("fund_ein", "ein").withColumns(dbl("total_fees"))


@query
def pagerank_unweighted(spark, d):
    g = G.project(graph(spark, d), [G.FUND, G.MANAGER], {G.ALLOCATED: "UNDIRECTED"})
    return PR.pagerank(g.nodes, g.edges).withColumns(rnd(5, "pagerank_score"))


@query
def pagerank_by_fees(spark, d):
    g = G.project(graph(spark, d, "sum"), [G.FUND, G.MANAGER], {G.ALLOCATED: "UNDIRECTED"})
    return PR.pagerank(g.nodes, g.edges, "weight").withColumns(rnd(5, "pagerank_score"))


@query
def pagerank_managers_only(spark, d):
    """The induced manager graph has no edges, so every score is 1 - damping."""
    g = G.induced(graph(spark, d), [G.MANAGER])
    return PR.pagerank(g.nodes, g.edges).withColumns(rnd(5, "pagerank_score"))


@query
def connected_components(spark, d):
    g = graph(spark, d)
    return CC.connected_components(g.edges, g.nodes)


@query
def circular_payments(spark, d):
    """Strong components of who-pays-whom with sponsors and providers in one id space."""
    return CC.circular_flag(CC.strongly_connected_components(star.entity_payments(spark, d)))


@query
def circular_flag_by_label(spark, d):
    """Payments only lead from funds to managers, so the labelled graph has no cycle."""
    g = graph(spark, d)
    flags = CC.circular_flag(CC.strongly_connected_components(g.edges, g.nodes))
    return flags.groupBy("in_circular_pattern").agg(F.count("*").alias("nodes"))


def scores_off_ties(df: DataFrame) -> DataFrame:
    """Scores are simple fractions; a small shift keeps them off exact rounding ties."""
    return df.withColumn("betweenness_score", F.round(F.col("betweenness_score") + 1e-5, 2))


@query
def betweenness_sampled(spark, d):
    g = graph(spark, d)
    return scores_off_ties(BC.betweenness(g.nodes, g.edges, sample=16))


@query
def betweenness_funds_sampled(spark, d):
    g = shared_graph(spark, d)
    return scores_off_ties(BC.betweenness(g.nodes, g.edges, sample=4))


@query
def betweenness_exact(spark, d):
    """All nodes as sources, on the graph of customer nations and part kinds that every line is contracted to."""
    e = star.nation_brands(spark, d)
    nodes = e.select(F.col("src").alias("id")).union(e.select("dst")).distinct()
    return BC.betweenness(nodes, e).withColumn("betweenness_score", F.round(F.col("betweenness_score") + 1e-7, 4))


@query
def betweenness_funds_exact(spark, d):
    """All funds as sources, on the edges between funds with common managers."""
    g = shared_graph(spark, d)
    paid = edges(spark, d).select(F.col("manager_ein").alias("group"), G.node_id(G.FUND, "fund_ein").alias("id"))
    return BB.exact_betweenness(g.nodes, g.edges, groups=paid)


@query
def similar_funds(spark, d):
    """Funds that pay much the same managers."""
    sets = R.distinct_pairs(edges(spark, d)).select(F.col("fund_ein").alias("src"), F.col("manager_ein").alias("dst"))
    return SIM.node_similarity(sets).withColumns(rnd(6, "similarity_score"))


@query
def similar_portfolios(spark, d):
    """Filings that pay much the same providers."""
    li = star.provider_lines(spark, d)
    sets = li.select(F.col("ACK_ID").alias("src"), C.normalize_ein("PROVIDER_OTHER_EIN").alias("dst")).dropna()
    return SIM.node_similarity(sets).withColumns(rnd(6, "similarity_score"))


@query
def louvain_communities(spark, d):
    """Payments and shared managers together, unweighted."""
    g = graph(spark, d, shares=True)
    return LV.louvain(g.nodes, g.edges)


@query
def louvain_customer_stars(spark, d):
    """Known communities: every customer with its orders is one, whatever the order of the moves; named by its smallest member."""
    e = star.table(spark, d, "orders").selectExpr("concat('order:', cast(o_orderkey as string)) AS src", "concat('customer:', cast(o_custkey as string)) AS dst").distinct()
    nodes = e.select(F.col("src").alias("id")).union(e.select("dst")).distinct()
    found = LV.louvain(nodes, e)
    names = found.groupBy("community_id").agg(F.min("id").alias("community"), F.count("*").alias("members"))
    return found.join(names, "community_id").select("id", "community", "members")


@query
def louvain_concentration(spark, d):
    """Community concentration of every fund from the Louvain communities of the same graph, computed once."""
    g = graph(spark, d, shares=True)
    c = cut(LV.louvain(g.nodes, g.edges), "communities")
    own = g.nodes.where(F.col("label") == G.MANAGER).select("id", F.col("ein").alias("manager_ein"))
    return A.community_concentration(edges(spark, d), own.join(c, "id").select("manager_ein", "community_id"))


@query
def louvain_fund_communities(spark, d):
    g = shared_graph(spark, d)
    return LV.louvain(g.nodes, g.edges, "weight")


@query
def modularity_by_fund_type(spark, d):
    g = shared_graph(spark, d)
    c = funds(spark, d).select(G.node_id(G.FUND, "ein").alias("id"), F.col("fund_type").alias("community_id"))
    return LV.modularity(g.edges, c, "weight").withColumns(rnd(8, "modularity"))


# ---- features, split, model, metrics


def manager_table(spark: SparkSession, d: str) -> DataFrame:
    """Managers with stand-in parent flags and the number of spellings as group size."""
    flags = star.manager_attributes(spark, d).select(F.col("manager_ein").alias("ein"), "same_parent_flag")
    return R.with_group_size(managers(spark, d), "ein").join(flags, "ein", "left")


def manager_score_table(spark: SparkSession, d: str) -> DataFrame:
    return star.table(spark, d, "part").selectExpr(
        "cast(p_partkey as string) AS ein", "CASE WHEN p_size <= 45 THEN p_size / 100.0D END AS pagerank_score", "p_type AS community_id"
    )


def training(spark: SparkSession, d: str, e: DataFrame | None = None) -> DataFrame:
    return X.training_rows(labelled(spark, d, e))


def predictions(spark: SparkSession, d: str) -> DataFrame:
    """Truth, prediction and a score with ties, derived from the label table."""
    return star.table(spark, d, "labels").selectExpr(
        "doc_id", "quality AS label", "1 - toxic AS prediction",
        "(ascii(substr(md5(cast(doc_id as string)), 1, 1)) - 40) / 80.0D AS probability_1",
    )


def model_in(spark: SparkSession, d: str) -> MD.ModelInput:
    """Model input from the chain: labels and features of the exported fund scores, the managers' PageRank and name groups."""
    labels, m = chained_labels(spark, d)
    return MD.model_input(labels, m, manager_ranks(m), edges(spark, d))


def manager_ranks(scored_managers: DataFrame) -> DataFrame:
    return scored_managers.select("ein", "pagerank_score", "community_id")


@query
def fund_feature_matrix(spark, d):
    return FT.fund_features(training(spark, d)).withColumns(rnd(6, *FT.FUND_FEATURES))


@query
def manager_feature_matrix(spark, d):
    m = FT.manager_features(manager_table(spark, d), manager_score_table(spark, d), ("ein", "name"))
    return m.withColumns(rnd(6, *FT.MANAGER_FEATURES))


@query
def standardized_fund_features(spark, d):
    x = FT.fund_features(training(spark, d))
    return FT.standardize(x, FT.FUND_FEATURES).withColumns(rnd(5, *FT.FUND_FEATURES))


@query
def stratified_split(spark, d):
    return FT.stratified_split(funds(spark, d).select("ein", F.col("fund_type").alias("label")))


@query
def fund_feature_matrix_chained(spark, d):
    """The funds' model input on the exported scores."""
    labels, _ = chained_labels(spark, d, SQL_PIVOTS)
    return FT.fund_features(X.training_rows(labels)).withColumns(rnd(6, *FT.FUND_FEATURES))


@query
def manager_feature_matrix_chained(spark, d):
    """The managers' model input on the exported scores."""
    m = chained_managers(spark, d, graph(spark, d))
    return FT.manager_features(m, manager_ranks(m), ("ein", "name")).withColumns(rnd(5, *FT.MANAGER_FEATURES))


def two_hops(f: DataFrame, m: DataFrame, e: DataFrame) -> DataFrame:
    out = FT.propagate(f.select("ein", *FT.FUND_FEATURES), m.select("ein", *FT.MANAGER_FEATURES), e, 2)
    # the means are simple fractions; a small shift keeps them off exact rounding ties
    large = ("total_fees", "total_shared_managers", "betweenness_score")
    return out.withColumns({c: F.round(F.col(c) + 1e-4, 2) if c.startswith(large) else F.round(F.col(c) + 1e-7, 5) for c in out.columns if c != "ein"})


@query
def propagate_two_hops(spark, d):
    e = cut(edges(spark, d).select("fund_ein", "manager_ein", "fee_paid"), "payments")  # read by the labels and by the hops
    f = FT.fund_features(training(spark, d, e), ("ein",))
    m = FT.manager_features(R.keep_last(manager_table(spark, d), "ein", "name"), manager_score_table(spark, d))
    return two_hops(f, m, e)


@query
def propagate_two_hops_chained(spark, d):
    """Two hops over the features that the exported scores give."""
    labels, m = chained_labels(spark, d, SQL_PIVOTS)
    return two_hops(FT.fund_features(X.training_rows(labels), ("ein",)), FT.manager_features(m, manager_ranks(m)), edges(spark, d))


@query
def confusion_table(spark, d):
    return M.confusion(predictions(spark, d))


@query
def weighted_scores(spark, d):
    return M.weighted_prf(predictions(spark, d)).withColumns(rnd(6, "f1", "precision", "recall"))


@query
def roc_auc(spark, d):
    return M.roc_auc(predictions(spark, d)).withColumns(rnd(6, "auc"))


@query
def classification_report(spark, d):
    return M.classification_report(predictions(spark, d)).withColumns({**rnd(6, "precision", "recall", "f1"), "support": F.col("support").cast("bigint")})


@query
def log_loss(spark, d):
    return M.log_loss(predictions(spark, d)).withColumns(rnd(6, "log_loss"))


@query
def best_fund_type(spark, d):
    """The fund type with the largest mean fee percentile."""
    means = training(spark, d).groupBy("fund_type").agg(F.round(F.avg("fee_percentile"), 6).alias("score"))
    return M.best_by(means, "fund_type", "score")


@query
def classifier_test_scores(spark, d):
    """Full model, chosen on the validation split, saved and loaded again."""
    table, cols = MD.propagated(model_in(spark, d), 2)
    model, _ = K.select_on_validation(table, cols)
    path = scratch_path(spark, "model")
    K.save_model(model, path)
    pred = K.predict(K.load_model(path), table.filter("split = 'test'"))
    return pred.select("ein", "label", "prediction", "probability_1")


@query
def layer_sweep(spark, d):
    return MD.layer_sweep(model_in(spark, d))


@query
def ablations(spark, d):
    """The variants at the number of hops that the sweep finds best."""
    x = model_in(spark, d)
    best = M.best_by(MD.layer_sweep(x), "layers", "f1").first()["layers"]
    return MD.ablations(x, best)


@query
def forest_baseline(spark, d):
    return MD.baseline(model_in(spark, d)).select("ein", "label", "prediction", "probability_1")
