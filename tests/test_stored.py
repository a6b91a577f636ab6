"""Tables stored in buckets are not shuffled again; stored sketches merge to the count of all parts."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fundgraph.operators import aggregates as A
from fundgraph.operators import features as FT
from fundgraph.operators import relational as R
from fundgraph.plans import registry
from fundgraph.session import bucketed


def payments(spark, n=4000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 40).cast("string")).alias("fund_ein"),
        F.when(F.col("id") % 97 != 0, (F.col("id") % 1500).cast("string")).alias("manager_ein"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 50 - 5).cast("decimal(18,2)")).alias("fee_paid"),
    )


def test_buckets_need_no_exchange_and_give_the_same_rows(spark):
    e = payments(spark)
    funds = e.select(F.col("fund_ein").alias("ein")).distinct().unionByName(spark.createDataFrame([("none",)], "ein string"))
    want = R.assemble_features(funds, A.num_managers(e), A.total_fees(e), A.top_manager_concentration(e))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = R.assemble_features(bucketed(funds, "ein"), A.per_fund(bucketed(A.fund_manager_fees(e), "fund_ein")))
        rows = sorted(map(tuple, got.select(*want.columns).collect()))
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert [(r[0], r[1] or 0, *r[2:]) for r in rows] == [(r[0], r[1] or 0, *r[2:]) for r in sorted(map(tuple, want.collect()))]


def test_sketches_of_parts_merge_to_the_count_of_all(spark):
    e = spark.range(60000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hub")).otherwise((F.col("id") % 100).cast("string")).alias("fund_ein"),
        (F.col("id") % 25000).cast("string").alias("manager_ein"), (F.col("id") % 7).alias("part"),
    )
    stored = A.manager_sketches(e, "part")
    late = A.manager_sketches(e.limit(0).unionByName(e.where("part = 3")), "part")  # a part that comes twice changes nothing
    got = dict(A.merged_num_managers(stored.unionByName(late)).collect())
    want = dict(A.num_managers(e).collect())
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) <= 0.05 * want[k] for k in want)
    assert abs(got["hub"] - want["hub"]) <= 0.03 * want["hub"]
    assert A.merged_num_managers(A.manager_sketches(e.limit(0), "part")).count() == 0


def star_folder(spark, folder):
    """Three filings of two customers and four payment lines."""
    day = "timestamp '1996-01-01 00:00:00'"
    orders = [(1, 1, 50000.0, "O"), (2, 1, 60000.0, "F"), (3, 2, 70000.0, "P")]
    lines = [(1, 1, 1, 10.0), (1, 2, 2, 30.0), (2, 1, 1, 5.0), (3, 1, 2, 7.0)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderstatus string").selectExpr(
        "*", f"{day} AS o_orderdate", "'1-URGENT' AS o_orderpriority"
    ).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_extendedprice double").selectExpr(
        "*", "cast(1 as double) AS l_quantity", "0.05D AS l_discount", "0.02D AS l_tax", "'N' AS l_returnflag", f"{day} AS l_shipdate", "1L AS l_suppkey"
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(1, "A", 10), (2, "B", 40)], "p_partkey long, p_type string, p_size int").write.parquet(f"{folder}/part.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["assemble_fund_features", "assemble_fund_features_stored"])
def test_assembly_reads_the_payment_lines_once(spark, tmp_path, monkeypatch, name):
    d, read, real = star_folder(spark, tmp_path), [], registry.P.shared_totals
    monkeypatch.setattr(registry.P, "shared_totals", lambda fm: read.extend(fm.inputFiles()) or real(fm))
    out = registry.QUERIES[name](spark, d)
    assert read and not any("lineitem.parquet" in f for f in [*read, *out.inputFiles()])
    assert rows(out, "ein", "num_managers", "total_fees", "top_manager_concentration", "total_shared_managers") == [
        ("106", 2, 45.0, 0.666667, 1), ("206", 1, 7.0, 1.0, 1),
    ]


def test_standardized_rows_are_computed_once(spark, tmp_path):
    path = str(tmp_path / "x")
    spark.createDataFrame([("a", 1.0), ("b", 3.0)], "ein string, x double").write.parquet(path)
    out = FT.standardize(spark.read.parquet(path), ["x"])
    assert not any(path in f for f in out.inputFiles())
    assert rows(out, "ein", "x") == [("a", -1.0), ("b", 1.0)]


def test_hops_and_labels_share_the_payments(spark, tmp_path, monkeypatch):
    d, calls, real = star_folder(spark, tmp_path), [], registry.edges
    monkeypatch.setattr(registry, "edges", lambda *a, **k: calls.append(a) or real(*a, **k))
    assert {r["ein"] for r in registry.QUERIES["propagate_two_hops"](spark, d).select("ein").collect()} == {"106", "206"}
    assert len(calls) == 1


class Reached(Exception):
    """The model input: what comes before it has been made."""


@pytest.mark.parametrize("name", ["fund_score_export", "forest_baseline", "classifier_test_scores"])
def test_exported_betweenness_has_all_nodes_as_sources(spark, tmp_path, monkeypatch, name):
    """The fund that pays two managers lies between the second one and the other two nodes."""
    d, seen, real = star_folder(spark, tmp_path), [], registry.chained_funds

    def stop(*_):
        raise Reached

    spark.createDataFrame([(1, "X"), (2, "Y")], "c_custkey long, c_mktsegment string").write.parquet(f"{d}/customer.parquet")
    monkeypatch.setattr(registry, "chained_funds", lambda *a: seen.append(real(*a)) or seen[0])
    monkeypatch.setattr(registry.BC, "betweenness", lambda *a, **k: pytest.fail("sampled"))
    monkeypatch.setattr(registry.MD, "model_input", stop)
    if name == "fund_score_export":
        assert rows(registry.QUERIES[name](spark, d), "ein", "betweenness_score") == [("106", 2.0), ("206", 0.0)]
    else:
        with pytest.raises(Reached):
            registry.QUERIES[name](spark, d)
    assert rows(seen[0], "ein", "betweenness_score") == [("106", 2.0), ("206", 0.0)]
