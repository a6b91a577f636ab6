import random

from conftest import rows
from pyspark.sql import functions as F

from fundgraph.operators import aggregates as A
from fundgraph.operators import pairs as P
from fundgraph.operators import ranking as W
from fundgraph.operators import relational as R
from fundgraph.operators import risk as X
from fundgraph.plans import ingest as I

FILING = "ACK_ID string, SPONS_DFE_EIN string, PLAN_NAME string, SPONSOR_DFE_NAME string, TYPE_PLAN_ENTITY_CD int, TOT_ACTIVE_PARTCP_CNT bigint, ADMIN_NAME string, ADMIN_EIN string, SPONS_DFE_MAIL_US_STATE string"
LINE = "ACK_ID string, PROVIDER_OTHER_NAME string, PROVIDER_OTHER_EIN string, PROVIDER_OTHER_DIRECT_COMP_AMT decimal(18,2)"


def filing(spark, *items):
    return spark.createDataFrame([(a, e, f"plan {a}", "s", 1, 5, "a", "1", "NY") for a, e in items], FILING)


def edges(spark, *items):
    return spark.createDataFrame(items, "fund_ein string, manager_ein string, fee_paid decimal(18,2)")


def dec(x):
    import decimal

    return None if x is None else decimal.Decimal(str(x))


def test_first_filing_per_sponsor(spark):
    f = filing(spark, ("2", "7.0"), ("1", "07"), ("3", None), ("4", "abc"), ("5", "8"))
    assert rows(I.fund_nodes(f), "ein", "ack_id") == [("7", "1"), ("8", "5")]
    assert rows(R.rejected_eins(f, "SPONS_DFE_EIN"), "rejected", "present") == [(1, 4)]


def test_null_filing_ids_match_and_repeated_ids_fan_out(spark):
    f = filing(spark, (None, "1"), ("a", "2"), ("a", "3"))
    lines = spark.createDataFrame([(None, "n", "9", dec(1)), ("a", "n", "9", dec(2)), ("z", "n", "9", dec(3))], LINE)
    assert rows(R.attach_fund(lines, f).fillna("-"), "ACK_ID", "SPONS_DFE_EIN") == [("-", "1"), ("a", "2"), ("a", "3"), ("z", "-")]
    e = I.fund_manager_edges(lines, f)
    assert rows(e, "fund_ein", "manager_ein") == [("1", "9"), ("2", "9"), ("3", "9")]


def test_upsert_keeps_the_last_row_even_if_null(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 7), ("b", 1, 5), ("b", 2, None)], "k string, pos int, fee int")
    assert sorted((r.k, r.fee) for r in R.keep_last(df, "k", "pos").collect()) == [("a", 7), ("b", None)]


def test_loops_and_duplicate_lines(spark):
    e = edges(spark, ("a", "a", dec(1)), ("a", "b", dec(1)), ("a", "b", dec(1)))
    e = R.drop_self_loops(e)
    assert e.count() == 2 and R.distinct_pairs(e).count() == 1


def test_manager_nodes_and_concentration(spark):
    lines = spark.createDataFrame([("1", "A", None), ("1", "A", None), ("2", "B", dec(3)), ("2", "B", None)], "ein string, name string, fee_paid decimal(18,2)")
    got = [(r.ein, float(r.total_fees), r.num_clients) for r in A.manager_nodes(lines).orderBy("ein").collect()]
    assert got == [("1", 0.0, 0), ("2", 3.0, 1)]
    e = edges(spark, ("p", "x", dec(5)), ("p", "y", dec(-5)), ("q", "x", dec(0)), ("q", "y", dec(0)), ("r", "x", dec(5)), ("r", "y", dec(-10)), ("s", "x", dec(7)))
    got = {r.ein: r.top_manager_concentration for r in A.top_manager_concentration(e).collect()}
    assert got == {"p": 1.0, "q": None, "r": 0.0, "s": 1.0}


def test_shared_totals_sum_and_text(spark):
    ff = spark.createDataFrame([("f", "a", 1), ("f", "b", 1), ("f", "c", 2)] + [("g", f"{i:04d}", 1) for i in range(310)], "fund_a string, fund_b string, shared_managers bigint")
    assert rows(A.total_shared_managers(ff), "ein", "total_shared_managers") == [("f", 4), ("g", 310)]
    assert rows(A.total_shared_managers(ff, "concat"), "ein", "total_shared_managers") == [("f", 112.0), ("g", 0.0)]


def test_pairs_of_a_hot_manager_are_whole(spark):
    rnd = random.Random(1)
    fm = {(f"f{i}", "hot") for i in range(60)} | {(f"f{rnd.randrange(60)}", f"m{rnd.randrange(12)}") for _ in range(150)}
    df = spark.createDataFrame(sorted(fm), "fund_ein string, manager_ein string")
    want = {}
    for f, m in fm:
        for g, n in fm:
            if m == n and f < g:
                want[f, g] = want.get((f, g), 0) + 1
    for block in (7, 1000):
        got = {(r.fund_a, r.fund_b): r.shared_managers for r in P.shared_manager_counts(df, block).collect()}
        assert got == want
    both = P.fund_fund_edges(df, 7)
    assert both.count() == 2 * len(want)
    totals = {r.ein: r.total_shared_managers for r in A.total_shared_managers(both).collect()}
    assert totals == {r.ein: r.total_shared_managers for r in P.shared_totals(df).collect()}


def test_percentile_rank_with_ties(spark):
    df = spark.createDataFrame([("a", 10), ("b", 20), ("c", 20), ("d", None), ("e", 30)], "k string, v int")
    got = {r.k: r.pct_rank for r in W.pct_rank_avg(df, "v").collect()}
    assert got == {"a": 0.25, "b": 0.625, "c": 0.625, "d": None, "e": 1.0}


def test_ranks_index_and_quantiles_against_a_sort(spark):
    rnd = random.Random(2)
    vals = [rnd.choice([rnd.randrange(50), rnd.random() * 50, 7]) * 1.0 for _ in range(500)]
    df = spark.createDataFrame([(i, v, "ab"[i % 2]) for i, v in enumerate(vals)], "i int, v double, g string")
    got = {r.i: r.pct_rank for r in W.pct_rank_avg(df, "v", partition="g").collect()}
    for i, v in enumerate(vals):
        same = [w for j, w in enumerate(vals) if j % 2 == i % 2]
        want = (sum(w < v for w in same) + (same.count(v) + 1) / 2) / len(same)
        assert abs(got[i] - want) < 1e-12
    idx = {r.i: r.idx for r in W.dense_index(df, ["v", "i"]).collect()}
    assert idx == {i: n for n, i in enumerate(sorted(range(500), key=lambda i: (vals[i], i)))}
    s = sorted(vals)
    q = W.quantiles(df, ["v"], (0.0, 0.25, 0.5, 0.9, 1.0)).first().quantiles
    for p, x in zip((0.0, 0.25, 0.5, 0.9, 1.0), q):
        pos = p * (len(s) - 1)
        lo = int(pos)
        hi = min(lo + 1, len(s) - 1)
        assert abs(x - (s[lo] + (s[hi] - s[lo]) * (pos - lo))) < 1e-9


def test_communities_and_parent_ratio(spark):
    e = edges(spark, ("f", "a", dec(1)), ("f", "b", dec(3)), ("g", "c", dec(0)))
    attrs = spark.createDataFrame([("a", None, None), ("b", None, 1), ("c", "x", 1)], "manager_ein string, community_id string, same_parent_flag int")
    assert rows(A.community_concentration(e, attrs), "ein", "manager_community_count", "community_concentration") == [("f", 0, 1.0), ("g", 1, 1.0)]
    assert rows(A.same_parent_fee_ratio(e, attrs), "ein", "same_parent_fee_ratio") == [("f", 0.75), ("g", 0.0)]


def test_risk_limits(spark):
    cols = "ein string, top_manager_concentration double, num_managers bigint, total_shared_managers bigint, fee_percentile double, community_concentration double, same_parent_fee_ratio double"
    data = [
        ("edge", 0.70, 2, 10, 0.90, 0.80, 0.50),
        ("over", 0.71, 2, 11, 0.91, 0.80, 0.51),
        ("four", 0.71, 2, 11, 0.5, 0.1, 0.1),
        ("none", 0.9, 0, 99, 0.99, 1.0, 0.9),
    ]
    got = {r.ein: (r.risk_score, r.label) for r in X.risk_labels(spark.createDataFrame(data, cols)).collect()}
    assert got == {"edge": (2, 1), "over": (8, 0), "four": (4, 0), "none": (0, -1)}


def test_fills_updates_and_casts(spark):
    df = spark.createDataFrame([("a", float("nan"), None)], "ein string, fee_percentile double, community_concentration double")
    assert rows(X.fill_features(df), "fee_percentile", "community_concentration") == [(0.5, 1.0)]
    nodes = spark.createDataFrame([("a", 1), ("b", 2)], "ein string, x int")
    patch = spark.createDataFrame([("a", 9, "n")], "ein string, x int, y string")
    assert rows(R.update_from(nodes, patch, "ein").fillna("-"), "ein", "x", "y") == [("a", 9, "n"), ("b", 2, "-")]
    assert rows(R.cast_props(spark.createDataFrame([("1", "q")], "a string, b string"), {"a": "int", "b": "int"}).fillna(-1), "a", "b") == [(1, -1)]


def test_describe(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "v double")
    r = A.describe(df, ["v"]).first()
    assert (r["count"], r["min"], r.p25, r.p50, r.p75, r["max"]) == (3, 1.0, 1.5, 2.0, 3.0, 4.0)
    assert abs(r["std"] - 1.5275252) < 1e-6


def test_hot_key_top_k_and_window_limit_plan(spark):
    df = spark.createDataFrame([("hot", i) for i in range(1000)] + [("b", 1)], "k string, v int")
    top = R.top_per_group(df, "k", "v", 2)
    assert rows(top, "k", "v") == [("b", 1), ("hot", 998), ("hot", 999)]
    # rows are limited per key before they are shuffled
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert df.select(F.count("*")).first()[0] == 1001


def test_partner_lists_hold_every_pair_once_in_arrays_of_a_block(spark):
    for name in (str, "f{}".format):
        data = [(name(f), "hub") for f in range(95, 105)] + [(name(f), "small") for f in (99, 100, 7)] + [(None, "hub"), ("1", None)]
        lists = P.partner_lists(spark.createDataFrame(data, "fund_ein string, manager_ein string"), 4).collect()
        pairs = sorted((str(r.fund_a), str(p)) for r in lists for p in r.partners)
        hub, small = sorted(name(f) for f in range(95, 105)), sorted(name(f) for f in (99, 100, 7))
        assert pairs == sorted((a, b) for s in (hub, small) for i, a in enumerate(s) for b in s[i + 1:])
        assert len(lists) < len(pairs)
