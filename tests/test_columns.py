import random

import pytest
from pyspark.sql import functions as F

from fundgraph.functions import columns as C
from fundgraph.functions import names as N


def one(spark, schema, data, **exprs):
    df = spark.createDataFrame(data, schema)
    return [tuple(r) for r in df.select(*[e.alias(n) for n, e in exprs.items()]).collect()]


def test_ein_forms(spark):
    got = one(spark, "x string", [("10233346",), ("10233346.0",), ("010233346.0",), (None,), ("abc",)], e=C.normalize_ein("x"))
    assert got == [("10233346",)] * 3 + [(None,)] * 2


def test_missing_markers_and_codes(spark):
    df = spark.createDataFrame([("NA",), ("N/A",), ("null",), ("",), ("x",)], "x string")
    assert [r.x for r in C.null_markers(df).collect()] == [None] * 4 + ["x"]
    got = one(spark, "c int", [(2,), (4,), (7,), (None,)], t=C.map_code("c"))
    assert [g[0] for g in got] == ["Multi Employer", "DFE", "Unknown", "Unknown"]


def test_clip_and_numbers(spark):
    data = [(None,), (float("nan"),), (-1.0,), (0.5,), (7.0,)]
    assert [g[0] for g in one(spark, "x double", data, c=C.clip("x", 0, 1))] == [None, None, 0.0, 0.5, 1.0]
    got = one(spark, "x string", [("3",), ("x",), (None,), ("NaN",), ("Infinity",)], n=C.to_num("x", 9))
    assert [g[0] for g in got] == [3.0, 9.0, 9.0, 9.0, 9.0]


def test_guarded_ratio(spark):
    data = [(5.0, 0.0), (0.0, 0.0), (-2.0, 0.0), (5.0, -5.0), (7.0, 7.0), (1.0, 4.0)]
    got = one(spark, "t double, n double", data, r=C.guarded_ratio("t", "n"))
    assert [g[0] for g in got] == [1.0, None, 0.0, 0.0, 1.0, 0.25]


def test_names(spark):
    data = [("Ubs Financial Services, Inc.",), ("\tINS. CO. ",), ("A-B  c d",)]
    assert [g[0] for g in one(spark, "n string", data, c=N.clean_name("n"))] == ["UBS", "INS", "AB C D"]
    people = [("TIAA",), ("VINCENT SMITH",), ("JOHN A B SMITH",), ("Jane Doe",), ("Acme Fund",)]
    assert [g[0] for g in one(spark, "n string", people, p=N.is_person("n"))] == [True, False, False, True, False]
    assert [g[0] for g in one(spark, "n string", [("UBS",), ("LONGER",)], t=N.threshold("n", True))] == [95, 85]


def lcs(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(prev[j] + 1 if x == y else max(prev[j + 1], row[j]))
        prev = row
    return prev[-1]


def test_similarity_equals_plain_recurrence(spark):
    rnd = random.Random(5)
    sizes = [0, 1, 2, 7, 30, 61, 62, 63, 124, 125, 140]
    word = lambda: "".join(rnd.choice("ABC1 ") for _ in range(rnd.choice(sizes)))
    data = [(word(), word()) for _ in range(250)]
    df = spark.createDataFrame(data, "a string, b string")
    got = df.select("a", "b", N.lcs_length("a", "b").alias("l"), N.sorted_ratio("a", "b").alias("r"), N.sorted_ratio("b", "a").alias("s")).collect()
    for r in got:
        assert r.l == lcs(r.a, r.b)
        want = 100.0 if r.a == r.b else 200.0 * lcs(r.a, r.b) / (len(r.a) + len(r.b))
        assert r.r == pytest.approx(want) and r.s == pytest.approx(want)


def test_token_sort_ratio(spark):
    data = [("B A", "A B"), ("", ""), ("ABCD", "ABCE"), ("", "A")]
    got = one(spark, "a string, b string", data, r=N.token_sort_ratio("a", "b"))
    assert [g[0] for g in got] == [100.0, 100.0, 75.0, 0.0]


def test_fee_sum_of_nulls_is_zero(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "k int, f decimal(18,2)")
    assert float(df.groupBy("k").agg(C.fee_sum("f").alias("s")).first().s) == 0.0
    assert df.agg(F.sum("f").alias("s")).first().s is None


def test_cleaned_values_are_not_built_again_in_filters(spark):
    """A filter that is moved below the projection would hold a copy of the whole cleaning."""
    from fundgraph.plans import ingest as I
    from fundgraph.schema import FILINGS

    names = ["ACK_ID", "PROVIDER_OTHER_NAME", "PROVIDER_OTHER_EIN", "PROVIDER_OTHER_DIRECT_COMP_AMT"]
    lines = spark.createDataFrame(
        [("1", " acme\xa0", "07.0", 2.0), ("1", "B", "x", 1.0), ("2", "NULL", "8", 1.0), (None, "c", "9", 3.0), ("2", "d", "5", 1.0)],
        "ACK_ID string, PROVIDER_OTHER_NAME string, PROVIDER_OTHER_EIN string, PROVIDER_OTHER_DIRECT_COMP_AMT double",
    ).select(*[F.concat(c, F.lit("")).alias(c) if i < 3 else c for i, c in enumerate(names)])
    filings = spark.createDataFrame([("1", "5.0"), ("2", "5"), (None, "6"), ("3", "?")], "ACK_ID string, SPONS_DFE_EIN string")
    wide = filings.select(*[c if c in filings.columns else F.lit(None).cast("string").alias(c) for c in FILINGS.fieldNames()])
    edges, paid, funds = I.fund_manager_edges(lines, filings), I.payments(lines), I.fund_nodes(wide)
    for df in (edges, paid, funds):
        filters = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x]
        assert filters and not any("RLIKE" in x for x in filters)
    assert sorted(tuple(r) for r in edges.select("fund_ein", "manager_ein").collect()) == [("5", "7"), ("5", "8"), ("6", "9")]
    assert sorted(tuple(r) for r in paid.select("ein", "name").collect()) == [("5", "D"), ("7", "ACME"), ("9", "C")]
    assert sorted(r["ein"] for r in funds.select("ein").collect()) == ["5", "6"]
