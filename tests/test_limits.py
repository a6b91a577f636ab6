"""Inputs on which a silent limit or a careless parser gives wrong results."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fundgraph.functions import columns as C
from fundgraph.functions import names as N
from fundgraph.operators import aggregates as A
from fundgraph.operators import components as CC
from fundgraph.operators import relational as R
from fundgraph.sources import tables


def test_components_of_a_long_path(spark):
    edges = spark.range(200).select(F.format_string("n%04d", "id").alias("src"), F.format_string("n%04d", F.col("id") + 1).alias("dst"))
    out = CC.connected_components(edges)
    assert out.count() == 201 and rows(out.select("component").distinct(), "component") == [("n0000",)]


def test_concatenated_totals_read_every_partner(spark):
    zeros = [("a", f"p{i:03d}", 0) for i in range(310)] + [("a", "q", 5)]
    long = [("b", f"p{i:03d}", 1) for i in range(310)]
    edge = [("c", f"p{i:03d}", 1) for i in range(309)] + [("d", "x", 0)]
    out = A.total_shared_managers(spark.createDataFrame(zeros + long + edge, "fund_a string, fund_b string, shared_managers long"), "concat")
    assert rows(out, "ein", "total_shared_managers") == [("a", 5.0), ("b", 0.0), ("c", float("1" * 309)), ("d", 0.0)]


def test_concatenated_totals_read_the_counts_twice(spark, monkeypatch):
    """Once for the lengths and once for the texts; a third time only where zeros decide."""
    kept, inner = [], A.cut
    monkeypatch.setattr(A, "cut", lambda df, name="t": kept.append(name) or inner(df, name))
    many = [("a", f"p{i:03d}", i % 7 + 1) for i in range(309)] + [("b", f"p{i:03d}", 12) for i in range(155)] + [("c", "x", 0), ("c", "y", 30)]
    ff = "fund_a string, fund_b string, shared_managers long"
    out = A.total_shared_managers(spark.createDataFrame(many, ff), "concat")
    assert rows(out, "ein", "total_shared_managers") == [("a", float("".join(str(i % 7 + 1) for i in range(309)))), ("b", 0.0), ("c", 30.0)]
    assert kept == ["lead"]
    zeros = [("d", "a", 1)] + [("d", f"p{i:03d}", 0) for i in range(309)] + [("e", f"p{i:03d}", 0) for i in range(309)] + [("e", "z", 4)]
    out = A.total_shared_managers(spark.createDataFrame(zeros, ff), "concat")
    assert rows(out, "ein", "total_shared_managers") == [("d", 0.0), ("e", 4.0)]
    assert kept == ["lead"] * 3


def test_quoted_line_breaks_and_encodings(spark, tmp_path):
    raw, utf = tmp_path / "raw.csv", tmp_path / "utf.csv"
    raw.write_bytes('ACK_ID,PROVIDER_OTHER_NAME,PROVIDER_OTHER_EIN,PROVIDER_OTHER_DIRECT_COMP_AMT\n1,"A\nB",5.0,1.5\n2,CAFÉ,6,2\n'.encode("latin-1"))
    utf.write_text("ein,name\n1,CAFÉ Ÿ\n", encoding="utf-8")
    assert rows(tables.read_provider_lines(spark, str(raw)), "ACK_ID", "PROVIDER_OTHER_NAME") == [("1", "A\nB"), ("2", "CAFÉ")]
    assert rows(tables.read_strings(spark, str(utf)), "ein", "name") == [("1", "CAFÉ Ÿ")]
    tables.write_table(spark.createDataFrame([("Ÿ",)], "name string"), str(tmp_path / "out"))
    assert rows(tables.read_strings(spark, str(tmp_path / "out")), "name") == [("Ÿ",)]


@pytest.mark.parametrize("text,ein,number,whole", [("12345D", None, None, None), ("12345f", None, None, None), ("0x1F", None, None, None), ("100.0", "100", 100.0, 100), ("1.5", "1", 1.5, None), ("9007199254740993", "9007199254740992", 9007199254740992.0, 9007199254740993), (" 7 ", "7", 7.0, 7), ("NaN", None, None, None)])
def test_numbers_in_text(spark, text, ein, number, whole):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(C.normalize_ein("x"), C.to_num("x"), C.to_int("x")).first() == (ein, number, whole)


def test_codes_with_a_tail_and_no_break_spaces(spark):
    df = spark.createDataFrame([("1.0", " Acme Co \x1f")], "code string, name string")
    assert df.select(C.map_code("code"), C.norm_name("name"), N.clean_name("name"), N.is_person("name")).first() == ("Single Employer", "ACME CO", "ACME", True)


def test_one_score_row_per_manager(spark):
    scores = spark.createDataFrame([("1", 0.5, "a"), ("1", 0.7, "b")], "ein string, pagerank_score double, community_id string")
    out = R.attach_scores(spark.createDataFrame([("1",), ("2",)], "ein string"), scores)
    assert rows(out, "ein", "pagerank_score") == [("1", 0.7), ("2", None)]


def test_components_where_tasks_hand_on_their_forest_early(spark, monkeypatch):
    rng = random.Random(5)
    pairs = [(f"n{rng.randrange(300)}", f"n{rng.randrange(300)}") for _ in range(260)] + [(f"p{i}", f"p{i + 1}") for i in range(200)]
    frame = spark.createDataFrame(pairs, "src string, dst string").repartition(5)
    want = {r.id: r.component for r in CC.connected_components(frame).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    monkeypatch.setattr(CC, "FOREST_NODES", 3)
    try:
        assert {r.id: r.component for r in CC.connected_components(frame).collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    group = {n: n for pair in pairs for n in pair}
    for _ in group:
        before = dict(group)
        for a, b in pairs:
            group[a] = group[b] = min(group[a], group[b])
        if group == before:
            break
    assert want == group
