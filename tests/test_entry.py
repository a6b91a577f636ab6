import pytest
from conftest import rows

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = "customer supplier part orders lineitem labels nation region".split()
CHECKED = (
    "risk_labels", "read_provider_lines_csv", "keep_last_payment", "fund_fund_edges", "shared_manager_totals_concat",
    "describe_fund_features", "fee_percentile", "enriched_managers", "pagerank_by_fees", "similar_portfolios", "stratified_split",
)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def canon(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rel = con.sql(entry.oracle_sql()[name])
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(rel.columns, rel.fetchall())


def test_flagship(spark):
    out = entry.entry(spark)
    assert out.count() > 0 and set(r[0] for r in rows(out.select("label").distinct(), "label")) <= {-1, 0, 1}


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
