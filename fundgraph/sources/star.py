"""Filings, provider lines and stand-in attributes read from the star-schema tables.

orders = plan filings (one fund per customer and order year), lineitem = payment
lines to providers (parts).  Dirty values follow ordinary columns: order status
sets the EIN's spelling, cheap orders lack a sponsor EIN, the next cheapest have one
that is no number or carries a type letter, names hold line breaks and no-break
spaces, tax and discount rates set missing, zero and negative fees.  No row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FUND_EIN = "o_custkey * 100 + (year(o_orderdate) - 1990)"

#: Select lists, written so that any ANSI engine can run them too.
FILING_SELECT = [
    "cast(o_orderkey as string) AS ACK_ID",
    f"CASE WHEN o_totalprice < 10000 THEN NULL "
    f"WHEN o_totalprice < 12000 THEN 'PENDING' "
    f"WHEN o_totalprice < 14000 THEN concat(cast({FUND_EIN} as string), 'D') "
    f"WHEN o_orderstatus = 'F' THEN concat('0', cast({FUND_EIN} as string), '.0') "
    f"WHEN o_orderstatus = 'P' THEN concat(cast({FUND_EIN} as string), '.0') "
    f"ELSE cast({FUND_EIN} as string) END AS SPONS_DFE_EIN",
    "concat('Plan ', cast(o_custkey as string), ', ', substr(o_orderpriority, 3)) AS PLAN_NAME",
    "concat('Sponsor \"', cast(o_custkey as string), '\"', CASE WHEN o_orderpriority = '1-URGENT' THEN concat(chr(10), 'Trust') ELSE '' END) AS SPONSOR_DFE_NAME",
    "cast(substr(o_orderpriority, 1, 1) as int) AS TYPE_PLAN_ENTITY_CD",
    "cast(floor(o_totalprice / 100) as bigint) AS TOT_ACTIVE_PARTCP_CNT",
    "CASE WHEN o_orderstatus = 'P' THEN 'NA' ELSE concat('Admin ', cast(o_custkey as string)) END AS ADMIN_NAME",
    "concat(cast(o_custkey as string), CASE WHEN o_orderstatus = 'P' THEN '.0' WHEN o_totalprice < 12000 THEN 'f' ELSE '' END) AS ADMIN_EIN",
    "o_orderstatus AS SPONS_DFE_MAIL_US_STATE",
]

HASH_NAME = "translate(md5(cast({div} as string)), '0123456789abcdef', 'ABCDEFGHIJKLMNOP')"

LINE_SELECT = [
    "cast(l_orderkey as string) AS ACK_ID",
    "CASE l_linenumber WHEN 1 THEN concat(u, ' ', v, ' LLC') "
    "WHEN 2 THEN concat(' ', lower(v), ' ', lower(u), ', Inc. ') "
    "WHEN 3 THEN concat(substr(u, 1, 3), substr(u, 5), ' ', v, ' Capital Group') "
    "WHEN 4 THEN concat(chr(160), u, ' ', v, chr(160)) "
    "ELSE concat(u, ' ', v, ' Trust Co.') END AS PROVIDER_OTHER_NAME",
    "CASE WHEN l_tax = 0.08 THEN NULL "
    "WHEN l_returnflag = 'R' THEN concat('0', cast(l_partkey as string), '.0') "
    "ELSE cast(l_partkey as string) END AS PROVIDER_OTHER_EIN",
    "cast(CASE WHEN l_discount = 0.1 THEN NULL "
    "WHEN l_discount = 0 AND l_tax = 0 THEN -l_extendedprice "
    "WHEN l_discount = 0 AND l_tax = 0.01 THEN 0 "
    "ELSE l_extendedprice END AS decimal(18, 2)) AS PROVIDER_OTHER_DIRECT_COMP_AMT",
    "l_linenumber AS line_no",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*FILING_SELECT)


#: An id of a line that deliveries repeat: order and line number alone are not unique in the test tables.
LINE_KEY = "md5(concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate)) AS line_key"


def provider_lines(spark: SparkSession, sf_dir: str, named: bool = False, extra: tuple[str, ...] = ()) -> DataFrame:
    """Payment lines; ``named`` adds the provider's name from the provider table.

    Names are hashed once per provider and joined (Spark broadcasts the provider
    table when it is small); jobs that need no name skip the join.
    """
    li = table(spark, sf_dir, "lineitem")
    if not named:
        return li.selectExpr("CAST(NULL AS string) AS PROVIDER_OTHER_NAME", *[e for e in LINE_SELECT if "PROVIDER_OTHER_NAME" not in e], *extra)
    x = HASH_NAME.format(div="p_partkey div 3")
    base = table(spark, sf_dir, "part").selectExpr("p_partkey AS l_partkey", f"substr({x}, 1, 8) AS u", f"substr({x}, 9, 7) AS v")
    return li.join(base, "l_partkey").selectExpr(*LINE_SELECT, *extra)


def manager_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in community and parent flag per manager, for checking A8, A9 and labels."""
    return table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) AS manager_ein",
        "p_type AS community_id",
        "CASE WHEN p_size <= 15 THEN 1 WHEN p_size <= 45 THEN 0 END AS same_parent_flag",
    )


def fund_communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored partition of the funds, for checking what follows communities: the sponsor's market segment."""
    od = table(spark, sf_dir, "orders").selectExpr("o_custkey", f"cast({FUND_EIN} as string) AS ein").distinct()
    segments = table(spark, sf_dir, "customer").selectExpr("c_custkey AS o_custkey", "c_mktsegment AS community_id")
    return od.join(segments, "o_custkey").select("ein", "community_id")


def nation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Funds and the nations of the suppliers of their lines: 25 providers, each of which very many funds share."""
    li, od = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey"), table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"cast({FUND_EIN} as string) AS fund_ein")
    su = table(spark, sf_dir, "supplier").selectExpr("s_suppkey", "cast(s_nationkey as string) AS manager_ein")
    return li.join(od, li.l_orderkey == od.o_orderkey).join(su, li.l_suppkey == su.s_suppkey).select("fund_ein", "manager_ein")


def nation_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line contracted to its customer's nation and its part's brand and size: distinct pairs."""
    li, od = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cu = table(spark, sf_dir, "customer").selectExpr("c_custkey", "concat('nation:', cast(c_nationkey as string)) AS src")
    pa = table(spark, sf_dir, "part").selectExpr("p_partkey", "concat(p_brand, ' ', cast(p_size as string)) AS dst")
    return li.join(od, li.l_orderkey == od.o_orderkey).join(cu, od.o_custkey == cu.c_custkey).join(pa, li.l_partkey == pa.p_partkey).select("src", "dst").distinct()


def entity_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who paid whom, with sponsors and providers in one id space."""
    li = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "cast(l_partkey as string) AS dst")
    od = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "cast(o_custkey as string) AS src")
    return li.join(od, li.l_orderkey == od.o_orderkey).select("src", "dst")
