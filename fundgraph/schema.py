"""Explicit schemas of the input and output tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


#: EINs stay strings until normalised: inference would turn them into numbers.
FILINGS = _struct(
    ("ACK_ID", S), ("SPONS_DFE_EIN", S), ("PLAN_NAME", S), ("SPONSOR_DFE_NAME", S),
    ("TYPE_PLAN_ENTITY_CD", I), ("TOT_ACTIVE_PARTCP_CNT", L), ("ADMIN_NAME", S),
    ("ADMIN_EIN", S), ("SPONS_DFE_MAIL_US_STATE", S),
)

PROVIDER_LINES = _struct(
    ("ACK_ID", S), ("PROVIDER_OTHER_NAME", S), ("PROVIDER_OTHER_EIN", S),
    ("PROVIDER_OTHER_DIRECT_COMP_AMT", MONEY),
)

FUND_SCORES = _struct(
    ("ein", S), ("community_id", S), ("betweenness_score", D), ("total_managers", L),
    ("manager_community_count", L), ("community_concentration", D), ("total_fees", D),
    ("same_parent_fee_ratio", D), ("in_circular_pattern", I),
)

MANAGER_SCORES = _struct(
    ("ein", S), ("name", S), ("pagerank_score", D), ("num_clients", L), ("total_fees", D),
    ("same_parent_flag", I), ("parent_group_id", L), ("group_size", L), ("community_id", S),
)

#: Filing column -> fund column.
FUND_COLUMNS = {
    "ACK_ID": "ack_id",
    "SPONS_DFE_EIN": "ein",
    "PLAN_NAME": "plan_name",
    "SPONSOR_DFE_NAME": "sponsor_name",
    "TYPE_PLAN_ENTITY_CD": "fund_type_code",
    "TOT_ACTIVE_PARTCP_CNT": "num_participants",
    "ADMIN_NAME": "admin_name",
    "ADMIN_EIN": "admin_ein",
    "SPONS_DFE_MAIL_US_STATE": "state",
}

#: Provider-line column -> payment column.
LINE_COLUMNS = {
    "PROVIDER_OTHER_NAME": "name",
    "PROVIDER_OTHER_EIN": "ein",
    "PROVIDER_OTHER_DIRECT_COMP_AMT": "fee_paid",
}
