"""DuckDB text for the registered queries.

Only the mapping of the test tables is shared with the engine; patterns, word
lists and codes are written out here again, so that a wrong one shows.
"""

from __future__ import annotations

from ..schema import FUND_COLUMNS
from ..sources.star import FILING_SELECT, HASH_NAME, LINE_SELECT

SQL: dict[str, str] = {}

# Texts a default CSV reader takes as missing.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Plan entity codes.
FUND_TYPES = {1: "Single Employer", 2: "Multi Employer", 3: "Multiple Employer", 4: "DFE"}

# Legal and industry words removed from company names.
LEGAL_WORDS = (
    "LLC", "INC", "CORP", "LTD", "LP", "NA", "CO", "GROUP", "ADVISORS", "ADVISORY",
    "MANAGEMENT", "TRUST", "SERVICES", "FINANCIAL", "INVESTMENTS", "CAPITAL",
)

# Substrings that mark a name as a company.
COMPANY_MARKS = (
    "LLC", "INC", "CORP", "TRUST", "FUND", "MANAGEMENT", "ADVISORS", "FINANCIAL",
    "CAPITAL", "SERVICES", "GROUP", "INSURANCE", "RETIREMENT", "PENSION", "INVESTMENT",
)

MISSING_LIST = ", ".join(f"'{m}'" for m in MISSING)


def nn(c: str) -> str:
    return f"CASE WHEN {c} IN ({MISSING_LIST}) THEN NULL ELSE {c} END"


def ein(c: str) -> str:
    return f"cast(cast(trunc({num(c)}) AS bigint) AS varchar)"


B = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{B}+|{B}+$', '', 'g')"


def num(c: str) -> str:
    x = strip(f"cast({c} AS varchar)")
    return f"CASE WHEN regexp_matches({x}, '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$') THEN try_cast({x} AS double) END"


FUND_TYPE = "CASE fund_type_code " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in FUND_TYPES.items()) + " ELSE 'Unknown' END"

PRELUDE = f"""
filings AS (SELECT {", ".join(FILING_SELECT)} FROM orders),
hashed AS (SELECT *, {HASH_NAME.format(div="l_partkey // 3")} AS x FROM lineitem),
lines AS (SELECT {", ".join(LINE_SELECT)} FROM (SELECT *, substr(x, 1, 8) AS u, substr(x, 9, 7) AS v FROM hashed)),
attrs AS (SELECT cast(p_partkey AS varchar) AS manager_ein, p_type AS community_id,
                 CASE WHEN p_size <= 15 THEN 1 WHEN p_size <= 45 THEN 0 END AS same_parent_flag FROM part),
renamed AS (SELECT {", ".join(f"{a} AS {b}" for a, b in FUND_COLUMNS.items())} FROM filings),
fund_rows AS (
  SELECT ack_id, {ein("ein")} AS ein, plan_name, sponsor_name, fund_type_code, num_participants,
         {nn("admin_name")} AS admin_name, admin_ein, state, {FUND_TYPE} AS fund_type, -1 AS label
  FROM renamed WHERE {ein("ein")} IS NOT NULL),
funds AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY ein ORDER BY ack_id) AS rn FROM fund_rows) WHERE rn = 1),
managers AS (
  SELECT {ein("PROVIDER_OTHER_EIN")} AS ein, upper({strip("PROVIDER_OTHER_NAME")}) AS name,
         coalesce(sum(PROVIDER_OTHER_DIRECT_COMP_AMT), 0) AS total_fees, count(PROVIDER_OTHER_DIRECT_COMP_AMT) AS num_clients
  FROM lines WHERE PROVIDER_OTHER_EIN IS NOT NULL AND PROVIDER_OTHER_NAME IS NOT NULL GROUP BY ALL),
edges AS (
  SELECT * FROM (
    SELECT {ein("SPONS_DFE_EIN")} AS fund_ein, {ein("PROVIDER_OTHER_EIN")} AS manager_ein,
           PROVIDER_OTHER_NAME AS manager_name, PROVIDER_OTHER_DIRECT_COMP_AMT AS fee_paid, lines.ACK_ID, line_no
    FROM lines LEFT JOIN filings ON lines.ACK_ID IS NOT DISTINCT FROM filings.ACK_ID)
  WHERE fund_ein IS NOT NULL AND manager_ein IS NOT NULL AND fund_ein <> manager_ein),
fees AS (SELECT fund_ein, manager_ein, coalesce(sum(fee_paid), 0) AS fee_paid FROM edges GROUP BY ALL),
shares AS (
  SELECT a.fund_ein AS fund_a, b.fund_ein AS fund_b, count(*) AS shared_managers
  FROM fees a JOIN fees b ON a.manager_ein = b.manager_ein AND a.fund_ein <> b.fund_ein GROUP BY ALL),
shared AS (SELECT fund_a AS ein, cast(sum(shared_managers) AS bigint) AS total_shared_managers FROM shares GROUP BY ALL),
profile AS (
  SELECT f.fund_ein AS ein, count(*) AS num_managers, cast(sum(fee_paid) AS double) AS total_fees,
         CASE WHEN sum(fee_paid) = 0 THEN (CASE WHEN max(fee_paid) > 0 THEN 1.0 WHEN max(fee_paid) < 0 THEN 0.0 END)
              ELSE greatest(0.0, least(1.0, cast(max(fee_paid) AS double) / cast(sum(fee_paid) AS double))) END AS top_manager_concentration,
         count(DISTINCT community_id) AS manager_community_count,
         CASE WHEN count(DISTINCT community_id) = 0 THEN 1.0 ELSE 1.0 / count(DISTINCT community_id) END AS community_concentration,
         CASE WHEN sum(fee_paid) = 0 THEN 0.0 ELSE
           cast(coalesce(sum(fee_paid) FILTER (WHERE same_parent_flag = 1), 0) AS double) / cast(sum(fee_paid) AS double) END AS same_parent_fee_ratio
  FROM fees f LEFT JOIN attrs USING (manager_ein) GROUP BY f.fund_ein),
ranked AS (
  SELECT *, (rank() OVER (ORDER BY total_fees) + (count(*) OVER (PARTITION BY total_fees) - 1) / 2.0) / count(*) OVER () AS fee_percentile
  FROM profile),
features AS (
  SELECT ein, plan_name, fund_type, num_participants, coalesce(num_managers, 0) AS num_managers,
         coalesce(total_fees, 0.0) AS total_fees, coalesce(top_manager_concentration, 0.0) AS top_manager_concentration,
         coalesce(fee_percentile, 0.5) AS fee_percentile,
         coalesce(total_shared_managers, 0) AS total_shared_managers,
         0.0::double AS betweenness_score, coalesce(community_concentration, 1.0) AS community_concentration,
         CASE WHEN same_parent_fee_ratio IS NULL THEN 0.0 ELSE greatest(0.0, least(1.0, same_parent_fee_ratio)) END AS same_parent_fee_ratio, 0 AS in_circular_pattern
  FROM funds LEFT JOIN ranked USING (ein) LEFT JOIN shared USING (ein)),
scored AS (
  SELECT *, cast(num_managers > 0 AS int) AS has_manager_data,
         CASE WHEN num_managers > 0 THEN
           CASE WHEN top_manager_concentration > 0.7 THEN 2 ELSE 0 END + CASE WHEN num_managers <= 2 THEN 1 ELSE 0 END
         + CASE WHEN total_shared_managers > 10 THEN 1 ELSE 0 END + CASE WHEN fee_percentile > 0.9 THEN 1 ELSE 0 END
         + CASE WHEN community_concentration >= 0.8 THEN 1 ELSE 0 END + CASE WHEN same_parent_fee_ratio > 0.5 THEN 2 ELSE 0 END
         ELSE 0 END AS risk_score FROM features),
labelled AS (SELECT *, CASE WHEN has_manager_data = 0 THEN -1 WHEN risk_score >= 4 THEN 0 ELSE 1 END AS label FROM scored),
training AS (SELECT * FROM labelled WHERE label <> -1)"""


def sql(name: str, body: str, more: str = "", recursive: bool = False) -> None:
    head = "WITH RECURSIVE" if recursive else "WITH"
    SQL[name] = f"{head} {PRELUDE}{(', ' + more) if more else ''}\n{body}"


RATIOS = """round(top_manager_concentration, 6) AS top_manager_concentration,
  round(community_concentration, 6) AS community_concentration, round(same_parent_fee_ratio, 6) AS same_parent_fee_ratio"""

sql("risk_labels", f"""SELECT ein, plan_name, fund_type, num_participants, num_managers, total_fees, round(fee_percentile, 6) AS fee_percentile,
  total_shared_managers, betweenness_score, in_circular_pattern, has_manager_data, risk_score, label, {RATIOS} FROM labelled""")

FILING_COLS = "ACK_ID, SPONS_DFE_EIN, PLAN_NAME, SPONSOR_DFE_NAME, TYPE_PLAN_ENTITY_CD, TOT_ACTIVE_PARTCP_CNT, ADMIN_EIN, SPONS_DFE_MAIL_US_STATE"
sql("read_filings_csv", f"SELECT {FILING_COLS}, {nn('ADMIN_NAME')} AS ADMIN_NAME FROM filings")
sql("read_provider_lines_csv", """SELECT ACK_ID, PROVIDER_OTHER_NAME, PROVIDER_OTHER_EIN,
  cast(PROVIDER_OTHER_DIRECT_COMP_AMT AS double) AS PROVIDER_OTHER_DIRECT_COMP_AMT FROM lines""")
sql("read_strings_csv", "SELECT ein, name, cast(cast(total_fees AS decimal(28,2)) AS varchar) AS total_fees, cast(num_clients AS varchar) AS num_clients FROM managers")
sql("read_scores_csv", """SELECT ein, cast(NULL AS varchar) AS community_id, 0.0::double AS betweenness_score, num_managers AS total_managers,
  manager_community_count, round(community_concentration, 6) AS community_concentration, total_fees,
  round(same_parent_fee_ratio, 6) AS same_parent_fee_ratio, 0 AS in_circular_pattern FROM profile""")
sql("read_manager_scores_csv", """SELECT ein, name, CASE WHEN p_size <= 45 THEN p_size / 100.0 END::double AS pagerank_score, num_clients, total_fees::double AS total_fees,
  same_parent_flag, ein::bigint AS parent_group_id, group_size, p_type AS community_id FROM (
  SELECT *, row_number() OVER (PARTITION BY ein ORDER BY name DESC) AS rn, count(*) OVER (PARTITION BY ein) AS group_size FROM managers)
  LEFT JOIN attrs ON ein = manager_ein LEFT JOIN part ON ein = p_partkey::varchar WHERE rn = 1""")
sql("write_table_parquet", "SELECT * FROM funds")
sql("missing_markers", f"SELECT ACK_ID, {nn('ADMIN_NAME')} AS ADMIN_NAME FROM filings")
sql("select_and_rename_filings", "SELECT * FROM renamed")
sql("rename_by_position", "SELECT fund_ein AS payer, manager_ein AS payee, count(*) AS payments FROM edges GROUP BY ALL")
sql("require_columns", "SELECT ACK_ID, SPONS_DFE_EIN FROM filings WHERE SPONS_DFE_EIN IS NOT NULL")
sql("normalize_eins", f"SELECT ACK_ID, {ein('SPONS_DFE_EIN')} AS ein, lpad({ein('SPONS_DFE_EIN')}, 9, '0') AS ein9 FROM filings")
sql("rejected_eins", f"SELECT count(*) FILTER (WHERE SPONS_DFE_EIN IS NOT NULL AND {ein('SPONS_DFE_EIN')} IS NULL) AS rejected, count(SPONS_DFE_EIN) AS present FROM filings")
sql("map_fund_type", f"SELECT {FUND_TYPE} AS fund_type, count(*) AS filings FROM renamed GROUP BY ALL")
sql("fund_nodes", "SELECT * FROM funds")
sql("keep_last_payment", """SELECT fund_ein, manager_ein, cast(fee_paid AS double) AS fee_paid FROM (
  SELECT *, row_number() OVER (PARTITION BY fund_ein, manager_ein ORDER BY ACK_ID DESC NULLS LAST, line_no DESC NULLS LAST, fee_paid DESC NULLS LAST) AS rn FROM edges) WHERE rn = 1""")
sql("normalize_names", f"SELECT upper({strip('PROVIDER_OTHER_NAME')}) AS name, count(*) AS lines FROM lines GROUP BY ALL")
sql("fund_manager_edges", "SELECT fund_ein, manager_ein, manager_name, cast(fee_paid AS double) AS fee_paid FROM edges")
sql("distinct_fund_manager_pairs", "SELECT DISTINCT fund_ein, manager_ein FROM edges")
sql("number_coercion", f"""SELECT ACK_ID, cast(line_no AS varchar) AS line_key, coalesce({num("PROVIDER_OTHER_EIN")}, 0) AS ein_number,
  coalesce({num("PROVIDER_OTHER_NAME")}, -1) AS name_number, coalesce(cast(PROVIDER_OTHER_DIRECT_COMP_AMT AS double), 0) AS fee FROM lines""")
sql("fill_feature_defaults", f"SELECT ein, num_managers, total_fees, total_shared_managers, {RATIOS} FROM features")
sql("fill_all_text", "SELECT ACK_ID, coalesce(SPONS_DFE_EIN, '0') AS SPONS_DFE_EIN FROM filings")
sql("clip_values", """SELECT ACK_ID, line_no, CASE WHEN f IS NOT NULL THEN greatest(0.0, least(1.0, f)) END AS unit,
  CASE WHEN f IS NOT NULL THEN greatest(0.0, least(1e6, f)) END AS million
  FROM (SELECT *, cast(PROVIDER_OTHER_DIRECT_COMP_AMT AS double) AS f FROM lines)""")
sql("cast_properties", f"""SELECT ACK_ID, try_cast(SPONS_DFE_EIN AS double) AS SPONS_DFE_EIN, try_cast(ADMIN_NAME AS int) AS ADMIN_NAME,
  cast({num("ADMIN_EIN")} AS bigint) AS ADMIN_EIN FROM filings""")
sql("update_managers", """SELECT ein, spellings, community_id, same_parent_flag FROM (SELECT ein, count(*) AS spellings FROM managers GROUP BY ein)
  LEFT JOIN attrs ON ein = manager_ein""")
sql("lines_with_fund", "SELECT lines.ACK_ID, line_no, PROVIDER_OTHER_EIN, SPONS_DFE_EIN FROM lines LEFT JOIN filings USING (ACK_ID)")
sql("fund_fund_edges", "SELECT * FROM shares")
sql("co_client_pairs_per_manager", "SELECT * FROM (SELECT manager_ein, count(*) * (count(*) - 1) // 2 AS pairs FROM fees GROUP BY ALL) WHERE pairs > 0")
sql("rows_with_group_size", "SELECT ein, name, count(*) OVER (PARTITION BY ein) AS group_size FROM managers")
sql("assemble_fund_features", """SELECT ein, plan_name, fund_type, num_participants, num_managers, total_fees,
  round(top_manager_concentration, 6) AS top_manager_concentration, total_shared_managers FROM funds LEFT JOIN profile USING (ein) LEFT JOIN shared USING (ein)""")
SQL["assemble_fund_features_stored"] = SQL["assemble_fund_features"]
sql("valid_graph_edges", """SELECT fund_ein, manager_ein FROM fees WHERE fund_ein IN (SELECT ein FROM funds)
  AND manager_ein IN (SELECT ein FROM managers)""")
sql("lookup_manager_attributes", "SELECT manager_ein, fund_ein, community_id, same_parent_flag FROM fees LEFT JOIN attrs USING (manager_ein)")
SQL_OF_MANAGERS = "SELECT ein, name, cast(total_fees AS double) AS total_fees, num_clients FROM managers"
SQL_OF_FEES = "SELECT fund_ein AS ein, cast(coalesce(sum(fee_paid), 0) AS double) AS total_fees FROM edges GROUP BY ALL"
sql("manager_nodes", SQL_OF_MANAGERS)
sql("managers_per_fund", "SELECT fund_ein AS ein, count(DISTINCT manager_ein) AS num_managers FROM edges GROUP BY ALL")
sql("managers_per_fund_sketched", "SELECT fund_ein AS ein, count(DISTINCT manager_ein) AS num_managers, true AS within_5_percent FROM edges GROUP BY ALL")
sql("total_fees_per_fund", SQL_OF_FEES)
sql("top_manager_concentration", "SELECT ein, round(top_manager_concentration, 6) AS top_manager_concentration FROM profile")
sql("shared_manager_totals", "SELECT ein, total_shared_managers, total_shared_managers AS by_clients FROM shared")
sql("shared_manager_totals_concat", """SELECT fund_a AS ein, CASE WHEN n > 309 THEN 0.0 ELSE coalesce(try_cast(t AS double), 0.0) END AS total_shared_managers
  FROM (SELECT fund_a, length(ltrim(t, '0')) AS n, t FROM (SELECT fund_a, string_agg(cast(shared_managers AS varchar), '' ORDER BY fund_b) AS t FROM shares GROUP BY ALL))""")
sql("community_concentration", """SELECT ein, num_managers AS total_managers, manager_community_count,
  round(community_concentration, 6) AS community_concentration FROM profile""")
sql("same_parent_fee_ratio", "SELECT ein, total_fees, round(same_parent_fee_ratio, 6) AS same_parent_fee_ratio FROM profile")
sql("same_parent_fee_ratio_last", """SELECT fund_ein AS ein, sum(fee)::double AS total_fees, round(CASE WHEN sum(fee) = 0 THEN 0.0
  ELSE coalesce(sum(fee) FILTER (WHERE same_parent_flag = 1), 0)::double / sum(fee)::double END, 6) AS same_parent_fee_ratio
  FROM (SELECT fund_ein, manager_ein, coalesce(fee_paid, 0) AS fee FROM (SELECT *, row_number() OVER (PARTITION BY fund_ein, manager_ein
    ORDER BY ACK_ID DESC NULLS LAST, line_no DESC NULLS LAST, fee_paid DESC NULLS LAST) AS rn FROM edges) WHERE rn = 1) LEFT JOIN attrs USING (manager_ein) GROUP BY ALL""")
sql("shared_totals_of_hubs", """SELECT f AS ein, sum(c - 1)::bigint AS total_shared_managers FROM (
  SELECT f, count(*) OVER (PARTITION BY s_nationkey) AS c FROM (SELECT DISTINCT cast(o_custkey * 100 + (year(o_orderdate) - 1990) AS varchar) AS f, s_nationkey
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey)) GROUP BY f""")
sql("fund_profile", f"SELECT ein, num_managers, total_fees, coalesce(total_shared_managers, 0) AS total_shared_managers, manager_community_count, {RATIOS} FROM profile LEFT JOIN shared USING (ein)")
sql("table_row_counts", " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in ("filings", "lines", "funds", "managers", "edges")))
sql("risk_score_distribution", "SELECT risk_score, count(*) AS count FROM training GROUP BY ALL")
sql("label_distribution", "SELECT label, count(*) AS count FROM labelled GROUP BY ALL")
sql("class_balance", """SELECT cast(sum(label) AS bigint) AS positive, count(*) FILTER (WHERE label = 0) AS negative,
  round(avg(label) * 100, 6) AS positive_pct, round(avg(label), 6) AS balance FROM training""")
sql("feature_means_by_label", """SELECT label, round(avg(num_managers), 3) AS num_managers, round(avg(top_manager_concentration), 3) AS top_manager_concentration,
  round(avg(total_shared_managers), 3) AS total_shared_managers, round(avg(community_concentration), 3) AS community_concentration,
  round(avg(same_parent_fee_ratio), 3) AS same_parent_fee_ratio, round(avg(betweenness_score), 3) AS betweenness_score FROM training GROUP BY ALL""")
sql("describe_fund_features", " UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  round(cast(min({c}) AS double), 4) AS min, round(quantile_cont(cast({c} AS double), 0.25), 4) AS p25, round(quantile_cont(cast({c} AS double), 0.5), 4) AS p50,
  round(quantile_cont(cast({c} AS double), 0.75), 4) AS p75, round(cast(max({c}) AS double), 4) AS max FROM profile"""
    for c in ("num_managers", "total_fees", "community_concentration", "same_parent_fee_ratio")))
sql("class_weights", "SELECT label, count(*) AS count, round(sum(count(*)) OVER () / count(*), 6) AS weight FROM training GROUP BY label")
sql("top_manager_per_fund", """SELECT fund_ein, manager_ein, cast(fee_paid AS double) AS fee_paid FROM (
  SELECT *, row_number() OVER (PARTITION BY fund_ein ORDER BY fee_paid DESC, manager_ein) AS rn FROM fees) WHERE rn = 1""")
sql("fee_percentile", "SELECT ein, total_fees, round(fee_percentile, 6) AS fee_percentile FROM ranked")
sql("fee_percentile_by_fund_type", """SELECT ein, total_fees, fund_type, round((rank() OVER (PARTITION BY fund_type ORDER BY total_fees)
  + (count(*) OVER (PARTITION BY fund_type, total_fees) - 1) / 2.0) / count(*) OVER (PARTITION BY fund_type), 6) AS fee_percentile
  FROM profile JOIN funds USING (ein)""")
sql("largest_managers", "SELECT ein, cast(sum(total_fees) AS double) AS total_fees FROM managers GROUP BY ein ORDER BY 2 DESC, 1 LIMIT 10")
sql("preview_funds", "SELECT ein, plan_name, fund_type, num_participants FROM funds ORDER BY ein LIMIT 5")
sql("dense_node_index", "SELECT ein, row_number() OVER (ORDER BY ein) - 1 AS idx FROM funds")

# ---- entity resolution


def clean(c: str) -> str:
    x = strip(f"upper({c})")
    x = f"regexp_replace({x}, '\\b(" + "|".join(LEGAL_WORDS) + ")\\b', '', 'g')"
    x = strip(f"regexp_replace({x}, '[^A-Z0-9 ]', '', 'g')")
    return f"regexp_replace({x}, '{B}+', ' ', 'g')"


def tokens(c: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split_regex({c}, '{B}+'), lambda t: t <> '')), ' ')"


def person(c: str) -> str:
    marks = " OR ".join(f"contains(upper({c}), '{m}')" for m in COMPANY_MARKS)
    return f"(len(list_filter(string_split_regex({c}, '{B}+'), lambda t: t <> '')) <= 3 AND NOT ({marks}))"


FULL = (1 << 62) - 1


def masks(name: str, source: str) -> str:
    """Per name: for each character, the bit set of its positions (names up to 62 characters)."""
    return f"""{name} AS (SELECT name, map_from_entries(list((ch, m))) AS at FROM (
      SELECT name, ch, bit_or(1::BIGINT << (pos - 1)) AS m FROM (
        SELECT name, unnest(string_split(name, '')) AS ch, generate_subscripts(string_split(name, ''), 1) AS pos FROM {source})
      GROUP BY name, ch) GROUP BY name)"""


def ratio(a: str, b: str, at: str) -> str:
    """200 * LCS / (|a| + |b|): bit-parallel LCS of b against the masks of a."""
    bits = f"list_transform(string_split({b}, ''), lambda c: coalesce({at}[c], 0::BIGINT))"
    left = f"list_reduce(list_prepend({FULL}::BIGINT, {bits}), lambda s, m: ((s + (s & m)) | (s & (~m))) & {FULL}::BIGINT)"
    return f"CASE WHEN {a} = {b} THEN 100.0 WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE 200.0 * (62 - bit_count({left})) / (length({a}) + length({b})) END"


PREPARED = f"""prepared AS MATERIALIZED (SELECT *, {tokens('name_clean')} AS sorted_name FROM (
  SELECT *, {clean('name')} AS name_clean FROM managers WHERE NOT {person('name')}))"""

PAIRS = f"""{PREPARED},
snames AS (SELECT DISTINCT sorted_name AS name FROM prepared WHERE sorted_name <> ''),
{masks('masked', 'snames')},
scored_pairs AS MATERIALIZED (SELECT a.name AS a, b.name AS b, {ratio('a.name', 'b.name', 'a.at')} AS score
  FROM masked a JOIN snames b ON a.name < b.name
  WHERE least(length(a.name), length(b.name)) * 23 >= 17 * greatest(length(a.name), length(b.name))),
similar_p AS MATERIALIZED (SELECT * FROM scored_pairs WHERE score >= 85)"""


def greedy(rounds: int = 4) -> str:
    """Leaders: an EIN no earlier leader covers; decided in unrolled rounds."""
    parts = [f"""{PAIRS},
near AS (SELECT a AS x, b AS y FROM similar_p UNION ALL SELECT b, a FROM similar_p UNION ALL SELECT DISTINCT sorted_name, sorted_name FROM prepared),
firsts AS (SELECT ein, arg_min(sorted_name, name) AS fname FROM prepared GROUP BY ein),
cover AS MATERIALIZED (SELECT DISTINCT f.ein AS e, p.ein AS f FROM firsts f JOIN near ON near.x = f.fname JOIN prepared p ON p.sorted_name = near.y AND f.ein < p.ein),
lead0 AS MATERIALIZED (SELECT ein FROM firsts WHERE ein NOT IN (SELECT f FROM cover)),
led0 AS MATERIALIZED (SELECT DISTINCT f FROM cover WHERE e IN (SELECT ein FROM lead0))"""]
    for i in range(1, rounds):
        p = i - 1
        parts.append(f"""lead{i} AS MATERIALIZED (SELECT ein FROM firsts WHERE ein NOT IN (SELECT f FROM led{p}) AND ein NOT IN (
  SELECT f FROM cover WHERE e NOT IN (SELECT f FROM led{p}))),
led{i} AS MATERIALIZED (SELECT DISTINCT f FROM cover WHERE e IN (SELECT ein FROM lead{i}))""")
    last = rounds - 1
    parts.append(f"""taken AS (SELECT ein AS f, ein AS e FROM lead{last} UNION ALL SELECT f, e FROM cover WHERE e IN (SELECT ein FROM lead{last})),
owner AS (SELECT f AS ein, min(e) AS leader FROM taken GROUP BY f),
numbered AS (SELECT ein AS leader, row_number() OVER (ORDER BY ein) - 1 AS parent_group_id FROM lead{last}),
grouped AS (SELECT ein, parent_group_id FROM owner JOIN numbered USING (leader)),
enriched AS (SELECT ein, name, cast(total_fees AS double) AS total_fees, num_clients, name_clean, parent_group_id,
  count(*) OVER (PARTITION BY parent_group_id) AS group_size,
  cast(count(*) OVER (PARTITION BY parent_group_id) > 1 AS int) AS same_parent_flag FROM prepared LEFT JOIN grouped USING (ein))""")
    return ",\n".join(parts)


sql("clean_names", f"SELECT name_clean, {tokens('name_clean')} AS sorted_name, lines FROM (SELECT {clean('PROVIDER_OTHER_NAME')} AS name_clean, count(*) AS lines FROM lines GROUP BY ALL)")
sql("person_names", f"SELECT ein, name, {person('name')} AS is_person FROM managers")
sql("name_thresholds", f"SELECT CASE WHEN length(trim({clean('name')})) <= 5 THEN 95 ELSE 85 END AS by_length, 85 AS constant, count(*) AS names FROM managers GROUP BY ALL")
sql("spelling_similarity", f"SELECT ein, name, round({ratio('a', 'b', 'm.at')}, 6) AS score FROM forms LEFT JOIN masked m ON m.name = a",
    f"""forms AS (SELECT ein, mn AS name, {tokens('cn')} AS a, {tokens('cf')} AS b FROM (
      SELECT ein, name AS mn, {clean('name')} AS cn, {clean('min(name) OVER (PARTITION BY ein)')} AS cf FROM managers)),
    anames AS (SELECT DISTINCT a AS name FROM forms), {masks('masked', 'anames')}""")
SQL["spelling_similarity"] = SQL["spelling_similarity"].replace("SELECT ein, name, round", "SELECT ein, forms.name AS name, round")
sql("similar_names", "SELECT a, b, round(score, 6) AS score FROM similar_p", PAIRS)
sql("enriched_managers", "SELECT * FROM enriched", greedy())
sql("parent_group_sizes", "SELECT parent_group_id, count(*) AS group_size, count(DISTINCT ein) AS distinct_eins FROM enriched GROUP BY ALL", greedy())
sql("parent_group_summary", "SELECT cast(sum(same_parent_flag) AS bigint) AS flagged, count(DISTINCT parent_group_id) AS groups FROM enriched", greedy())


def min_labels(nodes: str, links: str, rounds: int) -> str:
    """Smallest id reachable, by unrolled rounds over links (x, y) in both directions."""
    out = [f"c0 AS MATERIALIZED (SELECT id, id AS c FROM ({nodes}))"]
    for i in range(1, rounds + 1):
        out.append(f"""c{i} AS MATERIALIZED (SELECT id, min(c) AS c FROM (SELECT id, c FROM c{i - 1}
  UNION ALL SELECT y, c FROM c{i - 1} JOIN {links} ON x = id) GROUP BY id)""")
    return ",\n".join(out)


sql("name_component_groups", "SELECT substr(id, 3) AS ein, substr(c, 3) AS component FROM c10 WHERE id LIKE 'e:%'", f"""{PAIRS},
one AS (SELECT DISTINCT 'e:' || ein AS x, 'n:' || sorted_name AS y FROM prepared UNION SELECT 'n:' || a, 'n:' || b FROM similar_p),
linked AS MATERIALIZED (SELECT x, y FROM one UNION ALL SELECT y, x FROM one),
{min_labels("SELECT DISTINCT x AS id FROM linked", "linked", 10)}""")

# ---- graph

GRAPH = """fund_n AS (SELECT 'PensionFund:' || ein AS id, 'PensionFund' AS label, ein, plan_name AS name, sponsor_name, fund_type, num_participants, admin_name, state,
  cast(NULL AS double) AS total_fees, cast(NULL AS bigint) AS num_clients FROM funds),
mgr_n AS (SELECT 'AssetManager:' || ein AS id, 'AssetManager' AS label, ein, name, cast(NULL AS varchar) AS sponsor_name, cast(NULL AS varchar) AS fund_type,
  cast(NULL AS bigint) AS num_participants, cast(NULL AS varchar) AS admin_name, cast(NULL AS varchar) AS state, cast(total_fees AS double) AS total_fees, num_clients
  FROM (SELECT *, row_number() OVER (PARTITION BY ein ORDER BY name DESC) AS rn FROM managers) WHERE rn = 1),
gnodes AS MATERIALIZED (SELECT * FROM fund_n UNION ALL SELECT * FROM mgr_n),
last_e AS (SELECT fund_ein, manager_ein, fee_paid FROM (SELECT *, row_number() OVER (PARTITION BY fund_ein, manager_ein
  ORDER BY ACK_ID DESC NULLS LAST, line_no DESC NULLS LAST, fee_paid DESC NULLS LAST) AS rn FROM edges
  WHERE fund_ein IN (SELECT ein FROM funds) AND manager_ein IN (SELECT ein FROM managers)) WHERE rn = 1),
gedges AS MATERIALIZED (SELECT 'PensionFund:' || fund_ein AS src, 'AssetManager:' || manager_ein AS dst, 'ALLOCATED_TO' AS type, cast(fee_paid AS double) AS weight FROM last_e),
sum_e AS MATERIALIZED (SELECT 'PensionFund:' || fund_ein AS src, 'AssetManager:' || manager_ein AS dst, cast(sum(fee_paid) AS double) AS weight FROM edges
  WHERE fund_ein IN (SELECT ein FROM funds) AND manager_ein IN (SELECT ein FROM managers) GROUP BY ALL)"""

sql("graph_nodes", "SELECT * FROM gnodes", GRAPH)
sql("graph_edges", """SELECT * FROM gedges UNION ALL SELECT 'PensionFund:' || fund_a, 'PensionFund:' || fund_b, 'SHARES_MANAGER_WITH', shared_managers::double
  FROM shares WHERE fund_a < fund_b AND fund_a IN (SELECT ein FROM funds) AND fund_b IN (SELECT ein FROM funds)""", GRAPH)
sql("graph_label_counts", "SELECT label, count(*) AS count FROM gnodes GROUP BY ALL", GRAPH)
sql("merged_fund_nodes", "SELECT * FROM funds")
sql("merged_graph_edges", "SELECT * FROM gedges", GRAPH)
sql("streamed_manager_nodes", SQL_OF_MANAGERS)
sql("streamed_total_fees", SQL_OF_FEES)
sql("project_reverse", "SELECT dst AS src, src AS dst, type, weight FROM gedges", GRAPH)
sql("induced_manager_subgraph", """SELECT 'nodes' AS "table", count(*) AS rows FROM gnodes WHERE label = 'AssetManager'
  UNION ALL SELECT 'edges', count(*) FROM gedges WHERE src IN (SELECT id FROM gnodes WHERE label = 'AssetManager')""", GRAPH)
sql("expand_allocations", "SELECT a.ein AS src_ein, b.ein AS dst_ein, weight FROM gedges JOIN gnodes a ON a.id = src JOIN gnodes b ON b.id = dst", GRAPH)
sql("undirected_edges", "SELECT fund_ein, manager_ein, 'forward' AS rel FROM fees UNION ALL SELECT manager_ein, fund_ein, 'reverse' FROM fees")


def rank_rounds(links: str, rounds: int = 20) -> str:
    out = [f"""w_out AS (SELECT src, sum(w) AS o FROM {links} GROUP BY src),
share AS MATERIALIZED (SELECT l.src, l.dst, w / o AS s FROM {links} l JOIN w_out USING (src)),
r0 AS (SELECT id, 0.15::double AS pr FROM gnodes)"""]
    for i in range(1, rounds + 1):
        out.append(f"""r{i} AS MATERIALIZED (SELECT id, 0.15 + 0.85 * coalesce(c, 0.0) AS pr FROM gnodes LEFT JOIN (
  SELECT dst, sum(pr * s) AS c FROM r{i - 1} JOIN share ON src = id GROUP BY dst) ON dst = id)""")
    return ",\n".join(out)


def both_ways(table: str, w: str) -> str:
    return f"""links AS (SELECT * FROM (SELECT src, dst, {w} AS w FROM {table} UNION ALL SELECT dst, src, {w} FROM {table}) WHERE w > 0)"""


RANK = "SELECT id, round(pr, 5) AS pagerank_score FROM r20"
sql("pagerank_unweighted", RANK, f"{GRAPH}, {both_ways('gedges', '1.0::double')}, {rank_rounds('links')}")
sql("pagerank_by_fees", RANK, f"{GRAPH}, {both_ways('sum_e', 'coalesce(weight, 0.0)')}, {rank_rounds('links')}")
sql("pagerank_managers_only", "SELECT id, 0.15::double AS pagerank_score FROM gnodes WHERE label = 'AssetManager'", GRAPH)
sql("connected_components", "SELECT id, c AS component FROM c14", f"""{GRAPH},
linked AS MATERIALIZED (SELECT src AS x, dst AS y FROM gedges UNION ALL SELECT dst, src FROM gedges), {min_labels("SELECT id FROM gnodes", "linked", 14)}""")
sql("circular_payments", """SELECT id, component, cast(count(*) OVER (PARTITION BY component) > 1 AS int) AS in_circular_pattern FROM (
  SELECT id, coalesce(max(r.t), id) AS component FROM ids LEFT JOIN (SELECT f.s, f.t FROM reach f JOIN reach b ON f.s = b.t AND f.t = b.s) r ON r.s = id GROUP BY id)""",
    """pay AS (SELECT DISTINCT cast(o_custkey AS varchar) AS src, cast(l_partkey AS varchar) AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ids AS (SELECT src AS id FROM pay UNION SELECT dst FROM pay),
loops AS MATERIALIZED (SELECT src, dst FROM pay WHERE src <> dst AND src IN (SELECT dst FROM pay) AND dst IN (SELECT src FROM pay)),
reach AS (SELECT src AS s, dst AS t FROM loops UNION SELECT s, dst FROM reach JOIN loops ON t = src)""", recursive=True)
sql("circular_flag_by_label", "SELECT 0 AS in_circular_pattern, count(*) AS nodes FROM gnodes", GRAPH)


def brandes(nodes: str, k: int | None, depth: int) -> str:
    some = f" ORDER BY md5(id), id LIMIT {k}" if k else ""
    out = [f"""bc_e AS MATERIALIZED (SELECT src AS u, dst AS v FROM bc_src UNION SELECT dst, src FROM bc_src),
pivots AS MATERIALIZED (SELECT id FROM {nodes}{some}),
l0 AS MATERIALIZED (SELECT id AS source, id AS node, 1.0::double AS paths FROM pivots)"""]
    for i in range(1, depth + 1):
        seen = " ".join(f"ANTI JOIN l{j} s{j} ON s{j}.source = t.source AND s{j}.node = t.node" for j in range(max(0, i - 2), i))
        out.append(f"""l{i} AS MATERIALIZED (SELECT t.* FROM (SELECT source, v AS node, sum(paths) AS paths FROM l{i - 1} JOIN bc_e ON u = node GROUP BY ALL) t {seen})""")
    out.append(f"d{depth} AS MATERIALIZED (SELECT *, 0.0::double AS delta FROM l{depth})")
    for i in range(depth - 1, -1, -1):
        out.append(f"""d{i} AS MATERIALIZED (SELECT l.source, l.node, l.paths, coalesce(l.paths * c, 0.0) AS delta FROM l{i} l LEFT JOIN (
  SELECT source, v AS node, sum((1 + delta) / paths) AS c FROM d{i + 1} JOIN bc_e ON u = node GROUP BY ALL) x ON x.source = l.source AND x.node = l.node)""")
    union = " UNION ALL ".join(f"SELECT node, delta FROM d{i} WHERE source <> node" for i in range(depth + 1))
    out.append(f"bc AS (SELECT node, sum(delta) AS delta FROM ({union}) GROUP BY node)")
    return ",\n".join(out)


def bc_select(nodes: str, k: int) -> str:
    return f"SELECT id, round(coalesce(delta, 0.0) * 0.5 * (SELECT count(*) FROM {nodes}) / {k}.0 + 1e-5, 2) AS betweenness_score FROM {nodes} LEFT JOIN bc ON node = id"


sql("betweenness_sampled", bc_select("gnodes", 16), f"{GRAPH}, bc_src AS (SELECT src, dst FROM gedges), {brandes('gnodes', 16, 12)}")
sql("betweenness_exact", "SELECT id, round(coalesce(delta, 0.0) * 0.5 + 1e-7, 4) AS betweenness_score FROM nb_nodes LEFT JOIN bc ON node = id",
    f"""bc_src AS MATERIALIZED (SELECT DISTINCT 'nation:' || c_nationkey AS src, p_brand || ' ' || p_size AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey),
nb_nodes AS (SELECT src AS id FROM bc_src UNION SELECT dst FROM bc_src), {brandes('nb_nodes', 1 << 40, 8)}""")
SHARED_EDGES = """sh AS MATERIALIZED (SELECT 'PensionFund:' || fund_a AS src, 'PensionFund:' || fund_b AS dst, shared_managers AS w FROM shares WHERE fund_a < fund_b),
fnodes AS MATERIALIZED (SELECT 'PensionFund:' || ein AS id, fund_type FROM funds)"""
sql("betweenness_funds_sampled", bc_select("fnodes", 4), f"{SHARED_EDGES}, bc_src AS (SELECT src, dst FROM sh), {brandes('fnodes', 4, 8)}")
SIMILAR = """SELECT src, dst, round(similarity_score, 6) AS similarity_score FROM (
  SELECT *, row_number() OVER (PARTITION BY src ORDER BY similarity_score DESC, dst) AS rn FROM (
    SELECT a.src, b.src AS dst, count(*) / (any_value(a.n) + any_value(b.n) - count(*)) AS similarity_score
    FROM sized a JOIN sized b ON a.m = b.m AND a.src <> b.src GROUP BY a.src, b.src) WHERE similarity_score >= 0.5) WHERE rn <= 5"""
sql("similar_funds", SIMILAR, "sized AS MATERIALIZED (SELECT fund_ein AS src, manager_ein AS m, count(*) OVER (PARTITION BY fund_ein) AS n FROM fees)")
sql("similar_portfolios", SIMILAR,
    f"""sets AS (SELECT DISTINCT ACK_ID AS src, {ein('PROVIDER_OTHER_EIN')} AS m FROM lines WHERE PROVIDER_OTHER_EIN IS NOT NULL),
sized AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY src) AS n FROM sets)""")
SQL["louvain_customer_stars"] = """WITH star AS (SELECT 'order:' || o_orderkey AS id, 'customer:' || o_custkey AS hub FROM orders UNION SELECT 'customer:' || o_custkey, 'customer:' || o_custkey FROM orders)
SELECT id, min(id) OVER (PARTITION BY hub) AS community, count(*) OVER (PARTITION BY hub) AS members FROM star"""
sql("modularity_by_fund_type", """SELECT round(sum(inside) / sum(tot) - sum(tot * tot) / (sum(tot) * sum(tot)), 8) AS modularity FROM (
  SELECT a.fund_type AS c, sum(w)::double AS tot, coalesce(sum(w) FILTER (WHERE a.fund_type = b.fund_type), 0)::double AS inside
  FROM (SELECT src, dst, w FROM sh UNION ALL SELECT dst, src, w FROM sh) e JOIN fnodes a ON a.id = e.src JOIN fnodes b ON b.id = e.dst GROUP BY a.fund_type)""", SHARED_EDGES)

# ---- the chain: entity groups and graph metrics into exports and labels

CHAINED_ATTRS = """groups AS (SELECT ein, any_value(parent_group_id) AS parent_group_id, any_value(group_size) AS group_size, any_value(same_parent_flag) AS same_parent_flag FROM enriched GROUP BY ein),
attrs AS MATERIALIZED (SELECT m.ein AS manager_ein, community_id, groups.same_parent_flag FROM (SELECT DISTINCT ein FROM managers) m LEFT JOIN attrs0 ON m.ein = attrs0.manager_ein LEFT JOIN groups ON m.ein = groups.ein)"""
CHAIN = PRELUDE.replace("attrs AS (", "attrs0 AS (").replace("\nedges AS (", f"\n{greedy()},\n{CHAINED_ATTRS},\nedges AS (")
SEGMENTS = """segments AS (SELECT DISTINCT cast(o_custkey * 100 + (year(o_orderdate) - 1990) AS varchar) AS ein, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey)"""
CHAIN_BC = f"{GRAPH}, bc_src AS (SELECT src, dst FROM gedges), {brandes('gnodes', 16, 12)}, " + """between AS (
  SELECT id, round(coalesce(delta, 0.0) * 0.5 * (SELECT count(*) FROM gnodes) / 16.0 + 1e-5, 2) AS score FROM gnodes LEFT JOIN bc ON node = id),
""" + SEGMENTS
# all nodes as sources, by number
CHAIN_EXACT = f"""{GRAPH}, num AS MATERIALIZED (SELECT id AS name, cast(row_number() OVER (ORDER BY id) AS integer) AS id FROM gnodes),
bc_src AS (SELECT a.id AS src, b.id AS dst FROM gedges JOIN num a ON src = a.name JOIN num b ON dst = b.name), {brandes('num', None, 16)}, between AS (
  SELECT name AS id, round(coalesce(delta, 0.0) * 0.5 + 1e-5, 2) AS score FROM num LEFT JOIN bc ON node = num.id),
{SEGMENTS}"""
SQL["fund_score_export"] = f"""WITH {CHAIN}, {CHAIN_EXACT}
SELECT ein, c_mktsegment AS community_id, score AS betweenness_score, num_managers AS total_managers, manager_community_count,
  round(community_concentration, 6) AS community_concentration, total_fees, round(same_parent_fee_ratio, 6) AS same_parent_fee_ratio, 0 AS in_circular_pattern
FROM funds LEFT JOIN profile USING (ein) LEFT JOIN segments USING (ein) LEFT JOIN between ON id = 'PensionFund:' || ein"""
SQL["manager_score_export"] = f"""WITH {CHAIN}, {GRAPH}, {both_ways('gedges', '1.0::double')}, {rank_rounds('links')}
SELECT mgr_n.ein, name, round(pr, 5) AS pagerank_score, num_clients, total_fees, attrs.same_parent_flag, parent_group_id, group_size, community_id
FROM mgr_n LEFT JOIN r20 USING (id) LEFT JOIN attrs ON mgr_n.ein = manager_ein LEFT JOIN groups ON mgr_n.ein = groups.ein"""
SQL["first_fund_score_export"] = f"""WITH {CHAIN}, {SEGMENTS}
SELECT ein, c_mktsegment AS community_id, 'PensionFund:' || ein AS scc_id, 0 AS in_circular_pattern FROM funds LEFT JOIN segments USING (ein)"""
SQL["first_manager_score_export"] = f"""WITH {CHAIN}, {GRAPH}
SELECT mgr_n.ein, name, 0.15::double AS pagerank_score, 0.0::double AS betweenness_score, community_id, attrs.same_parent_flag, parent_group_id
FROM mgr_n LEFT JOIN attrs ON mgr_n.ein = manager_ein LEFT JOIN groups ON mgr_n.ein = groups.ein"""
SQL["risk_labels_chained"] = f"""WITH {CHAIN}, {CHAIN_BC}
SELECT ein, plan_name, fund_type, num_participants, num_managers, total_fees, round(fee_percentile, 6) AS fee_percentile, total_shared_managers,
  score AS betweenness_score, in_circular_pattern, has_manager_data, risk_score, label, {RATIOS} FROM labelled JOIN between ON id = 'PensionFund:' || ein"""

# ---- features, split, metrics

FUND_X = """fund_x AS (SELECT ein, label, num_managers::double AS num_managers, top_manager_concentration, fee_percentile,
  least(1e6, total_shared_managers::double) AS total_shared_managers, community_concentration, same_parent_fee_ratio, betweenness_score,
  in_circular_pattern::double AS in_circular_pattern FROM training)"""
FUND_COLS = ("num_managers", "top_manager_concentration", "fee_percentile", "total_shared_managers", "community_concentration",
             "same_parent_fee_ratio", "betweenness_score", "in_circular_pattern")
MANAGER_X = """manager_x AS (SELECT m.ein, m.name, m.num_clients::double AS num_clients, cast(m.total_fees AS double) AS total_fees,
  coalesce(same_parent_flag, 0)::double AS same_parent_flag, (count(*) OVER (PARTITION BY m.ein))::double AS group_size,
  coalesce(CASE WHEN p_size <= 45 THEN p_size / 100.0 END, 0.15)::double AS pagerank_score
  FROM managers m LEFT JOIN attrs ON m.ein = manager_ein LEFT JOIN part ON m.ein = cast(p_partkey AS varchar))"""
sql("fund_feature_matrix", "SELECT ein, label, " + ", ".join(f"round({c}, 6) AS {c}" for c in FUND_COLS) + " FROM fund_x", FUND_X)
sql("manager_feature_matrix", """SELECT ein, name, num_clients, round(total_fees, 6) AS total_fees, same_parent_flag, group_size,
  round(pagerank_score, 6) AS pagerank_score FROM manager_x""", MANAGER_X)
sql("standardized_fund_features", "SELECT ein, label, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / (CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END), 5) AS {c}" for c in FUND_COLS) + " FROM fund_x", FUND_X)
sql("stratified_split", """SELECT ein, label, CASE WHEN rn <= t THEN 'test' WHEN rn <= t + round((n - t) * 0.15) THEN 'val' ELSE 'train' END AS split FROM (
  SELECT *, round(n * 0.2) AS t FROM (SELECT ein, fund_type AS label, count(*) OVER (PARTITION BY fund_type) AS n,
    row_number() OVER (PARTITION BY fund_type ORDER BY md5(ein || '#42'), ein) AS rn FROM funds))""")
MANAGER_COLS = ("num_clients", "total_fees", "same_parent_flag", "group_size", "pagerank_score")


def shifted(expr: str, name: str) -> str:
    return f"round({expr} + 1e-4, 2) AS {name}" if name.startswith(("total_fees", "total_shared_managers", "betweenness_score")) else f"round({expr} + 1e-7, 5) AS {name}"


TWO_HOPS = "SELECT ein, " + ", ".join([*[shifted(c, c) for c in FUND_COLS], *[shifted(f"coalesce({c}_h1, 0)", f"{c}_h1") for c in MANAGER_COLS], *[shifted(f"coalesce({c}_h2, 0)", f"{c}_h2") for c in FUND_COLS]]) + " FROM fund_x LEFT JOIN f1 USING (ein) LEFT JOIN f2 USING (ein)"
HOPS = f"""mx AS (SELECT ein, {", ".join(f"arg_max({c}, name) AS {c}" for c in MANAGER_COLS)} FROM manager_x GROUP BY ein),
  ve AS (SELECT fund_ein, manager_ein FROM edges WHERE fund_ein IN (SELECT ein FROM fund_x) AND manager_ein IN (SELECT ein FROM mx)),
  f1 AS (SELECT fund_ein AS ein, {", ".join(f"avg({c}) AS {c}_h1" for c in MANAGER_COLS)} FROM ve JOIN mx ON manager_ein = ein GROUP BY fund_ein),
  m1 AS (SELECT manager_ein AS ein, {", ".join(f"avg({c}) AS {c}" for c in FUND_COLS)} FROM ve JOIN fund_x ON fund_ein = ein GROUP BY manager_ein),
  f2 AS (SELECT fund_ein AS ein, {", ".join(f"avg({c}) AS {c}_h2" for c in FUND_COLS)} FROM ve JOIN m1 ON manager_ein = ein GROUP BY fund_ein)"""
sql("propagate_two_hops", TWO_HOPS, f"{FUND_X}, {MANAGER_X}, {HOPS}")
# the same on the scores of the chain
CHAINED_FUND_X = "scored_funds AS (SELECT training.* REPLACE (score AS betweenness_score) FROM training JOIN between ON id = 'PensionFund:' || ein),\n" + FUND_X.replace(
    "betweenness_score,", "greatest(0.0, least(1e6, betweenness_score)) AS betweenness_score,").replace("FROM training", "FROM scored_funds")
CHAINED_MANAGER_X = """manager_x AS (SELECT mgr_n.ein, name, coalesce(num_clients, 0)::double AS num_clients, coalesce(total_fees, 0)::double AS total_fees,
  coalesce(attrs.same_parent_flag, 0)::double AS same_parent_flag, coalesce(group_size, 0)::double AS group_size, coalesce(pr, 0.15)::double AS pagerank_score
  FROM mgr_n LEFT JOIN r20 USING (id) LEFT JOIN attrs ON mgr_n.ein = manager_ein LEFT JOIN groups ON mgr_n.ein = groups.ein)"""
CHAINED_RANK = f"{both_ways('gedges', '1.0::double')}, {rank_rounds('links')}"
SQL["fund_feature_matrix_chained"] = f"WITH {CHAIN}, {CHAIN_BC}, {CHAINED_FUND_X} SELECT ein, label, " + ", ".join(f"round({c}, 6) AS {c}" for c in FUND_COLS) + " FROM fund_x"
SQL["manager_feature_matrix_chained"] = f"WITH {CHAIN}, {GRAPH}, {CHAINED_RANK}, {CHAINED_MANAGER_X} SELECT ein, name, " + ", ".join(f"round({c}, 5) AS {c}" for c in MANAGER_COLS) + " FROM manager_x"
SQL["propagate_two_hops_chained"] = f"WITH {CHAIN}, {CHAIN_BC}, {CHAINED_RANK}, {CHAINED_FUND_X}, {CHAINED_MANAGER_X}, {HOPS} {TWO_HOPS}"

PRED = """pred AS (SELECT doc_id, quality AS label, 1 - toxic AS prediction, (ascii(substr(md5(cast(doc_id AS varchar)), 1, 1)) - 40) / 80.0 AS p1 FROM labels),
cls AS (SELECT c, count(*) FILTER (WHERE label = c) AS support, count(*) FILTER (WHERE prediction = c) AS predicted,
  count(*) FILTER (WHERE label = c AND prediction = c) AS tp FROM pred, (SELECT DISTINCT unnest([label, prediction]) AS c FROM pred) GROUP BY c),
pr AS (SELECT c, support, tp, CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS p, CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS r FROM cls),
prf AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM pr)"""
sql("confusion_table", "SELECT label AS y, prediction AS yhat, count(*) AS n FROM pred GROUP BY ALL", PRED)
sql("weighted_scores", """SELECT round(sum(f * support) / sum(support), 6) AS f1, round(sum(p * support) / sum(support), 6) AS "precision",
  round(sum(r * support) / sum(support), 6) AS recall FROM prf""", PRED)
sql("roc_auc", """SELECT round(sum(CASE WHEN a.p1 > b.p1 THEN 1.0 WHEN a.p1 = b.p1 THEN 0.5 ELSE 0.0 END) / count(*), 6) AS auc
  FROM pred a JOIN pred b ON a.label = 1 AND b.label = 0""", PRED)
sql("classification_report", """SELECT cast(c AS varchar) AS "row", round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1, support FROM prf
  UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), cast(sum(support) AS bigint) FROM prf
  UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), cast(sum(support) AS bigint) FROM prf
  UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6), cast(sum(support) AS bigint) FROM prf""", PRED)
sql("log_loss", """SELECT round(sum(w * -ln(CASE WHEN label = 1 THEN p1 ELSE 1 - p1 END)) / sum(w), 6) AS log_loss
  FROM (SELECT *, count(*) OVER () / count(*) OVER (PARTITION BY label) AS w FROM pred)""", PRED)
sql("best_fund_type", """SELECT fund_type, score FROM (SELECT fund_type, round(avg(fee_percentile), 6) AS score FROM training GROUP BY fund_type)
  ORDER BY score DESC, fund_type LIMIT 1""")
