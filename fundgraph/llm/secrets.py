"""Secret scan over a trigram inverted index.

Each rule's regex gives a Boolean query over trigrams that every match must hold
(an AND of ORs).  The index holds postings (trigram, document) for the trigrams
those queries name; a query intersects and unites postings, the documents it
leaves are candidates, and only on them the rule's regex runs.  A rule without a
mandatory trigram scans every text.

Nulls: a null text is empty and has no span; a null doc_id is a key like any
other.  Rows that repeat doc_id and text get the same result, each its own row.
An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import re._parser as sre
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fundgraph.llm.common import texts


@dataclass(frozen=True)
class Rule:
    """``least``: characters that the last group (or the whole match, without groups) must have."""

    name: str
    regex: str
    least: int = 1
    group: int = 0


#: The three base rules, in the order that breaks ties between equal starts.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Token formats with a known prefix, which add spans to the base.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

#: A trigram query: every inner list is an alternative set, one member (an AND of trigrams) of each must hold.
Query = list[list[frozenset[str]]]


def trigrams(literal: str) -> frozenset[str]:
    return frozenset(literal[i : i + 3] for i in range(len(literal) - 2))


def trigram_query(regex: str) -> Query:
    """Mandatory trigrams of a regex, lower case; empty if none is mandatory."""
    return mandatory(sre.parse(regex))


def mandatory(parts) -> Query:
    """Literal runs give one AND each; a choice gives an OR if each way has trigrams; a repeat counts if it runs at least once."""
    query: Query = []
    run = ""
    for op, arg in [*parts, (None, None)]:
        if op is sre.LITERAL:
            run += chr(arg)
            continue
        if grams := trigrams(run.lower()):
            query.append([grams])
        run = ""
        if op is sre.SUBPATTERN:
            query += mandatory(arg[3])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0]:
            query += mandatory(arg[2])
        elif op is sre.BRANCH:
            ways = [frozenset().union(*(either[0] for either in mandatory(way) if len(either) == 1)) for way in arg[1]]
            if all(ways):
                query.append(ways)
    return query


def holds(query: Query, has: dict[str, Column]) -> Column:
    """The query as a condition on one flag for each trigram."""
    every = [reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [has[t] for t in sorted(grams)]) for grams in either]) for either in query]
    return reduce(lambda a, b: a & b, every)


def postings(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """The inverted index (trigram, doc_id, text_key): a row for each of the vocabulary's trigrams that a text holds."""
    low = F.lower("text")
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in vocabulary]))
    return docs.select("doc_id", "text_key", low.alias("low")).select("doc_id", "text_key", F.explode(found).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> tuple[DataFrame, dict[str, str]]:
    """Documents that pass at least one rule's trigram query, with a flag for each; and the flag's name by rule.

    All postings of a document come from one task, so the aggregation combines
    them before the shuffle: a frequent trigram is never gathered as one list.
    """
    queries = {r.name: q for r in rules if (q := trigram_query(r.regex))}
    vocabulary = sorted({t for q in queries.values() for either in q for grams in either for t in grams})
    has = {t: F.col(f"has_{i}") for i, t in enumerate(vocabulary)}
    flags = {name: f"may_{name}" for name in queries}
    lists = postings(docs, vocabulary).groupBy("doc_id", "text_key").agg(*[F.bool_or(F.col("trigram") == t).alias(f"has_{i}") for i, t in enumerate(vocabulary)])
    found = lists.select("doc_id", "text_key", *[holds(queries[name], has).alias(flag) for name, flag in flags.items()])
    return found.filter(reduce(lambda a, b: a | b, [F.col(x) for x in flags.values()])), flags


def spans(text: Column, rule: Rule, order: int) -> Column:
    """All matches as (start, kind, end), code points: texts between matches and matches, added up."""
    regex = F.lit(rule.regex)
    between, found = F.split(text, rule.regex, -1), F.regexp_extract_all(text, regex, F.lit(0))
    held = F.regexp_extract_all(text, regex, F.lit(rule.group))
    pairs = F.arrays_zip(between.alias("b"), found.alias("m"), held.alias("g"))
    kind = "array<struct<start:int,kind:int,end:int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begins = acc["at"] + F.length(F.coalesce(x["b"], F.lit("")))
        ends = begins + F.length(F.coalesce(x["m"], F.lit("")))
        one = F.struct(begins.alias("start"), F.lit(order).alias("kind"), ends.alias("end"))
        keep = F.length(x["g"]) >= rule.least
        return F.struct(ends.alias("at"), F.when(keep, F.concat(acc["out"], F.array(one))).otherwise(acc["out"]).alias("out"))

    walked = F.aggregate(pairs, start, step, lambda acc: acc["out"])
    return F.when(F.size(found) > 0, walked).otherwise(F.array().cast(kind))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """(doc_id, text, spans array of (start, kind, end) ordered): kind is the rule's place in ``rules``."""
    rows = texts(docs).withColumn("text_key", F.xxhash64("text"))
    found, flags = candidates(rows, rules)
    found = found.select(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key"), *flags.values())
    joined = rows.join(found, rows.doc_id.eqNullSafe(found.c_id) & (rows.text_key == found.c_key), "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    each = [F.when(F.col(flags[r.name]), spans(F.col("text"), r, i)).otherwise(none) if r.name in flags else spans(F.col("text"), r, i) for i, r in enumerate(rules)]
    return joined.select("doc_id", "text", F.array_sort(F.concat(*each)).alias("spans"))


def written(found: Column, rules: tuple[Rule, ...]) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(r.name) for r in rules])
    return F.concat_ws(",", F.transform(found, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))))


def digest(docs: DataFrame) -> DataFrame:
    """Counts and digests of the contract, one row per document."""
    rules, n = BASE + MORE, len(BASE)
    base = F.filter("spans", lambda x: x["kind"] < n)
    kinds = F.transform("spans", lambda x: x["kind"])
    counts = [F.size(F.array_remove(kinds, i)) for i in range(n)]
    counts = [(F.size("spans") - left).cast("long").alias(f"n_{r.name}") for r, left in zip(BASE, counts, strict=True)]
    return scan(docs, rules).select("doc_id", *counts, F.sha2(written(base, rules), 256).alias("base_sha256"), written(F.col("spans"), rules).alias("spans"))


def oracle() -> str:
    """The same result in DuckDB: every rule over every text, no index."""
    parts = []
    for i, r in enumerate(BASE + MORE):
        regex = r.regex.replace("'", "''")
        parts.append(f"""
SELECT rid, {i} AS kind, '{r.name}' AS name, s + length(b) AS start, s + length(b) + length(m) AS "end", g FROM (
  SELECT rid, b, m, g, i, coalesce(sum(length(b) + length(m)) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM (
    SELECT rid, unnest(bs[1:len(ms)]) AS b, unnest(ms) AS m, unnest(gs) AS g, unnest(range(len(ms))) AS i FROM (
      SELECT rid, string_split_regex(t, '{regex}') AS bs, regexp_extract_all(t, '{regex}', 0) AS ms, regexp_extract_all(t, '{regex}', {r.group}) AS gs FROM d))) WHERE length(g) >= {r.least}""")
    n = len(BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
a AS ({' UNION ALL '.join(parts)}),
j AS (SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  string_agg(name || ':' || start || ':' || "end", ',' ORDER BY start, kind) FILTER (kind < {n}) AS base,
  string_agg(name || ':' || start || ':' || "end", ',' ORDER BY start, kind) AS spans FROM a GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN j USING (rid)"""
