"""Mixing sources to target weights: exact word budgets by distributed prefix sums over hash-random order.

Every document gets a hash-random key; equal stretches of the key space are the ranges.
Ranges are summed for each source, the sums are added up in order, and within a
range a window continues them, so a source of any size is spread over as many
ranges as it needs and no task sorts more than one range.  A source's budget is
cut where its running sum of words reaches it: whole epochs first, then the
documents in key order, the last one in part.

Nulls: a null text has size 0; a null source is a source of its own, last in
order; a null doc_id sorts last among equal keys.  Rows that repeat doc_id and
text are interchangeable, so their order changes nothing.  Without any word all
targets are 0.  An empty table gives an empty result.  Other columns, whatever their
names, pass through the mix unchanged.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from fundgraph.llm.common import WORD, words

#: Fixed values of the contract: weights by place of the source, repeating; largest multiple of a source.
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3

#: Documents that a range holds on average.
RANGE_ROWS = 1_000


def source_key(source: Column) -> Column:
    """Never null, so that plain equality joins it and one partitioning serves join and window."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with mix_source (a name for every source, null's too), mix_size and the hash-random mix_key."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long")
    key = F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.md5(text)))
    return docs.withColumns({"mix_source": source_key(F.col("source").cast("string")), "mix_size": size, "mix_key": key})


def targets(sums: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from one row per source.

    Sources reach their limit in the order of limit / weight; those before the
    first one whose fair share fits are capped, the rest divide what is left.
    The source table is a list of names, small beside the documents.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    w = F.get(F.array(*[F.lit(x) for x in weights]), (place - 1) % len(weights))
    rows = sums.withColumn("weight", w).withColumn("cap", most * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select(
        "source", "source_size", "weight", "cap",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("share"),
    )
    # level: words per weight if exactly the sources before this one are capped
    rows = rows.withColumn("level", F.col("left").cast("double") / F.col("share").cast("double"))
    fits = rows.withColumn("fair", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)["level"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("fair") * F.col("weight"), F.col("cap").cast("double")))
    return fits.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row, mix_size, mix_source_size, mix_target and mix_taken."""
    n = math.ceil(docs.count() / RANGE_ROWS)
    place = F.conv(F.substring("mix_key", 1, 8), 16, 10).cast("long")
    rows = keyed(docs).select(*keep, "mix_source", "mix_size", "mix_key", F.shiftright(place * n, 32).alias("mix_range"))
    # sums by range and source: at most n narrow rows for each source, combined before the shuffle
    ranges = rows.groupBy("mix_source", "mix_range").agg(F.sum("mix_size").alias("words"))
    sums = ranges.groupBy("mix_source").agg(F.sum("words").alias("source_size"))
    goal = targets(sums.select(F.when(F.col("mix_source") != "", F.substr("mix_source", F.lit(2))).alias("source"), "source_size"))
    goal = goal.select(source_key(F.col("source")).alias("mix_source"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"))
    running = Window.partitionBy("mix_source").orderBy("mix_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.withColumn("mix_offset", F.coalesce(F.sum("words").over(running), F.lit(0)))
    known = offsets.join(goal, "mix_source").select("mix_source", "mix_range", "mix_offset", "mix_source_size", "mix_target")
    # join and window have the same keys: the rows are shuffled once
    joined = rows.join(known, ["mix_source", "mix_range"])
    inside = Window.partitionBy("mix_source", "mix_range").orderBy("mix_key", F.col("doc_id").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("mix_offset") + F.coalesce(F.sum("mix_size").over(inside), F.lit(0))
    placed = joined.withColumn("mix_before", before)
    budget = F.floor("mix_target")
    epochs = F.when(F.col("mix_source_size") > 0, F.floor(budget / F.col("mix_source_size"))).otherwise(0)
    rest = budget - epochs * F.col("mix_source_size")
    part = F.least(F.col("mix_size"), F.greatest(F.lit(0).cast("long"), rest - F.col("mix_before")))
    return placed.select(*keep, "mix_size", "mix_source_size", "mix_target", (epochs * F.col("mix_size") + part).cast("long").alias("mix_taken"))


def digest(docs: DataFrame) -> DataFrame:
    out = mix(docs, ["doc_id"])
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(f"mix_{x}").alias(x) for x in ("size", "source_size", "target", "taken")])


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them; the one document in which a source's budget ends keeps that many of its words."""
    # the row travels as one struct, so none of its columns can meet a column of the mix
    packed = docs.select(F.struct("*").alias("mix_row"), "doc_id", "text", "source")
    rows = mix(packed, ["doc_id", "mix_row"])
    whole = F.when(F.col("mix_size") > 0, F.floor(F.col("mix_taken") / F.col("mix_size"))).otherwise(0)
    rest = F.col("mix_taken") - whole * F.col("mix_size")
    copies = F.concat(F.array_repeat(F.lit(-1).cast("long"), whole.cast("int")), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<long>")))
    rows = rows.withColumn("mix_words", F.explode(copies))
    row = F.col("mix_row")
    head = F.array_join(F.slice(words(row.getField("text")), F.lit(1), F.col("mix_words").cast("int")), " ")
    own = {"text": head, "n_chars": F.length(head)}
    cell = lambda c, kind: F.when(F.col("mix_words") < 0, row.getField(c)).otherwise(own[c].cast(kind)) if c in own else row.getField(c)
    return rows.select(*[cell(c, kind).alias(c) for c, kind in docs.dtypes])


def oracle() -> str:
    """The same order and budgets in DuckDB, by plain windows over each source."""
    w = r"[^\x20\x09-\x0D]+"
    weights = "[" + ", ".join(map(str, WEIGHTS)) + "]"
    return f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{w}'))::BIGINT AS size,
  md5(concat_ws(':', doc_id::VARCHAR, md5(coalesce(text, '')))) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
p AS (SELECT *, {weights}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight, {MAX_EPOCHS} * source_size AS cap FROM s),
q AS (SELECT *, (SELECT sum(source_size) FROM p) - coalesce(sum(cap) OVER o, 0) AS lft, (SELECT sum(weight) FROM p) - coalesce(sum(weight) OVER o, 0) AS share FROM p
  WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, lft::DOUBLE / share::DOUBLE AS level FROM q),
f AS (SELECT level AS fair FROM l WHERE level * weight <= cap ORDER BY cap / weight, level LIMIT 1),
t AS (SELECT source, source_size, least(cap::DOUBLE, coalesce((SELECT fair FROM f) * weight, cap::DOUBLE)) AS target FROM l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
  coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (CASE WHEN source_size > 0 THEN (budget // source_size) * size ELSE 0 END
  + least(size, greatest(0, (CASE WHEN source_size > 0 THEN budget % source_size ELSE 0 END) - before)))::BIGINT AS taken FROM r"""
