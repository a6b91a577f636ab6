"""Filter interaction audit by the Hart-Mas-Colell potential of the removal game.

Which of five filters a document fails is one of 32 masks.  For a part, v(S) is the number of its
documents that fail a filter of the coalition S.  The potential is 0 for no filter and

    P(S) = (v(S) + sum of P(S without i) over i in S) / |S|,

and a filter's Shapley value is P(all) - P(all without it).  Kept in whole numbers as
Q(S) = |S|! P(S) = (|S| - 1)! v(S) + sum of Q(S without i), so that 120 times the value - the
filter's removals summed over all orders - is Q(all) - 5 Q(all without it).  The steps of an order
are differences of v between the coalition before the step and the one after it.

Texts are judged where they are read (Arrow batches, long texts in pieces) and become narrow rows:
document, part, text hash, mask.  All further work counts such rows, equal ones combined before
every shuffle; a part ends as one row of 32 counts, and its 600 result rows are derived from it.
No text, and no list of documents, is gathered anywhere.

Copies: a document fails E if a smaller doc_id has the same text (128-bit hash).  Nulls: a null
text is empty; a null source is the part '' (as is an empty one); a document without doc_id is
neither smaller nor greater than any, so it passes E and has no label.  Rows that repeat a doc_id
are counted each; none makes another fail E.  A document is good or toxic if any of its label rows
says so.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fundgraph.session import cut

FILTERS = "ABCDE"
ALL = 2 ** len(FILTERS) - 1
COPY = 1 << FILTERS.index("E")

#: Fixed values of the contract.
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_UPPER_PERCENT = 5
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = b"#$%&*|"

#: A longer text is taken apart at blanks, in pieces of about this many bytes.
PIECE = 4 << 20
_CONTINUATION = bytes(range(0x80, 0xC0))

NARROW = "doc_id long, part string, text_hash binary, mask int"


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """The text in stretches that end at a space or line end; a longer word is one stretch."""
    at = 0
    while len(text) - at > size:
        ends = [x for x in (text.find(b" ", at + size), text.find(b"\n", at + size)) if x >= 0]
        if not ends:
            break
        yield text[at : min(ends)]
        at = min(ends)
    yield text[at:]


def mask_of(text: bytes) -> int:
    """Filters A to D that a text fails, as bits.  bytes.split() cuts at just the six blanks of the contract."""
    n_words = 0
    seen: set[bytes] = set()
    for piece in pieces(text):
        words = piece.split()
        n_words += len(words)
        seen.update(words)
    upper = len(text) - len(text.translate(None, UPPER))
    chars = len(text.translate(None, _CONTINUATION))
    fails = (
        n_words < MIN_WORDS,
        100 * len(seen) < MIN_DISTINCT_PERCENT * n_words,
        100 * upper > MAX_UPPER_PERCENT * chars,
        len(text) != len(text.translate(None, SYMBOLS)),
    )
    return sum(1 << i for i, f in enumerate(fails) if f)


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, part, text_hash, mask of A to D), one narrow row per document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, masks = [], []
            for x in batch.column("text"):
                text = x.as_py()
                hashes.append(hashlib.blake2b(text, digest_size=16).digest())
                masks.append(mask_of(text))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(hashes, pa.binary()), pa.array(masks, pa.int32())], ["doc_id", "part", "text_hash", "mask"])

    return rows.mapInArrow(judge, NARROW)


def profile(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents by all five filters they fail and by label."""
    rows = cut(judged(docs), "judged")
    marks = labels.select(F.col("doc_id").cast("long").alias("l_id"), (F.col("quality") == 1).alias("g"), (F.col("toxic") == 1).alias("t")).filter("l_id is not null")
    marks = marks.groupBy("l_id").agg(F.coalesce(F.bool_or("g"), F.lit(False)).alias("good"), F.coalesce(F.bool_or("t"), F.lit(False)).alias("toxic"))
    # repeated rows are combined before anything is joined or dealt by document
    known = rows.filter("doc_id is not null").groupBy("doc_id", "text_hash", "mask", "part").agg(F.count("mask").alias("n"))
    by_document = known.groupBy("doc_id", "text_hash", "mask").agg(F.collect_list(F.struct("part", "n")).alias("parts"))
    marked = by_document.join(marks, F.col("doc_id") == F.col("l_id"), "left")
    marked = cut(marked.select("doc_id", "text_hash", "mask", "parts", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")), "marked")
    kind = ["part", "mask", "good", "toxic"]
    every = marked.select("mask", "good", "toxic", F.inline("parts")).groupBy(*kind).agg(F.sum("n").alias("n"))
    # the smallest doc_id of each text passes E: a minimum, so copies are combined before the shuffle
    first = marked.groupBy("text_hash").agg(F.min(F.struct("doc_id", "mask", "good", "toxic", "parts")).alias("f"))
    first = first.select("f.mask", "f.good", "f.toxic", F.inline("f.parts")).groupBy(*kind).agg(F.sum("n").alias("n"))
    copies = every.withColumn("mask", F.col("mask") + COPY).unionByName(first).unionByName(first.select("part", (F.col("mask") + COPY).alias("mask"), "good", "toxic", (-F.col("n")).alias("n")))
    nameless = rows.filter("doc_id is null").groupBy("part", "mask").agg(F.count("mask").alias("n")).select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"), "n")
    return copies.unionByName(nameless).groupBy(*kind).agg(F.sum("n").alias("n"))


def counted(found: Column, field: str) -> Column:
    """Documents by mask as an array of 32, from the part's list of (mask, n, good, toxic)."""
    return F.transform(F.sequence(F.lit(0), F.lit(ALL)), lambda m: F.aggregate(F.filter(found, lambda x: x["mask"] == m), F.lit(0).cast("long"), lambda a, x: a + x[field]))


def removals(counts: Column) -> Column:
    """v(S) for each of the 32 coalitions: documents whose mask meets S."""
    def met(s: Column) -> Column:
        return F.aggregate(F.transform(counts, lambda n, m: F.when(m.bitwiseAND(s) != 0, n).otherwise(0)), F.lit(0).cast("long"), lambda a, n: a + n)

    return F.transform(F.sequence(F.lit(0), F.lit(ALL)), met)


def potentials(v: Column) -> Column:
    """Q(S) = |S|! P(S) for the 32 coalitions: in rising order every S without one of its filters comes before S."""
    bits = F.array(*[F.lit(1 << i) for i in range(len(FILTERS))])
    factorials = F.array(*[F.lit(factorial(i)).cast("long") for i in range(len(FILTERS))])

    def grow(q: Column, s: Column) -> Column:
        own = F.filter(bits, lambda b: s.bitwiseAND(b) != 0)
        return F.concat(q, F.array(F.aggregate(own, F.get(v, s) * F.get(factorials, F.size(own) - 1), lambda a, b: a + F.get(q, s - b))))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ALL)), F.array(F.lit(0).cast("long")), grow)


def audit(profiled: DataFrame) -> DataFrame:
    """(part, filter_order, step and the contract's counts) from one profile: 600 rows for each part."""
    labelled = [F.sum(F.when(F.col(x), F.col("n")).otherwise(0)).alias(x) for x in ("good", "toxic")]
    masks = profiled.groupBy("part", "mask").agg(F.sum("n").alias("n"), *labelled)
    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("found"))
    parts = parts.select("part", *[counted(F.col("found"), x).alias(f"c_{x}") for x in ("n", "good", "toxic")])
    parts = parts.select("part", "c_n", *[removals(F.col(f"c_{x}")).alias(f"v_{x}") for x in ("n", "good", "toxic")], F.aggregate("c_n", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))
    parts = parts.withColumn("q", potentials(F.col("v_n")))
    # the same 120 orders of five steps for every part, whatever the data
    orders = F.split(F.lit(" ".join("".join(o) for o in permutations(FILTERS))), " ")
    rows = parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bits = F.transform(F.split("filter_order", ""), lambda x: F.get(F.array(*[F.lit(1 << i) for i in range(len(FILTERS))]), F.ascii(x) - ord(FILTERS[0])))
    rows = rows.withColumn("bits", bits).withColumns({"own": F.get("bits", F.col("step") - 1), "before": F.aggregate(F.slice("bits", F.lit(1), F.col("step") - 1), F.lit(0), lambda a, x: a + x)})
    after = F.col("before") + F.col("own")

    def gain(v: str) -> Column:
        return F.get(v, after) - F.get(v, F.col("before"))

    return rows.select(
        "part", "filter_order", "step",
        (F.col("total") - F.get("v_n", after)).alias("kept"),
        gain("v_n").alias("removed"),
        (F.get("v_n", F.col("own")) - gain("v_n")).alias("redundant"),
        F.get("c_n", F.col("own")).alias("unique_fails"),
        gain("v_good").alias("good_lost"), gain("v_toxic").alias("toxic_lost"),
        (F.get("q", F.lit(ALL)) - len(FILTERS) * F.get("q", F.lit(ALL) - F.col("own"))).alias("shapley"),
    )


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(profile(docs, labels))


def oracle() -> str:
    """Every order applied step by step to the counts of masks; Shapley as the plain sum over orders."""
    w = r"[^\x20\x09-\x0D]+"
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{w}') AS ws FROM documents),
f AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (SELECT part, (len(ws) < {MIN_WORDS})::INT + 2 * (100 * list_unique(ws) < {MIN_DISTINCT_PERCENT} * len(ws))::INT
  + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > {MAX_UPPER_PERCENT} * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
  + 16 * coalesce(d.doc_id > f.first, false)::INT AS mask, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic FROM d JOIN f USING (t) LEFT JOIN l USING (doc_id)),
g AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS ng, count(*) FILTER (toxic) AS nt FROM m GROUP BY part, mask),
b AS (SELECT range AS i, substr('{FILTERS}', range::INT + 1, 1) AS name FROM range({len(FILTERS)})),
o AS (SELECT a.i AS a, b.i AS b, c.i AS c, d.i AS d, e.i AS e, a.name || b.name || c.name || d.name || e.name AS filter_order FROM b a, b b, b c, b d, b e
  WHERE a.i NOT IN (b.i, c.i, d.i, e.i) AND b.i NOT IN (c.i, d.i, e.i) AND c.i NOT IN (d.i, e.i) AND d.i <> e.i),
s AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step, unnest([a, b, c, d, e]) AS own, unnest([0, 1 << a, (1 << a) | (1 << b), (1 << a) | (1 << b) | (1 << c), (1 << a) | (1 << b) | (1 << c) | (1 << d)]) AS bef FROM o),
r AS (SELECT part, filter_order, step, own,
  coalesce(sum(n) FILTER (mask & (bef | (1 << own)) = 0), 0) AS kept, coalesce(sum(n) FILTER (mask & bef = 0 AND mask & (1 << own) <> 0), 0) AS removed,
  coalesce(sum(n) FILTER (mask & bef <> 0 AND mask & (1 << own) <> 0), 0) AS redundant, coalesce(sum(n) FILTER (mask = 1 << own), 0) AS unique_fails,
  coalesce(sum(ng) FILTER (mask & bef = 0 AND mask & (1 << own) <> 0), 0) AS good_lost, coalesce(sum(nt) FILTER (mask & bef = 0 AND mask & (1 << own) <> 0), 0) AS toxic_lost FROM g, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r"""
