"""Line dedup: ranges of line hashes in document order, and compressed keep bitmaps.

A line's key is the line without blanks at its ends, A-Z in lower case.  Keys of at least
MIN_CHARS code points that at least MIN_DOCS documents hold lose all their lines but those of
the last document.

1. Every such line becomes one narrow row: 128 bits of its key's hash, document, position.
2. The rows are range-partitioned by hash and sorted by document (last first) and position
   inside.  A window over each run of one hash streams them: the first document met keeps its
   lines, the others lose theirs if the run holds MIN_DOCS documents.
3. Lost positions are gathered by document into a keep bitmap, compressed to its runs: eight
   bytes (start, length, big-endian) for each stretch of kept lines.  Texts never travel.
4. Bitmaps meet the texts again by document.

A hash with more than HOT_ROWS lines, or a share above 1 / HOT_SHARE of all lines, is hot: there
are at most HOT_SHARE of them.  Their lines stay out of the ranges; their documents are counted in
two levels (equal rows are combined before the shuffle), and the verdicts, one row for each hot
hash, are broadcast.

A document is a doc_id; a row without one is a document by its text and comes before all with an
id, such rows among themselves in the order of their text's MD5.  Rows that repeat a doc_id are one
document: all keep or lose a key together.  Null or empty texts have one empty line.  An empty table
gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fundgraph.llm.common import texts
from fundgraph.session import cut

#: Fixed values of the contract.
MIN_CHARS = 20
MIN_DOCS = 3
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Lines of one hash that a run may hold, and the most hashes that may hold more (they are broadcast: 100,000 rows of 60 bytes).
HOT_ROWS = 1_000
HOT_SHARE = 100_000

HASH = ("h1", "h2")
#: A document's place in the order: null ids first, among them by MD5 of the text (empty for the others).
DOCUMENT = ("doc_id", "tie")


def line_key(line: Column) -> Column:
    """Blanks off both ends, A-Z lowered; other letters as they are."""
    core = F.btrim(line, F.lit(BLANKS))
    return F.when(F.length(core) == F.octet_length(core), F.lower(core)).otherwise(F.translate(core, UPPER, LOWER))


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, text_key, text): the key tells apart texts under one document."""
    return texts(docs).select("doc_id", F.when(F.col("doc_id").isNull(), F.md5("text")).otherwise(F.lit("")).alias("tie"), F.xxhash64("text").alias("text_key"), "text")


def occurrences(rows: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id, tie, text_key, n_lines, at): one row per line whose key is long enough."""
    lines = F.split("text", "\n", -1)
    each = rows.select(*DOCUMENT, "text_key", F.size(lines).alias("n_lines"), F.posexplode(lines).alias("at", "line"))
    # a key is not longer than its line: short lines are left out before anything is computed of them
    each = each.filter(F.length("line") >= min_chars).withColumn("line", line_key(F.col("line"))).filter(F.length("line") >= min_chars)
    return each.select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), *DOCUMENT, "text_key", "n_lines", "at")


def _order(first: str = "") -> list[Column]:
    return [F.col("doc_id").desc_nulls_last(), F.col("tie").desc(), *([F.col(first)] if first else [])]


def lost_in_ranges(rows: DataFrame, parts: int, min_docs: int) -> DataFrame:
    """Lines to drop, by ranges of hashes with document and position as the order inside."""
    ranged = rows.repartitionByRange(parts, *HASH).sortWithinPartitions(*HASH, *_order("at"))
    run = Window.partitionBy(*HASH).orderBy(*_order())
    # dense_rank counts the documents met so far; the first one is the last document of the run
    met = ranged.withColumn("met", F.dense_rank().over(run))
    held = met.withColumn("held", F.max("met").over(Window.partitionBy(*HASH)))
    return held.filter((F.col("met") > 1) & (F.col("held") >= min_docs))


def lost_among_hot(rows: DataFrame, min_docs: int) -> DataFrame:
    """Lines to drop of hot hashes: documents are counted in two levels, the verdicts (one per hash) are broadcast."""
    rows = rows.distinct()  # rows of repeated documents are one
    held = rows.groupBy(*HASH, *DOCUMENT).agg(F.lit(1).alias("one"))
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie")
    verdicts = held.groupBy(*HASH).agg(F.count("one").alias("held"), F.max(place).alias("last")).filter(F.col("held") >= min_docs)
    return rows.join(F.broadcast(verdicts), list(HASH)).filter(place < F.col("last"))


def runs(lost: Column, n_lines: Column) -> Column:
    """The keep bitmap of a document from its lost positions, in order: (start, length) of each stretch of kept lines as eight bytes."""
    starts = F.filter(lost, lambda x, i: (i == 0) | (F.get(lost, i - 1) != x - 1))
    ends = F.filter(lost, lambda x, i: (i == F.size(lost) - 1) | (F.get(lost, i + 1) != x + 1))
    kept = F.zip_with(F.concat(F.array(F.lit(0)), F.transform(ends, lambda x: x + 1)), F.concat(starts, F.array(n_lines)), lambda a, b: F.struct(a.alias("a"), (b - a).alias("n")))
    hexed = F.transform(F.filter(kept, lambda x: x["n"] > 0), lambda x: F.concat(F.lpad(F.hex(x["a"]), 8, "0"), F.lpad(F.hex(x["n"]), 8, "0")))
    return F.unhex(F.array_join(hexed, ""))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, tie, text_key, n_lines, n_dropped, keep) of every document that loses a line; all others keep every line."""
    spark = docs.sparkSession
    lines = cut(occurrences(identified(docs), min_chars), "lines")
    counts = lines.groupBy(*HASH).agg(F.count("at").alias("n"))
    bound = max(HOT_ROWS, lines.count() // HOT_SHARE)
    hot = F.broadcast(counts.filter(F.col("n") > bound).select(*HASH))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = [*DOCUMENT, "text_key", "n_lines", "at"]
    ranged = lost_in_ranges(lines.join(hot, list(HASH), "left_anti"), parts, min_docs)
    lost = ranged.select(*columns).unionByName(lost_among_hot(lines.join(hot, list(HASH), "left_semi"), min_docs).select(*columns))
    # a set: equal rows name the same positions, so it never outgrows one text's lines
    gathered = lost.groupBy(*DOCUMENT, "text_key", "n_lines").agg(F.array_sort(F.collect_set("at")).alias("lost"))
    return gathered.select(*DOCUMENT, "text_key", "n_lines", F.size("lost").alias("n_dropped"), runs(F.col("lost"), F.col("n_lines")).alias("keep"))


def kept_text(text: Column, keep: Column) -> Column:
    """The lines that a bitmap keeps, joined again; without a bitmap the text itself."""
    def number(place: Column) -> Column:
        return F.conv(F.hex(F.substr(keep, place, F.lit(4))), 16, 10).cast("int")

    stretches = F.when(F.octet_length(keep) > 0, F.sequence(F.lit(0), F.shiftright(F.octet_length(keep), 3) - 1)).otherwise(F.array().cast("array<int>"))
    split = F.split(text, "\n", -1)
    # one lambda variable holds the lines, so that they are split once
    joined = F.transform(F.array(split), lambda lines: F.array_join(F.flatten(F.transform(stretches, lambda i: F.slice(lines, number(i * 8 + 1) + 1, number(i * 8 + 5)))), "\n"))
    return F.when(keep.isNull(), text).otherwise(F.get(joined, F.lit(0)))


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped, keep, kept) of every row; keep is null where nothing is lost."""
    found = cut(keep_bitmaps(docs, min_chars, min_docs), "keep").select(F.col("doc_id").alias("k_id"), F.col("tie").alias("k_tie"), F.col("text_key").alias("k_text"), "n_dropped", "keep")
    rows = identified(docs)
    # a stored table: its measured size decides between a broadcast and a shuffled join
    joined = rows.join(found, rows.doc_id.eqNullSafe(found.k_id) & (rows.tie == found.k_tie) & (rows.text_key == found.k_text), "left")
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    return joined.select("doc_id", "text", n_lines.cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "keep", kept_text(F.col("text"), F.col("keep")).alias("kept"))


def digest(docs: DataFrame) -> DataFrame:
    return deduplicated(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def oracle() -> str:
    """The same in DuckDB: keys themselves, grouped."""
    blanks = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, CASE WHEN doc_id IS NULL THEN md5(coalesce(text, '')) ELSE '' END AS tie, coalesce(text, '') AS t FROM documents),
s AS (SELECT rid, doc_id, tie, string_split(t, chr(10)) AS ls FROM d),
l AS (SELECT rid, doc_id, tie, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM s),
k AS (SELECT *, translate(trim(line, {blanks}), '{UPPER}', '{LOWER}') AS key FROM l),
p AS (SELECT *, dense_rank() OVER (PARTITION BY key ORDER BY doc_id DESC NULLS LAST, tie DESC) AS met FROM k WHERE length(key) >= {MIN_CHARS}),
h AS (SELECT rid, pos, met > 1 AND max(met) OVER (PARTITION BY key) >= {MIN_DOCS} AS lost FROM p),
j AS (SELECT l.rid, l.doc_id, l.pos, l.line, coalesce(h.lost, false) AS lost FROM l LEFT JOIN h ON l.rid = h.rid AND l.pos = h.pos)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (lost)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256 FROM j GROUP BY rid, doc_id"""
