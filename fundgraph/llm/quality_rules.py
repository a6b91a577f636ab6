"""Line-first cleaning: rules judge every line, failing lines go, and a document that loses too much text goes too.

Nulls: a null text is empty, has no words and fails.  Repeated rows are judged
alike, each its own row; a null doc_id is kept.  An empty table gives an empty
result.  Other columns are ignored.  Nothing is shuffled: each text is judged
where it is read, in time linear in its length (whatever the length of its words) up to one sort of
its windows' hashes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fundgraph.llm.common import SPACES, texts

#: Base limits of the contract.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: How a sentence may end, separators of navigation bars, phrases of page furniture (lower case).
SENTENCE_END = r"[.!?;:,\x22')\]…。！？؟।]\s*$"
SEPARATORS = r"[|<>»«•]"
SYMBOLS = r"[#*$%&|<>]"
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "accept cookies", "use cookies",
    "enable javascript", "javascript is disabled", "sign in", "log in", "subscribe to our", "click here", "read more", "share this",
    "skip to content", "back to top", "lorem ipsum", "powered by",
)

#: A line fails with at least this many separators, or this share of words that are shouted or carry symbols.
MAX_SEPARATORS = 3
MAX_MARKED = 0.3
#: A line without a sentence's end fails below this many words, unless it is the text's last.
SHORT_LINE = 4
#: A document goes if the failing lines hold more than this share of its words.
MAX_LOST = 0.3
#: Page furniture stands in lines of fewer words than this.
SHORT_FURNITURE = 25
#: A marked word holds doubled exclamation marks or one of the symbols.
MARK = f"!!|{SYMBOLS}"
BLANKS = " \t\n\x0b\x0c\r"


def cut_words(line: Column) -> Column:
    """Words of a line that has one."""
    return F.split(F.btrim(line, F.lit(BLANKS)), SPACES, -1)


def failing(line: Column, w: Column) -> Column:
    """Punctuation, navigation and boilerplate rules for one line and its words; costly ones last, each behind a cheap one."""
    n_words = F.size(w)
    navigation = F.regexp_like(line, F.lit(f"(?:{SEPARATORS}{SEPARATORS.replace('[', '[^', 1)}*){{{MAX_SEPARATORS}}}"))
    marked = F.size(F.filter(w, lambda x: F.regexp_like(x, F.lit(MARK))))
    noisy = F.regexp_like(line, F.lit(MARK)) & (marked > MAX_MARKED * n_words)
    unfinished = (n_words < SHORT_LINE) & ~F.regexp_like(line, F.lit(SENTENCE_END))
    # one lambda variable holds the lowered line, so that it is lowered once
    furniture = (n_words < SHORT_FURNITURE) & F.exists(F.array(F.lower(line)), lambda low: reduce(lambda a, b: a | b, [F.contains(low, F.lit(x)) for x in BOILERPLATE]))
    return unfinished | navigation | noisy | furniture


def judged_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text, lines array of (line, words, fails)) for lines with a word."""
    held = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    rows = texts(docs).withColumn("held", held)
    # every line is cut into words once; a line end is a blank, so the lines' words are the text's
    counted = rows.select("doc_id", "text", "held", F.transform("held", lambda x: F.struct(x.alias("line"), cut_words(x).alias("w"))).alias("counted"))
    lines = F.transform("counted", lambda x: F.struct(x["line"].alias("line"), F.size(x["w"]).alias("words"), failing(x["line"], x["w"]).alias("fails")))
    return counted.select("doc_id", "text", "held", lines.alias("lines"), F.flatten(F.transform("counted", lambda x: x["w"])).alias("w"))


def clean(docs: DataFrame) -> DataFrame:
    """(doc_id, text, its words w, cleaned, lost words, kept): the text without its failing lines, and the verdict."""
    rows = judged_lines(docs)
    total = F.aggregate("lines", F.lit(0), lambda a, x: a + x["words"])
    lost = F.aggregate("lines", F.lit(0), lambda a, x: a + F.when(x["fails"], x["words"]).otherwise(0))
    left = F.array_join(F.transform(F.filter("lines", lambda x: ~x["fails"]), lambda x: x["line"]), "\n")
    rows = rows.select("doc_id", "text", "held", "w", left.alias("cleaned"), total.alias("total"), lost.alias("lost"))
    return rows.withColumn("kept", (F.col("total") > 0) & (F.col("lost") <= MAX_LOST * F.col("total")))


def _windows(w: Column) -> Column:
    return F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>"))


def window_hash(a: Column, b: Column, c: Column) -> Column:
    return F.xxhash64(a, b, c)


def covered(at: Column) -> Column:
    """Words in the windows that begin at these places, in rising order."""
    return F.aggregate(F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)


def places_of_repeats(rows: DataFrame, w: str, out: str) -> DataFrame:
    """``rows`` with the places of 3-word windows that occur twice or more, in order.

    A window is a number: as many bits of its hash as its place leaves free, then its place.  Sorted,
    equal windows are neighbours, and neighbours of equal hash are compared word by word.  Should two
    different windows share a hash, the text is told apart by its windows' words instead.
    """
    n = F.size(w)
    bits = F.length(F.bin(n.cast("long")))
    places = F.transform(_windows(F.col(w)), lambda i: F.call_function("shiftleft", F.call_function("shiftrightunsigned", window_hash(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), bits), bits) + i)
    rows = rows.withColumn("r_bits", bits).withColumn("r_sorted", F.sort_array(places))

    def place(x: Column) -> Column:
        return (x - F.call_function("shiftleft", F.call_function("shiftright", x, F.col("r_bits")), F.col("r_bits"))).cast("int")

    def hashed(x: Column) -> Column:
        return F.call_function("shiftright", x, F.col("r_bits"))

    near = F.transform("r_sorted", lambda x, i: F.when(hashed(x) == hashed(F.get("r_sorted", i + 1)), F.struct(place(x).alias("a"), place(F.get("r_sorted", i + 1)).alias("b"))))
    rows = rows.withColumn("r_near", F.array_compact(near)).drop("r_sorted")
    same = F.transform(F.array("r_near"), lambda near: F.forall(near, lambda x: reduce(lambda p, q: p & q, [F.get(w, x["a"] + k) == F.get(w, x["b"] + k) for k in range(3)])))
    fast = F.array_sort(F.array_distinct(F.concat(F.transform("r_near", lambda x: x["a"]), F.transform("r_near", lambda x: x["b"]))))
    return rows.withColumn(out, F.when(F.get(same, F.lit(0)), fast).otherwise(F.array_sort(_by_words(F.col(w))))).drop("r_near", "r_bits")


def _by_words(w: Column) -> Column:
    """Places of repeated windows by sorting the windows' words."""
    windows = F.sort_array(F.transform(_windows(w), lambda i: F.struct(F.concat(F.get(w, i), F.lit(" "), F.get(w, i + 1), F.lit(" "), F.get(w, i + 2)).alias("g"), i.alias("i"))))
    same = F.flatten(F.transform(F.array(windows), lambda s: F.filter(s, lambda x, i: (x["g"] == F.get(s, i + 1)["g"]) | ((i > 0) & (x["g"] == F.get(s, i - 1)["g"])))))
    return F.transform(same, lambda x: x["i"])


def digest(docs: DataFrame) -> DataFrame:
    """Counts and verdicts of the contract, one row per document."""
    rows = places_of_repeats(clean(docs), "w", "repeats")
    n = F.size("w").cast("long")
    blank_free = reduce(lambda x, c: F.replace(x, F.lit(c), F.lit("")), BLANKS, F.col("text"))
    chars = F.length(blank_free).cast("long")
    symbols = (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long")
    dup = (F.size("held") - F.size(F.array_distinct("held"))).cast("long")
    out = rows.select(
        "doc_id", n.alias("n_words"), chars.alias("word_chars"), symbols.alias("n_symbols"), dup.alias("n_dup_lines"),
        covered(F.col("repeats")).cast("long").alias("n_repeat_words"), F.col("lost").cast("long").alias("n_lost_words"), F.col("kept").alias("cleaned_kept"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & F.col("cleaned_kept")).drop("cleaned_kept")


def oracle() -> str:
    """The same rules in DuckDB, windows counted by grouping rows."""
    phrases = " OR ".join(f"contains(low, '{x}')" for x in BOILERPLATE)
    w = r"[^\x20\x09-\x0D]"
    re2 = SENTENCE_END.replace("'", "''")
    for code in ("2026", "3002", "ff01", "ff1f", "061f", "0964"):
        re2 = re2.replace(f"\\u{code}", f"\\x{{{code}}}")
    seps = SEPARATORS
    for code in ("00bb", "00ab", "2022"):
        seps = seps.replace(f"\\u{code}", f"\\x{{{code}}}")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
x AS (SELECT rid, doc_id, t, regexp_extract_all(t, '{w}+') AS ws, list_filter(string_split(t, chr(10)), lambda y: regexp_matches(y, '{w}')) AS ls FROM d),
l AS (SELECT rid, unnest(ls) AS line FROM x),
c AS (SELECT rid, line, lower(line) AS low, len(regexp_extract_all(line, '{w}+')) AS n,
  len(regexp_extract_all(line, '{w}*(?:!!|[#*$%&|<>]){w}*')) AS marked, length(line) - length(regexp_replace(line, '{seps}', '', 'g')) AS seps FROM l),
f AS (SELECT rid, sum(n) AS total, coalesce(sum(n) FILTER (seps >= {MAX_SEPARATORS} OR marked > {MAX_MARKED} * n OR (n < {SHORT_LINE} AND NOT regexp_matches(line, '{re2}')) OR (({phrases}) AND n < {SHORT_FURNITURE})), 0) AS lost FROM c GROUP BY rid),
u AS (SELECT rid, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM x),
v AS (SELECT rid, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM u WINDOW o AS (PARTITION BY rid ORDER BY i)),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w, w2, w3) AS k FROM v WHERE w3 IS NOT NULL),
r AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM g WHERE k > 1) GROUP BY rid),
o AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
  coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS n_lost_words, total FROM x LEFT JOIN f USING (rid) LEFT JOIN r USING (rid))
SELECT * EXCLUDE (total), n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND coalesce(total, 0) > 0 AND n_lost_words <= {MAX_LOST} * coalesce(total, 0) AS kept FROM o"""
