"""Benchmark decontamination by pigeonhole edit matching.

An item of length m may differ in k = floor(RATE * m) edits.  Cut into k + 1
pieces, at least one of them must stand unchanged in any text that holds the item
within k edits.  All pieces of a block of items form one automaton that runs over
every text; around each piece hit, Myers' bit-parallel recurrence gives the
smallest edit distance between the item and any stretch of the text.

Items and texts are compared in lower case, with each run of other characters
than letters and digits as one space, so marks and line breaks don't count.

The benchmark is a stated query set: it is taken in blocks of about BLOCK_CHARS
characters, each of which is sent to all tasks, and each block meets every text.

Every item with a letter or digit is searched.  One of fewer than MIN_WORDS words
that allows less than two edits is compared with a space at either end, so that it is
not found inside a longer word; scripts written without spaces have no such bounds
and their items are found anywhere.

Nulls: a null text is empty; a null doc_id is given back as null; a null item or
one without letters and digits is not searched; a null item_id is given back as null.  Items of equal compared text
are searched once, and each of their item_ids gets the rows.  Rows that repeat a doc_id are searched each on their own.  With no items nothing is found
and nothing removed; an empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fundgraph.llm.common import NO_ID, texts
from fundgraph.session import cut, scratch_path

#: Edits allowed for each character of an item.
RATE = 0.08

#: Items of fewer words may have to stand on word bounds.
MIN_WORDS = 5

#: Characters of items in one block: the bound of what is sent to the tasks.
BLOCK_CHARS = 2_000_000

_OTHER = re.compile(r"[\W_]+")

#: Letters of scripts without spaces between words: Thai, Lao, Tibetan, Burmese, Khmer, Chinese, Japanese.
_UNSPACED = re.compile("[\u0e00-\u109f\u1780-\u17ff\u2e80-\u312f\u31a0-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


def compared(text: str) -> str:
    return _OTHER.sub(" ", text.lower()).strip()


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """errors + 1 pieces of nearly equal length, with their places."""
    n = errors + 1
    cuts = [i * len(item) // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


class Pattern:
    """An item and its bit masks."""

    def __init__(self, item_id: int, text: str, rate: float) -> None:
        self.item_id, self.errors = item_id, int(rate * len(text))
        self.bound = self.errors < 2 and text.count(" ") + 1 < MIN_WORDS and not _UNSPACED.search(text)
        self.text = text = f" {text} " if self.bound else text
        self.masks: dict[str, int] = {}
        for i, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def best(self, text: str, a: int, b: int) -> tuple[int, int] | None:
        """Smallest distance to a stretch of text[a:b] and where the stretch ends; None beyond the allowed errors."""
        if (at := text.find(self.text, a, b)) >= 0:
            return 0, at + len(self.text)
        m = len(self.text)
        full, top = (1 << m) - 1, 1 << (m - 1)
        plus, minus, score, found = full, 0, m, None
        for i in range(a, b):
            eq = self.masks.get(text[i], 0)
            xv = eq | minus
            xh = (((eq & plus) + plus) ^ plus) | eq
            ph = (minus | ~(xh | plus)) & full
            mh = plus & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
                if score <= self.errors and (found is None or score < found[0]):
                    found = score, i + 1
            ph, mh = ph << 1 & full, mh << 1 & full
            plus = (mh | ~(xv | ph)) & full
            minus = ph & xv
        return found


class Searcher:
    """Patterns and the automaton of all their pieces."""

    def __init__(self, items: list[tuple[int, str]], rate: float) -> None:
        import ahocorasick

        self.patterns = [Pattern(i, t, rate) for i, t in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for n, p in enumerate(self.patterns):
            for at, piece in pieces(p.text, p.errors):
                places.setdefault(piece, []).append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, int]]:
        """(item_id, distance, end in the compared text): the best for each item found."""
        text = f" {compared(text)} "
        around: dict[int, list[int]] = {}
        if self.patterns:
            for end, (size, where) in self.automaton.iter(text):
                for n, at in where:
                    around.setdefault(n, []).append(end + 1 - size - at)
        out = []
        for n, starts in around.items():
            p = self.patterns[n]
            first, last = (0, len(text)) if p.bound else (1, len(text) - 1)
            best: tuple[int, int] | None = None
            starts.sort()
            low = 0
            while low < len(starts):
                high = low  # windows that overlap are one
                while high + 1 < len(starts) and starts[high + 1] - starts[high] <= len(p.text) + 2 * p.errors:
                    high += 1
                a, b = max(first, starts[low] - p.errors), min(last, starts[high] + len(p.text) + p.errors)
                if b - a >= len(p.text) - p.errors and (found := p.best(text, a, b)) and (best is None or found < best):
                    best = found
                low = high + 1
            if best:
                out.append((p.item_id, best[0], best[1] - 1 - (p.bound and text[best[1] - 1] == " ")))
        return sorted(out)


_searchers: dict[str, Searcher] = {}


def searcher(key: str, items: list[tuple[int, str]], rate: float) -> Searcher:
    """One per worker process and block."""
    if key not in _searchers:
        _searchers.clear()
        _searchers[key] = Searcher(items, rate)
    return _searchers[key]


def compared_items(benchmark: DataFrame) -> DataFrame:
    """(compared, item_id): each item once under every id that it has; a null id is NO_ID."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("long"), F.lit(NO_ID)).alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([compared(x.as_py()) for x in batch.column("text")], pa.string()), batch.column("item_id")], ["compared", "item_id"])

    return rows.mapInArrow(fold, "compared string, item_id long").filter("compared <> ''").distinct()


def distinct_items(members: DataFrame) -> DataFrame:
    """(compared, item_key): a stored table with a number for each compared text."""
    return cut(members.select("compared").distinct().withColumn("item_key", F.monotonically_increasing_id()), "items")


def blocks(items: DataFrame, size: int) -> Iterator[list[tuple[int, str]]]:
    """The distinct items in blocks of about ``size`` characters, by a hash of the text; a block is read when its turn comes."""
    total = items.agg(F.sum(F.length("compared"))).first()[0] or 0
    n = max(1, math.ceil(total / size))
    for i in range(n):
        yield sorted((r.item_key, r.compared) for r in items.filter(F.pmod(F.xxhash64("compared"), F.lit(n)) == i).collect())


FOUND = "doc_id long, item_key long, distance int, end int"


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, distance, end): the best match of every item in every text that holds it.

    Each block's hits are stored, and its broadcast is let go, before the next block is read.
    """
    spark = docs.sparkSession
    rows, path = texts(docs), scratch_path(spark, "leaks")
    members = cut(compared_items(benchmark), "members")
    items = distinct_items(members)
    for block in blocks(items, block_chars):
        key, sent = uuid.uuid4().hex, spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find = searcher(key, sent.value, rate)  # noqa: B023
            for batch in batches:
                found = [(i, *h) for i, t in enumerate(batch.column("text")) for h in find.hits(t.as_py())]
                of, item, distance, end = (list(x) for x in zip(*found)) if found else ([], [], [], [])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(of, pa.int64())), pa.array(item, pa.int64()), pa.array(distance, pa.int32()), pa.array(end, pa.int32())], ["doc_id", "item_key", "distance", "end"])

        rows.mapInArrow(search, FOUND).write.mode("append").parquet(path)
        sent.destroy()
    found = spark.read.schema(FOUND).parquet(path)
    # every id of an item gets the item's rows
    named = found.join(items, "item_key").join(members, "compared")
    return named.select("doc_id", F.when(F.col("item_id") != NO_ID, F.col("item_id")).alias("item_id"), "distance", "end")


def without_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no item; what a block leaves is stored before the next one is read."""
    for i, block in enumerate(blocks(distinct_items(compared_items(benchmark)), block_chars)):
        docs = _without(cut(docs, "left") if i else docs, block, rate)
    return docs


def _without(docs: DataFrame, items: list[tuple[int, str]], rate: float) -> DataFrame:
    key, sent = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(items)
    own = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = searcher(key, sent.value, rate)
        for batch in batches:
            yield batch.filter(pa.array([t is None or not find.hits(t) for t in (x.as_py() for x in batch.column(own))], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
