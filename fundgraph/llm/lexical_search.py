"""Ranked lexical search by presence masks.

Every item of the benchmark is a query over all documents; its score in a document sums, over the
item's distinct terms, a weight times a saturating term frequency (see ``weights`` and ``impact``).

1. One pass over the texts counts terms and stores a narrow forward index: for every document its
   length in terms and the item terms it holds, with their frequencies.
2. Spark aggregates the index to the number of documents, the sum of lengths and the document
   frequency of each item term, which give the weights.
3. Each task turns its documents, a batch at a time, into postings and a bitmap per term.  For an
   item the bitmaps of its terms are transposed, which leaves each document's presence mask: the
   documents fall into groups of one mask.  A mask's maximum score is the sum of its terms' best
   values in the batch.  Groups are scored by descending maximum, until the next maximum is below
   the task's TOP-th best score so far: no later document can enter the list.  A maximum that
   equals it is still scored, for an equal score ranks by doc_id.
4. The tasks' lists are cut to TOP in two levels, so no task sorts all lists of an item.

Items are searched in blocks of at most BLOCK_CHARS characters (an item longer than that is a block
of its own), one after the other: the terms, weights and items of one block are all that is ever
broadcast, so it does not grow with the documents, and a larger benchmark takes more blocks.

Nulls: a null text has no term.  Documents without doc_id are searched too and come after all
others of their score.  Rows that repeat a doc_id are ranked each; equal rows follow each other.
Items of equal (item_id, text) are one; different texts under one item_id (null is an id too) are
ranked apart.  Items and documents without terms give no rows, empty tables an empty result.  Other
columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fundgraph.llm.common import NO_ID
from fundgraph.session import cut, discard, scratch_path

#: Fixed values of the contract: results per item, frequency unit, length share in percent.
TOP = 50
UNIT = 1_000_000_000
LENGTH_PERCENT = 50

#: Characters of items in one block.
BLOCK_CHARS = 2_000_000
#: A longer text is taken apart at its separators, in pieces of about this many bytes.
PIECE = 4 << 20
#: Bytes that the bitmaps of one batch may take, and the most documents of a batch.
BITMAP_BYTES, BATCH_DOCS = 32 << 20, 1 << 16
#: Postings that one batch may hold.
BATCH_POSTINGS = 1 << 22
#: Lists of an item that are merged at once in the first level.
SALTS = 64

#: Terms are runs of ASCII letters, digits and all bytes of other characters; the rest becomes blank, A-Z become a-z.
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))

INDEX = "doc_id long, n long, terms array<int>, tfs array<int>"
_INDEX = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])


def terms_of(text: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in pieces of a long one; a piece ends between terms."""
    at = 0
    while len(text) - at > size:
        end = at + size
        # move to a separator: at most the rest of one term
        folded = text[at:end].translate(_FOLD)
        stop = folded.rfind(b" ")
        while stop < 0 and end < len(text):
            end = min(len(text), end + size)
            folded = text[at:end].translate(_FOLD)
            stop = folded.find(b" ")
        if stop < 0:
            break
        yield folded[:stop].split()
        at += stop + 1
    yield text[at:].translate(_FOLD).split()


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Saturating frequency, whole numbers; ``m`` is the document's length norm."""
    return (UNIT * tf) // (1000 * tf + 20 * m)


def norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    # whole numbers of any size: 50 * n * N may pass 64 bits only at absurd lengths, so check
    if n.size and int(n.max()) * n_docs * LENGTH_PERCENT >= 1 << 63:
        return np.array([100 - LENGTH_PERCENT + LENGTH_PERCENT * int(x) * n_docs // n_terms for x in n], np.int64)
    return 100 - LENGTH_PERCENT + (LENGTH_PERCENT * n * n_docs) // n_terms


class Block:
    """Items of one block: their terms numbered, each item as an array of term numbers."""

    def __init__(self, rows: list[tuple[int | None, str]]) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.item_ids: list[int | None] = []
        self.items: list[np.ndarray] = []
        for item_id, text in rows:
            own = sorted({t for piece in terms_of(text.encode()) for t in piece})
            if own:
                self.item_ids.append(item_id)
                self.items.append(np.array([self.vocabulary.setdefault(t, len(self.vocabulary)) for t in own], np.int64))


def blocks(benchmark: DataFrame, size: int = BLOCK_CHARS) -> Iterator[Block]:
    """The items, one block after the other; a block is read when its turn comes."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null").distinct()
    rows = rows.withColumn("part", F.xxhash64("text", "item_id"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / size))
    for i in range(n):
        some = rows.filter(F.pmod("part", F.lit(n)) == i).select("item_id", "text")
        yield Block([(r.item_id, r.text) for r in some.toLocalIterator()])


def forward_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term; ``terms`` are those of the vocabulary, in rising order."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            ids, ns, ends, terms, tfs = [], [], [0], [], []
            for one, x in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                n, counts = 0, Counter()
                for piece in terms_of(x.as_py()):
                    n += len(piece)
                    counts.update(piece)
                if not n:
                    continue
                own = sorted((known[t], counts[t]) for t in counts.keys() & known.keys())
                ids.append(one)
                ns.append(n)
                terms += [t for t, _ in own]
                tfs += [k for _, k in own]
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), *lists], schema=_INDEX)

    return rows.mapInArrow(index, INDEX)


class Postings:
    """A batch of documents by term: postings in document order, a bitmap and the best impact of each term."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.ids, self.n = ids, len(ids)
        of = np.repeat(np.arange(self.n), sizes)
        order = np.argsort(terms, kind="stable")
        self.docs, found = of[order], terms[order]
        self.impacts = impact(tfs[order].astype(np.int64), norm(n, n_docs, n_terms)[self.docs])
        self.terms, self.starts = np.unique(found, return_index=True)
        self.ends = np.append(self.starts[1:], len(found))
        self.best = np.maximum.reduceat(self.impacts, self.starts) if len(found) else np.zeros(0, np.int64)
        bits = np.zeros((len(self.terms), -(-self.n // 8)), np.uint8)
        row = np.repeat(np.arange(len(self.terms)), self.ends - self.starts)
        # postings of a term are in document order, so the bits of one byte are neighbours and add up
        place = row * bits.shape[1] + self.docs // 8
        if len(place):
            first = np.flatnonzero(np.diff(place, prepend=-1))
            bits.ravel()[place[first]] = np.add.reduceat((128 >> (self.docs % 8)).astype(np.uint8), first)
        self.bits = bits

    def held(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``wanted`` of the terms that the batch holds, and their rows."""
        at = np.searchsorted(self.terms, wanted)
        ok = np.flatnonzero(at < len(self.terms))
        ok = ok[self.terms[at[ok]] == wanted[ok]]
        return ok, at[ok]

    def masks(self, rows: np.ndarray) -> np.ndarray:
        """One mask per document: the bitmaps transposed, 64 terms to a word."""
        words = -(-len(rows) // 64)
        table = np.zeros((64 * words, 8 * self.bits.shape[1]), np.uint8)
        table[: len(rows)] = np.unpackbits(self.bits[rows], axis=1)
        packed = np.packbits(table[:, : self.n], axis=0, bitorder="little")
        return np.ascontiguousarray(packed.T).view("<u8").reshape(self.n, words)

    def search(self, wanted: np.ndarray, weight: np.ndarray, best: list[tuple[int, int]], top: int) -> list[tuple[int, int]]:
        """The ``top`` of ``best`` and this batch's documents, as (-score, doc_id) in order."""
        places, rows = self.held(wanted)
        # a term of weight zero adds nothing to any score
        rows, weight = rows[weight[places] > 0], weight[places][weight[places] > 0]
        if not len(rows):
            return best
        masks = self.masks(rows)
        kinds, group = _distinct(masks)
        present = np.unpackbits(np.ascontiguousarray(kinds).view(np.uint8).reshape(len(kinds), -1), axis=1, bitorder="little")[:, : len(rows)]
        maximum = present.astype(np.int64) @ (weight * self.best[rows])
        order = np.argsort(-maximum, kind="stable")
        by_group = np.argsort(group, kind="stable")
        ends = np.cumsum(np.bincount(group, minlength=len(kinds)))
        starts = ends - np.bincount(group, minlength=len(kinds))
        at, step = 0, 1
        while at < len(order):
            least = -best[-1][0] if len(best) == top else 1
            if maximum[order[at]] < least:
                break  # safely finished: every later group has no more
            some = order[at : at + step]
            some = some[maximum[some] >= least]
            docs = np.sort(np.concatenate([by_group[starts[g] : ends[g]] for g in some]))
            score = self.scores(docs, rows, weight)
            good = np.flatnonzero(score >= least)
            if len(good):
                best = sorted(best + list(zip((-score[good]).tolist(), self.ids[docs[good]].tolist(), strict=True)))[:top]
            at, step = at + step, 2 * step
        return best

    def scores(self, docs: np.ndarray, rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores of documents (in order) by their postings."""
        out = np.zeros(len(docs), np.int64)
        for row, w in zip(rows.tolist(), weight.tolist(), strict=True):
            own = slice(self.starts[row], self.ends[row])
            listed = self.docs[own]
            at = np.searchsorted(listed, docs)
            at[at == len(listed)] = 0
            hit = listed[at] == docs
            out[hit] += w * self.impacts[own][at[hit]]
        return out


def _distinct(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct masks, and each document's place among them; words are numbered one after the other."""
    group = np.zeros(len(masks), np.int64)
    for word in range(masks.shape[1]):
        _, own = np.unique(masks[:, word], return_inverse=True)
        _, first, group = np.unique(group * (int(own.max()) + 1) + own, return_index=True, return_inverse=True)
    return masks[first], group


def _batches(batches: Iterator[pa.RecordBatch], most_docs: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Index rows in stretches of bounded documents and postings."""
    for batch in batches:
        column = batch.column("terms")
        ends = column.offsets.to_numpy().astype(np.int64)
        terms, tfs = column.values.to_numpy(), batch.column("tfs").values.to_numpy()
        tf_at = batch.column("tfs").offsets.to_numpy()
        ids = np.array([NO_ID if x is None else x for x in batch.column("doc_id").to_pylist()], np.int64)
        n = batch.column("n").to_numpy()
        at = 0
        while at < len(ids):
            to = min(at + most_docs, len(ids))
            to = max(at + 1, min(to, int(np.searchsorted(ends, ends[at] + BATCH_POSTINGS, "right")) - 1))
            yield ids[at:to], n[at:to], np.diff(ends[at : to + 1]), terms[ends[at] : ends[to]], tfs[tf_at[at] : tf_at[to]]
            at = to


RANKED = "place int, doc_id long, score long"


def _search_block(index: DataFrame, block: Block, top: int) -> DataFrame:
    """(item_id, rank, doc_id, score) of one block's items."""
    spark = index.sparkSession
    facts = index.agg(F.count("n").alias("docs"), F.sum("n").alias("terms")).first()
    held = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("term").alias("df")).collect()  # a row per term of the block
    df = np.zeros(len(block.vocabulary), np.int64)
    for r in held:
        df[r.term] = r.df
    n_docs, n_terms = facts.docs, facts.terms or 1
    w = weights(df, n_docs)
    sent = spark.sparkContext.broadcast([(t, w[t]) for t in block.items])
    most = max(1024, min(BATCH_DOCS, 8 * BITMAP_BYTES // max(1, len(block.vocabulary))))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: list[list[tuple[int, int]]] = [[] for _ in sent.value]
        for batch in _batches(batches, most):
            postings = Postings(*batch, n_docs, n_terms)
            for i, (terms, weight) in enumerate(sent.value):
                lists[i] = postings.search(terms, weight, lists[i], top)
        rows = [(i, d, -s) for i, one in enumerate(lists) for s, d in one]
        place, doc, score = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], ["place", "doc_id", "score"])

    found = index.mapInArrow(search, RANKED).withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    order = [F.col("score").desc(), F.col("doc_id")]
    for keys in (["place", "salt"], ["place"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    names = spark.createDataFrame(list(enumerate(block.item_ids)), "i int, item_id long")
    named = found.join(F.broadcast(names), F.col("place") == F.col("i"))
    return named.select("item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score")


RESULT = "item_id long, rank int, doc_id long, score long"


def search(docs: DataFrame, benchmark: DataFrame, top: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item.  Each block's rows are stored before the next one is read."""
    spark = docs.sparkSession
    path = scratch_path(spark, "ranked")
    for block in blocks(benchmark, block_chars):
        if block.items:
            index = cut(forward_index(docs, block.vocabulary), f"terms-{uuid.uuid4().hex[:6]}")
            _search_block(index, block, top).write.mode("append").parquet(path)
            discard(index)
    spark.createDataFrame([], RESULT).write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return search(docs, benchmark)


def oracle() -> str:
    """The same scores in DuckDB by joining all terms."""
    t = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({low.format("coalesce(text, '')")}, '{t}') AS ws FROM documents),
e AS (SELECT rid, doc_id, ws, len(ws)::BIGINT AS n FROM d WHERE len(ws) > 0),
c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM e),
b AS (SELECT row_number() OVER () AS iid, item_id, list_distinct(regexp_extract_all({low.format("coalesce(text, '')")}, '{t}')) AS ws FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT iid, item_id, unnest(ws) AS term FROM b),
u AS (SELECT DISTINCT term FROM q),
p AS (SELECT rid, term, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(ws) AS term FROM e) SEMI JOIN u USING (term) GROUP BY rid, term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, c GROUP BY term, docs),
m AS (SELECT rid, doc_id, {100 - LENGTH_PERCENT} + ({LENGTH_PERCENT} * n * docs) // terms AS m FROM e, c),
s AS (SELECT iid, item_id, rid, doc_id, sum(w * (({UNIT} * tf) // (1000 * tf + 20 * m)))::BIGINT AS score FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (rid) GROUP BY iid, item_id, rid, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= {TOP}"""
