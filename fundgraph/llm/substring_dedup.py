"""Substring dedup by a compressed FM-index per shard.

A shard's distinct segments are laid end to end and indexed: the Burrows-Wheeler
transform of their word numbers in a wavelet matrix of packed bits.  All documents'
segments stream against it: backward search extends every position's match word by
word, all positions at once, up to the threshold (the matching statistics cut off
there), and drops those whose match has become unique.  Positions that reach the
threshold and occur in a document with a smaller id give the intervals to remove.

How documents reach shards, and how hot passages are kept from piling up, is told
in :mod:`fundgraph.llm.shared_windows`.

Nulls: a null text has no words; a null doc_id comes after every other id (two of
them are one document's) and is given back as null.  Rows that repeat a doc_id remove
nothing from each other, whatever their texts; equal rows get equal results.  An empty table
gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fundgraph.llm.common import NO_ID
from fundgraph.llm.shared_windows import Contents, Found, Scheme, expand, removed, shared_stretches
from fundgraph.llm.text_arrays import byte_symbols, chunks, flat, prefix_hash, stretch_hash, word_bounds

#: Words of a window, and of the anchors that deal windows to shards.
WINDOW = 13
GRAM = 5


def word_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, and the offsets of the texts in words."""
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for _, _, some, places in chunks(data, offsets, 1 << 20):
        starts, ends = word_bounds(some, places)
        hashes.append(stretch_hash(prefix_hash(byte_symbols(some)), starts, ends))
        counts.append(np.diff(np.searchsorted(starts, places)))
    return np.concatenate(hashes), np.cumsum(np.concatenate(counts))


class WaveletMatrix:
    """Packed bits of every level, with counts of ones every 64 bits."""

    def __init__(self, symbols: np.ndarray, distinct: int) -> None:
        self.levels = max(1, int(distinct - 1).bit_length())
        self.words, self.ones, self.zeros = [], [], []
        for level in range(self.levels):
            bits = (symbols >> (self.levels - 1 - level)) & 1
            packed = np.zeros((len(bits) >> 6) + 1, np.uint64)
            raw = np.packbits(bits.astype(bool), bitorder="little")
            packed.view(np.uint8)[: len(raw)] = raw
            self.words.append(packed)
            self.ones.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed).astype(np.int64))[:-1]]))
            self.zeros.append(len(bits) - int(bits.sum()))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])
        self.first = self._descend(np.arange(distinct), np.zeros(distinct, np.int64))

    def _descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            block = place >> 6
            below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.ones[level][block] + np.bitwise_count(self.words[level][block] & below)
            place = np.where((symbol >> (self.levels - 1 - level)) & 1, self.zeros[level] + ones, place - ones)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        return self._descend(symbol, place) - self.first[symbol]


class FMIndex:
    """Counts and places of word sequences up to ``depth`` words, over segments closed by a mark that no query holds."""

    def __init__(self, symbols: np.ndarray, size: np.ndarray, depth: int) -> None:
        _, word = np.unique(symbols, return_inverse=True)
        starts = np.cumsum(size) - size
        #: Where each segment begins in the text, which has one mark after each segment.
        self.starts = starts + np.arange(len(size))
        self.text = np.zeros(len(symbols) + len(size), np.int64)
        self.text[expand(self.starts, size)] = word + 1
        rank, known = self.text, 1
        while known < depth:
            follow = np.zeros(len(rank), np.int64)
            follow[:-known] = rank[known:] + 1
            _, rank = np.unique(rank * (len(rank) + 2) + follow, return_inverse=True)
            known *= 2
        #: Suffixes in the order of their first words, ``depth`` at least: enough to count sequences that long.
        self.order = np.argsort(rank, kind="stable")
        distinct = int(self.text.max(initial=0)) + 1
        self.before = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=distinct))])
        self.bwt = WaveletMatrix(self.text[self.order - 1], distinct)

    def repeated(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the text's stretches [at, at + length) occur twice or more, and their intervals of ``order``.

        One backward step for all positions at a time; a position whose match is unique is dropped.
        """
        low, high = np.zeros(len(at), np.int64), np.full(len(at), len(self.text), np.int64)
        alive = np.arange(len(at))
        for k in range(length - 1, -1, -1):
            symbol = self.text[at[alive] + k]
            low, high = (self.before[symbol] + self.bwt.rank(symbol, x) for x in (low, high))
            more = high - low > 1
            alive, low, high = alive[more], low[more], high[more]
        return alive, low, high


def in_smaller_document(contents: Contents, window: int = WINDOW) -> Found:
    """Stretches of segments whose windows also stand in a segment of a document with a smaller id."""
    size, none = contents.size, np.zeros(0, np.int64)
    if not len(size):
        return none, none, none
    index = FMIndex(contents.symbols, size, window)
    windows = size - window + 1
    segment = np.repeat(np.arange(len(size)), windows)
    at = expand(index.starts, windows)
    hit, low, high = index.repeated(at, window)
    if not len(hit):
        return none, none, none
    owner = np.zeros(len(index.text) + 1, np.int64)
    owner[: len(index.text)] = contents.id[np.searchsorted(index.starts, index.order, "right") - 1]
    # equal windows share one interval, and intervals of equal length are apart
    lows, which = np.unique(low, return_inverse=True)
    highs = np.zeros(len(lows), np.int64)
    highs[which] = high
    smallest = np.minimum.reduceat(owner, np.column_stack([lows, highs]).ravel())[::2][which]
    hit = hit[smallest < contents.id[segment[hit]]]
    # neighbouring windows make one stretch
    new = np.concatenate([[True], (np.diff(hit) != 1) | (np.diff(segment[hit]) != 0)]) if len(hit) else np.zeros(0, bool)
    first = hit[new]
    last = hit[np.concatenate([np.flatnonzero(new)[1:], [len(hit)]]) - 1] if len(hit) else none
    low = at[first] - index.starts[segment[first]]
    return segment[first], low, low + (last - first) + window


def scheme(hot: int | None = None) -> Scheme:
    more = {} if hot is None else {"hot": hot}
    return Scheme(WINDOW, GRAM, word_symbols, lambda symbols: symbols, np.dtype(np.uint64), False, in_smaller_document, **more)


CLEANED = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string"


def substring_dedup(docs: DataFrame, hot: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, spans of removed words, kept): every document without the words that a smaller one holds in a window."""
    rows, found = shared_stretches(docs, scheme(hot))

    def clean(docs: pa.Table, spans: pa.Table) -> pa.Table:
        text = docs.column("text")
        data, offsets = flat(text)
        raw = data.tobytes()
        counts = [len(raw[a:b].split()) for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
        places = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        gone = removed(docs, spans, places)
        kept, runs, n_removed = [], [], []
        for i, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
            words, out = raw[a:b].split(), gone[places[i] : places[i + 1]]
            if out.any():
                edges = np.flatnonzero(np.diff(out.astype(np.int8), prepend=0, append=0))
                runs.append([{"start": x, "end": y} for x, y in edges.reshape(-1, 2).tolist()])
                words = list(compress(words, ~out))
            else:
                runs.append([])
            n_removed.append(int(out.sum()))
            kept.append(b" ".join(words).decode())
        ids = [None if x == NO_ID else x for x in docs.column("id").to_pylist()]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table([pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(runs, kind), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "spans", "kept"])

    return rows.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(clean, CLEANED)


def digest(docs: DataFrame) -> DataFrame:
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def oracle() -> str:
    """The same result in DuckDB: every window as a row, grouped by its words."""
    w, n = r"[^\x20\x09-\x0D]+", WINDOW
    window = ", ".join(f"lead(word, {k}) OVER o AS w{k}" for k in range(1, n))
    names = ", ".join(["word", *(f"w{k}" for k in range(1, n))])
    last = "9223372036854775807"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{w}') AS ws FROM documents),
p AS (SELECT rid, doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
v AS (SELECT rid, doc_id, p, word, {window} FROM p WINDOW o AS (PARTITION BY rid ORDER BY p)),
x AS (SELECT rid, p AS i, coalesce(doc_id, {last}) > min(coalesce(doc_id, {last})) OVER (PARTITION BY {names}) AS later FROM v WHERE w{n - 1} IS NOT NULL),
r AS (SELECT DISTINCT rid, unnest(range(i, i + {n})) AS p FROM x WHERE later),
k AS (SELECT rid, count(r.p) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (r.p IS NULL) AS kept FROM p LEFT JOIN r USING (rid, p) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (rid)"""
