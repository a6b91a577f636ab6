"""Stretches of text that occur elsewhere: what substring dedup by any index has in common.

Texts are sequences of symbols (words or bytes); a window is ``window`` of them in
a row.  Every window has an anchor: of its runs of ``gram`` symbols, the one with the
smallest hash.  Equal windows have equal anchors, and neighbouring windows mostly share
one, so a text falls into segments (windows in a row around one anchor).

1. Documents are dealt into batches by a hash of id and text.  A batch sends each
   anchor it holds once, with a count, to the anchor's bucket.
2. A bucket answers each batch with those of its anchors that the corpus holds twice or more.
3. A batch sends its segments around such anchors to the anchor's shard, equal
   segments once (under the document that comes first); the others are removed at once.
4. A shard unites equal segments again, indexes the distinct ones (``resolve``)
   and reports the stretches that occur earlier.
5. Batches join their documents with the stretches found.

Nothing is gathered whole: an anchor in a third of all documents reaches its bucket
once per batch, a passage reaches its shard once per batch, and an anchor with more than
``hot`` occurrences in different contexts is dealt by whole windows instead, each to
the shard of its own hash.  The steps are one plan; the dealt documents are one
exchange, which its three readers reuse.

Symbols, segments and windows are compared by 64-bit hashes where they are dealt
and united; the index of a shard compares symbols themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fundgraph.llm.common import NO_ID, parts_for, texts, total_bytes
from fundgraph.llm.text_arrays import flat, mix, powers, prefix_hash, stretch_hash, _P_INVERSE

#: Text of one partition; a partition holds some BATCHES batches.
PART_BYTES = 32 << 20
BATCHES = 4

#: Text for each shard: what an index needs is a multiple of its shard's segments, so shards are small.
SHARD_BYTES = 1 << 20

#: Symbols handled at a time.
CHUNK = 1 << 20

#: Occurrences from which on an anchor is dealt by whole windows.
HOT = 100_000

_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class Contents:
    """Distinct segments of a shard: symbols laid end to end, and for each segment its first document and place."""

    symbols: np.ndarray
    size: np.ndarray
    id: np.ndarray
    text_key: np.ndarray
    start: np.ndarray


#: Stretches (segment, from, to) of the segments that occur earlier.
Found = tuple[np.ndarray, np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Scheme:
    """``symbols`` gives a batch's symbols, their offsets by text, and a 64-bit value of each symbol.

    ``same_document``: whether a stretch that occurs earlier in its own document counts;
    if not, all occurrences in the document with the smallest id stay.
    """

    window: int
    gram: int
    symbols: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    values: Callable[[np.ndarray], np.ndarray]
    dtype: np.dtype
    same_document: bool
    resolve: Callable[[Contents], Found]
    hot: int = HOT


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span, out = 1, x
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def segments(values: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, windows and anchor of every segment, and the sums for hashes of stretches."""
    n = len(values)
    prefix = prefix_hash(values)
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none, np.zeros(0, np.uint64), prefix
    grams = mix((prefix[gram:] - prefix[:-gram]) * powers(_P_INVERSE, n - gram + 1))
    # the smaller hash wins, then the place further left: equal windows choose alike
    least = sliding_min((grams & _HIGH) | np.arange(len(grams), dtype=np.uint64), window - gram + 1)
    at = (least & _LOW).astype(np.int64)
    crossing = np.zeros(n + 1, np.int64)
    inner = offsets[1:-1]
    np.add.at(crossing, np.maximum(inner - window + 1, 0), 1)
    np.add.at(crossing, inner, -1)
    starts = np.flatnonzero(np.cumsum(crossing)[: len(at)] == 0)
    if not len(starts):
        return none, none, np.zeros(0, np.uint64), prefix
    at = at[starts]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(starts) != 1) | (np.diff(at) != 0)]))
    return starts[new], np.diff(np.concatenate([new, [len(starts)]])), grams[at[new]], prefix


def pieces(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of whole texts with about CHUNK symbols."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1)
        yield first, last
        first = last


def expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of stretches, one after the other."""
    total = int(sizes.sum())
    return np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)


def firsts(content: np.ndarray, size: np.ndarray, order: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences sorted by content, then by ``order``; where each content begins, and which of them each belongs to."""
    sort = np.lexsort((*reversed(order), size, content))
    c, s = content[sort], size[sort]
    new = np.concatenate([[True], (c[1:] != c[:-1]) | (s[1:] != s[:-1])]) if len(c) else np.zeros(0, bool)
    return sort, np.flatnonzero(new), np.cumsum(new) - 1


def dealt(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """(batch, id, text_key, text) in one partitioning, the number of its partitions, and that of shards."""
    rows = texts(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("text_key"), "text")
    size = total_bytes(rows)
    n, shards = (parts_for(docs.sparkSession, size, each) for each in (PART_BYTES, SHARD_BYTES))
    batch = F.pmod(F.xxhash64("id", "text_key"), F.lit(n * BATCHES)).cast("int")
    return rows.select(batch.alias("batch"), "id", "text_key", "text").repartition(n, "batch"), n, shards


ANCHORS = "bucket int, batch int, anchors binary, counts binary"
SHARED = "batch int, anchors binary, hot binary"
SEGMENTS = "shard int, batch int, symbols binary, sizes binary, ids binary, keys binary, starts binary, which binary"
SPANS = "batch int, ids binary, keys binary, starts binary, ends binary"


def rows_of(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def joined(t: pa.Table, column: str, dtype: type | np.dtype) -> np.ndarray:
    """A binary column's arrays, one after the other."""
    data, _ = flat(t.column(column))
    return np.frombuffer(data.tobytes(), dtype)


def lengths(t: pa.Table, column: str, width: int) -> np.ndarray:
    return np.diff(flat(t.column(column))[1]) // width


def shared_stretches(docs: DataFrame, scheme: Scheme) -> tuple[DataFrame, DataFrame]:
    """The dealt documents, and (batch, ids, keys, starts, ends): stretches of their symbols to remove, in binary arrays."""
    rows, n, shards = dealt(docs)
    window, gram = scheme.window, scheme.gram

    def anchors(t: pa.Table) -> pa.Table:
        symbols, offsets = scheme.symbols(*flat(t.column("text")))
        found = []
        for first, last in pieces(offsets):
            some = symbols[offsets[first] : offsets[last]]
            found.append(segments(scheme.values(some), offsets[first : last + 1] - offsets[first], window, gram)[2])
        own, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        bucket = (own % np.uint64(n)).astype(np.int64)
        sort = np.argsort(bucket, kind="stable")
        bucket, own, counts = bucket[sort], own[sort], counts[sort].astype(np.uint32)
        new = np.flatnonzero(np.diff(bucket, prepend=-1))
        batch = t.column("batch")[0].as_py()
        return rows_of(ANCHORS, [(int(bucket[a]), batch, own[a:b].tobytes(), counts[a:b].tobytes()) for a, b in zip(new, [*new[1:], len(own)])])

    def shared(t: pa.Table) -> pa.Table:
        own, counts, sizes = joined(t, "anchors", np.uint64), joined(t, "counts", np.uint32), lengths(t, "anchors", 8)
        distinct, which = np.unique(own, return_inverse=True)
        total = np.bincount(which, counts, len(distinct))[which]
        out, at = [], 0
        for batch, size in zip(t.column("batch").to_pylist(), sizes.tolist()):
            again = total[at : at + size] > 1
            if again.any():
                out.append((batch, own[at : at + size][again].tobytes(), (total[at : at + size][again] > scheme.hot).tobytes()))
            at += size
        return rows_of(SHARED, out)

    def send(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows or not answers.num_rows:
            return rows_of(SEGMENTS, [])
        known, hot = joined(answers, "anchors", np.uint64), joined(answers, "hot", bool)
        sort = np.argsort(known)
        known, hot = known[sort], hot[sort]
        symbols, offsets = scheme.symbols(*flat(docs.column("text")))
        parts = []
        for first, last in pieces(offsets):
            low = offsets[first]
            starts, windows, anchor, prefix = segments(scheme.values(symbols[low : offsets[last]]), offsets[first : last + 1] - low, window, gram)
            place = np.minimum(np.searchsorted(known, anchor), len(known) - 1)
            held = known[place] == anchor
            split = held & hot[place]
            held &= ~split
            one = expand(starts[split], windows[split])
            starts, sizes, key = np.concatenate([starts[held], one]), np.concatenate([windows[held] + window - 1, np.full(len(one), window)]), anchor[held]
            content = stretch_hash(prefix, starts, starts + sizes)
            # the whole-window segments of hot anchors go where their own hash says
            shard = (np.concatenate([key, content[len(key) :]]) // np.uint64(n) % np.uint64(shards)).astype(np.int64)
            parts.append((starts + low, sizes, content, shard))
        starts, sizes, content, shard = (np.concatenate(x) for x in zip(*parts))
        of = np.searchsorted(offsets, starts, "right") - 1
        ids, keys = (docs.column(c).to_numpy()[of] for c in ("id", "text_key"))
        places = starts - offsets[of]
        batch = docs.column("batch")[0].as_py()
        return pack_segments(scheme, batch, symbols, starts, sizes, content, shard, ids, keys, places)

    def resolve(t: pa.Table) -> pa.Table:
        return resolve_shard(scheme, t)

    asked = rows.groupBy("batch").applyInArrow(anchors, ANCHORS)
    answered = asked.groupBy("bucket").applyInArrow(shared, SHARED)
    sent = rows.groupBy("batch").cogroup(answered.groupBy("batch")).applyInArrow(send, SEGMENTS)
    return rows, sent.repartition(n, "shard").groupBy("shard").applyInArrow(resolve, SPANS)


def pack_segments(
    scheme: Scheme, batch: int, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, content: np.ndarray, shard: np.ndarray, ids: np.ndarray, keys: np.ndarray, places: np.ndarray
) -> pa.Table:
    """A row for each shard: the symbols of each distinct segment once, and all its occurrences.

    ``which`` numbers an occurrence's segment in the row; -1 - that number for one that comes after another in the batch.
    """
    sort, new, group = firsts(content, sizes, (ids, keys, places))
    lead = sort[new][group]
    kept = (sort == lead) if scheme.same_document else ids[sort] == ids[lead]
    shard_sorted = shard[sort]
    out = []
    order = np.argsort(shard_sorted, kind="stable")
    bounds = np.flatnonzero(np.diff(shard_sorted[order], prepend=-1))
    for a, b in zip(bounds, [*bounds[1:], len(order)]):
        some = order[a:b]
        rows, leads, stays = sort[some], group[some], kept[some]
        # segments are in order of their group, so each new group is the next segment of the row
        index = np.cumsum(np.diff(leads, prepend=-1) != 0) - 1
        one = rows[np.diff(leads, prepend=-1) != 0]
        text = symbols[expand(starts[one], sizes[one])]
        which = np.where(stays, index, -1 - index)
        out.append((int(shard_sorted[some[0]]), batch, text.tobytes(), sizes[one].astype(np.int32).tobytes(), ids[rows].tobytes(), keys[rows].tobytes(), places[rows].tobytes(), which.astype(np.int32).tobytes()))
    return rows_of(SEGMENTS, out)


def resolve_shard(scheme: Scheme, t: pa.Table) -> pa.Table:
    """Stretches to remove in the documents of a shard's segments, by batch."""
    symbols, sizes = joined(t, "symbols", scheme.dtype), joined(t, "sizes", np.int32).astype(np.int64)
    ids, keys, places, which = (joined(t, c, k) for c, k in (("ids", np.int64), ("keys", np.int64), ("starts", np.int64), ("which", np.int32)))
    per_row, segments_of = lengths(t, "ids", 8), lengths(t, "sizes", 4)
    row = np.repeat(np.arange(t.num_rows), per_row)
    later = which < 0
    segment = np.where(later, -1 - which, which) + np.repeat(np.cumsum(segments_of) - segments_of, per_row)
    starts = np.cumsum(sizes) - sizes
    content = stretch_hash(prefix_hash(scheme.values(symbols)), starts, starts + sizes)
    # occurrences that a batch kept, united over batches
    own = np.flatnonzero(~later)
    sort, new, group = firsts(content[segment[own]], sizes[segment[own]], (ids[own], keys[own], places[own]))
    occ = own[sort]
    lead = occ[new]
    kept = (occ == lead[group]) if scheme.same_document else ids[occ] == ids[lead][group]
    gone = np.concatenate([np.flatnonzero(later), occ[~kept]])
    pick = segment[lead]
    contents = Contents(symbols[expand(starts[pick], sizes[pick])], sizes[pick], ids[lead], keys[lead], places[lead])
    at, low, high = scheme.resolve(contents)
    # what is found in a segment holds for all its occurrences that are left
    left, left_group = occ[kept], group[kept]
    first_left = np.searchsorted(left_group, np.arange(len(lead)))
    many = np.bincount(left_group, minlength=len(lead))[at]
    target = left[expand(first_left[at], many)] if len(at) else np.zeros(0, np.int64)
    target = np.concatenate([gone, target])
    from_, to = np.concatenate([np.zeros(len(gone), np.int64), np.repeat(low, many)]), np.concatenate([sizes[segment[gone]], np.repeat(high, many)])
    batch = t.column("batch").to_numpy()[row[target]]
    order = np.argsort(batch, kind="stable")
    batch, target, from_, to = batch[order], target[order], from_[order], to[order]
    bounds = np.flatnonzero(np.diff(batch, prepend=-1))
    columns = (ids[target], keys[target], places[target] + from_, places[target] + to)
    return rows_of(SPANS, [(int(batch[a]), *(c[a:b].tobytes() for c in columns)) for a, b in zip(bounds, [*bounds[1:], len(batch)])])


def removed(docs: pa.Table, spans: pa.Table, offsets: np.ndarray) -> np.ndarray:
    """For each symbol of a batch whether a stretch covers it."""
    change = np.zeros(int(offsets[-1]) + 1, np.int64)
    if spans.num_rows:
        ids, keys, starts, ends = (joined(spans, c, np.int64) for c in ("ids", "keys", "starts", "ends"))
        sort = np.lexsort((keys, ids))
        ids, keys, starts, ends = ids[sort], keys[sort], starts[sort], ends[sort]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(ids) != 0) | (np.diff(keys) != 0)]))
        where = {(int(ids[a]), int(keys[a])): (a, b) for a, b in zip(new, [*new[1:], len(ids)])}
        for i, document in enumerate(zip(docs.column("id").to_pylist(), docs.column("text_key").to_pylist())):
            if document in where:
                a, b = where[document]
                np.add.at(change, offsets[i] + starts[a:b], 1)
                np.add.at(change, offsets[i] + ends[a:b], -1)
    return np.cumsum(change)[:-1] > 0
