"""Suffix-array dedup by the interval tree of common prefixes.

A shard's distinct segments (bytes) get an enhanced suffix array: suffixes in
order, and the common prefix of each neighbouring pair.  A scan with a stack
visits the nested intervals of suffixes that share a prefix.  An interval whose
suffixes are preceded by different bytes cannot be extended to the left; it is a
maximal repeat, and all its occurrences are its group.  In each group all but the
first occurrence (smallest doc_id, then start) are removed.

How documents reach shards, and how hot passages are kept from piling up, is told
in :mod:`fundgraph.llm.shared_windows`.

Nulls: a null text is empty; a null doc_id comes after every other and is given
back as null.  Rows that repeat a doc_id with different texts are ordered by a hash of
the text; equal rows count as one document and get equal results.  An empty table gives
an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fundgraph.llm.common import NO_ID
from fundgraph.llm.shared_windows import Contents, Found, Scheme, removed, shared_stretches
from fundgraph.llm.text_arrays import byte_symbols, flat

#: Bytes of a repeat at least, and of the anchors that deal windows to shards.
WINDOW = 100
GRAM = 20

#: Stands for an interval whose suffixes are preceded by different bytes.
DIVERSE = -1


def _ranks(key: np.ndarray, suffix: np.ndarray, rank: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New ranks from the suffixes in the order of their keys, and those that still share one.

    ``group``: for each place in that order, where the group that it lies in began before.
    """
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    at = np.arange(len(key))
    first = np.maximum.accumulate(np.where(new, at, 0))
    old = np.concatenate([[True], group[1:] != group[:-1]]) if len(key) else new
    begin = np.maximum.accumulate(np.where(old, at, 0))
    out = rank.copy()
    out[suffix] = group + (first - begin)
    alone = new & np.concatenate([new[1:], [True]]) if len(key) else new
    return out, suffix[~alone]


def enhanced_suffix_array(symbols: np.ndarray, size: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of at least ``least`` bytes in order, and the prefix that each shares with the one before (0 for the first).

    Suffixes end with their segment.  Order by prefix doubling, from 7 bytes in one number; suffixes that are
    told apart are not sorted again.
    """
    n = len(symbols)
    end = np.repeat(np.cumsum(size), size)
    here = np.arange(n)
    padded = np.concatenate([symbols.astype(np.int64) + 1, np.zeros(8, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(7):
        key = key * 512 + np.where(here + j < end, padded[j : j + n], 0)
    # a rank is the place where its group of equal prefixes begins, so ranks stay right while other groups are told apart
    order = np.argsort(key, kind="stable")
    rank, active = _ranks(key[order], order, np.zeros(n, np.int32), np.zeros(n, np.int32))
    known, ranks = 7, [(7, rank)]
    while known < size.max(initial=0) and len(active):
        # only suffixes that share their prefix with another are sorted again, each within its group
        inside = here[active] + known < end[active]
        key = rank[active] * np.int64(n + 1)
        key[inside] += rank[active[inside] + known] + 1
        sort = np.argsort(key, kind="stable")
        rank, active = _ranks(key[sort], active[sort], rank, np.sort(rank[active]))
        known *= 2
        ranks.append((known, rank))
    long = np.flatnonzero(end - here >= least)
    order = long[np.argsort(rank[long], kind="stable")]
    a, b = order[:-1].copy(), order[1:].copy()
    end_a, end_b = end[a], end[b]
    shared = np.zeros(len(a), np.int64)
    for known, rank in reversed(ranks):
        inside = (a + shared < end_a) & (b + shared < end_b)
        same = np.zeros(len(a), bool)
        same[inside] = rank[(a + shared)[inside]] == rank[(b + shared)[inside]]
        shared[same] += known
    for _ in range(6):
        inside = (a + shared < end_a) & (b + shared < end_b)
        same = np.zeros(len(a), bool)
        same[inside] = symbols[(a + shared)[inside]] == symbols[(b + shared)[inside]]
        shared[same] += 1
    shared = np.minimum(shared, np.minimum(end_a - a, end_b - b))
    return order, np.concatenate([[0], shared])[: len(order)]


def repeat_groups(shared: np.ndarray, left: np.ndarray, when: np.ndarray, least: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Maximal repeats as (length, first place, last place) of the suffix order, and (place, length) of the occurrences to remove.

    ``left``: the byte before each suffix, DIVERSE where there is none.  ``when``:
    order of occurrence.  An occurrence that is not its group's first is reported once,
    with the longest repeat in which it comes later.
    """
    groups: list[tuple[int, int, int]] = []
    later: list[tuple[int, int]] = []
    stack: list[list] = []  # intervals that are open: length, first place, first occurrences of its children, byte before

    def close(last: int) -> tuple[int, int]:
        length, begin, children, before = stack.pop()
        lead = min(children, key=when.__getitem__)
        if before == DIVERSE:
            groups.append((length, begin, last))
            later.extend((x, length) for x in children if x != lead)
        return lead, before

    def add(child: tuple[int, int]) -> None:
        top = stack[-1]
        top[3] = child[1] if not top[2] or top[3] == child[1] else DIVERSE
        top[2].append(child[0])

    # places whose prefix with the one before is long enough, and the one that opens each row of them
    lengths, before = shared.tolist(), left.tolist()
    when = when.tolist()
    n = len(lengths)
    inside = np.flatnonzero(shared >= least)
    for i in inside.tolist():
        length, begin, child = lengths[i], i - 1, (i - 1, before[i - 1])
        while stack and stack[-1][0] > length:
            add(child)
            begin = stack[-1][1]
            child = close(i - 1)
        if not stack or stack[-1][0] < length:
            stack.append([length, begin, [], DIVERSE])
        add(child)
        if i + 1 == n or lengths[i + 1] < least:
            child = (i, before[i])
            while stack:
                add(child)
                child = close(i)
    return groups, later


def later_repeats(contents: Contents, least: int = WINDOW) -> Found:
    """Stretches of segments that occur earlier."""
    none = np.zeros(0, np.int64)
    if not len(contents.size):
        return none, none, none
    order, shared = enhanced_suffix_array(contents.symbols, contents.size, least)
    # only suffixes that share enough with a neighbour lie in an interval; the first of each row of them keeps rows apart
    long = shared >= least
    held = long | np.append(long[1:], False)
    order, shared = order[held], shared[held]
    starts = np.cumsum(contents.size) - contents.size
    segment = np.searchsorted(starts, order, "right") - 1
    inside = order - starts[segment]
    left = np.where(inside > 0, contents.symbols[order - 1].astype(np.int64), DIVERSE)
    when = np.empty(len(order), np.int64)
    when[np.lexsort((contents.start[segment] + inside, contents.text_key[segment], contents.id[segment]))] = np.arange(len(order))
    _, later = repeat_groups(shared, left, when, least)
    if not later:
        return none, none, none
    place, length = np.array(later, np.int64).T
    return segment[place], inside[place], inside[place] + length


def scheme(hot: int | None = None) -> Scheme:
    more = {} if hot is None else {"hot": hot}
    return Scheme(WINDOW, GRAM, lambda data, offsets: (data, offsets), byte_symbols, np.dtype(np.uint8), True, later_repeats, **more)


CLEANED = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"


def suffix_dedup(docs: DataFrame, hot: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans of removed bytes, kept): every document without its bytes in repeats that occur earlier."""
    rows, found = shared_stretches(docs, scheme(hot))

    def clean(docs: pa.Table, spans: pa.Table) -> pa.Table:
        data, offsets = flat(docs.column("text"))
        gone = removed(docs, spans, offsets)
        edges = np.zeros(len(data) + 1, bool)
        edges[1:-1] = gone[1:] != gone[:-1]
        edges[offsets] = True
        bounds = np.flatnonzero(edges)
        first, last = bounds[:-1], bounds[1:]
        out = gone[first] if len(first) else np.zeros(0, bool)
        first, last = first[out], last[out]
        of = np.searchsorted(offsets, first, "right") - 1
        per_doc = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(offsets) - 1))])
        spans_out = pa.ListArray.from_arrays(pa.array(per_doc, pa.int32()), pa.StructArray.from_arrays([pa.array(first - offsets[of]), pa.array(last - offsets[of])], ["start", "end"]))
        total = np.concatenate([[0], np.cumsum(gone)])
        n_removed = total[offsets[1:]] - total[offsets[:-1]]
        kept_offsets = offsets - total[offsets]
        kept = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(kept_offsets.astype(np.int32)), pa.py_buffer(data[~gone].tobytes())])
        ids = [None if x == NO_ID else x for x in docs.column("id").to_pylist()]
        return pa.table([pa.array(ids, pa.int64()), pa.array(np.diff(offsets)), pa.array(n_removed), spans_out, kept], ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return rows.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(clean, CLEANED)


def digest(docs: DataFrame) -> DataFrame:
    return suffix_dedup(docs).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
