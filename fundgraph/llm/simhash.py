"""SimHash near-duplicates: fingerprints, BK-trees per shard, connected groups.

Equal fingerprints are one node.  Two 64-bit fingerprints within ``radius`` bits
agree on at least one of radius + 1 pieces, so every node goes to one shard for
each of its pieces, and each link lies within some shard.  A shard with more
nodes than SHARD_NODES is dealt again by the pieces of its remaining bits, until
it fits or no bits are left, so no task holds more than a bounded tree.  A shard's
BK-tree (children keyed by their integer distance to the parent) travels to the
task that holds the shard's queries, and a query follows only the edges within
the radius.  Of the pairs found, a shard reports one link per node at most (to
the root of its group), which keeps every connection and never lists the pairs
of a group.

Words are lower-cased in A-Z and split at ASCII white space; shingles keep
repeats.  Nulls: a null text is empty and has fingerprint zero, which links like
any other; a null doc_id comes after every other and is given back as null.  A
group's component_id is its smallest doc_id, null if it has none.  Fingerprints
alone link, so texts that share a doc_id, or have none, are told apart; ``by_id``
also makes the rows of one doc_id, null included, one document.  An empty table
gives an empty result.  Other columns, whatever their names, change no group and
stay with the rows kept; of rows equal in doc_id and text the one of the smallest
hash stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fundgraph.llm.common import NO_ID, texts
from fundgraph.llm.components import smallest_reachable
from fundgraph.llm.text_arrays import whole_groups
from fundgraph.session import cut, discard

SHINGLE = 3
RADIUS = 3

#: Most nodes in one BK-tree while bits are left to split by.
SHARD_NODES = 20_000

#: Pairs of query and tree node that one step handles.
FRONTIER = 1 << 20

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is 1 if over half the shingles' hashes have it."""
    from xxhash import xxh64_intdigest

    words = _WORD.findall(text.translate(_LOWER))
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0, *(e + 1 for e in ends)]
    k = min(shingle, len(words))
    hashes = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, ends[k - 1 :])], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # little-endian bytes, lowest bit first: place i is bit i
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def tie_of(text: str) -> Column:
    """Tells the texts of one doc_id, or of none, from each other."""
    return F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, tie: bool = False) -> DataFrame:
    """(id, fp): a null doc_id as NO_ID, the fingerprint as a signed long; with ``tie`` also tie_of the text."""
    more = ["tie"] if tie else []

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_buffer().to_pybytes(), shingle) for t in batch.column("text").cast(pa.large_binary())], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.view(np.int64)), *map(batch.column, more)], ["id", "fp", *more])

    rows = texts(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text", *[tie_of("text").alias(c) for c in more])
    return rows.mapInArrow(compute, "id long, fp long" + ", tie string" * tie)


def split(rows: DataFrame, bits: int, pieces: int) -> DataFrame:
    """Each row once per piece of its ``bits`` left: a key that names the piece, and the other bits as the new ``rest``."""
    ways = []
    for j in range(pieces):
        lo, hi = j * bits // pieces, (j + 1) * bits // pieces
        piece = F.shiftrightunsigned("rest", lo).bitwiseAND((1 << (hi - lo)) - 1)
        above = F.lit(0).cast("long") if hi >= 64 else F.shiftleft(F.shiftrightunsigned("rest", hi), lo)
        below = F.col("rest").bitwiseAND((1 << lo) - 1)
        ways.append(F.struct(F.xxhash64("key", F.lit(j), piece).alias("key"), above.bitwiseOR(below).alias("rest")))
    return rows.withColumn("way", F.explode(F.array(*ways))).select("node", "fp", "way.key", "way.rest")


def shards(nodes: DataFrame, radius: int, most: int) -> list[DataFrame]:
    """Tables (node, fp, key) whose keys hold every pair within ``radius`` at least once."""
    pieces, bits = radius + 1, 64
    rows = split(nodes.select("node", "fp", F.lit(0).cast("long").alias("key"), F.col("fp").alias("rest")), bits, pieces)
    out = []
    while True:
        bits -= bits // pieces
        stored = cut(rows, "shards")
        large = cut(stored.groupBy("key").count().filter(F.col("count") > most).select("key"), "shards")
        if bits <= pieces or large.isEmpty():
            discard(large)
            return [*out, stored.select("node", "fp", "key")]
        out.append(stored.join(large, "key", "left_anti").select("node", "fp", "key"))
        rows = split(stored.join(large, "key", "left_semi"), bits, pieces)


def bk_forest(fp: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of one BK-tree per shard, level by level for all trees: sorted parent * 65 + distance, and the child of each.

    ``root`` has each node's first of its shard; fingerprints of a shard differ.
    """
    keys, children = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    active = np.flatnonzero(root != np.arange(len(fp)))
    parent = root[active]
    while len(active):
        edge = parent * 65 + np.bitwise_count(fp[active] ^ fp[parent]).astype(np.int64)
        own, first, which = np.unique(edge, return_index=True, return_inverse=True)
        child = active[first]
        keys.append(own)
        children.append(child)
        stay = np.ones(len(active), bool)
        stay[first] = False
        active, parent = active[stay], child[which][stay]
    key, child = np.concatenate(keys), np.concatenate(children)
    order = np.argsort(key)
    return key[order], child[order]


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the groups of a and b, pair by pair; a group's label is its smallest member."""

    def find(x: np.ndarray) -> np.ndarray:
        while True:
            up = label[label[x]]
            if np.array_equal(up, label[x]):
                return up
            label[x] = up

    while True:
        ra, rb = find(a), find(b)
        differ = ra != rb
        if not differ.any():
            return
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))


def groups_within(fp: np.ndarray, shard: np.ndarray, radius: int) -> np.ndarray:
    """Each node's group: nodes of one shard connected by steps of at most ``radius`` bits.  ``shard`` is sorted."""
    n = len(fp)
    first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
    root = np.repeat(first, np.diff(np.concatenate([first, [n]])))
    key, child = bk_forest(fp, root)
    label = np.arange(n)
    several = np.flatnonzero(np.repeat(np.diff(np.concatenate([first, [n]])) > 1, np.diff(np.concatenate([first, [n]]))))
    stack = [(several, root[several])]
    while stack:
        query, node = stack.pop()
        if len(query) > FRONTIER:
            half = len(query) // 2
            stack += [(query[:half], node[:half]), (query[half:], node[half:])]
            continue
        distance = np.bitwise_count(fp[query] ^ fp[node]).astype(np.int64)
        near = (distance <= radius) & (query != node)
        unite(label, query[near], node[near])
        lo = np.searchsorted(key, node * 65 + np.maximum(distance - radius, 0), "left")
        hi = np.searchsorted(key, node * 65 + np.minimum(distance + radius, 64), "right")
        many = hi - lo
        if total := int(many.sum()):
            at = np.arange(total) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)
            stack.append((np.repeat(query, many), child[at]))
    while not np.array_equal(label, label[label]):
        label = label[label]
    return label


def links(shard_rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): a link from each node of a shard to the root of its group there, if that is another node."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "key"):
            node, fp, key = (t.column(c).to_numpy() for c in ("node", "fp", "key"))
            label = groups_within(fp.view(np.uint64), key, radius)
            moved = label != np.arange(len(label))
            yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[label[moved]])], ["u", "v"])

    return shard_rows.repartition("key").sortWithinPartitions("key", "node", "fp").mapInArrow(search, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, shard_nodes: int = SHARD_NODES, by_id: bool = False) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``; ``by_id`` also links the texts of a doc_id."""
    prints = cut(fingerprints(docs, shingle), "fingerprints")
    out = prints.join(grouped(prints, radius, shard_nodes, by_id), "fp")
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(real("id").alias("doc_id"), "fp", real("least").alias("component_id"))


def grouped(prints: DataFrame, radius: int, shard_nodes: int, by_id: bool) -> DataFrame:
    """(fp, group, least): each fingerprint's group, named by a fingerprint of it, and the group's smallest id."""
    nodes = cut(prints.groupBy("fp").agg(F.min("id").alias("least")).withColumn("node", F.col("fp")), "fingerprints")
    found = shards(nodes, radius, shard_nodes)
    edges = links(found[0], radius)
    for more in found[1:]:
        edges = edges.union(links(more, radius))
    if by_id:
        repeated = prints.groupBy("id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).filter("lo <> hi").select("id", "lo")
        edges = edges.union(prints.join(repeated, "id").select("fp", "lo"))
    component = smallest_reachable(edges)
    named = cut(nodes.join(component, "node", "left").select("fp", F.coalesce("component", "node").alias("group"), F.col("least").alias("own")), "fingerprints")
    least = cut(named.groupBy("group").agg(F.min("own").alias("least")), "fingerprints")
    return cut(named.join(least, "group").select("fp", "group", "least"), "fingerprints")


def digest(docs: DataFrame, by_id: bool = False) -> DataFrame:
    """The contract's columns."""
    return near_duplicates(docs, by_id=by_id).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, by_id: bool = False) -> DataFrame:
    """One row of each group: that of the smallest doc_id and, of its texts in the group, the smallest hash."""
    prints = cut(fingerprints(docs, tie=True), "fingerprints")
    group = grouped(prints, RADIUS, SHARD_NODES, by_id).select("fp", "group")
    rows = prints.join(group, "fp").groupBy("group", "id", "tie").agg(F.count("*").alias("rows"))
    best = rows.groupBy("group").agg(F.min(F.struct("id", "tie", "rows")).alias("best"))
    kept = cut(best.select(F.col("best.id").alias("sim_id"), F.col("best.tie").alias("sim_tie"), F.col("best.rows").alias("sim_rows")), "kept")
    # the row travels as one struct, so none of its columns can meet a key
    keyed = docs.select(F.struct("*").alias("sim_row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("sim_id"), tie_of("text").alias("sim_tie"))
    own = ["sim_id", "sim_tie"]
    once = keyed.join(kept.filter("sim_rows = 1"), own, "left_semi").select("sim_row.*")
    if (repeats := kept.filter("sim_rows > 1")).isEmpty():
        return once
    first = F.min_by("sim_row", F.xxhash64(F.to_json("sim_row"))).alias("sim_row")
    return once.unionByName(keyed.join(repeats, own, "left_semi").groupBy(*own).agg(first).select("sim_row.*"))
