import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash
from llm_frames import LONG, edge_rows, empty, frame, random_rows

import corpus_pipeline
from fundgraph.llm import simhash, substring_dedup, suffix_dedup
from fundgraph.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(b):
    return hashlib.sha256(b).hexdigest()


def brute_words(rows, window=13):
    docs = [(LONG if d is None else d, WORD.findall(t or "")) for d, t in rows]
    first = {}
    for d, w in docs:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, LONG), d)
    out = []
    for (d, w), (real, _) in zip(docs, rows):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out.append((real, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g).encode())))
    return sorted(out, key=repr)


def brute_bytes(rows, window=100):
    """For distinct (doc_id, text) rows with distinct ids."""
    seen, out = set(), []
    for d, t in sorted(rows, key=lambda r: LONG if r[0] is None else r[0]):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if b[i : i + window] in seen:
                gone[i : i + window] = True
            seen.add(b[i : i + window])
        runs = int(np.diff(gone.astype(np.int8), prepend=0).clip(0).sum())
        out.append((d, len(b), int(gone.sum()), runs, sha(np.frombuffer(b, np.uint8)[~gone].tobytes())))
    return sorted(out, key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def words_result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, sha(r.kept.encode())) for r in df.collect()), key=repr)


def bytes_result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), sha(bytes(r.kept))) for r in df.collect()), key=repr)


@pytest.mark.parametrize("hot", [None, 2])
def test_substrings_equal_brute_force(spark, hot):
    rows = random_rows(120, 1)
    assert sum(r[2] for r in brute_words(rows)) > 0
    assert words_result(substring_dedup.substring_dedup(frame(spark, rows), hot)) == brute_words(rows)


def test_substring_edges(spark):
    assert collected(substring_dedup.digest(frame(spark, edge_rows()))) == brute_words(edge_rows())
    assert collected(substring_dedup.digest(empty(spark))) == []


def test_fm_index_counts_every_sequence():
    rng = np.random.default_rng(2)
    size = np.array([30, 1, 45, 20])
    symbols = rng.integers(0, 3, size.sum()).astype(np.uint64)
    index = substring_dedup.FMIndex(symbols, size, 5)
    texts = np.split(symbols, np.cumsum(size)[:-1])
    at = np.concatenate([s + np.arange(max(0, n - 4)) for s, n in zip(index.starts, size)])
    stretch = [tuple(t[i : i + 5]) for t in texts for i in range(max(0, len(t) - 4))]
    hit, low, high = index.repeated(at, 5)
    found = dict(zip(hit.tolist(), (high - low).tolist()))
    assert [found.get(i, 1) for i in range(len(at))] == [stretch.count(s) for s in stretch]


@pytest.mark.parametrize("hot", [None, 2])
def test_suffixes_equal_brute_force(spark, hot):
    rows = [*random_rows(80, 3), (900, "ab" * 300), (901, "b" + "ab" * 120), (902, "é" * 250), (903, "q" * 99), (904, "q" * 100), (905, "q" * 101)]
    assert bytes_result(suffix_dedup.suffix_dedup(frame(spark, rows), hot)) == brute_bytes(rows)


def test_suffix_edges(spark):
    rows = [r for r in edge_rows() if r[0] not in (5, 6, None)] + [(None, "null " + "k" * 300)]
    assert bytes_result(suffix_dedup.suffix_dedup(frame(spark, rows))) == brute_bytes(rows)
    # equal rows count as one document; an id with two texts is ordered by their hash, so its result is the same in any order
    got = bytes_result(suffix_dedup.suffix_dedup(frame(spark, edge_rows())))
    assert len(got) == len(edge_rows()) and got == bytes_result(suffix_dedup.suffix_dedup(frame(spark, edge_rows()[::-1])))
    assert collected(suffix_dedup.digest(empty(spark))) == []


def test_repeat_groups_are_maximal_with_all_occurrences():
    texts = [b"xxabcabcabyy", b"zabcabw", b"abcab"]
    size = np.array([len(t) for t in texts])
    symbols = np.frombuffer(b"".join(texts), np.uint8)
    order, shared = suffix_dedup.enhanced_suffix_array(symbols, size, 2)
    starts = np.cumsum(size) - size
    segment = np.searchsorted(starts, order, "right") - 1
    left = np.where(order > starts[segment], symbols[order - 1].astype(np.int64), suffix_dedup.DIVERSE)
    groups, _ = suffix_dedup.repeat_groups(shared, left, np.argsort(np.argsort(order)), 2)
    got = {bytes(symbols[order[a] : order[a] + n]): sorted(order[a : b + 1].tolist()) for n, a, b in groups}

    def occurrences(s):
        return [int(starts[k]) + i for k, t in enumerate(texts) for i in range(len(t) - len(s) + 1) if t[i : i + len(s)] == s]

    want = {}
    for t in set(t[i:j] for t in texts for i in range(len(t)) for j in range(i + 2, len(t) + 1)):
        at = occurrences(t)
        ends = [i + len(t) for i in at]
        lefts = {bytes([symbols[i - 1]]) if i not in starts else i for i in at}
        rights = {bytes([symbols[e]]) if e not in np.cumsum(size) else e for e in ends}
        if len(at) > 1 and len(lefts) > 1 and len(rights) > 1:
            want[t] = at
    assert got == want


def brute_print(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(rows):
    prints = [brute_print(t) for _, t in rows]
    ids = [LONG if d is None else d for d, _ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 or ids[i] == ids[j]:
                parent[find(i)] = find(j)
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), LONG), ids[i])
    return sorted(((rows[i][0], f"{prints[i]:016x}", None if least[find(i)] == LONG else least[find(i)]) for i in range(len(rows))), key=repr)


@pytest.mark.parametrize("shard_nodes", [20_000, 4])
def test_simhash_equals_brute_force(spark, shard_nodes):
    rnd = random.Random(4)
    base = [[rnd.choice("abcdefghijklmnop") + str(rnd.randint(0, 99)) for _ in range(200)] for _ in range(4)]
    rows = []
    for i in range(150):
        w = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(len(w))] = "Edited"
        rows.append((i * 3 % 151, " ".join(w)))
    got = simhash.near_duplicates(frame(spark, rows), shard_nodes=shard_nodes, by_id=True)
    got = sorted(((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in got.collect()), key=repr)
    assert got == brute_groups(rows) and len({g[2] for g in got}) < 100


def test_simhash_edges(spark):
    assert collected(simhash.digest(frame(spark, edge_rows()), by_id=True)) == brute_groups(edge_rows())
    assert collected(simhash.digest(empty(spark))) == []
    kept = simhash.one_of_each(frame(spark, edge_rows()), by_id=True)
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and set(ids) == {g[2] for g in brute_groups(edge_rows())}
    assert kept.columns == frame(spark, edge_rows()).columns


def test_rows_without_an_id_and_texts_of_one_id_are_told_apart(spark, tmp_path):
    rnd = random.Random(8)
    some = lambda: " ".join(rnd.choice("abcdefghijklmnop") + str(rnd.randint(0, 999)) for _ in range(200))
    a, b, c, d, e, f = (some() for _ in range(6))
    rows = [(1, a), (2, b), (None, a), (None, b), (None, c), (None, c), (None, d), (3, e), (3, f), (3, f), (None, None), (None, "")]
    prints = [brute_print(t) for _, t in rows]
    assert all((x ^ y).bit_count() > 3 for x in prints for y in prints if x != y)
    frame(spark, rows, clash=False).write.parquet(f"{tmp_path}/documents.parquet")
    component = {a: 1, b: 2, e: 3, f: 3}
    want = sorted(((i, f"{p:016x}", component.get(t)) for (i, t), p in zip(rows, prints)), key=repr)
    assert collected(QUERIES["op6_simhash"](spark, str(tmp_path))) == want
    kept = corpus_pipeline.near_duplicates(spark, frame(spark, rows), str(tmp_path))
    assert kept.columns == frame(spark, rows).columns
    assert sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=repr) == sorted([(1, a), (2, b), (None, c), (None, d), (3, e), (3, f), (None, "")], key=repr)
    assert {(r.sim_id, r.sim_tie, r.sim_row) for r in kept.collect()} == {("x", "x", "x")}


def test_of_equal_rows_the_same_one_stays(spark):
    rows = [(1, "some text of a few words")] * 3
    some = frame(spark, rows, clash=False).select("doc_id", "text", F.monotonically_increasing_id().alias("nth"))
    stored = spark.createDataFrame(some.toPandas())
    kept = {simhash.one_of_each(stored.repartition(n)).first().nth for n in (1, 2, 3)}
    assert len(kept) == 1
