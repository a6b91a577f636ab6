import hashlib
import math
import random
import re
from itertools import permutations

import numpy as np
import pytest
from llm_frames import LONG, edge_rows, empty, frame, random_rows
from pyspark.sql import functions as F

from fundgraph.llm import filter_audit, lexical_search, line_dedup


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# line dedup

BLANKS = " \t\n\x0b\x0c\r"


def brute_key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute_lines(rows, least=20, docs=3):
    """A document is its id, or its text where it has none; those come first, by MD5."""
    place = lambda d, t: (0, hashlib.md5(t.encode()).hexdigest()) if d is None else (1, d)
    rows = [(d, t or "") for d, t in rows]
    held = {}
    for d, t in rows:
        for line in t.split("\n"):
            if len(brute_key(line)) >= least:
                held.setdefault(brute_key(line), set()).add(place(d, t))
    out = []
    for d, t in rows:
        lines = t.split("\n")
        lost = [len(held.get(brute_key(x), ())) >= docs and place(d, t) != max(held[brute_key(x)]) for x in lines]
        out.append((d, len(lines), sum(lost), sha("\n".join(x for x, gone in zip(lines, lost) if not gone))))
    return sorted(out, key=repr)


def line_rows(n, seed):
    rnd = random.Random(seed)
    base = ["A line that stands in many documents", "a LINE that stands in many documents\t", "  Zeile über Straßen und Häuser, lang", "ÉTÉ longue ligne de texte ici", "été longue ligne de texte ici", "short", "", "exactly twenty chars", "nineteen characters", "中" * 20, "x" * 21, "y" * 22, "\x0b" + "z" * 23]
    return [(None if rnd.random() < 0.1 else i, "\n".join(rnd.choices(base + [f"own line number {i} of this text"], k=rnd.randint(0, 12)))) for i in range(n)]


@pytest.mark.parametrize("hot", [1_000, 3])
def test_line_dedup_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT_ROWS", hot)
    for rows in (line_rows(80, 1), line_rows(5, 2) + line_rows(5, 2), [(d, t) for d, t in edge_rows()] + line_rows(9, 3), [(7, "the same line in one document\n" * 50), (8, "the same line in one document"), (8, "x")]):
        assert collected(line_dedup.digest(frame(spark, rows))) == brute_lines(rows)
    assert collected(line_dedup.digest(empty(spark))) == []


def test_bitmaps_are_runs_of_kept_lines(spark):
    rows = [(i, "\n".join(f"{'shared' if k % 3 else 'own %d' % i} line number {k:05d}" for k in range(90))) for i in range(4)]
    got = {r.doc_id: r for r in line_dedup.keep_bitmaps(frame(spark, rows)).collect()}
    assert sorted(got) == [0, 1, 2]  # the last document keeps all
    for r in got.values():
        runs = np.frombuffer(bytes(r.keep), ">u4").reshape(-1, 2).tolist()
        kept = [k for a, n in runs for k in range(a, a + n)]
        assert kept == [k for k in range(90) if k % 3 == 0] and r.n_lines == 90 and r.n_dropped == 60
    # a document that keeps nothing has an empty bitmap, which is not a missing one
    rows = [(i, "one and the same line everywhere") for i in range(3)]
    assert [(r.doc_id, r.n_dropped, r.kept) for r in line_dedup.deduplicated(frame(spark, rows)).orderBy("doc_id").collect()] == [(0, 1, ""), (1, 1, ""), (2, 0, "one and the same line everywhere")]


# filter audit


def brute_fails(rows):
    out = []
    for d, t, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        copy = d is not None and any(o is not None and o < d and (x or "") == t for o, x, _ in rows)
        out.append((len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search(r"[#$%&*|]", t)), copy))
    return out


def brute_audit(rows, labels):
    fails = brute_fails(rows)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    out, shapley = [], {}
    parts = sorted({s or "" for _, _, s in rows})
    for part in parts:
        mine = [i for i, r in enumerate(rows) if (r[2] or "") == part]
        for order in permutations(range(5)):
            left = set(mine)
            for step, f in enumerate(order):
                failing = {i for i in mine if fails[i][f]}
                gone = left & failing
                left -= gone
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                lost = lambda marked: sum(rows[i][0] in marked for i in gone)  # noqa: E731, B023
                out.append([part, "".join("ABCDE"[k] for k in order), step + 1, len(left), len(gone), len(failing - gone), sum(sum(fails[i]) == 1 for i in failing), lost(good), lost(toxic), f])
    return sorted([(*r[:-1], shapley[r[0], r[-1]]) for r in out], key=repr)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def label_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumns({c: F.lit("x") for c in ("part", "n", "mask", "text", "good")})


def test_filter_audit_equals_brute_force(spark):
    rnd = random.Random(4)
    words = ["alpha", "Beta", "GAMMA", "delta", "a$b", "été", *(f"w{i}" for i in range(60))]
    texts = [" ".join(rnd.choices(words, k=rnd.choice([0, 3, 49, 50, 51, 80]))) for _ in range(25)] + ["", None]
    rows = [(rnd.choice([i, i, i, None]), rnd.choice(texts), rnd.choice(["a", "b", "", None])) for i in range(60)]
    rows += rows[:4] + [(3, rows[5][1], "b"), (3, rows[5][1], "a")]  # repeated rows, and one id in two parts
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(40)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    assert collected(filter_audit.digest(frame(spark, rows), label_frame(spark, labels)), *COLUMNS) == brute_audit(rows, labels)


def test_filter_audit_edges(spark):
    rows = [(d, t, "s") for d, t in edge_rows()]
    assert collected(filter_audit.digest(frame(spark, rows), label_frame(spark, [(1, 1, 1)]).limit(0)), *COLUMNS) == brute_audit(rows, [])
    assert collected(filter_audit.digest(empty(spark), label_frame(spark, [(1, 1, 1)]))) == []


def test_long_texts_are_judged_in_pieces(monkeypatch):
    rnd = random.Random(5)
    for _ in range(200):
        text = "".join(rnd.choices(["a", "b", "é", " ", "\n", "\t", "\x0b", "word"], k=rnd.randint(0, 60))).encode()
        some = list(filter_audit.pieces(text, 5))
        assert b"".join(some) == text and [w for p in some for w in p.split()] == text.split()
        assert [t for p in lexical_search.terms_of(text, 5) for t in p] == text.translate(lexical_search._FOLD).split()


def test_potentials_are_shapley_values(spark):
    counts = [random.Random(6).randint(0, 9) for _ in range(32)]
    got = spark.range(1).select(filter_audit.removals(F.array(*[F.lit(x).cast("long") for x in counts])).alias("v")).withColumn("q", filter_audit.potentials(F.col("v"))).first()
    v = [sum(n for m, n in enumerate(counts) if m & s) for s in range(32)]
    assert got.v == v
    p = {0: 0.0}
    for s in range(1, 32):
        own = [i for i in range(5) if s >> i & 1]
        p[s] = (v[s] + sum(p[s ^ 1 << i] for i in own)) / len(own)
    assert got.q == pytest.approx([math.factorial(bin(s).count("1")) * p[s] for s in range(32)])


# lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(rows, items, top=50):
    docs = [(d, w) for d, t in rows if (w := brute_terms(t))]
    n_docs, total = len(docs), sum(len(w) for _, w in docs)
    out = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        scores = [0] * len(docs)
        for term in set(brute_terms(text)):
            df = sum(term in w for _, w in docs)
            weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) if df else 0
            for k, (_, w) in enumerate(docs):
                if tf := w.count(term):
                    scores[k] += weight * (1_000_000_000 * tf // (1000 * tf + 20 * (50 + 50 * len(w) * n_docs // total)))
        best = sorted((-s, LONG if d is None else d) for s, (d, _) in zip(scores, docs) if s > 0)[:top]
        out += [(item, rank + 1, None if d == LONG else d, -s) for rank, (s, d) in enumerate(best)]
    return sorted(out, key=repr)


def item_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("x") for c in ("doc_id", "rank", "score", "part", "term")})


def search_rows(n, seed):
    rnd = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(40)] + ["The", "the", "été", "中文", "a-b", "x_y"]
    return [(i, " ".join(rnd.choices(vocabulary, k=rnd.randint(0, 30)))) for i in range(n)]


@pytest.mark.parametrize(("top", "block_chars"), [(50, 2_000_000), (3, 2_000_000), (7, 40)])
def test_search_equals_brute_force(spark, top, block_chars):
    rows = search_rows(150, 2) + [(None, "t1 t2 the"), (None, "t1 t2 the"), (5, "t1 t2 the"), (5, "t1 t2 the"), (6, None), (7, " ... ")]
    items = [(1, "The t1 t2"), (1, "the T3"), (1, "The t1 t2"), (2, None), (3, ""), (4, "unknown words only"), (None, "t5 t5 t6, 中文!"), (6, " ".join(f"t{i}" for i in range(40)) + " été a b x y " + " ".join(f"u{i}" for i in range(90)) + " the")]
    assert collected(lexical_search.search(frame(spark, rows), item_frame(spark, items), top, block_chars)) == brute_search(rows, items, top)


def test_search_in_small_batches(spark, monkeypatch):
    rows, items = search_rows(90, 3), [(i, t) for i, t in search_rows(12, 4)]
    index = [(d, len(w), w) for d, t in rows if (w := brute_terms(t))]
    block = lexical_search.Block([(i, t) for i, t in items])
    n_docs, total = len(index), sum(n for _, n, _ in index)
    df = np.array([sum(t.decode() in w for _, _, w in index) for t in block.vocabulary])
    weight = lexical_search.weights(df, n_docs)
    lists = [[] for _ in block.items]
    for at in range(0, len(index), 7):  # lists go on from batch to batch
        some = index[at : at + 7]
        own = [sorted((block.vocabulary[t.encode()], w.count(t)) for t in set(w) if t.encode() in block.vocabulary) for _, _, w in some]
        flat = [x for one in own for x in one]
        batch = lexical_search.Postings(np.array([d for d, _, _ in some]), np.array([n for _, n, _ in some]), np.array([len(x) for x in own]), np.array([t for t, _ in flat]), np.array([k for _, k in flat]), n_docs, total)
        lists = [batch.search(t, weight[t], best, 5) for t, best in zip(block.items, lists)]
    got = [(i, r + 1, d, -s) for i, one in zip(block.item_ids, lists) for r, (s, d) in enumerate(one)]
    assert sorted(got, key=repr) == brute_search(rows, items, 5)


def test_search_edges(spark):
    rows = [(d, t) for d, t in edge_rows()]
    items = [(1, "alpha beta"), (2, "y" * 50_000), (3, "z x 中文 straße line one")]
    assert collected(lexical_search.search(frame(spark, rows), item_frame(spark, items))) == brute_search(rows, items)
    assert collected(lexical_search.search(empty(spark), item_frame(spark, items))) == []
    assert collected(lexical_search.search(frame(spark, random_rows(5, 1)), item_frame(spark, items).limit(0))) == []
