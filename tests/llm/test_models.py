import random
import zlib

import numpy as np
import pytest
from llm_frames import edge_rows, empty, frame, random_rows
from pyspark.sql import functions as F
from test_dedup import brute_groups

import corpus_pipeline
from fundgraph.llm import decontaminate, mixing, quality_model, token_files
from fundgraph.llm.queries import QUERIES
from fundgraph.session import scratch_path

SF = "/root/testdata/sf0.01"


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_classifier_on_held_out_rows(spark):
    out = QUERIES["op8_quality_classifier"](spark, SF)
    rows = out.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 60 and np.mean([r.predicted == r.quality for r in held]) > 0.93


def test_held_out_labels_are_never_read(spark):
    docs, known = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    flipped = known.withColumn("quality", F.when(quality_model.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert collected(quality_model.digest(docs, known)) == collected(quality_model.digest(docs, flipped))


def test_classifier_edges(spark):
    docs, none = frame(spark, edge_rows()), labels(spark, [])
    assert {r.score for r in quality_model.digest(docs, none).collect()} == {1.0}
    one = quality_model.digest(docs, labels(spark, [(1, 0, 0), (4, 0, None), (4, 1, 0), (5, 0, 1), (None, 1, 1), (7, None, 0)])).collect()
    assert len(one) == len(edge_rows()) and all(r.score < 0.5 for r in one) and not any(r.held_out for r in one if r.doc_id is None)
    assert collected(quality_model.digest(empty(spark), none)) == []
    assert quality_model.accepted(docs, none).columns == docs.columns and collected(quality_model.accepted(docs, none)) == collected(docs)


def test_flat_trees_equal_a_walk_by_hand():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 4))
    y = (x[:, 0] * x[:, 2] > 0).astype(float)
    forest = quality_model.fit(x, y)
    assert np.mean((forest.score(x) > 0.5) == y) > 0.95

    def walk(row):
        total = forest.start
        for f, l, leaf in zip(forest.feature, forest.limit, forest.leaf):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if row[f[at]] > l[at] else 1)
            total += leaf[at - len(f)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(forest.score(x[:20]), [walk(r) for r in x[:20]])


def test_statistics_do_not_depend_on_the_batch():
    texts = [(t or "").encode() for _, t in edge_rows()]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    together = quality_model.statistics(data, offsets)
    alone = np.concatenate([quality_model.statistics(np.frombuffer(t, np.uint8), np.array([0, len(t)])) for t in texts])
    assert np.allclose(together, alone)


def test_encoder_equals_the_library_on_any_text():
    encoder, rnd = token_files.Encoder(), random.Random(2)
    parts = [" ", "  ", "\n", "a", "b.", "'s", "\t", "é", " the", "12", "!!", "\n\n", "\xa0", "x", "<|endoftext|>", "　", "'ll", " '", "\r\n", "\x1c", "​", "word" * 30]
    for _ in range(60):
        batch = ["".join(rnd.choices(parts, k=rnd.randint(0, 14))) for _ in range(100)]
        assert encoder.encode(batch) == [encoder.plain(t).tobytes() for t in batch]


@pytest.mark.parametrize("block,segment", [(1 << 16, 1 << 19), (7, 20)])
def test_token_files_round_trip(spark, block, segment):
    encoder = token_files.Encoder()
    rows = random_rows(60, 12) + [(-5, None), (7, "again"), (7, "again"), (None, "no id"), (1 << 40, "w " * 30_000)]
    path = scratch_path(spark, "test")
    token_files.write(frame(spark, rows), path, block_ids=block, segment_ids=segment)
    got = sorted(token_files.read(spark, path).collect(), key=lambda r: r.start)
    start = 0
    for r in got:
        assert r.start == start and len(r.ids) == 4 * r.n_tokens
        start += r.n_tokens
    ids = [r.doc_id for r in got]
    assert ids[-1] is None and ids[:-1] == sorted(ids[:-1])
    want = [(d, encoder.plain(t or "").tobytes() + (2).to_bytes(4, "little")) for d, t in rows]
    assert sorted([(r.doc_id, bytes(r.ids)) for r in got], key=repr) == sorted(want, key=repr)
    index = spark.read.parquet(f"{path}/index").collect()
    assert sum(r.n_ids for r in index) == start and all(sum(r.block_ids) == r.n_ids and max(r.block_ids) <= block for r in index)


def test_token_edges(spark):
    assert len(collected(token_files.digest(frame(spark, edge_rows())))) == len(edge_rows())
    assert collected(token_files.digest(empty(spark))) == []


def test_planes_hold_the_ids():
    ids = np.random.default_rng(1).integers(0, 1 << 32, 1000, np.uint64).astype("<u4").tobytes()
    assert token_files.unpack(*token_files.pack(ids)) == ids


def distance_to_part(item, text):
    """Smallest edit distance between the item and any stretch of the text, by the full table."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (c != x)))
        row = new
        best = min(best, row[-1])
    return best


def leak_frames(spark):
    rnd = random.Random(9)
    some = lambda n: " ".join("".join(rnd.choices("abcdeéß", k=rnd.randint(1, 7))) for _ in range(n))
    items = [(i, some(rnd.randint(5, 25))) for i in range(12)] + [(50, "too short"), (51, None), (None, some(6)), (52, "")]
    items.append((60, items[0][1].upper()))
    docs = []
    for i in range(60):
        body = rnd.choice(items[:12])[1]
        text = list(body)
        for _ in range(rnd.randint(0, len(text) // 8)):
            at = rnd.randrange(len(text))
            text[at : at + 1] = rnd.choice(["", "q", text[at] + "q"])
        docs.append((i, f"{some(9)}\n{''.join(text)}, {some(9)}" if rnd.random() < 0.8 else some(30)))
    return items, docs


@pytest.mark.parametrize("block_chars", [2_000_000, 150])
def test_leaks_equal_brute_force(spark, block_chars):
    items, docs = leak_frames(spark)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.leaks(frame(spark, docs), table, block_chars=block_chars).collect()}
    want = {}
    for d, t in docs:
        for i, item in items:  # each of equal items gets its rows
            c = decontaminate.compared(item or "")
            if c and (n := distance_to_part(c, decontaminate.compared(t))) <= int(decontaminate.RATE * len(c)):
                want[d, i] = n
    assert got == want and any(want.values()) and 0 in want.values()
    kept = {r.doc_id for r in decontaminate.without_leaks(frame(spark, docs), table, block_chars=block_chars).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_short_and_unspaced_items_are_searched(spark):
    chinese, japanese = "下列哪一种气体在大气层中所占的比例最高呢", "日本で一番高い山の名前とその標高を答えてくださいませ"
    items = [(1, chinese), (2, japanese), (3, "cat"), (4, "x += 1"), (5, "Who wrote Hamlet?"), (6, "???"), (7, "ประเทศไทย")]
    docs = [
        (1, f"题目是{chinese}请回答"), (2, "問い" + japanese.replace("山", "川") + "以上"), (3, "concatenate the category"), (4, "The cat!"), (5, "if y: x += 1"),
        (6, "so who wrote hamlet"), (7, "so who wrote hamlat then"), (8, None), (9, "cat"), (10, "xcat x 12"), (11, "ในประเทศไทยมี"),
    ]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.distance, r.end) for r in decontaminate.leaks(frame(spark, docs), table).collect()}
    assert {k: d for k, (d, _) in got.items()} == {(1, 1): 0, (2, 2): 1, (4, 3): 0, (5, 4): 0, (6, 5): 0, (7, 5): 1, (9, 3): 0, (11, 7): 0}
    assert [got[4, 3][1], got[6, 5][1], got[9, 3][1], got[1, 1][1]] == [7, 19, 3, 3 + len(chinese)]
    assert {r.doc_id for r in decontaminate.without_leaks(frame(spark, docs), table).collect()} == {3, 8, 10}


def test_every_id_of_an_item_gets_its_rows(spark):
    items = [(1, "Which river is the longest one?"), (2, "which river: is the longest one"), (2, "which river: is the longest one"), (None, "WHICH river is the longest one!"), (1, "another text under one id")]
    docs = [(7, "so which river is the longest one then"), (8, "another text under one id"), (9, "nothing")]
    got = sorted(((r.doc_id, r.item_id) for r in decontaminate.leaks(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()), key=repr)
    assert got == [(7, 1), (7, 2), (7, None), (8, 1)]


def test_leak_edges(spark):
    table = spark.createDataFrame([(1, "alpha beta gamma delta alpha beta"), (2, None)], "item_id long, text string")
    docs = frame(spark, edge_rows())
    decontaminate.leaks(docs, table).collect()
    assert decontaminate.without_leaks(docs, table).columns == docs.columns
    assert collected(decontaminate.leaks(empty(spark), table)) == []
    assert collected(decontaminate.leaks(docs, table.limit(0))) == [] and collected(decontaminate.without_leaks(docs, table.limit(0))) == collected(docs)


def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    scores = {r.doc_id: r.predicted for r in QUERIES["op8_quality_classifier"](spark, SF).collect()}
    left = [(d, docs[d].text) for d in sorted(docs) if scores[d]]
    left = [(d, t) for (d, t), g in zip(left, sorted(brute_groups(left))) if g[2] == d]
    items = [decontaminate.compared(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    # no stretch of these tables is near an item without holding it
    left = [(d, t) for d, t in left if not any(i in decontaminate.compared(t) for i in items)]
    taken = mixing.digest(spark.createDataFrame([(d, t, docs[d].source) for d, t in left], "doc_id long, text string, source string")).collect()
    rows = []
    for r in taken:
        words = docs[r.doc_id].text.split()
        rows += [(r.doc_id, docs[r.doc_id].text)] * (r.taken // r.size) + ([(r.doc_id, " ".join(words[: r.taken % r.size]))] if r.taken % r.size else [])
    encoder = token_files.Encoder()
    want = sorted((d, len(b := encoder.plain(t).tobytes() + b"\2\0\0\0") // 4, zlib.crc32(b)) for d, t in rows)
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert sorted(r.start for r in got)[0] == 0 and len({r.start for r in got}) == len(got)


def test_stages_keep_columns_and_bear_edges(spark):
    docs = frame(spark, edge_rows(), clash=False)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    docs = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
