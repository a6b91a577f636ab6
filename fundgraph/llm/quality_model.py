"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are counted with numpy over whole Arrow batches.  Trees are fitted on
at most MAX_TRAIN labelled documents (those with the smallest hash of their id),
which is 20,000 rows of some 30 numbers whatever the corpus holds; scoring passes
every text once, and all rows of a batch walk all trees together over flat arrays.

Only rows whose crc32(doc_id) mod 4 is not 2 are learned from; the rest are held out.

Nulls: a null text is empty and is scored like an empty text; a null doc_id is
scored, not held out and never learned from; a null quality is no label.
Documents with both labels count as 0.  Without any label nothing speaks against
a document: every score is 1.  With one class only, the trees stay flat and the
score is near that class.  Repeated rows get the same score.  An empty table
gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fundgraph.llm.common import texts
from fundgraph.llm.text_arrays import byte_symbols, chunks, fields_of, flat, prefix_hash, stretch_hash, word_bounds

#: Bound of the labelled sample that the trees are fitted on.
MAX_TRAIN = 20_000

#: Trees, their depth, and how they learn.
TREES, DEPTH, RATE, BINS, L2, MIN_ROWS = 60, 4, 0.2, 64, 1.0, 20

#: From this score on, a document counts as good (contract).
GOOD = 0.7

#: Byte classes that are counted.
CLASSES = {
    "space": b" ", "newline": b"\n", "lower": bytes(range(97, 123)), "upper": bytes(range(65, 91)), "digit": b"0123456789", "stop": b".", "comma": b",", "shout": b"!",
    "ask": b"?", "bar": b"|", "symbol": b"#*$%&<>", "rule": b"-_=+~/\\", "quote": b"\"'()[]{};:", "high": bytes(range(0xC0, 256)), "follow": bytes(range(0x80, 0xC0)),
}
_CLASS = np.full(256, len(CLASSES), np.int64)
for _i, _b in enumerate(CLASSES.values()):
    _CLASS[list(_b)] = _i
FEATURES = (
    "log_bytes", *CLASSES, "log_words", "word_length", "long_words", "short_words", "distinct_words", "shouted_words", "marked_words", "stopped_words",
    "log_lines", "words_per_line", "distinct_lines", "stopped_lines", "lower_lines", "short_lines",
)


def ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def distinct(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of each owner; 44 bits of a hash are enough for a share."""
    both = np.unique((owner.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
    return np.bincount((both >> np.uint64(44)).astype(np.int64), minlength=n)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text."""
    n, k = len(offsets) - 1, len(CLASSES) + 1
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(n), sizes)
    counts = np.bincount(owner * k + _CLASS[data], minlength=n * k).reshape(n, k)[:, : len(CLASSES)]
    count = lambda where: np.bincount(where, minlength=n)
    prefix = prefix_hash(byte_symbols(data))
    starts, ends = word_bounds(data, offsets)
    of = fields_of(starts, offsets)
    words, length, last = count(of), ends - starts, data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    before = data[np.maximum(ends - 2, 0)] if len(ends) else last
    shouted = (last == 33) & (before == 33) & (length > 1)
    marked = (_CLASS[last] == list(CLASSES).index("symbol")) | (_CLASS[last] == list(CLASSES).index("bar"))
    # lines with at least one word: from a line's first word to its last
    if len(starts):
        line = np.cumsum(np.concatenate([[0], (data == 10).astype(np.int64)]))[starts]
        new = np.concatenate([[True], (np.diff(line) != 0) | (np.diff(of) != 0)])
        first = np.flatnonzero(new)
        final = np.concatenate([first[1:], [len(starts)]]) - 1
        line_of, line_words = of[first], final - first + 1
        line_hash = stretch_hash(prefix, starts[first], ends[final])
        line_last, line_first = last[final], data[starts[first]]
        word_hash = stretch_hash(prefix, starts, ends)
    else:
        line_of = line_words = np.zeros(0, np.int64)
        line_hash = word_hash = np.zeros(0, np.uint64)
        line_last = line_first = np.zeros(0, np.uint8)
    lines = count(line_of)
    return np.column_stack([
        np.log1p(sizes), *(ratio(counts[:, i], sizes) for i in range(len(CLASSES))), np.log1p(words), ratio(np.bincount(of, length, n), words),
        ratio(count(of[length > 14]), words), ratio(count(of[length < 4]), words), ratio(distinct(word_hash, of, n), words), ratio(count(of[shouted]), words),
        ratio(count(of[marked]), words), ratio(count(of[last == 46]), words), np.log1p(lines), ratio(words, lines), ratio(distinct(line_hash, line_of, n), lines),
        ratio(count(line_of[line_last == 46]), lines), ratio(count(line_of[(line_first >= 97) & (line_first < 123)]), lines), ratio(count(line_of[line_words < 4]), lines),
    ])


@dataclass(frozen=True)
class Forest:
    """Complete trees as arrays: node i has children 2 i + 1 and 2 i + 2; a row goes right if its feature exceeds the limit."""

    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))[None, :]
        at = np.zeros((len(x), len(self.feature)), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            at = 2 * at + 1 + (x[rows, self.feature[trees, at]] > self.limit[trees, at])
        total = self.start + self.leaf[trees, at - (2**DEPTH - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """Level-wise boosting of the logistic loss over BINS quantile bins."""
    n, k = x.shape
    inner = 2**DEPTH - 1
    feature, limit, leaf = np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, 2**DEPTH))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(k)]
    binned = np.column_stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(k)])
    share = (y.sum() + 0.5) / (n + 1)
    start = float(np.log(share / (1 - share)))
    raw = np.full(n, start)
    cell = binned + np.arange(k) * BINS
    for t in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(DEPTH):
            nodes, base = 2**level, 2**level - 1
            flat_cell = ((at - base)[:, None] * (k * BINS) + cell).ravel()
            shape = (nodes, k, BINS)
            g, h, c = (np.bincount(flat_cell, None if v is None else np.repeat(v, k), nodes * k * BINS).reshape(shape).cumsum(axis=2) for v in (grad, hess, None))
            gt, ht, ct = g[:, :, -1:], h[:, :, -1:], c[:, :, -1:]
            gain = g**2 / (h + L2) + (gt - g) ** 2 / (ht - h + L2) - gt**2 / (ht + L2)
            gain[(c < MIN_ROWS) | (ct - c < MIN_ROWS)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for node in range(nodes):
                j, b = divmod(int(best[node]), BINS)
                if gain[node, j, b] > 1e-9 and b < len(edges[j]):
                    feature[t, base + node], limit[t, base + node] = j, edges[j][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[t, at]] > limit[t, at])
        place = at - inner
        leaf[t] = -RATE * np.bincount(place, grad, 2**DEPTH) / (np.bincount(place, hess, 2**DEPTH) + L2)
        raw += leaf[t][place]
    return Forest(feature, limit, leaf, start)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_table(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of the bounded sample; the labels are broadcast, at most ``most`` rows of two numbers."""
    known = labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col("quality").cast("int").alias("quality")).filter(F.col("quality").isin(0, 1) & ~held_out(F.col("l_id")))
    sample = known.groupBy("l_id").agg(F.min("quality").alias("quality")).orderBy(F.md5(F.col("l_id").cast("string")), "l_id").limit(most)
    rows = texts(docs).join(F.broadcast(sample), F.col("doc_id") == F.col("l_id")).select("doc_id", "quality", "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in chunks(*flat(batch.column("text"))):
                x = statistics(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[first:last], batch.column("quality")[first:last], pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    # one row per labelled id reaches the driver, also where documents repeat an id
    found = rows.mapInArrow(measure, "doc_id long, quality int, x array<double>").groupBy("doc_id").agg(F.min(F.struct("quality", "x")).alias("r"))
    sample_rows = sorted((r.doc_id, r.r.quality, r.r.x) for r in found.collect())
    return np.array([r[2] for r in sample_rows]).reshape(len(sample_rows), len(FEATURES)), np.array([r[1] for r in sample_rows], float)


def scored(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(doc_id, or the columns ``keep``; quality_score) for every row of ``docs``."""
    x, y = training_table(docs, labels)
    forest = fit(x, y) if len(y) else None
    columns = keep or ["doc_id"]
    read = columns if "text" in columns else [*columns, "text"]
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(read)])
    own, n = read.index("text"), len(columns)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.ones(batch.num_rows)
            if forest is not None:
                for first, last, data, offsets in chunks(*flat(batch.column(own))):
                    out[first:last] = forest.score(statistics(data, offsets))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(out)], [*batch.schema.names[:n], "quality_score"])

    kinds = dict(docs.dtypes)
    schema = ", ".join([*[f"k{i} {kinds[c]}" for i, c in enumerate(columns)], "quality_score double"])
    return rows.mapInArrow(score, schema).select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(columns)], "quality_score")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = scored(docs, labels).select(F.col("doc_id").cast("long").alias("doc_id"), "quality_score")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= GOOD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier takes for good."""
    return scored(docs, labels, docs.columns).filter(F.col("quality_score") >= GOOD).drop("quality_score")
