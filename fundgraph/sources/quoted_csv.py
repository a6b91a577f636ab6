"""CSV with line breaks inside quotes, read by many tasks per file.

A split of a file may begin inside a quoted field, which only the splits before
it can tell.  So the text is scanned twice.  The first scan gives, for each
split, whether it ends inside a quoted field if it began outside one, and if it
began inside one; a window over these few rows (one a split) gives where each
split really begins.  The second scan joins lines to records.  A record that
crosses the end of a split leaves it in pieces, which are put together by file
and position; all others are joined where they are read, without a shuffle.

Lines end with ``\\n`` or ``\\r\\n``; breaks inside quotes stay as written.  A quote that is not closed takes in the rest
of its file, as it does for any reader of quoted CSV.  Empty lines are no records,
empty files give no rows, and the first record of each file is its header.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What a line does to "inside a quoted field": nothing, turn it, leave outside, leave inside.
SAME, TURN, OUT, IN = 0, 1, 2, 3

#: Role of an emitted text: a whole record, the end of one begun before this split,
#: the beginning of one, a split that lies inside one.
WHOLE, END, BEGIN, MIDDLE = 0, 1, 2, 3


def _line_kind(text: Column) -> Column:
    """SAME, TURN, OUT or IN: a quote opens a field only at its start; elsewhere outside it is an ordinary character."""
    parts = F.split(F.replace(text, F.lit('""'), F.lit("")), '"')

    def step(acc: Column, part: Column) -> Column:
        opens = part.endswith(",") | (acc["first"] & (part == ""))
        return F.struct((~acc["o"] & opens).alias("o"), (~acc["i"] & opens).alias("i"), F.lit(False).alias("first"))

    start = F.struct(F.lit(False).alias("o"), F.lit(True).alias("i"), F.lit(True).alias("first"))
    end = F.aggregate(F.slice(parts, 1, F.size(parts) - 1), start, step)
    kind = F.when(end["o"] == end["i"], F.when(end["o"], IN).otherwise(OUT)).when(end["o"], TURN).otherwise(SAME)
    return F.when(~text.contains('"'), SAME).otherwise(kind).cast("tinyint")


def _states(kinds: np.ndarray, inside: bool) -> np.ndarray:
    """Whether each line ends inside a quoted field, if the first begins ``inside``."""
    turns = np.cumsum(kinds == TURN)
    fixed = np.maximum.accumulate(np.where(kinds >= OUT, np.arange(len(kinds)), -1))
    base = np.where(fixed >= 0, (kinds[fixed] == IN) ^ (turns[fixed] & 1).astype(bool), inside)
    return base ^ (turns & 1).astype(bool)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, int]]:
    """((file, start of the split), first row, end row) of each run of rows of one split."""
    file, at = batch.column("file").to_numpy(), batch.column("at").to_numpy()
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (at[1:] != at[:-1])) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(file)], strict=True):
        yield (int(file[lo]), int(at[lo])), int(lo), int(hi)


def _split_effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a split: whether it ends inside, begun outside (o) and begun inside (i)."""
    here, o, i = None, False, True

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"file": pa.array([here[0]], pa.int64()), "at": pa.array([here[1]], pa.int64()), "o": [o], "i": [i]})

    for batch in batches:
        if not batch.num_rows:
            continue
        kinds = batch.column("kind").to_numpy()
        for key, lo, hi in _runs(batch):
            if key != here:
                if here is not None:
                    yield row()
                here, o, i = key, False, True
            o, i = bool(_states(kinds[lo:hi], o)[-1]), bool(_states(kinds[lo:hi], i)[-1])
    if here is not None:
        yield row()


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records of each split, and the pieces of those that cross its ends."""
    here, inside, began, held = None, False, False, []

    def batch_of(roles: list[int], firsts: list[bool], texts: list[str]) -> pa.RecordBatch:
        n = len(texts)
        return pa.RecordBatch.from_pydict({
            "file": pa.array([here[0]] * n, pa.int64()), "at": pa.array([here[1]] * n, pa.int64()),
            "role": pa.array(roles, pa.int8()), "first": pa.array(firsts, pa.bool_()), "text": pa.array(texts, pa.string()),
        })

    def rest() -> Iterator[pa.RecordBatch]:
        if held:  # the split ends inside a record
            yield batch_of([BEGIN if began else MIDDLE], [head and began], ["\n".join(held)])

    for batch in batches:
        if not batch.num_rows:
            continue
        kinds, texts, starts_in = batch.column("kind").to_numpy(), batch.column("text"), batch.column("inside")
        for key, lo, hi in _runs(batch):
            if key != here:
                if here is not None:
                    yield from rest()
                # `began`: the open record has its first line in this split; `head`: it is the first record of the file
                here, inside, held = key, starts_in[lo].as_py(), []
                began, head = not inside, key[1] == 0
            ends_in = _states(kinds[lo:hi], inside)
            roles, firsts, out, last = [], [], [], 0
            lines = texts.slice(lo, hi - lo).to_pylist()
            for k in np.flatnonzero(~ends_in):  # each closes a record
                held += lines[last : k + 1]
                out.append("\n".join(held) if len(held) > 1 else held[0])
                roles.append(WHOLE if began else END)
                firsts.append(head and began)
                held, last, began, head = [], k + 1, True, False
            held += lines[last:]
            inside = bool(ends_in[-1])
            if out:
                yield batch_of(roles, firsts, out)
    if here is not None:
        yield from rest()


def read_records(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """text of every record but the headers, line breaks inside quotes kept."""
    raw = spark.read.text(path, lineSep="\n")
    text = F.make_valid_utf8("value") if encoding.upper() in ("UTF-8", "UTF8") else F.decode(F.col("value").cast("binary"), encoding)
    lines = raw.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), text.alias("text"),
    ).withColumn("kind", _line_kind(F.col("text")))

    effects = lines.select("file", "at", "kind").mapInArrow(_split_effects, "file long, at long, o boolean, i boolean")
    # the same rule as for lines, over the splits of a file: one row for each of them
    w = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    turns = F.coalesce(F.sum(F.when(F.col("i") | ~F.col("o"), 0).otherwise(1)).over(w), F.lit(0))
    upto = effects.withColumn("turns", turns)
    fixed = F.last(F.when(F.col("o") == F.col("i"), F.struct("o", "turns")), ignorenulls=True).over(w)
    base = F.coalesce(fixed["o"].cast("int") + fixed["turns"], F.lit(0))
    begin_inside = upto.withColumn("inside", (F.col("turns") + base) % 2 == 1).where("inside")

    # one row of three fields a split that begins inside a field: 800,000 splits, some 30 MB, at most for 100 TB
    known = lines.join(F.broadcast(begin_inside.select("file", "at", "inside")), ["file", "at"], "left")
    known = known.select("file", "at", "text", "kind", F.coalesce("inside", F.lit(False)).alias("inside"))
    found = known.mapInArrow(_records, "file long, at long, role byte, first boolean, text string")

    whole = found.where(F.col("role") == WHOLE)
    pieces = found.where(F.col("role") != WHOLE)
    # in a split END comes before BEGIN; a piece belongs to the last BEGIN at or before it
    order = Window.partitionBy("file").orderBy("at", F.col("role") != END)
    pieces = pieces.withColumn("record", F.sum((F.col("role") == BEGIN).cast("int")).over(order))
    joined = pieces.groupBy("file", "record").agg(
        F.bool_or("first").alias("first"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), "\n").alias("text"),
    )
    every = whole.select("first", "text").unionByName(joined.select("first", "text"))
    return every.where(~F.col("first")).select(F.regexp_replace("text", r"\r\z", "").alias("text")).where("text != ''")


def read_quoted_csv(spark: SparkSession, path: str, options: dict[str, str], encoding: str = "UTF-8") -> DataFrame:
    """All columns as text, named by the header."""
    names = spark.read.options(**options, multiLine="true", encoding=encoding).csv(path).columns
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    row = F.from_csv("text", schema, {**options, "multiLine": "true", "header": "false"})
    return read_records(spark, path, encoding).select(row.alias("row")).select("row.*")
