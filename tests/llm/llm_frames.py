"""Small documents with the cases that every operator must bear."""

import random

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

LONG = (1 << 63) - 1
SCHEMA = StructType([StructField(n, t()) for n, t in (("doc_id", LongType), ("text", StringType), ("lang", StringType), ("source", StringType), ("n_chars", LongType))])

#: Names that operators use inside; as columns of the input they must change nothing.
CLASHES = ("id", "batch", "text_key", "low", "trigram", "spans", "key", "size", "lines", "held", "lost", "kept", "score", "quality", "component", "fp", "node", "tie", "part", "target", "taken", "words",
           "mix_size", "mix_source", "mix_key", "mix_words", "mix_range", "mix_row", "sim_id", "sim_tie", "sim_rows", "sim_row")


def frame(spark, rows, clash=True):
    """rows: (doc_id, text[, source])."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    out = spark.createDataFrame(full, SCHEMA).repartition(3)
    return out.withColumns({c: F.lit("x") for c in CLASHES}) if clash else out


def edge_rows():
    """Nulls, empty and blank texts, repeated rows, one id with two texts, a very long text and one very long word."""
    rnd = random.Random(7)
    words = ["alpha", "beta", "gamma", "delta", "été", "straße", "中文", "x", "Omega."]
    some = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    shared = some(40)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, shared + " one"), (5, "two " + shared), (5, "two " + shared), (6, shared), (6, "other " + some(30)), (None, shared + " null"),
        (None, None), (None, "null id " + some(20)), (7, some(30_000)), (8, "y" * 50_000), (9, "z z z z " * 200), (10, "a"), (11, "line one.\nline one.\n\nlast"), (12, shared + "\x0b\x0c\r\n" + shared),
    ]


def random_rows(n, seed, alphabet=("a", "b", "c", "the", "of", "é")):
    """Texts cut from a few passages, so that stretches, lines and whole texts repeat."""
    rnd = random.Random(seed)
    base = [" ".join(rnd.choices(alphabet, k=60)) for _ in range(5)]
    out = []
    for i in range(n):
        parts = [rnd.choice(base), rnd.choice(base)[rnd.randint(0, 40) :], " ".join(rnd.choices(alphabet, k=9)), "x" * rnd.randint(0, 250), str(i), "\n"]
        out.append((i, " ".join(rnd.choices(parts, k=rnd.randint(0, 5)))))
    return out


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
