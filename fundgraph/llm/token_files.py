"""Token ids in a bit-plane-shuffled binary format.

Documents are range-dealt and sorted by doc_id, encoded, and each is closed with
the end id.  A partition writes segments: runs of whole documents of at least
SEGMENT_IDS ids (a longer document is a segment by itself).  A segment's ids are
cut into blocks of BLOCK_IDS; each block is transposed into its four byte planes
(all lowest bytes, then all second bytes, ...) and every plane is compressed by
itself with zstandard, so that the nearly constant high planes cost next to
nothing.  Segments are rows of a Parquet table, which any file system that Spark
writes to can hold; the index table says for each segment where its ids begin
in the whole corpus and how many ids each of its blocks holds.  A segment can be
read alone, so reading back needs no shuffle.

Nulls: a null text is empty, so its document has the end id alone; a null doc_id
comes after every other.  Rows that repeat a doc_id are ordered by a hash of
their text, then by text; equal rows follow each other.  An empty table gives an empty
file and an empty result.  Other columns are ignored.  Strings of special tokens
inside a text are ordinary text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fundgraph.llm.common import NO_ID, parts_for, texts, total_bytes
from fundgraph.session import scratch_path

VOCABULARY = "byte_bpe_50k.json"
END = 2
BLOCK_IDS = 1 << 16
SEGMENT_IDS = 1 << 19
LEVEL = 3

#: Text that one partition encodes.
PART_BYTES = 32 << 20

#: Encoded stretches that a worker remembers in each of two generations, and the longest that is worth it (characters).
REMEMBERED, LONGEST = 700_000, 48

#: Where a token begins whatever stands around it: at a run of blanks, and after a word of common letters that no further word character follows.
#: A text may be cut there and its stretches be encoded one by one.
STRETCH = re.compile(r"[ \n]*+(?:[A-Za-zÀ-ÖØ-öø-ɏ]++(?!\w)|[^ \n]++)|[ \n]++")
#: White space other than these two (for any version of Unicode) joins with blanks in ways a stretch can't see.
OTHER_BLANKS = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e" + "".join(map(chr, range(0x2000, 0x200C))) + "\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"


def _byte_level(made: dict) -> bool:
    """Whether STRETCH may cut texts for this tokenizer: plain byte-level BPE whose words take the blank before them along."""
    cuts = made.get("pre_tokenizer") or {}
    whole = made["model"]["type"] == "BPE" and not made.get("normalizer") and not made["model"].get("dropout")
    return bool(whole and cuts.get("type") == "ByteLevel" and cuts.get("use_regex", True) and not cuts.get("add_prefix_space"))


class Encoder:
    """Ids of texts as little-endian 32-bit bytes; a stretch met again is not encoded again."""

    def __init__(self, vocabulary: str | None = None) -> None:
        from tokenizers import Tokenizer

        if vocabulary is None:
            import public_tokenizers

            vocabulary = public_tokenizers.path(VOCABULARY)
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True
        # a byte-level token is written with one character per byte
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_of = np.zeros(max(names.values()) + 1, np.int64)
        for name, i in names.items():
            self.bytes_of[i] = len(name)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.by_stretch = _byte_level(json.loads(self.tokenizer.to_str()))

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def stretches(self, parts: list[str]) -> list[bytes]:
        """Ids of each stretch: those that begin with a blank and end without one are encoded in one go and told apart by their bytes."""
        out: list[bytes] = [b""] * len(parts)
        joint = [i for i, p in enumerate(parts) if p[0] in " \n" and p[-1] not in " \n"]
        for i in set(range(len(parts))).difference(joint):
            out[i] = self.plain(parts[i]).tobytes()
        for at in range(0, len(joint), 4096):
            some = joint[at : at + 4096]
            ids = self.plain("".join([parts[i] for i in some]))
            ends = np.cumsum([len(parts[i].encode()) for i in some])
            cuts = np.searchsorted(np.cumsum(self.bytes_of[ids]), ends, "left") + 1
            raw, last = ids.tobytes(), 0
            for i, cut in zip(some, (4 * cuts).tolist()):
                out[i] = raw[last:cut]
                last = cut
        return out

    def encode(self, batch: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        # texts with other blanks are not cut; nor is anything for a vocabulary whose tokens may cross a blank
        cut = [self.by_stretch and not any(c in text for c in OTHER_BLANKS) for text in batch]
        parts = [STRETCH.findall(text) if c else () for text, c in zip(batch, cut, strict=True)]
        missing = [p for p in set().union(*parts) if p not in known]
        known.update((p, older[p]) for p in missing if p in older)
        new = [p for p in missing if p not in known]
        known.update(zip(new, self.stretches(new), strict=True))
        out = [b"".join(map(known.__getitem__, p)) if c else self.plain(text).tobytes() for text, p, c in zip(batch, parts, cut, strict=True)]
        for part in [p for p in new if len(p) > LONGEST]:
            del known[part]
        return out


@lru_cache(maxsize=1)
def encoder_of(vocabulary: str | None) -> Encoder:
    """One per worker process, so that what it remembers serves all its tasks."""
    return Encoder(vocabulary)


def pack(ids: bytes, block_ids: int = BLOCK_IDS) -> tuple[list[int], list[bytes]]:
    """Ids per block, and the four compressed byte planes of each block."""
    from zstandard import ZstdCompressor

    press = ZstdCompressor(level=LEVEL)
    sizes, planes = [], []
    for at in range(0, len(ids), 4 * block_ids):
        block = np.frombuffer(ids[at : at + 4 * block_ids], np.uint8).reshape(-1, 4)
        sizes.append(len(block))
        planes += [press.compress(np.ascontiguousarray(block[:, k]).tobytes()) for k in range(4)]
    return sizes, planes


def unpack(sizes: list[int], planes: list[bytes]) -> bytes:
    from zstandard import ZstdDecompressor

    press = ZstdDecompressor()
    out = []
    for i, n in enumerate(sizes):
        block = np.empty((n, 4), np.uint8)
        for k in range(4):
            block[:, k] = np.frombuffer(press.decompress(planes[4 * i + k], max_output_size=n), np.uint8)
        out.append(block.tobytes())
    return b"".join(out)


DATA = "part int, segment int, n_ids long, doc_ids array<long>, doc_sizes array<long>, block_ids array<int>, planes array<binary>"
_DATA = pa.schema([
    ("part", pa.int32()), ("segment", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64())),
    ("block_ids", pa.list_(pa.int32())), ("planes", pa.list_(pa.binary())),
])


def write(docs: DataFrame, path: str, vocabulary: str | None = None, end: int = END, block_ids: int = BLOCK_IDS, segment_ids: int = SEGMENT_IDS) -> None:
    """Encodes ``docs`` into the tables ``path``/data and ``path``/index."""
    spark = docs.sparkSession
    rows = texts(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("tie"), "text")
    n = parts_for(spark, total_bytes(rows), PART_BYTES)
    # the tie-breaker is part of the range, so that one id on very many rows is spread too
    dealt = rows.repartitionByRange(n, "id", "tie").sortWithinPartitions("id", "tie", "text").select("id", "text")
    close = np.array([end], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, part, segment = encoder_of(vocabulary), TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        ids: list[int | None] = []
        size = 0

        def flush() -> pa.RecordBatch:
            sizes, planes = pack(b"".join(held), block_ids)
            row = {"part": part, "segment": segment, "n_ids": size // 4, "doc_ids": ids, "doc_sizes": [len(x) // 4 for x in held], "block_ids": sizes, "planes": planes}
            return pa.RecordBatch.from_pylist([row], _DATA)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                for one, coded in zip(some.column("id").to_pylist(), encoder.encode(some.column("text").to_pylist()), strict=True):
                    held.append(coded + close)
                    ids.append(None if one == NO_ID else one)
                    size += len(held[-1])
                    if size >= 4 * segment_ids:
                        yield flush()
                        held, ids, size, segment = [], [], 0, segment + 1
        if held:
            yield flush()

    dealt.mapInArrow(encode, DATA).write.option("compression", "uncompressed").parquet(f"{path}/data")
    # parts and segments are few: one row for PART_BYTES of text, and for SEGMENT_IDS ids
    kept = spark.read.schema(DATA).parquet(f"{path}/data").select("part", "segment", "n_ids", "block_ids")
    parts = kept.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("p"), F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    index = kept.join(parts, F.col("part") == F.col("p")).withColumn("start", F.col("part_start") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    index.select("part", "segment", "start", "n_ids", "block_ids").write.parquet(f"{path}/index")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary) of every document, from the files; ids are little-endian unsigned 32-bit."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, sizes = unpack(row["block_ids"], row["planes"]), np.array(row["doc_sizes"], np.int64)
                ends = np.cumsum(sizes)
                whole = pa.array([ids[4 * a : 4 * b] for a, b in zip(ends - sizes, ends)], pa.large_binary()).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends - sizes), pa.array(sizes), whole], ["doc_id", "start", "n_tokens", "ids"])

    data = spark.read.schema(DATA).parquet(f"{path}/data")
    index = spark.read.parquet(f"{path}/index").select(F.col("part").alias("i_part"), F.col("segment").alias("i_segment"), "start")
    rows = data.join(index, (F.col("part") == F.col("i_part")) & (F.col("segment") == F.col("i_segment")))
    return rows.select("start", "doc_ids", "doc_sizes", "block_ids", "planes").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def digest(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Writes the files to the shared folder and gives the contract's figures as read back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write(docs, path, vocabulary)
    return read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

