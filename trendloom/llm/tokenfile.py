"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of whole documents, in ascending order of their numbers:

    header       magic, partition, place in it, ids, documents, ids a block, CRC-32 of the rest
    block index  the byte at which each block starts, and the end of the last one
    documents    numbers, whether each number is known, and the id at which each ends
    blocks       minimum, width, number of exceptions, packed low bits, exceptions

A block subtracts its minimum and packs what is left at the width that a given share of
its ids needs. Ids that need more are exceptions: their low bits are packed like the
others, position and high bits follow in a list. Any range of ids is read by decoding
the blocks that cover it. Files do not depend on each other: where a file begins in the
whole corpus comes from the headers of all, summed by partition and then inside it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendloom.llm.arrow import text_bytes
from trendloom.operators.joins import broadcast_if_small
from trendloom.sources.workspace import materialise, new_path

MAGIC = b"TLPFOR01"
#: Big-endian, so that SQL can read it: magic, part, nth, ids, documents, block, CRC-32.
HEADER = struct.Struct(">8sIIQQII")
_AT = {"part": (8, 4), "nth": (12, 4), "n_ids": (16, 8)}
#: A block's minimum, width and number of exceptions.
_HEAD = 7
#: Blocks that are packed or unpacked in one step, which bounds the memory of it.
_STEP = 4096
#: Ids in one batch that a reading task returns, but for a longer document.
_BATCH = 1 << 20


# --- blocks ------------------------------------------------------------------


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for counts[0] numbers, then the same from starts[1]."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()))


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of each value of each row, as bytes."""
    bits = np.unpackbits(values.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(bits[:, 32 - width :].reshape(len(values), -1), axis=1)


def _unpacked(rows: np.ndarray, width: int, block: int) -> np.ndarray:
    bits = np.zeros((len(rows) * block, 32), np.uint8)
    bits[:, 32 - width :] = np.unpackbits(rows, axis=1).reshape(-1, width)
    return np.packbits(bits, axis=1).view(">u4").astype(np.uint32).reshape(len(rows), block)


def pack_blocks(rows: np.ndarray, share: float) -> tuple[bytes, np.ndarray]:
    """The bytes of some blocks, one a row of ids, and the size of each."""
    block = rows.shape[1]
    low = rows.min(axis=1)
    rest = rows - low[:, None]
    needed = np.frexp(rest.astype(np.float64))[1]  # bits that each value needs
    kth = max(0, int(np.ceil(share * block)) - 1)
    width = np.partition(needed, kth, axis=1)[:, kth].astype(np.int64)
    row, column = np.nonzero(needed > width[:, None])
    many = np.bincount(row, minlength=len(rows))
    body = block * width // 8
    sizes = _HEAD + body + 5 * many
    at = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    head = np.zeros(len(rows), np.dtype([("low", "<u4"), ("width", "u1"), ("many", "<u2")]))
    head["low"], head["width"], head["many"] = low, width, many
    out[at[:, None] + np.arange(_HEAD)] = head.view(np.uint8).reshape(-1, _HEAD)
    for w in np.unique(width[width > 0]).tolist():
        same = np.flatnonzero(width == w)
        out[(at[same] + _HEAD)[:, None] + np.arange(block * w // 8)] = _packed(rest[same], w)
    lists = at + _HEAD + body
    out[_spread(lists, many)] = column
    high = (rest[row, column] >> width[row].astype(np.uint32)).astype("<u4")
    out[_spread(lists + many, 4 * many)] = high.view(np.uint8)
    return out.tobytes(), sizes


def unpack_blocks(data: np.ndarray, at: np.ndarray, block: int) -> np.ndarray:
    """The ids of the blocks that start at ``at``, one block a row."""
    head = data[at[:, None] + np.arange(_HEAD)].copy()
    head = head.view(np.dtype([("low", "<u4"), ("width", "u1"), ("many", "<u2")])).reshape(-1)
    width, many = head["width"].astype(np.int64), head["many"].astype(np.int64)
    out = np.zeros((len(at), block), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        same = np.flatnonzero(width == w)
        rows = data[(at[same] + _HEAD)[:, None] + np.arange(block * w // 8)]
        out[same] = _unpacked(rows, w, block)
    lists = at + _HEAD + block * width // 8
    row = np.repeat(np.arange(len(at)), many)
    column = data[_spread(lists, many)]
    high = np.ascontiguousarray(data[_spread(lists + many, 4 * many)]).view("<u4").astype(np.uint32)
    out[row, column] |= high << width[row].astype(np.uint32)
    return out + head["low"][:, None]


# --- files -------------------------------------------------------------------


def encode_file(
    part: int,
    nth: int,
    documents: list[int | None],
    lengths: list[int],
    ids: np.ndarray,
    block: int = 256,
    share: float = 0.9,
) -> bytes:
    """One file: the ids of some documents one after the other."""
    if not 8 <= block <= 256 or block % 8:
        raise ValueError("a block has a multiple of 8 ids, 256 at most")
    ids = ids.astype(np.uint32)
    n = -(-len(ids) // block)
    padded = np.concatenate([ids, np.repeat(ids[-1:], n * block - len(ids))]).reshape(n, block)
    made = [pack_blocks(padded[i : i + _STEP], share) for i in range(0, n, _STEP)]
    sizes = np.concatenate([[0], *[s for _, s in made]])
    known = np.array([d is not None for d in documents], np.uint8)
    numbers = np.array([d or 0 for d in documents], "<i8")
    ends = np.cumsum(lengths, dtype="<i8")
    before = HEADER.size + 8 * (n + 1) + 17 * len(documents)
    index = (before + np.cumsum(sizes)).astype("<i8")
    rest = b"".join([index.tobytes(), numbers.tobytes(), known.tobytes(), ends.tobytes(), *[b for b, _ in made]])
    return HEADER.pack(MAGIC, part, nth, len(ids), len(documents), block, zlib.crc32(rest)) + rest


@dataclass(frozen=True)
class TokenFile:
    """A file in memory; only the blocks asked for are decoded."""

    data: np.ndarray
    part: int
    nth: int
    n_ids: int
    n_docs: int
    block: int

    @classmethod
    def open(cls, data: bytes) -> TokenFile:
        """Bytes after the end of the last block (the writer's line break) do not count."""
        magic, part, nth, n_ids, n_docs, block, crc = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        made = cls(np.frombuffer(data, np.uint8), part, nth, n_ids, n_docs, block)
        if zlib.crc32(made.data[HEADER.size : int(made.index[-1])]) != crc:
            raise ValueError(f"token file {part}-{nth} is damaged")
        return made

    def _section(self, at: int, count: int, kind: str) -> np.ndarray:
        return np.frombuffer(self.data, kind, count, at)

    @cached_property
    def index(self) -> np.ndarray:
        return self._section(HEADER.size, -(-self.n_ids // self.block) + 1, "<i8")

    @cached_property
    def documents(self) -> list[int | None]:
        at = HEADER.size + 8 * len(self.index)
        known = self._section(at + 8 * self.n_docs, self.n_docs, "u1")
        numbers = self._section(at, self.n_docs, "<i8").tolist()
        return [d if k else None for d, k in zip(numbers, known, strict=True)]

    @cached_property
    def ends(self) -> np.ndarray:
        return self._section(HEADER.size + 8 * len(self.index) + 9 * self.n_docs, self.n_docs, "<i8")

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids from ``start`` to before ``stop``."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, -(-stop // self.block)
        parts = [
            unpack_blocks(self.data, self.index[i : min(i + _STEP, last)], self.block).reshape(-1)
            for i in range(first, last, _STEP)
        ]
        whole = np.concatenate(parts)
        return whole[start - first * self.block : stop - first * self.block]


# --- the jobs ----------------------------------------------------------------


def write_token_files(
    docs: DataFrame,
    path: str,
    load: Callable[[], Callable[[str], list[int]]],
    *,
    end_id: int = 2,
    block: int = 256,
    share: float = 0.9,
    file_ids: int = 1 << 24,
    doc: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode all texts into files below ``path``, in ascending order of their numbers.

    ``load`` gives, in a task, the function from text to ids; ``end_id`` follows each
    document. A file is closed once it has ``file_ids`` ids, between documents. Null texts
    are empty, null numbers come first, rows of one number are in the order of a hash of
    their texts, and repeated rows are all written. Other columns do not matter; an empty
    table makes no files.
    """
    plain = docs.select(F.col(f"`{doc}`").cast("bigint").alias("_doc"), text_bytes(text).alias("_text"))
    # the row number only keeps copies of one row from ending up in one range
    order = ["_doc", "_hash", "_row"]
    keyed = plain.withColumns({"_hash": F.xxhash64("_text"), "_row": F.monotonically_increasing_id()})
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, nth, total = load(), TaskContext.get().partitionId(), 0, 0
        numbers, lengths, parts = [], [], []

        def file() -> pa.RecordBatch:
            data = encode_file(part, nth, numbers, lengths, np.concatenate(parts), block, share)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["value"])

        for batch in batches:
            texts = batch.column(1)
            for i, number in enumerate(batch.column(0).to_pylist()):
                ids = encode(texts[i].as_py().decode("utf-8", "replace"))
                numbers.append(number)
                lengths.append(len(ids) + 1)
                parts.append(np.array([*ids, end_id], np.uint32))
                total += len(ids) + 1
                if total >= file_ids:
                    yield file()
                    nth, total = nth + 1, 0
                    numbers, lengths, parts = [], [], []
        if numbers:
            yield file()

    made = ranged.select("_doc", "_text").mapInArrow(run, "value binary")
    # the text writer puts out a string's bytes as they are, and a line break at the end
    lines = made.select(F.col("value").cast("string")).write
    lines.option("maxRecordsPerFile", 1).text(path, lineSep="\n")


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Spark leaves an empty file where a task had no rows."""
    return spark.read.format("binaryFile").load(path).where(F.col("length") > HEADER.size)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(part, nth, n_ids, base): how many ids each file has, and all files before it.

    Only one row per writing task meets in one place.
    """
    head = F.hex(F.substring("content", 1, HEADER.size))

    def number(name: str) -> Column:
        at, size = _AT[name]
        return F.conv(F.substring(head, 2 * at + 1, 2 * size), 16, 10).cast("bigint").alias(name)

    files = materialise(_files(spark, path).select(*map(number, _AT)), "manifest")
    before = (Window.unboundedPreceding, -1)
    by_part = files.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    earlier = F.sum("_n").over(Window.partitionBy(F.lit(1)).orderBy("part").rowsBetween(*before))
    parts = by_part.select("part", F.coalesce(earlier, F.lit(0)).alias("_before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("nth").rowsBetween(*before))
    placed = files.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(parts, "part")
    return placed.select("part", "nth", "n_ids", (F.col("_before") + F.col("_inside")).alias("base"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids), one row per document written.

    ``start`` counts the ids of all documents before it, ``ids`` are little-endian
    unsigned 32-bit numbers. A damaged file raises.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "nth", "doc_id", "_start", "n_tokens", "ids"]
        for batch in batches:
            for i in range(batch.num_rows):
                file = TokenFile.open(batch.column(0)[i].as_py())
                ends, documents, first = file.ends, file.documents, 0
                while first < len(ends):
                    start = int(ends[first - 1]) if first else 0
                    last = max(first + 1, int(np.searchsorted(ends, start + _BATCH, "right")))
                    ids = file.ids(start, int(ends[last - 1])).astype("<u4")
                    starts = np.concatenate([[start], ends[first : last - 1]]).astype(np.int64)
                    cuts = np.concatenate([starts, ends[last - 1 : last]]) - start
                    blobs = [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                    n = last - first
                    columns = [
                        pa.array(np.full(n, file.part, np.int64)),
                        pa.array(np.full(n, file.nth, np.int64)),
                        pa.array(documents[first:last], pa.int64()),
                        pa.array(starts),
                        pa.array(np.diff(cuts)),
                        pa.array(blobs, pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names)
                    first = last

    schema = "part bigint, nth bigint, doc_id bigint, _start bigint, n_tokens bigint, ids binary"
    found = _files(spark, path).select("content").mapInArrow(run, schema)
    bases = materialise(manifest(spark, path).select("part", "nth", "base"), "bases")
    placed = found.join(broadcast_if_small(bases), ["part", "nth"])
    return placed.select("doc_id", (F.col("base") + F.col("_start")).alias("start"), "n_tokens", "ids")


def write_and_read(docs: DataFrame, load: Callable[[], Callable[[str], list[int]]], **options) -> DataFrame:
    """``docs`` through files in the shared folder."""
    path = new_path(docs.sparkSession, "tokens")
    write_token_files(docs, path, load, **options)
    return read_token_files(docs.sparkSession, path)
