"""Line dedup: windows of consecutive lines that occur earlier in the corpus go.

Windows run over the lines that hold text. Occurrences are ordered by document id, the
text's hash and position. Every line covered by a later occurrence of some window is
removed, judged on the input, so the first occurrence of every distinct line stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.llm.arrow import to_arrow
from trendloom.sources.workspace import materialise

_BLANKS = " \t\x0b\x0c\r"
_ADDED = T.StructType([T.StructField(n, T.LongType()) for n in ("n_lines", "n_removed", "n_spans")])


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(_BLANKS))


def _windows(keyed: DataFrame, size: int) -> DataFrame:
    """(_id, _hash, _at, _w1, _w2): the windows of every text, by 128 bits of hash."""
    lines = F.filter(F.transform(F.split("_text", "\n"), _bare), lambda x: x != "")
    at = keyed.select("_id", "_hash", lines.alias("_lines")).where(F.size("_lines") >= size)
    window = lambda i: F.concat_ws("\n", F.slice("_lines", i + 1, size))
    each = at.select(
        "_id",
        "_hash",
        F.posexplode(
            F.transform(F.sequence(F.lit(0), F.size("_lines") - size), window)
        ).alias("_at", "_window"),
    )
    return each.select(
        "_id", "_hash", "_at",
        F.xxhash64("_window").alias("_w1"),
        F.xxhash64(F.lit(size), F.reverse("_window")).alias("_w2"),
    )


def dedup_lines(
    docs: DataFrame, size: int = 3, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with shortened texts and n_lines (with text), n_removed, n_spans.

    Null texts are empty and stay empty strings. Texts of fewer than ``size`` lines keep
    all of them. Rows that agree in id and text count as one document: all keep the
    same lines. Null ids are one id, before all others. Blank lines are never removed.
    Other columns pass through; columns named like a result are replaced.
    """
    kept = docs.drop(*[f.name for f in _ADDED])
    fields = [f.name for f in kept.schema]
    others = [n for n in fields if n not in (doc, text)]
    names = {n: f"__other{i}" for i, n in enumerate(others)} | {doc: "__id", text: "__text"}
    plain = F.coalesce(F.col("__text"), F.lit(""))
    inner = kept.toDF(*[names[n] for n in fields])
    keyed = inner.select(F.col("__id").alias("_id"), F.xxhash64(plain).alias("_hash"), plain.alias("_text"))
    windows = _windows(keyed, size)
    place = F.struct("_id", "_hash", "_at")
    firsts = (
        windows.groupBy("_w1", "_w2")
        .agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select("_w1", "_w2", "_first")
    )
    # stored, so that both sides of the join are shuffled and a hot window can be split
    firsts = materialise(firsts, "windows")
    later = (
        windows.join(firsts, ["_w1", "_w2"])
        .where(~place.eqNullSafe(F.col("_first")))
        .groupBy("_id", "_hash")
        .agg(F.collect_set("_at").alias("_later"))
    )
    passed = ["__id", *[names[n] for n in others]]
    marked = (
        inner.withColumn("__hash", F.xxhash64(plain))
        .join(later, F.col("__id").eqNullSafe(F.col("_id")) & (F.col("__hash") == F.col("_hash")), "left")
        .select(*passed, plain.cast("binary").alias("__text"), "_later")
    )
    made = T.StructType([T.StructField("__text", T.StringType()), *_ADDED])
    schema = T.StructType([*[f for f in marked.schema if f.name in passed], *made])
    types = to_arrow(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_columns
            pairs = zip(batch.column(n - 2).to_pylist(), batch.column(n - 1).to_pylist(), strict=True)
            columns = list(zip(*[_without(t, at, size) for t, at in pairs], strict=True)) or [[]] * 4
            new = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(n - 2)] + new, schema.fieldNames())

    done = marked.mapInArrow(run, schema)
    return done.select(*[F.col(names[n]).alias(n) for n in fields], *_ADDED.fieldNames())


def _without(text: bytes, later: list[int] | None, size: int) -> tuple[str, int, int, int]:
    """The text without the lines of the windows that start at ``later``."""
    lines = text.decode("utf-8", "replace").split("\n")
    full = np.array([i for i, line in enumerate(lines) if line.strip(_BLANKS)], np.int64)
    covered = np.zeros(len(full), bool)
    if later:
        starts = np.array(later)
        for shift in range(size):
            covered[starts + shift] = True
    gone = set(full[covered].tolist())
    rest = "\n".join(line for i, line in enumerate(lines) if i not in gone) if gone else "\n".join(lines)
    spans = int(covered[:1].sum() + (covered[1:] & ~covered[:-1]).sum())
    return rest, len(full), len(gone), spans
