"""Helpers for operators that work on Arrow batches inside Spark tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def text_bytes(text: str) -> F.Column:
    """A text column as UTF-8 bytes; null is empty."""
    return F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")


def with_text_columns(
    docs: DataFrame,
    text: str,
    added: T.StructType,
    compute: Callable[..., list],
    beside: F.Column | None = None,
) -> DataFrame:
    """``docs`` with the columns of ``added``, computed from each batch of texts.

    ``compute`` takes the UTF-8 texts of a batch and returns one list per added column;
    given ``beside``, it takes the values of that column of ``docs`` as well.
    Columns of ``docs`` that have a name of ``added`` are replaced.
    """
    names = [f.name for f in added]
    kept = [f for f in docs.schema if f.name not in names]
    types = to_arrow(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = compute(*[c.to_pylist() for c in batch.columns[len(kept) :]])
            made = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            old = batch.columns[: len(kept)]
            yield pa.RecordBatch.from_arrays(old + made, [f.name for f in kept] + names)

    columns = [F.col(f"`{f.name}`").alias(f"_{i}") for i, f in enumerate(kept)]
    read = [text_bytes(text).alias("_text"), *([] if beside is None else [beside.alias("_beside")])]
    plain = docs.select(*columns, *read)
    return plain.mapInArrow(run, T.StructType([*kept, *added]))


_ARROW = {
    T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(),
    T.BooleanType: pa.bool_(), T.StringType: pa.string(), T.BinaryType: pa.binary(),
}


def to_arrow(schema: T.StructType) -> list[pa.DataType]:
    def one(kind: T.DataType) -> pa.DataType:
        if isinstance(kind, T.ArrayType):
            return pa.list_(one(kind.elementType))
        if isinstance(kind, T.StructType):
            return pa.struct([(f.name, one(f.dataType)) for f in kind])
        return _ARROW[type(kind)]

    return [one(f.dataType) for f in schema]
