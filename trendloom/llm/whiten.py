"""Whitening of embeddings by a mixed-precision eigendecomposition.

Every vector, as whole numbers, counts once in the fit, however often it occurs. Sums and
the centred covariance are added up over all tasks, entry by entry; the driver gets a
matrix of the dimension. Its eigenvectors are found in single precision and corrected in
double precision by the iteration of Ogita and Aishima, made of matrix products only.
Eigenvalues that lie too close for it are clusters: the small matrix of such a cluster,
shifted by its mean, is decomposed on its own, and the iteration goes on from there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.sources.workspace import materialise

#: Entries beyond this would leave the range in which sums of whole numbers are exact.
LARGEST = float(1 << 40)


# --- eigenvectors ------------------------------------------------------------


def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One correction: new vectors, eigenvalues, and the limit below which gaps are clusters."""
    r = np.eye(len(a)) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    limit = 2 * (np.linalg.norm(off) + np.linalg.norm(a, 2) * np.linalg.norm(r))
    gap = values[None, :] - values[:, None]
    near = np.abs(gap) <= limit
    e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gap))
    return x + x @ e, values, limit


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Newton-Schulz steps towards the nearest orthonormal columns; products only."""
    for _ in range(4):
        r = np.eye(x.shape[1]) - x.T @ x
        if np.abs(r).max() < 4 * np.finfo(float).eps:
            break
        x = x + x @ r / 2
    return x


def _clusters(values: np.ndarray, limit: float) -> list[np.ndarray]:
    """Indices of eigenvalues that hang together by gaps of at most ``limit``."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > limit) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def refined_eigenvectors(a: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and its eigenvectors as columns.

    Starts from single precision. Each round corrects all vectors; while the limit still
    joins eigenvalues, the cluster's small matrix is solved in double precision, so that
    its vectors turn inside the space they span. Ends when what is off the diagonal has
    come down to rounding and stays there.
    """
    d = len(a)
    scale = float(np.abs(a).max()) if d else 0.0
    if scale == 0.0:
        return np.zeros(d), np.eye(d)
    a = (a + a.T) / (2 * scale)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    enough = 8 * d * np.finfo(float).eps
    best, seen = np.inf, 0
    for _ in range(rounds):
        new, values, limit = _step(a, x)
        new = _orthonormal(new)
        groups = _clusters(values, limit)
        for group in groups:
            sub = new[:, group]
            mean = float(values[group].mean())
            small = sub.T @ (a @ sub - mean * sub)
            turn = np.linalg.eigh((small + small.T) / 2)[1]
            new[:, group] = sub @ turn
        x = _orthonormal(new) if groups else new
        off = x.T @ (a @ x)
        residual = float(np.abs(off - np.diag(np.diag(off))).max())
        seen = seen + 1 if residual >= best / 2 else 0
        best = min(best, residual)
        if seen and (residual <= enough or seen == 3):
            break
    values = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]


# --- the jobs ----------------------------------------------------------------


def whole_numbers(vector: Column, scale: int, shift: int) -> Column:
    """A vector's entries as whole numbers, or null where the vector is not usable."""

    def usable(c: Column) -> Column:
        wide = c.cast("double")
        return c.isNotNull() & ~F.isnan(wide) & (F.abs(wide) <= LARGEST)

    made = F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("bigint") + shift)
    return F.when(F.forall(vector, usable) & (F.size(vector) > 0), made)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, d)


def vector_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and sum by dimension, exact however large."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (d + 1)
        for batch in batches:
            rows = _matrix(batch.column(0), d)
            for i in range(0, len(rows), 1024):  # 2^46 at most each, so 64 bits hold their sum
                some = rows[i : i + 1024]
                total = [a + b for a, b in zip(total, [len(some), *some.sum(axis=0).tolist()], strict=True)]
        sums = pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1)), sums], ["i", "s"])

    sums = fit.select("_x").mapInArrow(run, "i bigint, s decimal(38,0)")
    out = [0] * (d + 1)
    for row in sums.groupBy("i").agg(F.sum("s").alias("s")).collect():
        out[row["i"]] = int(row["s"])
    return out[0], out[1:]


def _product_sums(
    fit: DataFrame, d: int, width: int, centred: Callable[[np.ndarray], np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Sums over the fit of the rows that ``centred`` makes, and of their outer products.

    Each task sends every entry once; Spark adds them up by entry.
    """
    up = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = np.zeros((width, width)), np.zeros(width)
        for batch in batches:
            rows = centred(_matrix(batch.column(0), d))
            total += rows.T @ rows
            first += rows.sum(axis=0)
        columns = [
            pa.array(np.concatenate([up[0], np.full(width, -1)])),
            pa.array(np.concatenate([up[1], np.arange(width)])),
            pa.array(np.concatenate([total[up], first])),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "s"])

    parts = fit.select("_x").mapInArrow(run, "i bigint, j bigint, s double")
    first, total = np.zeros(width), np.zeros((width, width))
    for row in parts.groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        if row["i"] < 0:
            first[row["j"]] = row["s"]
        else:
            total[row["i"], row["j"]] = total[row["j"], row["i"]] = row["s"]
    return first, total


def whiten(
    rows: DataFrame,
    components: int = 16,
    *,
    scale: int = 64,
    shift: int = 1_000_000,
    vector: str = "embedding",
    name: str = "vec_id",
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error).

    One row per usable vector and component, strongest first. Rows whose vector is null,
    empty, holds a null, a non-finite entry or one beyond 2^40, or has another length than
    most (the smaller of two as frequent ones) are left out; repeated rows and numbers
    stay. Components without variance (of copies of one vector, of constant dimensions)
    cannot be whitened and are left out, so fewer than ``components`` may come back.
    ``deviation`` is null where it does not fit into 64 bits. Other columns are dropped.
    """
    spark = rows.sparkSession
    kind = rows.schema[name].dataType.simpleString()
    schema = (
        f"`{name}` {kind}, component int, n bigint, deviation bigint, whitened double, "
        "explained double, identity_error double"
    )
    made = rows.select(
        F.col(f"`{name}`").alias("_name"), whole_numbers(F.col(f"`{vector}`"), scale, shift).alias("_x")
    )
    usable = materialise(made.where(F.col("_x").isNotNull()), "vectors")
    lengths = usable.groupBy(F.size("_x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), "d").first()
    empty = spark.createDataFrame([], T.StructType.fromDDL(schema))
    if common is None:
        return empty
    d = common["d"]
    usable = usable.where(F.size("_x") == d)
    fit = materialise(usable.select("_x").distinct(), "fit")
    n, total = vector_sums(fit, d)

    def apart(x: np.ndarray) -> np.ndarray:
        """n times the distance from the mean: whole numbers, of any size if need be."""
        if n * int(np.abs(x).max(initial=0)) + max(map(abs, total)) < 1 << 62:
            return n * x - np.array(total, np.int64)
        return n * x.astype(object) - np.array(total, object)

    def centre(x: np.ndarray) -> np.ndarray:
        return (apart(x) / n).astype(float)

    _, products = _product_sums(fit, d, d, centre)
    covariance = products / n
    values, vectors = refined_eigenvectors(covariance)
    trace = float(np.trace(covariance))
    held = min(components, int((values > 4 * d * np.finfo(float).eps * max(values[0], 0)).sum()))
    if held == 0 or trace <= 0:
        return empty
    explained = values[:held] / trace
    projection = vectors[:, :held] / np.sqrt(values[:held])
    first, again = _product_sums(fit, d, held, lambda x: centre(x) @ projection)
    error = float(np.abs(again / n - np.outer(first / n, first / n) - np.eye(held)).max())
    numbers = np.arange(1, held + 1, dtype=np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), d)
            if not len(x):
                continue
            whole = apart(x)
            if whole.dtype == np.int64 and int(np.abs(whole).max()) ** 2 * d < 1 << 62:
                deviation = pa.array((whole * whole).sum(axis=1))
            else:
                exact = [sum(v * v for v in row) for row in whole.tolist()]
                deviation = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
            each = np.repeat(np.arange(len(x)), held)
            columns = [
                batch.column(0).take(pa.array(each)),
                pa.array(np.tile(numbers, len(x))),
                pa.array(np.full(len(each), n)),
                deviation.take(pa.array(each)),
                pa.array(((whole / n).astype(float) @ projection).reshape(-1)),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(each), error)),
            ]
            names = [name, "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return usable.select("_name", "_x").mapInArrow(run, schema)
