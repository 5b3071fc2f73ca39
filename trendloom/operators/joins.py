"""Join helpers that check sizes before they broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.operators.ordered import join_null_safe

# file sizes are compressed: in memory a frame may be several times larger
BROADCAST_BYTES = 32 * 1024 * 1024


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a frame (file sizes for plain scans)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the size estimate is within ``limit``.

    Beyond it the frame is returned as it is, and Spark picks a shuffle join.
    """
    return F.broadcast(df) if planned_bytes(df) <= limit else df


def join_dimension(facts: DataFrame, dim: DataFrame, on: str | list[str]) -> DataFrame:
    """Inner equi-join of facts with a dimension table."""
    return facts.join(broadcast_if_small(dim), on)


def left_join_where(
    left: DataFrame, right: DataFrame, keys: list[str], right_filter
) -> DataFrame:
    """Left outer join with a residual on the right side of ON.

    Filtering the right side first gives the same rows: unmatched left rows
    stay, with NULLs. NULL keys match nothing.
    """
    return left.join(right.filter(right_filter), on=keys, how="left")


def keep_matching(facts: DataFrame, wanted: DataFrame, on: str | list[str]) -> DataFrame:
    """Left-semi join: rows of ``facts`` whose key occurs in ``wanted``."""
    return facts.join(broadcast_if_small(wanted), on, "left_semi")


__all__ = [
    "broadcast_if_small",
    "join_dimension",
    "join_null_safe",
    "keep_matching",
    "left_join_where",
    "planned_bytes",
]
