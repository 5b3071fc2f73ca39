"""Cleaning raw observations: dedupe, coerce, drop, trim outliers, derive."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions import (
    category_name,
    coerce_long,
    coerce_timestamp,
    engagement_rate,
    iso_duration_seconds,
    like_ratio,
    whole_number,
)
from trendloom.operators.reshape import dedupe_first
from trendloom.operators.topics import quantile_scalar
from trendloom.sources.workspace import materialise

# Columns that are coerced where present.
DATE_COLUMNS = ("trending_date", "publish_time", "publishedAt")
COUNT_COLUMNS = (
    "views",
    "likes",
    "dislikes",
    "comment_count",
    "view_count",
    "like_count",
    "dislike_count",
)


@dataclass(frozen=True)
class CleanConfig:
    """``order`` decides which copy of a key is the first; it should be total."""

    keys: Sequence[str] = ("video_id", "trending_date", "country")
    order: Sequence[str] = ("source_file", "trending_date")
    date_format: str | None = None
    outlier_k: float | None = 3.0
    exact: bool = False


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def coerce_dates(df: DataFrame, fmt: str | None = None) -> DataFrame:
    return df.withColumns({c: coerce_timestamp(c, fmt) for c in present(df, DATE_COLUMNS)})


def coerce_counts(df: DataFrame) -> DataFrame:
    return df.withColumns({c: coerce_long(c) for c in present(df, COUNT_COLUMNS)})


def narrow_types(df: DataFrame) -> DataFrame:
    """Table types for text columns; fractions are dropped, unreadable text is NULL.

    Missing dislikes are 0.
    """
    to_int = {
        "category_id": "int",
        "likes": "int",
        "dislikes": "int",
        "comment_count": "int",
        "views": "bigint",
    }
    casts = {c: whole_number(c, t) for c, t in to_int.items() if c in df.columns}
    if "dislikes" in casts:
        casts["dislikes"] = F.coalesce(casts["dislikes"], F.lit(0))
    if "trending_date" in df.columns:
        casts["trending_date"] = F.try_to_date("trending_date")
    if "publish_time" in df.columns:
        casts["publish_time"] = F.try_to_timestamp("publish_time")
    return df.withColumns(casts)


def drop_missing(df: DataFrame, column: str = "title") -> DataFrame:
    return df.dropna(subset=[column]) if column in df.columns else df


def within_iqr(
    df: DataFrame,
    column: str,
    k: float = 3.0,
    *,
    exact: bool = False,
) -> Column:
    """Whether a value lies in [max(0, Q1 - k IQR), Q3 + k IQR] of the table.

    True for all rows where the column's sum is not positive.
    """
    q = quantile_scalar(
        df,
        column,
        {"q1": 0.25, "q3": 0.75},
        exact=exact,
        interpolate=True,
    )
    total = df.agg(F.coalesce(F.sum(column), F.lit(0))).scalar()
    q1, q3 = q.getField("q1"), q.getField("q3")
    low = F.greatest(F.lit(0), q1 - k * (q3 - q1))
    return (total <= 0) | F.col(column).between(low, q3 + k * (q3 - q1))


def iqr_filter(
    df: DataFrame,
    column: str,
    k: float = 3.0,
    *,
    exact: bool = False,
) -> DataFrame:
    return df.filter(within_iqr(df, column, k, exact=exact))


def clean(df: DataFrame, cfg: CleanConfig = CleanConfig()) -> tuple[DataFrame, DataFrame]:
    """Cleaned rows and a one-row report of what each step removed.

    Steps whose columns are missing are skipped. Order: dedupe, dates, counts,
    durations, missing titles, outliers, derived measures, category names.
    """
    keys = present(df, cfg.keys)
    work = dedupe_first(df, keys, present(df, cfg.order)) if keys else df
    work = coerce_counts(coerce_dates(work, cfg.date_format))
    if "duration" in work.columns:
        work = work.withColumn("duration_sec", iso_duration_seconds("duration"))
    # read by the quantiles, the report and the result
    work = materialise(work, "clean")

    titled = drop_missing(work)
    has_title = F.col("title").isNotNull() if "title" in work.columns else F.lit(True)
    view_col = next(iter(present(work, ("views", "view_count"))), None)
    if view_col and cfg.outlier_k is not None:
        inside = within_iqr(
            titled, view_col, cfg.outlier_k, exact=cfg.exact
        )
    else:
        inside = F.lit(True)

    flags = work.select(has_title.alias("titled"), (has_title & inside).alias("kept"))
    report = _report(df, flags)

    out = titled.filter(inside)
    if {"views", "likes"} <= set(out.columns):
        dislikes = "dislikes" if "dislikes" in out.columns else None
        out = out.withColumns(
            {
                "engagement_rate": engagement_rate("cleaner"),
                "like_ratio": like_ratio("cleaner", dislikes=dislikes),
            }
        )
    if "category_id" in out.columns:
        number = F.col("category_id").try_cast("double").try_cast("int")
        out = out.withColumn("category_id", number).withColumn(
            "category_name", category_name("category_id", unknown="Unknown")
        )
    return out, report


def _report(raw: DataFrame, flags: DataFrame) -> DataFrame:
    initial = raw.agg(F.count(F.lit(1))).scalar()
    counted = flags.agg(
        F.count(F.lit(1)).alias("unique_rows"),
        F.count_if("titled").alias("titled_rows"),
        F.count_if("kept").alias("kept_rows"),
    )
    return counted.withColumn("initial_rows", initial).select(
        "initial_rows",
        (F.col("initial_rows") - F.col("unique_rows")).alias("duplicates"),
        (F.col("unique_rows") - F.col("titled_rows")).alias("missing_titles"),
        (F.col("titled_rows") - F.col("kept_rows")).alias("outliers"),
        "kept_rows",
        (F.try_divide(F.col("kept_rows"), F.col("initial_rows")) * 100).alias("kept_percent"),
    )
