"""Selecting, combining and reshaping rows; dashboard frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from trendloom.operators.joins import keep_matching
from trendloom.operators.ordered import numbered

# Divisors that bring chart metrics to a common scale.
TITLE_SCALE = 100
TAG_SCALE = 50
ENGAGEMENT_SCALE = 100

DATA_EXTENSIONS = ("csv", "json", "txt", "tsv")


def dedupe_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """The first row of each key in ``order``.

    Spark cuts every input partition to one row per key before the shuffle, so
    a key with very many copies does not gather in one task.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_distinct_ids(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n smallest distinct non-NULL ids."""
    return df.select(column).dropna().distinct().orderBy(column).limit(n)


def head(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def id_batches(df: DataFrame, column: str, size: int = 50) -> DataFrame:
    """Distinct ids in order, cut into batches of ``size``; only the last is short."""
    placed = numbered(df.select(column).dropna().distinct(), [column], "_place")
    batch = F.floor(F.col("_place") / size)
    return placed.groupBy(batch.alias("batch")).agg(
        F.array_sort(F.collect_list(column)).alias("ids")
    )


def top_sums(df: DataFrame, key: str, value: str, n: int = 5) -> DataFrame:
    """The n keys with the largest sum; smaller keys win ties."""
    return (
        df.groupBy(key)
        .agg(F.sum(value).alias(f"sum_{value}"))
        .orderBy(F.col(f"sum_{value}").desc(), key)
        .limit(n)
    )


# --- manifests ---------------------------------------------------------------

def usable_files(
    manifest: DataFrame, max_mb: float = 100, extensions: Sequence[str] = DATA_EXTENSIONS
) -> DataFrame:
    """Manifest entries of a usable size whose name contains a data extension."""
    name = F.lower("filename")
    matches = reduce(
        lambda a, b: a | b, [F.contains(name, F.lit(f".{e}")) for e in extensions]
    )
    return manifest.filter((F.col("size_mb") > 0) & (F.col("size_mb") < max_mb) & matches)


def most_downloaded(manifest: DataFrame, n: int = 5) -> DataFrame:
    return manifest.orderBy(F.col("downloads").desc(), "key").limit(n)


# --- dashboard frames --------------------------------------------------------

def radar_frame(viral: DataFrame) -> DataFrame:
    """Viral-factor profile on a common scale, one row per tier."""
    return viral.select(
        "viral_category",
        (F.col("avg_title_length") / TITLE_SCALE).alias("title_length"),
        (F.col("avg_tag_count") / TAG_SCALE).alias("tag_count"),
        (F.col("avg_engagement") * ENGAGEMENT_SCALE).alias("engagement"),
        F.col("has_caps_ratio").alias("caps_usage"),
        F.col("has_punctuation_ratio").alias("punctuation"),
    )


def heatmap_frame(timing: DataFrame, value: str = "global_avg_views") -> DataFrame:
    """Weekday rows (1 = Sunday) by 24 hour columns."""
    hours = list(range(24))
    wide = timing.groupBy("day_of_week").pivot("hour", hours).agg(F.first(value))
    return wide.withColumnsRenamed({str(h): f"hour_{h}" for h in hours})


def evolution_frame(evolution: DataFrame, n: int = 5) -> DataFrame:
    """Month series of the n categories with the largest total."""
    top = top_sums(evolution, "category_id", "total_views", n)
    return keep_matching(evolution, top, "category_id").select(
        "month", "category_id", "total_views"
    )


def strategy_frame(strategies: DataFrame) -> DataFrame:
    """Tier metrics as (tier, metric, value) rows with display names."""
    metrics = ["avg_category_diversity", "avg_consistency", "avg_peak_ratio"]
    long = strategies.withColumn(
        "avg_category_diversity", F.col("avg_category_diversity").cast("double")
    ).unpivot(["performance_tier"], metrics, "metric", "value")
    shown = F.initcap(
        F.replace(F.replace("metric", F.lit("avg_"), F.lit("")), F.lit("_"), F.lit(" "))
    )
    return long.withColumn("metric", shown)
