"""Aggregate tables and descriptive aggregates over trending observations."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from trendloom.functions import category_name, time_segment, trending_score
from trendloom.operators.joins import broadcast_if_small, left_join_where
from trendloom.operators.ordered import approx_quantiles, exact_quantiles


def _rows() -> Column:
    return F.count(F.lit(1))


# --- channel statistics ------------------------------------------------------

def channel_metrics(df: DataFrame) -> DataFrame:
    return df.groupBy("channel_title", "country").agg(
        F.count_distinct("video_id").alias("total_videos"),
        F.sum("views").alias("total_views"),
        F.avg("views").alias("avg_views"),
        F.sum("likes").cast("bigint").alias("total_likes"),
        F.avg("engagement_rate").alias("avg_engagement_rate"),
    )


def category_ranks_by_channel(df: DataFrame) -> DataFrame:
    """Categories of each channel by row count; ties go to the smaller id.

    The window sees one row per category, not the observations.
    """
    w = W.partitionBy("channel_title", "country").orderBy(
        F.col("category_count").desc(), F.col("category_id").asc()
    )
    return (
        df.groupBy("channel_title", "country", "category_id")
        .agg(_rows().alias("category_count"))
        .withColumn("rn", F.row_number().over(w))
    )


def channel_statistics_joined(df: DataFrame) -> DataFrame:
    """``channel_statistics`` spelled as metrics left-joined to the top category."""
    top = category_ranks_by_channel(df)
    joined = left_join_where(
        channel_metrics(df), top, ["channel_title", "country"], F.col("rn") == 1
    )
    return joined.select(
        "channel_title",
        "country",
        "total_videos",
        "total_views",
        "avg_views",
        "total_likes",
        "avg_engagement_rate",
        F.col("category_id").alias("top_category"),
    )


def channel_statistics(df: DataFrame) -> DataFrame:
    """Per channel and country: volumes, means and the most frequent category.

    A channel whose key is NULL has no top category; a NULL category can win.
    """
    known = F.col("channel_title").isNotNull() & F.col("country").isNotNull()
    return _channel_single_scan(df, F.lit(True)).withColumn(
        "top_category", F.when(known, F.col("top_category"))
    )


def channel_statistics_mode(df: DataFrame) -> DataFrame:
    """As ``channel_statistics`` with MODE: every channel, NULL categories ignored."""
    return _channel_single_scan(df, F.col("category_id").isNotNull())


def _channel_single_scan(df: DataFrame, counts_as_category: Column) -> DataFrame:
    """Each row feeds a total per category and one per video of its channel.

    Both are combined before the shuffle, so a channel with very many rows
    arrives as a few rows per task, and the facts are read once.
    """
    keys = ["channel_title", "country"]
    # the last grouping bit is set where video_id is not part of the set
    is_category = F.grouping_id().bitwiseAND(F.lit(1)) == 1
    parts = df.groupingSets(
        [[*keys, "category_id"], [*keys, "video_id"]], *keys, "category_id", "video_id"
    ).agg(
        is_category.alias("is_category"),
        _rows().alias("n"),
        F.sum("views").alias("views"),
        F.count("views").alias("n_views"),
        F.sum("likes").cast("bigint").alias("likes"),
        F.sum("engagement_rate").alias("rate"),
        F.count("engagement_rate").alias("n_rate"),
    )
    c = F.col("is_category")

    def total(name: str) -> Column:
        return F.sum(F.when(c, F.col(name)))

    by_count = F.when(c & counts_as_category, F.struct(-F.col("n"), "category_id"))
    return parts.groupBy(*keys).agg(
        F.count(F.when(~c, F.col("video_id"))).alias("total_videos"),
        total("views").alias("total_views"),
        F.try_divide(total("views"), total("n_views")).alias("avg_views"),
        total("likes").alias("total_likes"),
        F.try_divide(total("rate"), total("n_rate")).alias("avg_engagement_rate"),
        F.min_by("category_id", by_count).alias("top_category"),
    )


def channel_dimension(df: DataFrame) -> DataFrame:
    """A row per channel title over all countries: its videos and its usual category's name.

    Facts carry neither channel ids nor subscribers: the key is a hash of the title, and
    ``subscriber_count`` is NULL. Rows without a title make no channel; NULL categories
    are ignored, and a channel with no other has no type.
    """
    unused = {n: F.lit(None).cast("double") for n in ("views", "likes", "engagement_rate")}
    narrow = df.where(F.col("channel_title").isNotNull()).select("channel_title", "video_id", "category_id")
    known = F.col("category_id").isNotNull()
    by_channel = _channel_single_scan(narrow.withColumns({"country": F.lit(""), **unused}), known)
    return by_channel.select(
        F.md5(F.col("channel_title").cast("binary")).alias("channel_id"),
        "channel_title",
        F.lit(None).cast("bigint").alias("subscriber_count"),
        F.col("total_videos").cast("int").alias("total_videos"),
        category_name("top_category").alias("channel_type"),
    )


#: Videos of a group up to which its distinct count is exact: 2 to this power.
_REACH_BITS = 16


def channel_reach(df: DataFrame) -> DataFrame:
    """Per channel, country and month: rows, and a sketch of the videos seen.

    Sketches of any months and countries can be merged, so distinct counts over them need
    no facts; a sum of monthly distinct counts would count a video in each month.
    """
    return df.groupBy(
        "channel_title",
        F.year("trending_date").alias("year"),
        F.month("trending_date").alias("month"),
        "country",
    ).agg(_rows().alias("n"), F.theta_sketch_agg("video_id", _REACH_BITS).alias("videos"))


def roll_up_reach(reach: DataFrame, *keys: str) -> DataFrame:
    """Rows and distinct videos per ``keys`` from the stored sketches of ``channel_reach``.

    Exact up to 2^16 videos a group, beyond within a relative standard error of 0.4 %.
    """
    merged = F.theta_union_agg("videos", _REACH_BITS)
    return reach.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.theta_sketch_estimate(merged).alias("unique_videos")
    )


# --- category trends ---------------------------------------------------------

def _trend_measures() -> list[Column]:
    return [
        _rows().alias("video_count"),
        F.sum("views").alias("total_views"),
        F.avg("views").alias("avg_views"),
        F.avg("likes").alias("avg_likes"),
        F.avg("engagement_rate").alias("avg_engagement"),
        trending_score(F.col("views"), F.col("engagement_rate")).alias("trending_score"),
    ]


def category_trends(df: DataFrame) -> DataFrame:
    """Per category, year, month and country; rows without a category are left out."""
    return (
        df.filter(F.col("category_id").isNotNull())
        .groupBy(
            "category_id",
            F.year("trending_date").alias("year"),
            F.month("trending_date").alias("month"),
            "country",
        )
        .agg(F.min("category_name").alias("category_name"), *_trend_measures())
    )


def category_trends_named(df: DataFrame) -> DataFrame:
    """Grouped by id and name, NULL categories included."""
    return df.groupBy(
        "category_id",
        "category_name",
        F.year("trending_date").alias("year"),
        F.month("trending_date").alias("month"),
        "country",
    ).agg(*_trend_measures())


# --- time series -------------------------------------------------------------

def time_series_metrics(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("trending_date").isNotNull())
        .groupBy(
            F.col("trending_date").alias("date_key"),
            F.hour("publish_time").alias("hour_of_day"),
            F.dayofweek("trending_date").alias("day_of_week"),
            "country",
        )
        .agg(
            _rows().alias("video_count"),
            F.sum("views").alias("total_views"),
            F.avg("views").alias("avg_views"),
            F.max("views").alias("max_views"),
        )
    )


def time_series_with_peak(df: DataFrame) -> DataFrame:
    """Hourly cells with the day's top video in the country on each of them.

    ``avg_views`` is the mean over the distinct (video, views) pairs of a cell.
    The peak windows run over at most 24 hour rows per day and country.
    """
    pairs = df.groupBy(
        F.col("trending_date").alias("date_key"),
        F.hour("publish_time").alias("hour_of_day"),
        F.dayofweek("trending_date").alias("day_of_week"),
        "country",
        "video_id",
        "views",
    ).agg(_rows().alias("n"))
    cells = pairs.groupBy("date_key", "hour_of_day", "day_of_week", "country").agg(
        F.sum("n").alias("video_count"),
        F.sum(F.col("views") * F.col("n")).alias("total_views"),
        F.avg("views").alias("avg_views"),
        F.min_by("video_id", F.struct(-F.col("views"), "video_id")).alias("cell_peak"),
        F.max("views").alias("cell_max"),
    )
    day = W.partitionBy("date_key", "country")
    by_views = day.orderBy(F.col("cell_max").desc_nulls_last(), F.col("cell_peak").asc())
    return cells.select(
        "date_key",
        "hour_of_day",
        "day_of_week",
        "country",
        "video_count",
        "total_views",
        "avg_views",
        F.first_value("cell_peak").over(by_views).alias("peak_video_id"),
        F.max("cell_max").over(day).alias("peak_video_views"),
    )


def temporal_patterns(df: DataFrame) -> DataFrame:
    """Typical hour: unweighted mean over hour buckets of the mean in each."""
    buckets = df.groupBy(
        F.date_trunc("hour", "publish_time").alias("hour_bucket"),
        F.hour("publish_time").alias("hour_of_day"),
        F.dayofweek("publish_time").alias("day_of_week"),
    ).agg(F.avg("views").alias("avg_views"), F.avg("engagement_rate").alias("avg_engagement"))
    return (
        buckets.groupBy("hour_of_day", "day_of_week")
        .agg(
            F.avg("avg_views").alias("typical_views"),
            F.avg("avg_engagement").alias("typical_engagement"),
        )
        .withColumn("time_segment", time_segment(F.col("hour_of_day")))
    )


# --- category insights -------------------------------------------------------

def category_insights(
    df: DataFrame, dim: DataFrame, *, exact: bool = False
) -> DataFrame:
    """Per category: distinct videos, volumes, spread, quantiles, top virality.

    Facts are aggregated by id first, so the dimension joins a few rows.
    """
    measures = df.groupBy("category_id").agg(
        F.count_distinct("video_id").alias("unique_videos"),
        F.sum("views").alias("total_views"),
        F.avg("engagement_rate").alias("avg_engagement"),
        F.stddev("views").alias("view_stddev"),
        F.max("virality_score").alias("max_virality"),
    )
    probs = {"median_views": 0.5, "p95_views": 0.95}
    if exact:
        spread = exact_quantiles(df, ["category_id"], "views", probs)
    else:
        spread = approx_quantiles(df, ["category_id"], "views", probs)
    return (
        measures.join(broadcast_if_small(dim), "category_id")
        .join(spread, "category_id", "left")
        .select(
            "category_id",
            "category_name",
            "category_group",
            "unique_videos",
            "total_views",
            "avg_engagement",
            "view_stddev",
            "median_views",
            "p95_views",
            "max_virality",
        )
    )


# --- whole-table summaries ---------------------------------------------------

def distinct_values(df: DataFrame, column: str) -> Column:
    """Number of distinct values of a column with few, as a scalar subquery.

    A second COUNT(DISTINCT) in one aggregate would multiply every row; this
    reads one column again and sends a few values per task.
    """
    return df.select(column).dropna().distinct().agg(_rows()).scalar()


def storage_summary(df: DataFrame) -> DataFrame:
    overall = df.agg(
        F.count_distinct("video_id").alias("unique_videos"),
        _rows().alias("total_records"),
        F.min("trending_date").alias("earliest_date"),
        F.max("trending_date").alias("latest_date"),
    )
    return overall.select(
        "unique_videos",
        "total_records",
        distinct_values(df, "country").alias("countries"),
        "earliest_date",
        "latest_date",
    )


def basic_stats(
    df: DataFrame, *, exact: bool = False
) -> DataFrame:
    """One row of counts, range, view statistics and mean ratios."""
    stats = df.agg(
        _rows().alias("total_videos"),
        F.count_distinct("video_id").alias("unique_videos"),
        F.min("trending_date").alias("first_date"),
        F.max("trending_date").alias("last_date"),
        F.sum("views").alias("total_views"),
        F.avg("views").alias("avg_views"),
        F.max("views").alias("max_views"),
        F.avg("engagement_rate").alias("avg_engagement"),
        F.avg("like_ratio").alias("avg_like_ratio"),
    )
    if exact:
        median = exact_quantiles(
            df, [], "views", {"m": 0.5}, interpolate=True
        )
    else:
        median = approx_quantiles(df, [], "views", {"m": 0.5})
    return stats.withColumns(
        {
            "median_views": median.scalar().cast("double"),
            "countries": distinct_values(df, "source_file"),
        }
    )


def country_stats(df: DataFrame, top: int | None = None) -> DataFrame:
    """Means and count by source file, two decimals, half-even."""
    stats = (
        df.filter(F.col("source_file").isNotNull())
        .groupBy("source_file")
        .agg(
            F.bround(F.avg("views"), 2).alias("avg_views"),
            F.bround(F.avg("engagement_rate"), 2).alias("avg_engagement"),
            F.count("video_id").alias("video_count"),
        )
    )
    if top is None:
        return stats
    return stats.orderBy(F.col("avg_views").desc(), "source_file").limit(top)


def monthly_series(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("trending_date").isNotNull())
        .groupBy(F.trunc("trending_date", "MM").alias("month"))
        .agg(_rows().alias("videos"), F.avg("views").alias("avg_views"))
    )


def monthly_summary(monthly: DataFrame) -> DataFrame:
    """Mean rows per month and the peak month; the earliest wins a tie."""
    return monthly.agg(
        F.avg("videos").alias("avg_per_month"),
        F.min_by("month", F.struct(-F.col("videos"), "month")).alias("peak_month"),
        F.max("videos").alias("peak_videos"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(_rows().alias("count"))


def percent_of_total(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their share of all rows, NULLs in the total."""
    total = df.agg(_rows())
    return value_counts(df, column).withColumn(
        "percent", F.col("count") / total.scalar() * 100
    )


def top_values(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    return percent_of_total(df, column).orderBy(F.col("count").desc(), column).limit(n)


def mode_value(df: DataFrame, column: str) -> DataFrame:
    """Most frequent value of a column, the smallest on a tie."""
    return value_counts(df, column).orderBy(F.col("count").desc(), column).limit(1)


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of the columns present, in one pass."""
    present = [c for c in columns if c in df.columns]
    pairs = list(combinations(present, 2))
    one = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = F.array(
        *[
            F.struct(
                F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"{a}|{b}").alias("corr")
            )
            for a, b in pairs
        ]
    )
    return one.select(F.inline(cells))


def strongest_pairs(df: DataFrame, columns: list[str], n: int = 3) -> DataFrame:
    return (
        correlation_matrix(df, columns)
        .orderBy(F.col("corr").desc_nulls_last(), "col_a", "col_b")
        .limit(n)
    )


def text_size(df: DataFrame) -> DataFrame:
    """Length of all values as text: one number, computed where the rows are."""
    return df.agg(F.coalesce(F.sum(row_chars(df)), F.lit(0)).alias("chars"))


def row_chars(df: DataFrame) -> Column:
    """Characters of a row's values as text; NULL has none."""
    parts = [F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in df.columns]
    return reduce(lambda a, b: a + b, parts).cast("bigint")


def size_ratio(initial: DataFrame, final: DataFrame) -> DataFrame:
    """Percent of text saved from ``initial`` to ``final``."""
    return text_size(initial).select(
        F.col("chars").alias("initial_chars"), text_size(final).scalar().alias("final_chars")
    ).withColumn(
        "saved_percent", (1 - F.try_divide(F.col("final_chars"), F.col("initial_chars"))) * 100
    )


def distinct_partitions(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).distinct().agg(_rows().alias("partitions"))


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once: empty when the declared key holds."""
    return df.groupBy(*keys).agg(_rows().alias("count")).filter(F.col("count") > 1)


# --- topic tables built on category months -----------------------------------

def monthly_categories(df: DataFrame) -> DataFrame:
    return df.groupBy(F.trunc("trending_date", "MM").alias("month"), "category_id").agg(
        _rows().alias("video_count"),
        F.sum("views").alias("total_views"),
        F.avg("engagement_rate").alias("avg_engagement"),
    )

