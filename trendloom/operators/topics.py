"""The four analytical topics: viral factors, timing, category and channel trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from trendloom.operators.aggregates import monthly_categories
from trendloom.operators.ordered import approx_quantiles, exact_quantiles, join_null_safe
from trendloom.sources.workspace import materialise

# Title patterns counted as capitals and as punctuation.
CAPITALS = "[A-Z]{2,}"
PUNCTUATION = "[!?]"


def quantile_scalar(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    *,
    exact: bool,
    interpolate: bool = False,
) -> Column:
    """Whole-table quantiles as one struct-valued scalar subquery.

    Rows are compared with it in place; no row travels to a global window.
    """
    if exact:
        q = exact_quantiles(df, [], value, probs, interpolate=interpolate)
    else:
        q = approx_quantiles(df, [], value, probs)
    return q.select(F.struct(*probs).alias("q")).scalar()


def with_tier(
    df: DataFrame,
    value: str,
    name: str,
    tiers: list[tuple[str, float]],
    otherwise: str,
    *,
    exact: bool = False,
) -> DataFrame:
    """Label rows by the first quantile they strictly exceed, highest first."""
    probs = {f"q{i}": p for i, (_, p) in enumerate(tiers)}
    q = quantile_scalar(df, value, probs, exact=exact)
    tiered = df.withColumn("_q", q)
    label = F.when(F.col(value) > F.col("_q.q0"), tiers[0][0])
    for i, (text, _) in enumerate(tiers[1:], 1):
        label = label.when(F.col(value) > F.col(f"_q.q{i}"), text)
    return tiered.withColumn(name, label.otherwise(otherwise)).drop("_q")


def viral_factors(
    df: DataFrame, *, exact: bool = False
) -> DataFrame:
    """Title, tag and engagement profile of viral, popular and other videos."""

    def share(pattern: str) -> Column:
        return F.avg(F.when(F.col("title").rlike(pattern), 1).otherwise(0))

    tiers = [("Viral", 0.95), ("Popular", 0.75)]
    return (
        with_tier(
            df, "views", "viral_category", tiers, "Normal", exact=exact
        )
        .groupBy("viral_category")
        .agg(
            F.avg(F.length("title")).alias("avg_title_length"),
            F.avg(F.size("tags")).alias("avg_tag_count"),
            F.avg("engagement_rate").alias("avg_engagement"),
            share(CAPITALS).alias("has_caps_ratio"),
            share(PUNCTUATION).alias("has_punctuation_ratio"),
            F.count(F.lit(1)).alias("video_count"),
        )
    )


def time_performance(
    df: DataFrame,
    min_samples: int = 30,
    *,
    exact: bool = False,
) -> DataFrame:
    """Per hour, weekday and country, cells with more than ``min_samples`` rows."""
    cells = df.select(
        F.hour("publish_time").alias("hour"),
        F.dayofweek("publish_time").alias("day_of_week"),
        "country",
        "views",
        "engagement_rate",
    )
    keys = ["hour", "day_of_week", "country"]
    measures = [
        F.avg("views").alias("avg_views"),
        F.avg("engagement_rate").alias("avg_engagement"),
        F.count(F.lit(1)).alias("sample_size"),
    ]
    if not exact:
        measures.append(F.percentile_approx("views", 0.75).alias("p75_views"))
    stats = cells.groupBy(*keys).agg(*measures)
    if exact:
        p75 = exact_quantiles(cells, keys, "views", {"p75_views": 0.75})
        stats = join_null_safe(stats, p75, keys, "left")
    return stats.filter(F.col("sample_size") > min_samples)


def optimal_timing(df: DataFrame, min_samples: int = 30) -> DataFrame:
    """Hours and weekdays ranked by the unweighted mean over countries.

    The ranks run over at most 24 x 7 aggregated rows.
    """
    slots = (
        time_performance(df, min_samples)
        .groupBy("hour", "day_of_week")
        .agg(
            F.avg("avg_views").alias("global_avg_views"),
            F.avg("avg_engagement").alias("global_avg_engagement"),
        )
    )
    by_views = W.orderBy(F.col("global_avg_views").desc())
    by_engagement = W.orderBy(F.col("global_avg_engagement").desc())
    return slots.withColumns(
        {
            "view_rank": F.rank().over(by_views),
            "engagement_rank": F.rank().over(by_engagement),
        }
    )


def category_evolution(df: DataFrame) -> DataFrame:
    """Monthly category volumes, growth on the month before, rank in the month.

    Months without growth are dropped before ranking.
    """
    history = W.partitionBy("category_id").orderBy("month")
    in_month = W.partitionBy("month").orderBy(F.col("total_views").desc())
    previous = F.col("prev_month_views")
    return (
        monthly_categories(df)
        .withColumn("prev_month_views", F.lag("total_views").over(history))
        .withColumn(
            "growth_rate", F.try_divide(F.col("total_views") - previous, previous) * 100
        )
        .filter(F.col("growth_rate").isNotNull())
        .select(
            "month",
            "category_id",
            "video_count",
            "total_views",
            "growth_rate",
            F.rank().over(in_month).alias("monthly_rank"),
        )
    )


def channel_profiles(df: DataFrame, min_videos: int = 5) -> DataFrame:
    mean = F.avg("views")
    return (
        df.groupBy("channel_title")
        .agg(
            F.count_distinct("video_id").alias("video_count"),
            F.count_distinct("category_id").alias("category_diversity"),
            mean.alias("avg_views"),
            F.try_divide(F.stddev("views"), mean).alias("view_consistency"),
            F.avg(F.length("title")).alias("avg_title_length"),
            F.avg("engagement_rate").alias("avg_engagement"),
            F.try_divide(F.max("views"), mean).alias("peak_ratio"),
        )
        .filter(F.col("video_count") >= min_videos)
    )


def channel_strategies(
    df: DataFrame,
    min_videos: int = 5,
    *,
    exact: bool = False,
) -> DataFrame:
    """Profiles averaged over channel tiers; tiers compare mean views."""
    # read by the tier limits and by the tiers: one pass over the facts
    profiles = materialise(channel_profiles(df, min_videos), "profiles")
    tiers = [("Top Performer", 0.9), ("Average", 0.5)]
    return (
        with_tier(
            profiles,
            "avg_views",
            "performance_tier",
            tiers,
            "Below Average",
            exact=exact,
        )
        .groupBy("performance_tier")
        .agg(
            F.avg("category_diversity").alias("avg_category_diversity"),
            F.avg("view_consistency").alias("avg_consistency"),
            F.avg("avg_title_length").alias("avg_title_length"),
            F.avg("peak_ratio").alias("avg_peak_ratio"),
            F.count(F.lit(1)).alias("channel_count"),
        )
    )
