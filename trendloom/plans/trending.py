"""Trending analysis: rank, momentum and growth of each observation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from trendloom.functions import growth_pct
from trendloom.operators.ordered import (
    HOT_ROWS,
    hot_keys,
    join_null_safe,
    ordered_windows,
    top_ranks,
    with_percent_rank,
    with_rank,
)
from trendloom.sources.workspace import materialise

DAY_GROUP = ["country", "trending_date"]
# later columns only decide between observations of one day
CHANNEL_ORDER = ["trending_date", "video_id", "country", "category_id", "views"]
VIDEO_ORDER = ["trending_date", "country", "channel_title", "category_id", "views"]


def trending_analysis(
    df: DataFrame, top: int = 100, *, most_rows: int | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Window measures over all observations, then the day's top ranks.

    One histogram tells which channels, videos, days and categories are hot. Where no day
    is, Spark trims each partition to the top ranks before the shuffle; else the ranks
    come from the value counts of the days. Category percentiles need only value counts.
    Where anything is hot, the facts are read several times and are stored first.
    ``most_rows`` is a known limit of the number of observations, see ``hot_keys``.
    """
    facts = df.select(
        "video_id", "title", "channel_title", "category_id", "views", "trending_date", "country"
    )
    hot = hot_keys(
        facts, [["channel_title"], ["video_id"], DAY_GROUP, ["category_id"]], hot_rows, most_rows
    )
    if any(found is not None for found in hot.values()):
        # else every slicing and ranking would join the sources again, with broadcasts of its own
        facts = materialise(facts, "facts")
    by_channel = ordered_windows(
        facts,
        ["channel_title"],
        CHANNEL_ORDER,
        "views",
        moving=("channel_7day_avg", 7),
        running="cumulative_channel_views",
        hot=hot,
    )
    by_video = ordered_windows(
        by_channel, ["video_id"], VIDEO_ORDER, "views", previous="prev_day_views", of=facts, hot=hot
    )
    if hot[tuple(DAY_GROUP)] is None:
        by_views = W.partitionBy(*DAY_GROUP).orderBy(F.col("views").desc())
        ranked = by_video.withColumn("daily_rank", F.rank().over(by_views).cast("bigint"))
        kept = ranked.where(F.col("daily_rank") <= top)
    else:
        ranks = top_ranks(facts, DAY_GROUP, "views", "daily_rank", top)
        kept = join_null_safe(by_video, ranks, [*DAY_GROUP, "views"])
    placed = with_percent_rank(
        kept, ["category_id"], "views", "category_percentile", of=facts, hot=hot
    )
    return placed.withColumn("growth_rate", growth_pct(F.col("views"), F.col("prev_day_views")))


def trending_top(df: DataFrame, top: int = 100) -> DataFrame:
    """Only the daily rank cut: Spark trims each partition before the shuffle."""
    return with_rank(df, DAY_GROUP, "views", "daily_rank", limit=top)
