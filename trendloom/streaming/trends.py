"""Sliding-window trends; the same function serves batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_trends(
    df: DataFrame,
    ts: str = "processing_time",
    key: str = "video_id",
    *,
    width: str = "5 minutes",
    slide: str = "1 minute",
    watermark: str = "10 minutes",
    views: str = "views_delta",
    likes: str = "likes_delta",
) -> DataFrame:
    """Views, mean likes and updates per key and sliding window."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp"))
    if df.isStreaming:
        timed = timed.withWatermark(ts, watermark)
    return (
        timed.groupBy(F.window(ts, width, slide), key)
        .agg(
            F.sum(views).alias("views_5min"),
            F.avg(likes).alias("avg_likes_5min"),
            F.count(F.lit(1)).alias("update_count"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            key,
            "views_5min",
            "avg_likes_5min",
            "update_count",
        )
    )
