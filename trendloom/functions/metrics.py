"""Derived measures.

Engagement and like ratio exist in three variants, because callers disagree on
how an empty denominator counts:

* ``safe``      0 when the denominator is missing or not positive
* ``unguarded`` plain ratio, NULL on a zero denominator
* ``cleaner``   the denominator's zeros become 1, missing results become 0
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MB = 1024 * 1024
GB = 1024 * MB


def engagement_rate(
    variant: str = "safe",
    views: str = "views",
    likes: str = "likes",
    comments: str = "comment_count",
) -> Column:
    v, lk, cm = F.col(views), F.col(likes), F.col(comments)
    if variant == "safe":
        interactions = F.coalesce(lk, F.lit(0)) + F.coalesce(cm, F.lit(0))
        return F.when(v > 0, interactions / v).otherwise(0.0)
    if variant == "unguarded":
        return F.try_divide(lk + cm, v)
    if variant == "cleaner":
        return F.coalesce(lk / F.when(v == 0, 1).otherwise(v), F.lit(0.0))
    raise ValueError(f"unknown engagement variant {variant!r}")


def like_ratio(
    variant: str = "safe", likes: str = "likes", dislikes: str | None = "dislikes"
) -> Column:
    """``dislikes=None`` stands for a source without that column."""
    lk = F.col(likes)
    total = lk + (F.lit(0) if dislikes is None else F.col(dislikes))
    if variant == "safe":
        return F.when(total > 0, lk / total).otherwise(0.0)
    if variant == "unguarded":
        return F.try_divide(lk, total)
    if variant == "cleaner":
        return F.coalesce(lk / F.when(total == 0, 1).otherwise(total), F.lit(0.0))
    raise ValueError(f"unknown like-ratio variant {variant!r}")


def virality_score(views: str = "views", rate: str = "engagement_rate") -> Column:
    """log10(views) * engagement * 100; NULL where views has no logarithm."""
    return F.log10(F.col(views)) * F.col(rate) * 100


def growth_pct(current: Column, previous: Column) -> Column:
    """Percent change; 0 without a previous value, NULL when it was 0."""
    return F.when(
        previous.isNotNull(), F.try_divide(current - previous, previous) * 100
    ).otherwise(0.0)


def trending_score(views: Column, engagement: Column) -> Column:
    """An aggregate expression: mean views weighted by mean engagement.

    Rates are summed as decimals, so that the score does not depend on the order of rows.
    """
    rates = F.sum(engagement.try_cast("decimal(27,12)")).cast("double")
    mean = F.try_divide(rates, F.count(engagement))
    return F.sum(views) / F.count(F.lit(1)) * mean * 1000


def time_segment(hour: Column) -> Column:
    return (
        F.when(hour.between(18, 23), "Prime Time")
        .when(hour.between(12, 17), "Afternoon")
        .when(hour.between(6, 11), "Morning")
        .otherwise("Late Night")
    )


def bytes_to_mb(size: Column) -> Column:
    return size / MB


def bytes_to_gb(size: Column) -> Column:
    return size / GB
