"""Column-level building blocks; every function returns a ``Column``."""

from trendloom.functions.metrics import (
    bytes_to_gb,
    bytes_to_mb,
    engagement_rate,
    growth_pct,
    like_ratio,
    time_segment,
    trending_score,
    virality_score,
)
from trendloom.functions.parsing import (
    category_name,
    coerce_long,
    coerce_timestamp,
    country_from_file,
    iso_duration_seconds,
    split_tags,
    whole_number,
)

__all__ = [
    "bytes_to_gb",
    "bytes_to_mb",
    "category_name",
    "coerce_long",
    "coerce_timestamp",
    "country_from_file",
    "engagement_rate",
    "growth_pct",
    "iso_duration_seconds",
    "like_ratio",
    "split_tags",
    "time_segment",
    "trending_score",
    "virality_score",
    "whole_number",
]
