"""Table contracts and fixed lookup values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The platform's category ids and display names.
CATEGORY_NAMES = {
    1: "Film & Animation",
    2: "Autos & Vehicles",
    10: "Music",
    15: "Pets & Animals",
    17: "Sports",
    19: "Travel & Events",
    20: "Gaming",
    22: "People & Blogs",
    23: "Comedy",
    24: "Entertainment",
    25: "News & Politics",
    26: "Howto & Style",
    27: "Education",
    28: "Science & Technology",
}


_STRING, _INT, _LONG, _DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_BOOL, _DATE, _TIME = T.BooleanType(), T.DateType(), T.TimestampType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


RAW_TRENDING = _struct(
    video_id=_STRING,
    trending_date=_DATE,
    title=_STRING,
    channel_title=_STRING,
    category_id=_INT,
    publish_time=_TIME,
    tags=_STRING,
    views=_LONG,
    likes=_INT,
    dislikes=_INT,
    comment_count=_INT,
    thumbnail_link=_STRING,
    comments_disabled=_BOOL,
    ratings_disabled=_BOOL,
    video_error_or_removed=_BOOL,
    description=_STRING,
    country=_STRING,
)

FACT_VIDEOS = _struct(
    video_id=_STRING,
    title=_STRING,
    channel_title=_STRING,
    category_id=_INT,
    publish_time=_TIME,
    tags=T.ArrayType(_STRING),
    views=_LONG,
    likes=_INT,
    dislikes=_INT,
    comment_count=_INT,
    engagement_rate=_DOUBLE,
    like_ratio=_DOUBLE,
    virality_score=_DOUBLE,
    description=_STRING,
    trending_date=_DATE,
    country=_STRING,
)
FACT_PARTITIONS = ["trending_date", "country"]

DIM_CHANNELS = _struct(
    channel_id=_STRING,
    channel_title=_STRING,
    subscriber_count=_LONG,
    total_videos=_INT,
    channel_type=_STRING,
)
DIM_CATEGORIES = _struct(category_id=_INT, category_name=_STRING, category_group=_STRING)

CHANNEL_STATISTICS = _struct(
    channel_title=_STRING,
    total_videos=_LONG,
    total_views=_LONG,
    avg_views=_DOUBLE,
    total_likes=_LONG,
    avg_engagement_rate=_DOUBLE,
    top_category=_INT,
    country=_STRING,
)
CATEGORY_TRENDS = _struct(
    category_id=_INT,
    category_name=_STRING,
    video_count=_LONG,
    total_views=_LONG,
    avg_views=_DOUBLE,
    avg_likes=_DOUBLE,
    avg_engagement=_DOUBLE,
    trending_score=_DOUBLE,
    year=_INT,
    month=_INT,
    country=_STRING,
)
TIME_SERIES_METRICS = _struct(
    date_key=_DATE,
    hour_of_day=_INT,
    day_of_week=_INT,
    video_count=_LONG,
    total_views=_LONG,
    avg_views=_DOUBLE,
    max_views=_LONG,
    country=_STRING,
)

STREAM_DELTAS = _struct(
    video_id=_STRING,
    timestamp=_TIME,
    views_delta=_LONG,
    likes_delta=_INT,
    comments_delta=_INT,
    processing_time=_TIME,
)

#: A stream's batches are partitions of the table, so that one can be written again.
STREAM_PARTITIONS = ["stream", "epoch"]
STREAMING_VIDEOS = T.StructType([*STREAM_DELTAS, T.StructField("stream", _STRING), T.StructField("epoch", _LONG)])

API_ITEM = _struct(
    id=_STRING,
    statistics=_struct(viewCount=_STRING, likeCount=_STRING, commentCount=_STRING),
    contentDetails=_struct(duration=_STRING),
    snippet=_struct(
        title=_STRING, categoryId=_STRING, publishedAt=_STRING, channelId=_STRING
    ),
)


def category_dimension(spark: SparkSession) -> DataFrame:
    """The built-in category dimension, one row per known id."""
    rows = [(i, name, None) for i, name in CATEGORY_NAMES.items()]
    return spark.createDataFrame(rows, DIM_CATEGORIES)
