"""The registered queries: name -> function of (spark, folder of parquet tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.functions import (
    bytes_to_gb,
    bytes_to_mb,
    category_name,
    coerce_long,
    coerce_timestamp,
    country_from_file,
    engagement_rate,
    iso_duration_seconds,
    like_ratio,
    split_tags,
    time_segment,
    virality_score,
)
from trendloom.operators import aggregates as agg
from trendloom.operators import cleaning, reshape, topics
from trendloom.operators.joins import join_dimension, keep_matching
from trendloom.operators.ordered import hot_keys, ordered_windows, with_percent_rank, with_rank
from trendloom.plans import load, summary, trending
from trendloom.schemas import FACT_PARTITIONS, RAW_TRENDING, STREAM_PARTITIONS
from trendloom.sources import files, sinks
from trendloom.sources import starschema as star
from trendloom.sources.workspace import materialise, new_path
from trendloom.streaming import ingest
from trendloom.streaming.trends import windowed_trends

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _register(fn: Query) -> Query:
    _QUERIES[fn.__name__] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def portable(df: DataFrame) -> DataFrame:
    """Types any SQL engine shares: 64-bit integers, plain timestamps."""
    casts = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            casts[f.name] = F.col(f.name).cast("bigint")
        elif isinstance(f.dataType, T.TimestampType):
            casts[f.name] = F.col(f.name).cast("timestamp_ntz")
    return df.withColumns(casts) if casts else df


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Sums of fractions depend on their order in the last bits."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- derived columns ---------------------------------------------------------

_GAP_KEYS = ["video_id", "trending_date", "category_id", "views", "likes"]


def _measure(spark, sf_dir, **columns) -> DataFrame:
    facts = star.facts_with_gaps(spark, sf_dir)
    return facts.select(*_GAP_KEYS, *[c.alias(n) for n, c in columns.items()])


@_register
def engagement_rate_safe(spark, sf_dir):
    return _measure(spark, sf_dir, engagement=engagement_rate("safe"))


@_register
def engagement_rate_unguarded(spark, sf_dir):
    return _measure(spark, sf_dir, engagement=engagement_rate("unguarded"))


@_register
def engagement_rate_cleaner(spark, sf_dir):
    return _measure(spark, sf_dir, engagement=engagement_rate("cleaner"))


@_register
def like_ratio_safe(spark, sf_dir):
    return _measure(spark, sf_dir, ratio=like_ratio("safe"))


@_register
def like_ratio_unguarded(spark, sf_dir):
    return _measure(spark, sf_dir, ratio=like_ratio("unguarded"))


@_register
def like_ratio_cleaner(spark, sf_dir):
    return _measure(
        spark,
        sf_dir,
        ratio=like_ratio("cleaner"),
        ratio_without_dislikes=like_ratio("cleaner", dislikes=None),
    )


@_register
def virality(spark, sf_dir):
    return rounded(_measure(spark, sf_dir, score=virality_score()), "score")


@_register
def tags_split_size(spark, sf_dir):
    piped = F.replace("title", F.lit(" "), F.lit("|"))
    tags = star.facts_daily(spark, sf_dir).select("video_id", split_tags(piped).alias("tags"))
    return tags.select(
        "video_id", F.size("tags").alias("tag_count"), F.array_join("tags", ",").alias("tags")
    )


def _countries(spark, sf_dir, variant) -> DataFrame:
    return star.facts_daily(spark, sf_dir).select(
        "video_id", "source_file", country_from_file(variant).alias("country_code")
    )


@_register
def country_loose(spark, sf_dir):
    return _countries(spark, sf_dir, "loose")


@_register
def country_strict(spark, sf_dir):
    return _countries(spark, sf_dir, "strict")


@_register
def country_default(spark, sf_dir):
    return _countries(spark, sf_dir, "default")


@_register
def coerce_types(spark, sf_dir):
    raw = star.raw_daily(spark, sf_dir)
    return cleaning.narrow_types(raw).select(
        "video_id", "views", "likes", "dislikes", "comment_count", "trending_date", "publish_time"
    )


@_register
def coerce_numeric(spark, sf_dir):
    return star.raw_daily(spark, sf_dir).select(
        "video_id", *[coerce_long(c).alias(c) for c in ("views", "likes", "dislikes")]
    )


@_register
def coerce_dates(spark, sf_dir):
    return star.raw_daily(spark, sf_dir).select(
        "video_id",
        coerce_timestamp("trending_date", "yyyy-MM-dd").alias("trending_at"),
        coerce_timestamp("publish_time").alias("published_at"),
    )


@_register
def iso_duration(spark, sf_dir):
    return star.raw_daily(spark, sf_dir).select(
        "video_id", "duration", iso_duration_seconds("duration").alias("seconds")
    )


@_register
def category_name_map(spark, sf_dir):
    return star.facts_hourly(spark, sf_dir).select(
        "video_id", "category_id", category_name().alias("name")
    )


@_register
def category_name_unknown(spark, sf_dir):
    return star.facts_hourly(spark, sf_dir).select(
        "video_id", "category_id", category_name(unknown="Unknown").alias("name")
    )


@_register
def hour_segment(spark, sf_dir):
    hour = F.hour("publish_time")
    return star.facts_hourly(spark, sf_dir).select(
        "video_id", hour.alias("hour"), time_segment(hour).alias("segment")
    )


@_register
def percent_of_total(spark, sf_dir):
    return agg.percent_of_total(star.facts_daily(spark, sf_dir), "title")


@_register
def value_counts_top5(spark, sf_dir):
    return agg.top_values(star.facts_daily(spark, sf_dir), "title", 5)


@_register
def mode_global(spark, sf_dir):
    return agg.mode_value(star.facts_daily(spark, sf_dir), "title")


# --- filters and joins -------------------------------------------------------

@_register
def drop_null_title(spark, sf_dir):
    return cleaning.drop_missing(star.raw_daily(spark, sf_dir)).select(
        "video_id", "title", "l_orderkey"
    )


@_register
def iqr_filter(spark, sf_dir):
    facts = star.facts_hourly(spark, sf_dir).select("video_id", "views")
    return cleaning.iqr_filter(
        facts, "views", 1.5, exact=True
    )


@_register
def category_join_broadcast(spark, sf_dir):
    dim = star.category_dimension_from_nations(spark, sf_dir).select(
        F.col("category_name").alias("country"), "category_group"
    )
    return (
        join_dimension(star.facts_daily(spark, sf_dir), dim, "country")
        .groupBy("category_group")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("views").alias("total_views"))
    )


@_register
def category_insights(spark, sf_dir):
    out = agg.category_insights(
        star.facts_daily(spark, sf_dir),
        star.category_dimension_from_nations(spark, sf_dir),
        exact=True,
    )
    return rounded(rounded(out, "avg_engagement", "max_virality"), "view_stddev", digits=3)


@_register
def top5_category_semi_join(spark, sf_dir):
    facts = star.facts_daily(spark, sf_dir)
    top = reshape.top_sums(facts, "category_id", "views", 5)
    return keep_matching(facts, top, "category_id").select(
        "video_id", "category_id", "trending_date", "views"
    )


# --- aggregate tables --------------------------------------------------------

@_register
def channel_statistics(spark, sf_dir):
    return rounded(
        agg.channel_statistics(star.facts_daily(spark, sf_dir)), "avg_engagement_rate"
    )


@_register
def channel_statistics_joined(spark, sf_dir):
    return rounded(
        agg.channel_statistics_joined(star.facts_daily(spark, sf_dir)), "avg_engagement_rate"
    )


@_register
def channel_statistics_mode(spark, sf_dir):
    return rounded(
        agg.channel_statistics_mode(star.facts_daily(spark, sf_dir)), "avg_engagement_rate"
    )


def _named_daily(spark, sf_dir) -> DataFrame:
    return star.facts_daily(spark, sf_dir).withColumn("category_name", category_name())


@_register
def category_trends(spark, sf_dir):
    out = agg.category_trends(_named_daily(spark, sf_dir))
    return rounded(rounded(out, "avg_engagement"), "trending_score", digits=4)


@_register
def category_trends_named(spark, sf_dir):
    out = agg.category_trends_named(_named_daily(spark, sf_dir))
    return rounded(rounded(out, "avg_engagement"), "trending_score", digits=4)


@_register
def time_series_metrics(spark, sf_dir):
    return agg.time_series_metrics(star.facts_hourly(spark, sf_dir))


@_register
def time_series_peak(spark, sf_dir):
    return agg.time_series_with_peak(star.facts_hourly(spark, sf_dir))


@_register
def temporal_patterns(spark, sf_dir):
    return rounded(
        agg.temporal_patterns(star.facts_hourly(spark, sf_dir)),
        "typical_views",
        "typical_engagement",
    )


@_register
def storage_summary(spark, sf_dir):
    return agg.storage_summary(star.facts_daily(spark, sf_dir))


@_register
def basic_stats(spark, sf_dir):
    out = agg.basic_stats(
        star.facts_daily(spark, sf_dir), exact=True
    )
    return rounded(out, "avg_engagement", "avg_like_ratio")


@_register
def country_stats(spark, sf_dir):
    return agg.country_stats(star.facts_daily(spark, sf_dir))


@_register
def country_stats_top5(spark, sf_dir):
    return agg.country_stats(star.facts_daily(spark, sf_dir), top=5)


@_register
def monthly_series(spark, sf_dir):
    return agg.monthly_series(star.facts_daily(spark, sf_dir))


@_register
def monthly_summary(spark, sf_dir):
    return agg.monthly_summary(agg.monthly_series(star.facts_daily(spark, sf_dir)))


@_register
def correlation_matrix(spark, sf_dir):
    out = agg.correlation_matrix(star.facts_daily(spark, sf_dir), summary.CORRELATED)
    return rounded(out, "corr")


@_register
def correlation_pairs(spark, sf_dir):
    out = agg.strongest_pairs(star.facts_daily(spark, sf_dir), summary.CORRELATED)
    return rounded(out, "corr")


# --- windows -----------------------------------------------------------------

#: So few that skewed keys are hot in the smallest tables too.
_HOT_HERE = 1500


def _order_lines(spark, sf_dir) -> int:
    """The daily facts are the order lines; files know how many they have."""
    return star.table(spark, sf_dir, "lineitem").count()


def _skewed_daily(spark, sf_dir) -> DataFrame:
    hot = F.col("views") % 3 == 0
    one = {
        "channel_title": "hot channel", "video_id": "hot video", "title": "hot title",
        "category_id": 1, "country": "HOT",
    }
    moved = {c: F.when(hot, F.lit(v)).otherwise(F.col(c)) for c, v in one.items()}
    day = F.when(F.col("views") % 6 == 0, F.lit("1996-01-01").cast("date"))
    moved["trending_date"] = F.coalesce(day, F.col("trending_date"))
    return star.facts_daily(spark, sf_dir).withColumns(moved)

@_register
def trending_analysis(spark, sf_dir):
    return trending.trending_analysis(
        star.facts_daily(spark, sf_dir), top=5, most_rows=_order_lines(spark, sf_dir)
    )


@_register
def trending_analysis_skewed(spark, sf_dir):
    """A third of all rows have one channel, video, category and country, half of these one
    day: they are hot, the others are not."""
    return trending.trending_analysis(_skewed_daily(spark, sf_dir), top=5, hot_rows=_HOT_HERE)


@_register
def trending_top_n(spark, sf_dir):
    facts = star.facts_daily(spark, sf_dir)
    return trending.trending_top(facts, top=3).select(
        "country", "trending_date", "video_id", "views", "daily_rank"
    )


@_register
def window_daily_rank(spark, sf_dir):
    facts = star.facts_daily(spark, sf_dir).select("country", "trending_date", "views")
    return with_rank(
        facts, trending.DAY_GROUP, "views", "daily_rank"
    )


@_register
def window_percent_rank(spark, sf_dir):
    facts = star.facts_daily(spark, sf_dir).select("category_id", "video_id", "views")
    hot = hot_keys(facts, [["category_id"]], most_rows=_order_lines(spark, sf_dir))
    return with_percent_rank(facts, ["category_id"], "views", "percentile", hot=hot)


@_register
def window_channel_momentum(spark, sf_dir):
    facts = star.facts_daily(spark, sf_dir).select(
        "channel_title", *trending.CHANNEL_ORDER
    )
    return ordered_windows(
        facts,
        ["channel_title"],
        trending.CHANNEL_ORDER,
        "views",
        moving=("channel_7day_avg", 7),
        running="cumulative_channel_views",
        hot=hot_keys(facts, [["channel_title"]], most_rows=_order_lines(spark, sf_dir)),
    )


@_register
def window_previous_views(spark, sf_dir):
    facts = star.facts_daily(spark, sf_dir).select("video_id", *trending.VIDEO_ORDER)
    return ordered_windows(
        facts,
        ["video_id"],
        trending.VIDEO_ORDER,
        "views",
        previous="prev_day_views",
        hot=hot_keys(facts, [["video_id"]], most_rows=_order_lines(spark, sf_dir)),
    )


@_register
def window_one_channel(spark, sf_dir):
    """Every row under one key: the group is far larger than any task's share."""
    facts = star.facts_daily(spark, sf_dir).select(*trending.CHANNEL_ORDER)
    return ordered_windows(
        facts.withColumn("channel_title", F.lit("all")),
        ["channel_title"],
        trending.CHANNEL_ORDER,
        "views",
        previous="prev_views",
        moving=("moving_avg", 7),
        running="running_views",
        position="pos",
        hot_rows=_HOT_HERE,
    )


# --- topics ------------------------------------------------------------------

_VIRAL = ["avg_title_length", "avg_tag_count", "avg_engagement"]


def _viral(spark, sf_dir) -> DataFrame:
    return topics.viral_factors(
        star.facts_daily(spark, sf_dir), exact=True
    )


@_register
def topic_viral_factors(spark, sf_dir):
    return rounded(_viral(spark, sf_dir), *_VIRAL)


@_register
def topic_viral_factors_text(spark, sf_dir):
    out = topics.viral_factors(
        star.facts_text(spark, sf_dir),
        exact=True,
    )
    return rounded(out, *_VIRAL)


@_register
def topic_time_performance(spark, sf_dir):
    out = topics.time_performance(
        star.facts_hourly(spark, sf_dir), 5, exact=True
    )
    return rounded(out, "avg_engagement")


def _timing(spark, sf_dir) -> DataFrame:
    return rounded(
        topics.optimal_timing(star.facts_hourly(spark, sf_dir), 2),
        "global_avg_views",
        "global_avg_engagement",
    )


@_register
def topic_optimal_timing(spark, sf_dir):
    return _timing(spark, sf_dir)


@_register
def topic_category_evolution(spark, sf_dir):
    return topics.category_evolution(star.facts_daily(spark, sf_dir))


def _strategies(spark, sf_dir) -> DataFrame:
    return rounded(
        topics.channel_strategies(
            star.facts_daily(spark, sf_dir), exact=True
        ),
        "avg_category_diversity",
        "avg_consistency",
        "avg_title_length",
        "avg_peak_ratio",
    )


@_register
def topic_channel_strategies(spark, sf_dir):
    return _strategies(spark, sf_dir)


# --- rows and shapes ---------------------------------------------------------

@_register
def dedupe_first(spark, sf_dir):
    facts = star.facts_daily(spark, sf_dir).select(
        "video_id", "trending_date", "country", "category_id", "views", "likes"
    )
    return reshape.dedupe_first(facts, ["video_id"], star.OBSERVATION_ORDER)


@_register
def union_by_name(spark, sf_dir):
    daily = star.facts_daily(spark, sf_dir).select("video_id", "views", "dislikes")
    hourly = star.facts_hourly(spark, sf_dir).select("views", "video_id", "event_type")
    return reshape.union_by_name([daily, hourly])


@_register
def distinct_partitions(spark, sf_dir):
    return agg.distinct_partitions(star.facts_daily(spark, sf_dir), FACT_PARTITIONS)


@_register
def key_uniqueness(spark, sf_dir):
    return agg.repeated_keys(star.facts_daily(spark, sf_dir), ["video_id", "trending_date"])


@_register
def distinct_ids_limit(spark, sf_dir):
    return reshape.first_distinct_ids(star.facts_daily(spark, sf_dir), "video_id", 100)


@_register
def head_n(spark, sf_dir):
    facts = star.facts_hourly(spark, sf_dir).select("video_id", "views", "country")
    return reshape.head(facts, 25, [F.col("views").desc(), "video_id"])


@_register
def id_batches(spark, sf_dir):
    batches = reshape.id_batches(
        star.facts_daily(spark, sf_dir), "video_id", 50
    )
    return batches.select(
        "batch", F.size("ids").alias("size"), F.array_join("ids", ",").alias("ids")
    )


@_register
def top5_sums(spark, sf_dir):
    return reshape.top_sums(star.facts_daily(spark, sf_dir), "title", "views", 5)


@_register
def manifest_filter_top(spark, sf_dir):
    manifest = star.manifest_from_pages(spark, sf_dir)
    return reshape.most_downloaded(reshape.usable_files(manifest), 5)


@_register
def radar_frame(spark, sf_dir):
    return rounded(
        reshape.radar_frame(_viral(spark, sf_dir)), "title_length", "tag_count", "engagement"
    )


@_register
def heatmap_pivot(spark, sf_dir):
    return reshape.heatmap_frame(_timing(spark, sf_dir))


@_register
def evolution_frame(spark, sf_dir):
    return reshape.evolution_frame(topics.category_evolution(star.facts_daily(spark, sf_dir)))


@_register
def strategy_unpivot(spark, sf_dir):
    return reshape.strategy_frame(_strategies(spark, sf_dir))


# --- cleaning ----------------------------------------------------------------

_RAW_ORDER = (
    "source_file",
    "l_orderkey",
    "category_id",
    "channel_title",
    "views",
    "likes",
    "dislikes",
    "comment_count",
    "duration",
)


def _clean(spark, sf_dir):
    cfg = cleaning.CleanConfig(
        order=_RAW_ORDER, outlier_k=0.5, exact=True
    )
    return cleaning.clean(star.raw_daily(spark, sf_dir), cfg)


@_register
def clean_facts(spark, sf_dir):
    return _clean(spark, sf_dir)[0].select(
        "video_id",
        "title",
        "trending_date",
        "publish_time",
        "views",
        "likes",
        "dislikes",
        "comment_count",
        "duration_sec",
        "engagement_rate",
        "like_ratio",
        "category_id",
        "category_name",
        "source_file",
    )


@_register
def cleaning_report(spark, sf_dir):
    return _clean(spark, sf_dir)[1]


# --- streaming ---------------------------------------------------------------

def _event_stream(spark, sf_dir) -> DataFrame:
    schema = star.table(spark, sf_dir, "events").schema
    # a glob may name one file or a folder of files; a plain path only a folder
    return ingest.landed_source(spark, f"{sf_dir}/events.parque[t]", schema)


@_register
def window_trends_batch(spark, sf_dir):
    return windowed_trends(star.deltas_from_events(star.table(spark, sf_dir, "events")))


@_register
def window_trends_stream(spark, sf_dir):
    """Every window, closed or open, in its last state."""
    return _streamed_trends(spark, _event_stream(spark, sf_dir))


_WINDOW_KEYS = ["window_start", "window_end", "video_id"]


def _streamed_trends(spark, events, mode="update") -> DataFrame:
    trends = windowed_trends(star.deltas_from_events(events))
    out, checkpoint = new_path(spark, "trends"), new_path(spark, "trends-checkpoint")
    ingest.update_files(trends, out, checkpoint, mode=mode, available_now=True).awaitTermination()
    return ingest.latest_state(spark, out, trends.schema, _WINDOW_KEYS)


@_register
def window_trends_complete(spark, sf_dir):
    """The same in complete mode: every batch writes the whole result."""
    return _streamed_trends(spark, _event_stream(spark, sf_dir), "complete")


def _late_landings(spark, sf_dir) -> tuple[DataFrame, int]:
    """Events land in two halves; then the first hour's come again and are too late."""
    events = star.table(spark, sf_dir, "events")
    half, hour = events.agg(
        F.min("ts") + (F.max("ts") - F.min("ts")) / 2, F.min("ts") + F.expr("INTERVAL 1 HOUR")
    ).first()
    path, out = new_path(spark, "landing"), new_path(spark, "trends")
    checkpoint, late = new_path(spark, "trends-checkpoint"), 0
    # one run for each landing, on the same checkpoint, so that the runs keep the order
    for i, landing in enumerate((F.col("ts") <= half, F.col("ts") > half, F.col("ts") <= hour)):
        events.where(landing).write.parquet(f"{path}/{i}")
        stream = ingest.landed_source(spark, f"{path}/*", events.schema)
        trends = windowed_trends(star.deltas_from_events(stream))
        with ingest.state_on_disk(spark):
            query = ingest.update_files(trends, out, checkpoint, available_now=True)
            query.awaitTermination()
        late += ingest.late_groups(query)
    return ingest.latest_state(spark, out, trends.schema, _WINDOW_KEYS), late


@_register
def window_trends_late(spark, sf_dir):
    return _late_landings(spark, sf_dir)[0]


@_register
def window_trends_late_report(spark, sf_dir):
    """How many windows there are, and how many states of closed ones were dropped."""
    trends, late = _late_landings(spark, sf_dir)
    return trends.agg(F.count(F.lit(1)).alias("windows")).withColumn(
        "late_windows", F.lit(late).cast("bigint")
    )


@_register
def stream_to_catalog(spark, sf_dir):
    """Deltas land in three files, go to the stream table, and a batch is written again."""
    name = f"{_new_database(spark)}.streaming_videos"
    sinks.create_tables(spark, name.split(".")[0])
    events = star.table(spark, sf_dir, "events")
    path, checkpoint = new_path(spark, "landing"), new_path(spark, "deltas-checkpoint")
    events.repartition(3, "event_id").write.parquet(path)
    source = ingest.landed_source(spark, path, events.schema, files_per_trigger=1)
    deltas = ingest.to_contract(star.deltas_from_events(source))
    for _ in range(2):  # the second run finds nothing new
        query = ingest.append_to_table(deltas, name, checkpoint, name="events", available_now=True)
        query.awaitTermination()
    again = spark.table(name).where("stream = 'events' AND epoch = 1").drop(*STREAM_PARTITIONS)
    ingest.insert_epoch(materialise(again), name, "events", 1)
    return spark.table(name).select("video_id", "views_delta", "likes_delta", "processing_time", "stream")


@_register
def stream_ingest(spark, sf_dir):
    enriched = ingest.with_event_columns(_event_stream(spark, sf_dir)).select(
        "event_id", "video_id", "views_delta", "processing_time"
    )
    out, checkpoint = new_path(spark, "ingest"), new_path(spark, "ingest-checkpoint")
    ingest.append_files(enriched, out, checkpoint, available_now=True).awaitTermination()
    landed = spark.read.schema(enriched.schema).parquet(out)
    return landed.select(
        "event_id",
        (F.length("video_id") == 36).alias("has_id"),
        F.col("views_delta").between(0, 999).alias("delta_in_range"),
        F.col("processing_time").isNotNull().alias("is_timed"),
    )


# --- jobs --------------------------------------------------------------------

@_register
def collection_summary(spark, sf_dir):
    return summary.collection_summary(
        {
            "daily": star.facts_daily(spark, sf_dir),
            "hourly": star.facts_hourly(spark, sf_dir),
            "documents": star.facts_text(spark, sf_dir),
            "pages": star.table(spark, sf_dir, "pages"),
        }
    )


def _job_table(spark, sf_dir, name) -> DataFrame:
    paths = load.job_load(
        star.raw_daily(spark, sf_dir),
        new_path(spark, "load"),
        partitions={"facts": ["country"], "category_trends": ["country"]},
        tables=[name],
    )
    return spark.read.orc(paths[name])


@_register
def job_load_channels(spark, sf_dir):
    return rounded(_job_table(spark, sf_dir, "channel_statistics"), "avg_engagement_rate")


@_register
def job_load_trends(spark, sf_dir):
    out = _job_table(spark, sf_dir, "category_trends")
    return rounded(rounded(out, "avg_engagement"), "trending_score", digits=4)


@_register
def job_load_time_series(spark, sf_dir):
    return _job_table(spark, sf_dir, "time_series_metrics")


def _yearly(spark, sf_dir) -> DataFrame:
    """Raw rows dated by year, so that a folder per date and country holds some rows."""
    raw = star.raw_daily(spark, sf_dir)
    return raw.withColumn(
        "trending_date", F.date_trunc("year", F.try_to_timestamp("trending_date")).cast("date")
    )


@_register
def job_load_history(spark, sf_dir):
    """Facts of even and odd years loaded apart and the first part again: all are there."""
    raw = _yearly(spark, sf_dir)
    even = F.coalesce(F.year("trending_date") % 2, F.lit(0)) == 0
    target = new_path(spark, "history")
    for part in (raw.where(even), raw.where(~even), raw.where(even)):
        paths = load.job_load(part, target, tables=[])
    return spark.read.orc(paths["facts"]).select(
        "video_id", "trending_date", "country", "views", "likes", "dislikes", "comment_count"
    )


@_register
def job_load_increments(spark, sf_dir):
    """Trends after loads of even years, of odd ones, and of one year again."""
    raw = _yearly(spark, sf_dir)
    year, target = F.coalesce(F.year("trending_date"), F.lit(0)), new_path(spark, "increments")
    for part in (year % 2 == 0, year % 2 == 1, year == 1997):
        paths = load.job_load(raw.where(part), target, tables=["category_trends"])
    out = spark.read.orc(paths["category_trends"])
    return rounded(rounded(out, "avg_engagement"), "trending_score", digits=4)


@_register
def job_load_reach(spark, sf_dir):
    """Distinct videos per channel over all years, merged from the stored monthly sketches."""
    raw, target = _yearly(spark, sf_dir), new_path(spark, "reach")
    even = F.coalesce(F.year("trending_date") % 2, F.lit(0)) == 0
    for part in (raw.where(even), raw.where(~even)):
        paths = load.job_load(part, target, tables=["channel_reach"])
    return agg.roll_up_reach(spark.read.orc(paths["channel_reach"]), "channel_title")


def _new_database(spark) -> str:
    name = f"trendloom_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_path(spark, 'tables')}'")
    return name


def _filled(spark, sf_dir) -> dict[str, str]:
    """A new database with the data model, filled in two loads."""
    name = _new_database(spark)
    raw = _yearly(spark, sf_dir).withColumn("tags", F.replace("channel_title", F.lit("#"), F.lit("|")))
    even = F.coalesce(F.year("trending_date") % 2, F.lit(0)) == 0
    load.job_fill_tables(raw.where(even), name)
    return load.job_fill_tables(raw.where(~even), name)


@_register
def tables_fact_videos(spark, sf_dir):
    return rounded(
        spark.table(_filled(spark, sf_dir)["fact_videos"]).select(
            "video_id", "trending_date", "country", "category_id", "views", "likes",
            F.size("tags").alias("tag_count"), "virality_score",
        ),
        "virality_score",
    )


@_register
def tables_dim_channels(spark, sf_dir):
    """The channel dimension after two loads that share channels."""
    return spark.table(_filled(spark, sf_dir)["dim_channels"]).select(
        "channel_id", "channel_title", F.col("total_videos").cast("bigint").alias("total_videos"),
        "channel_type",
    )


@_register
def tables_time_series(spark, sf_dir):
    """The bucketed table."""
    return spark.table(_filled(spark, sf_dir)["time_series_metrics"])


@_register
def tables_storage_summary(spark, sf_dir):
    name = _new_database(spark)
    return load.job_load_tables(_yearly(spark, sf_dir), name)


@_register
def external_csv_table(spark, sf_dir):
    """Raw CSV files that stay where they are, read through the catalog."""
    facts = star.facts_daily(spark, sf_dir)
    given = {n: F.col(n) for n in facts.columns}
    given["tags"] = F.array_join("tags", "|")
    raw = facts.select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RAW_TRENDING]
    )
    path = new_path(spark, "external")
    sinks.write_csv(raw, path)
    name = f"{_new_database(spark)}.raw"
    sinks.create_external_csv(spark, name, path)
    return spark.table(name).select(
        "video_id", "trending_date", "title", "category_id", "tags", "views", "likes",
        "comments_disabled", "country",
    )


@_register
def summary_document(spark, sf_dir):
    """The summary stored as one JSON document, read back."""
    facts = star.facts_daily(spark, sf_dir).withColumn(
        "category_name", category_name(unknown="Unknown")
    )
    path = new_path(spark, "summary")
    sinks.write_summary(summary.summary_document(facts, exact=True), path)
    return spark.read.json(path).select(
        "total_videos",
        "unique_videos",
        "total_views",
        "top_category",
        "peak_month",
        F.array_join("top_categories.category_name", "; ").alias("categories"),
        F.array_join("top_countries.source_file", "; ").alias("files"),
        F.col("analysis_date").isNotNull().alias("is_stamped"),
    )


@_register
def tables_category_trends(spark, sf_dir):
    out = spark.table(_filled(spark, sf_dir)["category_trends"])
    return rounded(rounded(out, "avg_engagement"), "trending_score", digits=4)


@_register
def job_batch_enrich(spark, sf_dir):
    raw = star.facts_daily(spark, sf_dir).select(
        "video_id",
        "views",
        "likes",
        "dislikes",
        "comment_count",
        "trending_date",
        "source_file",
        F.replace("title", F.lit(" "), F.lit("|")).alias("tags"),
    )
    path = new_path(spark, "enrich")
    load.job_batch_enrich(raw, path, ["country"])
    stored = files.read_orc(spark, path).select(
        "video_id",
        "trending_date",
        "country",
        "views",
        "engagement_rate",
        "like_ratio",
        F.size("tags").alias("tag_count"),
        "virality_score",
    )
    return rounded(stored, "virality_score")


@_register
def job_summarise(spark, sf_dir):
    facts = star.facts_daily(spark, sf_dir).withColumn(
        "category_name", category_name(unknown="Unknown")
    )
    out = summary.summarise(facts, exact=True)
    return rounded(out, "avg_engagement", "avg_like_ratio")


# --- files -------------------------------------------------------------------

@_register
def text_size_mb(spark, sf_dir):
    """Text stored per source of documents, in MB and GB."""
    size = F.sum(F.octet_length("text"))
    docs = star.table(spark, sf_dir, "documents").groupBy("source")
    return docs.agg(size.alias("bytes")).select(
        "source", "bytes", bytes_to_mb(F.col("bytes")).alias("mb"), bytes_to_gb(F.col("bytes")).alias("gb")
    )


@_register
def profile(spark, sf_dir):
    facts = star.facts_daily(spark, sf_dir)
    return files.profile(facts).select(
        "rows", "columns", F.array_join("first_columns", ",").alias("first_columns")
    )


@_register
def size_ratio(spark, sf_dir):
    raw = star.raw_daily(spark, sf_dir)
    return agg.size_ratio(raw, cleaning.narrow_types(raw))


_TRIP = "video_id string, title string, country string, trending_date date, views bigint, likes int"


def _trip_rows(spark, sf_dir) -> DataFrame:
    return star.facts_daily(spark, sf_dir).select(
        "video_id", "title", "country", "trending_date", "views", "likes"
    )


@_register
def roundtrip_orc(spark, sf_dir):
    path = new_path(spark, "orc")
    sinks.replace_partitions(_trip_rows(spark, sf_dir), path, ["country"])
    return files.read_orc(spark, path)


@_register
def roundtrip_parquet(spark, sf_dir):
    path = new_path(spark, "parquet")
    sinks.write_files(_trip_rows(spark, sf_dir), path, "parquet")
    return spark.read.parquet(path)


@_register
def roundtrip_csv(spark, sf_dir):
    path = new_path(spark, "csv")
    sinks.write_csv(_trip_rows(spark, sf_dir), path, compression="gzip")
    return files.read_first_available(spark, [f"{path}/none-*.csv", f"{path}/*.csv.gz"], _TRIP)


@_register
def roundtrip_csv_dir(spark, sf_dir):
    path = new_path(spark, "csv-dir")
    sinks.write_csv(_trip_rows(spark, sf_dir), path)
    return files.read_csv_dir(spark, path).drop("source_file")


@_register
def roundtrip_csv_dirty(spark, sf_dir):
    """Latin-1 lines, a tenth of them too long and a tenth too short, in gzip files."""
    parts = star.table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    start = F.concat(key.cast("string"), F.lit(',"'), F.col("p_name"), F.lit(', \u00e9"'))
    line = (
        F.when(key % 10 == 0, F.concat(start, F.lit(",1,2")))
        .when(key % 10 == 1, start)
        .otherwise(F.concat(start, F.lit(","), F.col("p_size").cast("string")))
    )
    path = new_path(spark, "csv-dirty")
    raw = parts.select(line.alias("video_id,title,views")).write.option("header", True)
    raw.options(quote="", sep="\u0001", encoding="ISO-8859-1", compression="gzip").csv(path)
    return files.read_csv_dir(spark, path).drop("source_file")


@_register
def roundtrip_tsv(spark, sf_dir):
    path = new_path(spark, "tsv")
    sinks.write_csv(_trip_rows(spark, sf_dir), path, sep="\t", compression="gzip")
    return files.read_tsv(spark, f"{path}/*.csv.gz", _TRIP)


@_register
def roundtrip_json(spark, sf_dir):
    path = new_path(spark, "json")
    _trip_rows(spark, sf_dir).write.option("compression", "gzip").json(path)
    return files.read_jsonl(spark, path, _TRIP)


@_register
def api_items(spark, sf_dir):
    """Nested items stored as arrays of one video's observations, read back flat."""
    item = F.struct(
        F.col("video_id").alias("id"),
        F.struct(
            F.col("views").cast("string").alias("viewCount"),
            F.col("likes").cast("string").alias("likeCount"),
        ).alias("statistics"),
        F.struct("duration").alias("contentDetails"),
        F.struct("title", F.col("category_id").alias("categoryId")).alias("snippet"),
    )
    path = new_path(spark, "items")
    raw = star.raw_daily(spark, sf_dir)
    raw.select(F.to_json(F.array(item)).alias("value")).write.text(path)
    return files.read_api_items(spark, path, multiline=False).select(
        "video_id", "title", "category_id", "view_count", "like_count", "comment_count", "duration"
    )
