"""Summary documents over the facts and over all collected sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.operators import aggregates
from trendloom.operators.reshape import union_by_name

# Columns whose pairwise correlation is reported.
CORRELATED = ["views", "likes", "dislikes", "comment_count", "engagement_rate"]


def summarise(
    df: DataFrame, *, exact: bool = False
) -> DataFrame:
    """One row with the overall statistics, top category and peak month."""
    months = aggregates.monthly_summary(aggregates.monthly_series(df))
    top = aggregates.mode_value(df, "category_name").select("category_name")
    peak = months.select(F.struct("*").alias("m")).scalar()
    return (
        aggregates.basic_stats(df, exact=exact)
        .withColumn("top_category", top.scalar())
        .withColumn("_m", peak)
        .select(
            "*",
            F.col("_m.avg_per_month").alias("avg_per_month"),
            F.col("_m.peak_month").alias("peak_month"),
            F.col("_m.peak_videos").alias("peak_videos"),
        )
        .drop("_m")
    )


def summary_document(
    df: DataFrame, *, exact: bool = False
) -> DataFrame:
    """``summarise`` with the short rankings nested in it, stamped with the time."""

    def nested(rows: DataFrame):
        return rows.agg(F.collect_list(F.struct("*")).alias("rows")).scalar()

    return summarise(df, exact=exact).withColumns(
        {
            "top_categories": nested(aggregates.top_values(df, "category_name", 5)),
            "top_countries": nested(aggregates.country_stats(df, 5)),
            "correlations": nested(aggregates.strongest_pairs(df, CORRELATED, 3)),
            "analysis_date": F.current_timestamp(),
        }
    )


def source_summary(name: str, df: DataFrame) -> DataFrame:
    """Status and volumes of one collected source; columns it lacks are NULL."""
    aggs = [F.count(F.lit(1)).alias("records")]
    if "video_id" in df.columns:
        aggs.append(F.count_distinct("video_id").alias("unique_videos"))
    if "views" in df.columns:
        aggs.append(F.avg("views").alias("avg_views"))
    status = F.when(F.col("records") > 0, "complete").otherwise("missing")
    out = df.agg(*aggs).select(F.lit(name).alias("source"), status.alias("status"), "*")
    if "country" in df.columns:
        out = out.withColumn("countries", aggregates.distinct_values(df, "country"))
    return out


def collection_summary(
    sources: dict[str, DataFrame], inventory: DataFrame | None = None
) -> DataFrame:
    """A row per source; with a file inventory, a last row of files and bytes."""
    parts = [source_summary(name, df) for name, df in sources.items()]
    if inventory is not None:
        parts.append(
            inventory.agg(
                F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")
            ).withColumn("source", F.lit("total"))
        )
    return union_by_name(parts)
