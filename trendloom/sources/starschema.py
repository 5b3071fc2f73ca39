"""Adapters: the star-schema parquet tables seen as trending observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.functions import engagement_rate, like_ratio, virality_score

# Order that leaves only rows alike in every fact column tied.
OBSERVATION_ORDER = ["trending_date", "video_id", "country", "category_id", "views", "likes"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _whole(value: Column, scale: int = 1) -> Column:
    return F.floor(value * scale)


def facts_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per order line: item, seller, day, country, counters."""
    line = table(spark, sf_dir, "lineitem")
    # what depends on the item or the seller alone is derived before the joins
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_partkey").cast("string").alias("video_id"),
        "p_name",
        F.split("p_name", " ").alias("tags"),
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select(
        "n_nationkey", "n_name", _file_name(F.col("n_nationkey")).alias("source_file")
    )
    # each parent is joined as a plain scan, whose size Spark knows: small ones
    # are broadcast and the facts are not shuffled for them
    return (
        line.join(part, line.l_partkey == part.p_partkey)
        .join(supplier, line.l_suppkey == supplier.s_suppkey)
        .join(nation, supplier.s_nationkey == nation.n_nationkey)
        .select(
            "video_id",
            F.col("p_name").alias("title"),
            F.col("s_name").alias("channel_title"),
            F.col("l_linenumber").alias("category_id"),
            F.col("l_shipdate").alias("publish_time"),
            "tags",
            _whole(F.col("l_extendedprice")).alias("views"),
            _whole(F.col("l_quantity"), 100).cast("int").alias("likes"),
            _whole(F.col("l_tax"), 1000).cast("int").alias("dislikes"),
            _whole(F.col("l_discount"), 1000).cast("int").alias("comment_count"),
            F.col("l_shipdate").cast("date").alias("trending_date"),
            F.col("n_name").alias("country"),
            "source_file",
        )
        .withColumn("engagement_rate", engagement_rate())
        .withColumn("like_ratio", like_ratio())
        .withColumn("virality_score", virality_score())
    )


def _file_name(nation: Column) -> Column:
    """File a row came from: some match the country pattern, some only loosely, some not."""
    code = F.concat(F.chr(nation + 65), F.lit("X"))
    return (
        F.when(nation % 10 == 7, F.lit(None))
        .when(nation % 10 == 8, F.lit("nope.csv"))
        .when(nation % 10 == 9, F.concat(F.lit("set_"), code, F.lit(".csv")))
        .otherwise(F.concat(code, F.lit("videos.csv")))
    )


def raw_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily observations as untyped text, with defects a cleaner must handle."""
    line = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_partkey").cast("string").alias("video_id"),
        F.when(F.col("p_size") % 17 != 0, F.col("p_name")).alias("title"),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", _file_name(F.col("s_nationkey")).alias("source_file")
    )
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    quantity = F.col("l_quantity").cast("int")
    return (
        line.join(part, line.l_partkey == part.p_partkey)
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            "video_id",
            "title",
            F.col("s_name").alias("channel_title"),
            F.col("l_linenumber").cast("string").alias("category_id"),
            F.when(quantity % 13 == 0, F.lit("not a day")).otherwise(day).alias("trending_date"),
            F.when(quantity % 13 == 1, F.lit("?"))
            .otherwise(F.concat(day, F.lit(" 0"), "l_linenumber", F.lit(":30:00")))
            .alias("publish_time"),
            F.when(quantity % 11 == 0, F.lit("n/a"))
            .when(quantity % 11 == 1, F.concat(quantity.cast("string"), F.lit(".7")))
            .otherwise(_whole(F.col("l_extendedprice")).cast("string"))
            .alias("views"),
            F.when(quantity % 7 == 0, F.lit(""))
            .otherwise(_whole(F.col("l_quantity"), 100).cast("string"))
            .alias("likes"),
            F.when(F.col("l_linenumber") != 3, _whole(F.col("l_tax"), 1000).cast("string"))
            .alias("dislikes"),
            _whole(F.col("l_discount"), 1000).cast("string").alias("comment_count"),
            F.when(quantity % 10 == 0, F.lit("P0D"))
            .when(quantity % 10 == 1, F.lit("unknown"))
            .when(quantity % 10 == 2, F.concat(F.lit("P1DT"), quantity, F.lit("H")))
            .when(quantity % 10 == 3, F.concat(F.lit("PT"), quantity, F.lit(".5S")))
            .otherwise(F.concat(F.lit("PT1H"), quantity, F.lit("M"), "l_linenumber", F.lit("S")))
            .alias("duration"),
            "source_file",
            "l_orderkey",
        )
    )


def facts_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily facts with zero and missing counters in some categories."""
    c = F.col("category_id")
    return facts_daily(spark, sf_dir).withColumns(
        {
            "views": F.when(c == 7, 0).when(c != 6, F.col("views")),
            "likes": F.when(c == 4, 0).when(c != 5, F.col("likes")),
            "dislikes": F.when(c == 4, 0).when(c != 3, F.col("dislikes")),
        }
    )


def category_dimension_from_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("category_id"),
        F.col("n_name").alias("category_name"),
        F.col("r_name").alias("category_group"),
    )


def manifest_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as manifest entries: the type of file varies with the id."""
    names = F.array(*[F.lit(e) for e in (".csv", ".JSON", ".txt.gz", ".tsv", ".png", ".bin")])
    kind = F.get(names, (F.col("page_id") % 6).cast("int"))
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("key"),
        F.concat(F.lit("file"), F.col("page_id").cast("string"), kind).alias("filename"),
        (F.length("html") / 100.0).alias("size_mb"),
        (F.col("page_id") * 7919 % 1009).alias("downloads"),
    )


def deltas_from_events(events: DataFrame) -> DataFrame:
    """Events as stream deltas, keyed by user."""
    return events.select(
        F.col("user_id").alias("video_id"),
        F.col("ts").cast("timestamp").alias("processing_time"),
        _whole(F.col("value"), 100).alias("views_delta"),
        F.get_json_object("props", "$.k").try_cast("int").alias("likes_delta"),
    )


def facts_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per event, for operators that need the hour of day."""
    events = table(spark, sf_dir, "events")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        events.join(customer, events.user_id == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("event_id").cast("string").alias("video_id"),
            F.col("event_type").alias("title"),
            F.col("c_name").alias("channel_title"),
            F.pmod(F.col("user_id"), F.lit(30)).cast("int").alias("category_id"),
            F.col("ts").alias("publish_time"),
            _whole(F.col("value"), 100).alias("views"),
            F.get_json_object("props", "$.k").try_cast("int").alias("likes"),
            F.col("ts").cast("date").alias("trending_date"),
            F.col("n_name").alias("country"),
            F.col("event_type"),
        )
        .withColumn("comment_count", F.lit(0))
        .withColumn("engagement_rate", engagement_rate())
    )


def facts_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per document, for operators on titles."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.col("text").alias("title"),
        F.col("source").alias("channel_title"),
        F.split("text", " ").alias("tags"),
        F.col("n_chars").alias("views"),
        F.col("lang").alias("country"),
        F.try_divide(F.length("text"), F.col("n_chars")).alias("engagement_rate"),
    )
