"""Writing files and managing catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from trendloom import schemas


def arranged(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring rows of one output partition together before a partitioned write.

    A rebalance, not a repartition: a partition with very many rows is split
    over several tasks and files, and small ones share a task.
    """
    return df.hint("rebalance", *columns) if columns else df


def write_files(
    df: DataFrame,
    path: str,
    fmt: str = "orc",
    partitions: Sequence[str] = (),
    mode: str = "overwrite",
    **options,
) -> None:
    """Columnar files, snappy unless told otherwise, partitioned by folder."""
    writer = arranged(df, partitions).write.mode(mode).format(fmt)
    writer = writer.options(**{"compression": "snappy", **options})
    (writer.partitionBy(*partitions) if partitions else writer).save(path)


def write_table(
    df: DataFrame,
    name: str,
    partitions: Sequence[str] = (),
    buckets: tuple[int, str] | None = None,
    *,
    fmt: str = "orc",
    path: str | None = None,
) -> None:
    """Write and register a table; ``buckets`` is (count, column).

    A partitioned table that exists keeps the partitions that ``df`` does not have.
    """
    spark = df.sparkSession
    if partitions and spark.catalog.tableExists(name):
        insert_partitions(df, name, partitions)
        return
    writer = arranged(df, partitions).write.mode("overwrite").format(fmt)
    writer = writer.option("compression", "snappy")
    if path:
        writer = writer.option("path", path)
    if partitions:
        writer = writer.partitionBy(*partitions)
    if buckets:
        writer = writer.bucketBy(*buckets).sortBy(buckets[1])
    writer.saveAsTable(name)


def insert_partitions(df: DataFrame, name: str, partitions: Sequence[str]) -> None:
    """Overwrite only the partitions of a table that occur in ``df``."""
    spark = df.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        columns = spark.table(name).columns
        arranged(df, partitions).select(*columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str], fmt="orc") -> None:
    """Overwrite only the partitions that occur in ``df``; a rerun is harmless."""
    write_files(df, path, fmt, partitions, partitionOverwriteMode="dynamic")


def write_csv(df: DataFrame, path: str, *, sep: str = ",", compression: str = "none") -> None:
    """Header and quoted text, UTF-8 without byte order mark."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("compression", compression)
        .csv(path)
    )


def write_summary(summary: DataFrame, path: str) -> None:
    """A summary frame (one or a few rows) as a single JSON document file."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def write_sample(df: DataFrame, path: str, n: int, fmt: str = "json", **options) -> None:
    df.limit(n).write.mode("overwrite").format(fmt).options(**options).save(path)


def _columns_ddl(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partitions: Sequence[str] = (),
    buckets: tuple[int, str] | None = None,
    fmt: str = "orc",
) -> None:
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({_columns_ddl(schema)}) USING {fmt}"
    if partitions:
        ddl += f" PARTITIONED BY ({', '.join(partitions)})"
    if buckets:
        ddl += f" CLUSTERED BY ({buckets[1]}) INTO {buckets[0]} BUCKETS"
    spark.sql(ddl)


def create_tables(spark: SparkSession, database: str) -> None:
    """The database and every table of the data model, empty."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    tables = {
        "fact_videos": (schemas.FACT_VIDEOS, schemas.FACT_PARTITIONS, None),
        "dim_channels": (schemas.DIM_CHANNELS, (), None),
        "dim_categories": (schemas.DIM_CATEGORIES, (), None),
        "channel_statistics": (schemas.CHANNEL_STATISTICS, ["country"], None),
        "category_trends": (schemas.CATEGORY_TRENDS, ["year", "month", "country"], None),
        "time_series_metrics": (schemas.TIME_SERIES_METRICS, ["country"], (10, "date_key")),
    }
    for table, (schema, partitions, buckets) in tables.items():
        create_table(spark, f"{database}.{table}", schema, partitions, buckets)
    create_table(
        spark, f"{database}.streaming_videos", schemas.STREAMING_VIDEOS, schemas.STREAM_PARTITIONS, fmt="parquet"
    )


def create_external_csv(
    spark: SparkSession, name: str, location: str, schema: T.StructType = schemas.RAW_TRENDING
) -> None:
    """A table over raw CSV files that stay where they are."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_columns_ddl(schema)}) USING csv "
        f"OPTIONS (header 'true') LOCATION '{location}'"
    )


def collect_statistics(spark: SparkSession, tables: Sequence[str]) -> None:
    for name in tables:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")


def keep_for_reuse(df: DataFrame) -> DataFrame:
    """Cache a result that several actions read; the caller unpersists it."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
