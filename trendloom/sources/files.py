"""Reading raw files: CSV, TSV, JSON, ORC, file listings and profiles."""

from __future__ import annotations

import csv
from collections import Counter, defaultdict
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.functions import bytes_to_gb, bytes_to_mb
from trendloom.operators.reshape import union_by_name
from trendloom.schemas import API_ITEM
from trendloom.sources.workspace import materialise

_CORRUPT = "_corrupt"
_QUOTED = r'"(?:[^"]|"")*"'
_CSV_FILES = "*.{csv,csv.gz}"


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    *,
    infer: bool = False,
    sep: str = ",",
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header. Without schema or ``infer`` every column is text."""
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("multiLine", multiline)
        .option("escape", '"')
    )
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", infer)
    return reader.csv(path if isinstance(path, str) else list(path))


def read_tsv(spark: SparkSession, path: str, schema=None, *, infer: bool = False) -> DataFrame:
    """Tab-separated text, compressed or not (the suffix decides)."""
    return read_csv(spark, path, schema, infer=infer, sep="\t")


def read_first_available(
    spark: SparkSession, paths: Sequence[str], schema=None, *, infer: bool = False
) -> DataFrame:
    """CSV from the first path or glob that exists."""
    missing = []
    for path in paths:
        try:
            return read_csv(spark, path, schema, infer=infer)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(path)
    raise FileNotFoundError(f"none of these exist: {missing}")


def text_file_traits(spark: SparkSession, path: str) -> DataFrame:
    """Per file: its header line and whether all of its bytes are UTF-8.

    Reads lines, so large files are split like any other text input.
    """
    lines = spark.read.option("pathGlobFilter", _CSV_FILES).text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("place"),
        F.is_valid_utf8("value").alias("utf8"),
        "value",
    )
    first = F.col("place.block") == 0
    return lines.groupBy("file_path").agg(
        F.min_by("value", F.when(first, F.col("place"))).alias("header"),
        F.bool_and("utf8").alias("is_utf8"),
    )


def read_csv_dir(
    spark: SparkSession, path: str, *, sep: str = ",", multiline: bool = False
) -> DataFrame:
    """Every CSV file of a folder, gzipped or not, as text columns plus ``source_file``.

    Files may differ in header and encoding; columns are united by name. Invalid UTF-8
    is read as Latin-1, which decodes any byte, line by line. Lines with too many fields
    are skipped, short ones padded with NULL, blank ones and repeated headers dropped.
    Data is scanned once, its files' first lines apart; only the distinct headers reach
    the driver. ``multiline`` allows line breaks inside quotes: files alike are then
    read together, undivided, and their encoding is one for each file.
    """
    if multiline:
        return _read_whole_files(spark, path, sep)
    lines = spark.read.option("pathGlobFilter", _CSV_FILES).text(path).select(
        F.when(F.is_valid_utf8("value"), F.col("value"))
        .otherwise(F.decode(F.col("value").cast("binary"), "ISO-8859-1"))
        .alias("line"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
    ).withColumn("line", F.regexp_replace("line", "^\ufeff", ""))
    first = lines.where("block = 0").withColumn("at", F.monotonically_increasing_id())
    # a row per file, of which the driver holds a longer entry since it listed the folder
    headers = first.groupBy("file_path").agg(F.min_by("line", "at").alias("header"))
    headers = materialise(headers, "headers")
    known = sorted(r["header"] for r in headers.select("header").distinct().collect())
    if not known:
        raise FileNotFoundError(f"no CSV file with a header in {path}")
    rows = lines.join(F.broadcast(headers), "file_path").where(
        (F.col("line") != F.col("header")) & (F.trim("line") != "")
    )
    bare = F.regexp_replace("line", _QUOTED, "")
    separators = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))
    fields = {h: next(csv.reader([h], delimiter=sep)) for h in known}
    options = {"sep": sep, "escape": '"', "mode": "PERMISSIVE"}
    parsed, fits = {}, F.lit(False)
    for h, names in fields.items():
        schema = ", ".join(f"`{n}` string" for n in names)
        parsed[h] = F.from_csv("line", schema, options)
        fits = fits | ((F.col("header") == h) & (separators < len(names)))
    columns = dict.fromkeys(n for names in fields.values() for n in names)
    chosen = [
        F.coalesce(*[
            F.when(F.col("header") == h, parsed[h][n]) for h, names in fields.items() if n in names
        ]).alias(n)
        for n in columns
    ]
    return rows.where(fits).select(*chosen, "source_file")


def _read_whole_files(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """One row per file reaches the driver, which lists the files anyway."""
    traits = text_file_traits(spark, path).collect()
    groups = defaultdict(list)
    for t in traits:
        groups[(t.header.lstrip("\ufeff"), t.is_utf8)].append(t.file_path)
    if not groups:
        raise FileNotFoundError(f"no CSV file with a header in {path}")
    frames = [
        _read_alike(spark, files, header, utf8, sep)
        for (header, utf8), files in sorted(groups.items())
    ]
    return union_by_name(frames)


def _read_alike(spark, files, header, utf8, sep) -> DataFrame:
    names = next(csv.reader([header], delimiter=sep))
    fields = [T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]]
    df = (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("sep", sep)
        .option("encoding", "UTF-8" if utf8 else "ISO-8859-1")
        .option("multiLine", True)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .csv(sorted(files))
    )
    return (
        df.withColumn("source_file", F.col("_metadata.file_name"))
        .filter(~_too_long(names, sep))
        .drop(_CORRUPT)
    )


def _too_long(names: list[str], sep: str) -> Column:
    """Whether a malformed line has more fields than the header."""
    bare = F.regexp_replace(_CORRUPT, _QUOTED, "")
    separators = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))
    # Names a data column: the reader refuses to read the corrupt column alone.
    data = F.length(F.coalesce(F.col(names[0]), F.lit("")))
    return F.col(_CORRUPT).isNotNull() & (separators >= len(names)) & (data >= 0)


def read_jsonl(spark: SparkSession, path: str, schema=None, *, n: int | None = None) -> DataFrame:
    """JSON lines; all objects, or the first ``n``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.json(path)
    return df if n is None else df.limit(n)


def read_json_arrays(
    spark: SparkSession, path: str, schema=None, *, multiline: bool = True
) -> DataFrame:
    """JSON arrays (or objects), one per file or one per line; a row per item."""
    reader = spark.read.option("multiLine", multiline)
    return (reader if schema is None else reader.schema(schema)).json(path)


def read_api_items(spark: SparkSession, path: str, *, multiline: bool = True) -> DataFrame:
    """Nested API items, flattened to the cleaner's column names."""
    return flatten_api_items(read_json_arrays(spark, path, API_ITEM, multiline=multiline))


def flatten_api_items(items: DataFrame) -> DataFrame:
    return items.select(
        F.col("id").alias("video_id"),
        F.col("snippet.title").alias("title"),
        F.col("snippet.categoryId").alias("category_id"),
        F.col("snippet.publishedAt").alias("publishedAt"),
        F.col("snippet.channelId").alias("channel_id"),
        F.col("statistics.viewCount").alias("view_count"),
        F.col("statistics.likeCount").alias("like_count"),
        F.col("statistics.commentCount").alias("comment_count"),
        F.col("contentDetails.duration").alias("duration"),
    )


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """One row per file below ``path``: folder, name, bytes. Contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    ).select("path", "length")
    return files.select(
        F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"),
        F.regexp_extract("path", r"([^/]*)$", 1).alias("file"),
        F.col("length").alias("bytes"),
    )


def inventory_summary(inventory: DataFrame, large_mb: float = 1.0) -> DataFrame:
    """Per folder: file count, size, and how many files are large."""
    size = F.sum("bytes")
    return inventory.groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"),
        size.alias("bytes"),
        bytes_to_mb(size).alias("size_mb"),
        bytes_to_gb(size).alias("size_gb"),
        F.count_if(bytes_to_mb(F.col("bytes")) > large_mb).alias("large_files"),
    )


def large_files(inventory: DataFrame, large_mb: float = 1.0) -> DataFrame:
    return inventory.withColumn("size_mb", bytes_to_mb(F.col("bytes"))).filter(
        F.col("size_mb") > large_mb
    )


def profile(df: DataFrame) -> DataFrame:
    """One row: shape, first five column names, columns per type."""
    types = Counter(t for _, t in df.dtypes)
    pairs = [F.lit(x) for item in sorted(types.items()) for x in item]
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        F.array(*[F.lit(c) for c in df.columns[:5]]).alias("first_columns"),
        F.create_map(*pairs).alias("type_counts"),
    )
