"""Stream sources, enrichment and sinks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trendloom.schemas import STREAM_DELTAS, STREAM_PARTITIONS


_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_CHANGES = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
_TOTAL = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB instead of the heap.

    State may then outgrow an executor's memory. A commit uploads the store's new files, so
    that a restart loads them and replays no changes. Rows are not counted, as each put and
    each removal would look its key up for it: ``numRowsTotal`` of the progress stays 0.
    A checkpoint remembers its store, so a query must be restarted in the same way.
    """
    wanted = {_STORE: _ROCKS, _CHANGES: "false", _TOTAL: "false"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def late_groups(query: StreamingQuery) -> int:
    """Groups (a window and its key) that came behind the watermark and were dropped.

    From the query's own progress, which covers its last run and at most
    ``spark.sql.streaming.numRecentProgressUpdates`` batches of it.
    """
    operators = [o for p in query.recentProgress for o in p["stateOperators"]]
    return sum(o["numRowsDroppedByWatermark"] for o in operators)


def rate_source(spark: SparkSession, rows_per_second: int = 10) -> DataFrame:
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def landed_source(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    glob: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files of a folder as a stream, new files as they arrive."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def with_event_columns(stream: DataFrame) -> DataFrame:
    """Random id and view delta, and the processing time."""
    return stream.withColumns(
        {
            "video_id": F.expr("uuid()"),
            "views_delta": F.floor(F.rand() * 1000),
            "processing_time": F.current_timestamp(),
        }
    )


def to_contract(stream: DataFrame, schema: T.StructType = STREAM_DELTAS) -> DataFrame:
    """The columns of the stream table, in its types; absent ones are NULL."""
    return stream.select(
        *[
            (F.col(f.name) if f.name in stream.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def append_files(
    stream: DataFrame, path: str, checkpoint: str, *, available_now: bool = False
) -> StreamingQuery:
    """Append-only parquet sink; each row is written once, also after a restart."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def update_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    mode: str = "update",
    available_now: bool = False,
) -> StreamingQuery:
    """Every state of an aggregation that changed, a folder for each micro-batch.

    Open windows are written too. A batch that is run again replaces its own folder.
    In complete mode each folder holds the whole result.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(write).start()


def append_to_table(
    stream: DataFrame, table: str, checkpoint: str, *, name: str, available_now: bool = False
) -> StreamingQuery:
    """Append a stream to a catalog table that is partitioned by stream and epoch.

    ``name`` tells this stream from others that write to the table, and has to stay with
    its checkpoint. A batch that is run again replaces its own partition, so each row is
    in the table once whatever fails in between.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        insert_epoch(batch, table, name, epoch)

    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(write).start()


def insert_epoch(batch: DataFrame, table: str, name: str, epoch: int) -> None:
    """The rows of one batch become the whole content of its partition."""
    spark = batch.sparkSession
    columns = ", ".join(f"`{c}`" for c in spark.table(table).columns if c not in STREAM_PARTITIONS)
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION (stream = {{name}}, epoch = {{epoch}}) "
        f"SELECT {columns} FROM {{batch}}",
        name=name,
        epoch=int(epoch),
        batch=batch,
    )


def latest_state(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]
) -> DataFrame:
    """The last row that ``update_files`` wrote for each key."""
    full = T.StructType([*schema.fields, T.StructField("epoch", T.LongType())])
    stored = spark.read.schema(full).parquet(path)
    rest = [n for n in schema.fieldNames() if n not in keys]
    if not rest:
        return stored.select(*keys).distinct()
    # column by column: numbers are then hashed, where a struct of them is sorted
    return stored.groupBy(*keys).agg(*[F.max_by(n, "epoch").alias(n) for n in rest])


def ingest(
    source: DataFrame, path: str, checkpoint: str, *, available_now: bool = False
) -> StreamingQuery:
    """Any streaming source, enriched and appended to a folder."""
    return append_files(
        to_contract(with_event_columns(source)), path, checkpoint, available_now=available_now
    )


def memory_table(stream: DataFrame, name: str, mode: str = "complete") -> StreamingQuery:
    """A queryable table on the driver, for small results and tests.

    In complete mode all state is kept, and the watermark evicts nothing.
    """
    return stream.writeStream.format("memory").queryName(name).outputMode(mode).start()
