import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from trendloom.schemas import STREAM_DELTAS
from trendloom.sources import starschema as star
from trendloom.streaming import ingest
from trendloom.streaming.trends import windowed_trends


def drain(query):
    query.processAllAvailable()
    progress = [p for p in query.recentProgress]
    query.stop()
    return progress


def event_stream(spark, sf_dir):
    schema = star.table(spark, sf_dir, "events").schema
    return ingest.landed_source(spark, f"{sf_dir}/events.parque[t]", schema)


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_stream_equals_batch(spark, sf_dir, mode):
    batch = windowed_trends(star.deltas_from_events(star.table(spark, sf_dir, "events")))
    stream = windowed_trends(star.deltas_from_events(event_stream(spark, sf_dir)))
    name = f"trends_{mode}"
    drain(ingest.memory_table(stream, name, mode))
    assert rows(spark.table(name)) == rows(batch)


def _write(spark, folder, *events):
    df = spark.createDataFrame(
        [(v, t, views, 1, 0, t) for v, t, views in events], STREAM_DELTAS
    ).coalesce(1)
    df.write.mode("append").parquet(folder)
    time.sleep(1.1)  # the source reads files in order of modification


@pytest.mark.parametrize(("mode", "dropped"), [("append", 5), ("update", 5), ("complete", 0)])
def test_late_rows(spark, tmp_path, mode, dropped):
    folder = f"{tmp_path}/in"
    start = dt.datetime(2024, 1, 1, 12, 0)
    _write(spark, folder, ("a", start, 10))
    # a late row is dropped from the second batch after the one that made it late
    _write(spark, folder, ("a", start + dt.timedelta(hours=1), 20))
    _write(spark, folder, ("a", start + dt.timedelta(hours=2), 20))
    _write(spark, folder, ("a", start, 40))
    source = ingest.landed_source(spark, folder, STREAM_DELTAS, files_per_trigger=1)
    name = f"late_{mode}"
    progress = drain(ingest.memory_table(windowed_trends(source), name, mode))
    lost = sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])
    assert lost == dropped
    total = spark.table(name).filter(F.col("window_start") == start).agg(F.max("views_5min"))
    assert total.first()[0] == (50 if mode == "complete" else 10)


def test_rate_source_lands_with_the_contract(spark, tmp_path):
    source = ingest.rate_source(spark, 10)
    query = ingest.ingest(source, f"{tmp_path}/out", f"{tmp_path}/cp")
    deadline = time.time() + 60
    landed = None
    while time.time() < deadline:
        query.processAllAvailable()
        landed = spark.read.schema(STREAM_DELTAS).parquet(f"{tmp_path}/out")
        if landed.count():
            break
    query.stop()
    row = landed.first()
    assert len(row["video_id"]) == 36 and 0 <= row["views_delta"] < 1000
    assert row["likes_delta"] is None and row["processing_time"] is not None


def test_restart_does_not_repeat_rows(spark, sf_dir, tmp_path):
    n = star.table(spark, sf_dir, "events").count()
    for _ in range(2):
        source = event_stream(spark, sf_dir).select("event_id")
        ingest.append_files(
            source, f"{tmp_path}/o", f"{tmp_path}/c", available_now=True
        ).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/o").count() == n


def test_late_landings_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    from pathlib import Path

    from trendloom.plans import catalog

    made = {}
    new_path = catalog.new_path
    monkeypatch.setattr(catalog, "new_path", lambda s, name: made.setdefault(name, new_path(s, name)))
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(4, "event_id").write.parquet(f"{tmp_path}/events.parquet")
    late = catalog.queries()["window_trends_late"](spark, str(tmp_path))
    assert sorted(late.collect()) == sorted(catalog.queries()["window_trends_batch"](spark, str(tmp_path)).collect())
    landed = Path(made["landing"].removeprefix("file:"))
    assert all(len(list((landed / str(i)).glob("part-*.parquet"))) > 1 for i in (0, 1))


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    from trendloom.sources import sinks

    sinks.create_tables(spark, "streamed")
    table, start = "streamed.streaming_videos", dt.datetime(2024, 1, 1)
    for i in range(3):
        _write(spark, f"{tmp_path}/in", ("a", start, i), ("b", start, i))
    source = ingest.landed_source(spark, f"{tmp_path}/in", STREAM_DELTAS, files_per_trigger=1)
    for name in ("one", "it's another"):
        checkpoint = f"{tmp_path}/{name[:3]}"
        ingest.append_to_table(source, table, checkpoint, name=name, available_now=True).awaitTermination()
    before = rows(spark.table(table))
    assert len(before) == 12 and {r[-1] for r in before} == {0, 1, 2}
    batch = spark.read.schema(STREAM_DELTAS).parquet(f"{tmp_path}/in").where("views_delta = 1")
    ingest.insert_epoch(batch, table, "one", 1)
    assert rows(spark.table(table)) == before
    ingest.insert_epoch(batch.limit(0), table, "one", 1)  # and an empty batch empties only its own
    assert spark.table(table).count() == 10


def test_state_on_disk_gives_the_same(spark, sf_dir, tmp_path):
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    batch = windowed_trends(star.deltas_from_events(star.table(spark, sf_dir, "events")))
    stream = windowed_trends(star.deltas_from_events(event_stream(spark, sf_dir)))
    with ingest.state_on_disk(spark):
        progress = drain(ingest.memory_table(stream, "trends_on_disk", "update"))
    assert spark.conf.get(setting) == before
    assert any("rocksdb" in m for p in progress for o in p["stateOperators"] for m in o["customMetrics"])
    assert rows(spark.table("trends_on_disk")) == rows(batch)


def test_a_restart_finds_the_whole_state_and_no_changes_to_replay(spark, tmp_path):
    from pathlib import Path

    start, folder = dt.datetime(2024, 1, 1, 12, 0), f"{tmp_path}/in"
    progress = []
    for minute in (0, 1):
        _write(spark, folder, ("a", start, 10), ("b", start, 1), ("a", start + dt.timedelta(minutes=minute), 5))
        trends = windowed_trends(ingest.landed_source(spark, folder, STREAM_DELTAS))
        with ingest.state_on_disk(spark):
            query = ingest.update_files(trends, f"{tmp_path}/out", f"{tmp_path}/cp", available_now=True)
            query.awaitTermination()
        progress += query.recentProgress
    state = Path(f"{tmp_path}/cp/state")
    assert list(state.rglob("*.zip")) and not list(state.rglob("*.changelog"))
    assert all(o["numRowsTotal"] == 0 for p in progress for o in p["stateOperators"])  # not looked up
    latest = ingest.latest_state(spark, f"{tmp_path}/out", trends.schema, ["window_start", "window_end", "video_id"])
    batch = windowed_trends(spark.read.schema(STREAM_DELTAS).parquet(folder))
    assert rows(latest) == rows(batch) and latest.where("views_5min = 30").count() == 4


def test_the_latest_state_is_hashed_and_keeps_nulls(spark, tmp_path):
    schema = "k string, views bigint, likes double"
    for epoch, made in enumerate([[("a", 1, 1.0), ("b", 2, 2.0), (None, 3, 3.0)], [("a", 5, None), (None, None, 4.0)]]):
        spark.createDataFrame(made, schema).write.parquet(f"{tmp_path}/out/epoch={epoch}")
    full = spark.read.schema(schema).parquet(f"{tmp_path}/out/epoch=0").schema
    latest = ingest.latest_state(spark, f"{tmp_path}/out", full, ["k"])
    assert rows(latest) == rows(spark.createDataFrame([("a", 5, None), ("b", 2, 2.0), (None, None, 4.0)], schema))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    keys = ingest.latest_state(spark, f"{tmp_path}/out", full, full.fieldNames())
    assert keys.columns == full.fieldNames() and keys.count() == 5


def test_late_report_restarts_from_snapshots(spark, tmp_path, monkeypatch):
    from pathlib import Path

    from trendloom.plans import catalog

    made = {}
    new_path = catalog.new_path
    monkeypatch.setattr(catalog, "new_path", lambda s, name: made.setdefault(name, new_path(s, name)))
    start = dt.datetime(2024, 1, 1)
    events = [(i, start + dt.timedelta(hours=h), u, "view", 1.0, '{"k": 1}') for i, (h, u) in enumerate([(0, 1), (1, 1), (1, 2), (9, 1)])]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(events, schema).write.parquet(f"{tmp_path}/events.parquet")
    report = catalog.queries()["window_trends_late_report"](spark, str(tmp_path))
    assert [tuple(r) for r in report.collect()] == [(20, 15)]
    state = Path(made["trends-checkpoint"].removeprefix("file:")) / "state"
    assert list(state.rglob("*.zip")) and not list(state.rglob("*.changelog"))
