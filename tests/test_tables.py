import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from trendloom.operators import aggregates
from trendloom.plans import load
from trendloom.schemas import RAW_TRENDING, category_dimension
from trendloom.sources import sinks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tables(spark, database):
    return {t.name for t in spark.catalog.listTables(database) if not t.isTemporary}


@pytest.fixture(scope="module")
def raw(spark):
    return spark.range(400).select(
        F.concat(F.lit("v"), (F.col("id") % 150).cast("string")).alias("video_id"),
        F.lit("t").alias("title"),
        F.concat(F.lit("ch"), (F.col("id") % 5).cast("string")).alias("channel_title"),
        (F.col("id") % 3).cast("string").alias("category_id"),
        (F.col("id") * 10).cast("string").alias("views"),
        F.col("id").cast("string").alias("likes"),
        F.lit(None).cast("string").alias("dislikes"),
        F.lit("1").alias("comment_count"),
        F.concat(F.lit("2024-01-0"), (F.col("id") % 4 + 1).cast("string")).alias("trending_date"),
        F.lit("2024-01-01 07:08:09").alias("publish_time"),
        F.expr("CASE WHEN id % 2 = 0 THEN 'USvideos.csv' ELSE 'GBvideos.csv' END")
        .alias("source_file"),
    )


def test_load_into_catalog_tables(spark, raw):
    summary = load.job_load_tables(raw, "loaded").first()
    assert tuple(summary) == (150, 400, 2, dt.date(2024, 1, 1), dt.date(2024, 1, 4))
    names = tables(spark, "loaded")
    assert names == {
        "trending_facts", "channel_statistics", "category_trends", "time_series_metrics",
    }
    facts = spark.table("loaded.trending_facts")
    assert [r["dislikes"] for r in facts.limit(1).collect()] == [0]
    one_day = facts.filter("trending_date = DATE'2024-01-02' AND country = 'US'")
    assert "PartitionFilters: [isnotnull(trending_date" in plan(one_day)
    high = facts.filter("views > 3000").select("video_id")
    assert "PushedFilters: [IsNotNull(views), GreaterThan(views,3000)]" in plan(high)
    assert "ReadSchema: struct<video_id:string,views:bigint>" in plan(high)
    sinks.collect_statistics(spark, [f"loaded.{n}" for n in sorted(names)])
    detail = spark.sql("DESCRIBE EXTENDED loaded.trending_facts").filter("col_name = 'Statistics'")
    assert "400 rows" in detail.first()["data_type"]


def test_bucketed_table_groups_without_a_shuffle(spark, raw):
    series = aggregates.time_series_metrics(load.load_facts(raw))
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    sinks.write_table(series, "bucketed.series", ["country"], (10, "date_key"))
    by_day = spark.table("bucketed.series").groupBy("date_key").agg(F.sum("total_views"))
    assert "Exchange" not in plan(by_day)
    assert rows(by_day) == rows(series.groupBy("date_key").agg(F.sum("total_views")))


def test_created_tables(spark, tmp_path):
    sinks.create_tables(spark, "model")
    sinks.create_tables(spark, "model")
    assert tables(spark, "model") == {
        "fact_videos", "dim_channels", "dim_categories", "channel_statistics",
        "category_trends", "time_series_metrics", "streaming_videos",
    }
    category_dimension(spark).write.insertInto("model.dim_categories")
    assert spark.table("model.dim_categories").count() == 14
    assert aggregates.repeated_keys(
        spark.table("model.dim_categories"), ["category_id"]
    ).count() == 0


def test_external_csv(spark, tmp_path):
    header = ",".join(RAW_TRENDING.names)
    line = "v1,2024-01-02,\"a, b\",ch,10,2024-01-01 00:00:00,x|y,5,1,0,2,,true,false,false,d,US"
    (tmp_path / "raw.csv").write_text(f"{header}\n{line}\n")
    spark.sql("CREATE DATABASE IF NOT EXISTS ext")
    sinks.create_external_csv(spark, "ext.raw", str(tmp_path))
    row = spark.table("ext.raw").first()
    assert (row["title"], row["views"], row["comments_disabled"]) == ("a, b", 5, True)


def test_rerun_replaces_only_its_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    two = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    sinks.replace_partitions(two, path, ["p"])
    sinks.replace_partitions(two.filter("p = 'b'").withColumn("v", F.lit(9)), path, ["p"])
    assert rows(spark.read.orc(path)) == [(1, "a"), (9, "b")]


def day(raw, n):
    return raw.filter(F.col("trending_date") == f"2024-01-0{n}")


def test_loads_keep_other_days(spark, raw, tmp_path):
    """Two days loaded one by one, the first once more: both are there, once."""
    want = raw.filter(F.col("trending_date") <= "2024-01-02").count()
    enriched = raw.withColumn("tags", F.lit("a")).withColumns(
        {c: F.col(c).cast("int") for c in ("views", "likes", "comment_count", "dislikes")}
    )
    for n in (1, 2, 1):
        paths = load.job_load(day(raw, n), f"{tmp_path}/load")
        load.job_batch_enrich(day(enriched, n), f"{tmp_path}/enrich")
        load.job_load_tables(day(raw, n), "history")
        filled = load.job_fill_tables(day(raw, n), "filled")
    assert spark.read.orc(paths["facts"]).count() == want
    assert spark.read.orc(f"{tmp_path}/enrich").count() == want
    assert spark.table("history.trending_facts").count() == want
    assert spark.table(filled["fact_videos"]).count() == want
    for videos in (
        spark.read.orc(paths["channel_statistics"]),
        spark.table("history.channel_statistics"),
        spark.table(filled["channel_statistics"]),
    ):
        whole = aggregates.channel_statistics(spark.read.orc(paths["facts"]))
        assert rows(videos.select("channel_title", "country", "total_views")) == rows(
            whole.select("channel_title", "country", "total_views")
        )


def test_channels_that_a_load_does_not_name_stay(spark, raw):
    """Two loads of different channels, the second again with one that both have."""
    titled = raw.withColumn("channel_title", F.when(F.col("channel_title") != "ch4", F.col("channel_title")))
    ch = F.col("channel_title")
    first = titled.where(ch.isin("ch0", "ch1") | ch.isNull())
    second = titled.where(ch.isin("ch1", "ch2", "ch3"))
    for part in (first, second, second):
        # the same days come again: what is stored of them is replaced, as in every load
        named = load.job_fill_tables(part, "channels")["dim_channels"]
        dim = {r.channel_title: r for r in spark.table(named).collect()}
        assert len(dim) == spark.table(named).count() and None not in dim
        stored = spark.table("channels.fact_videos").where(ch.isNotNull()).groupBy("channel_title")
        for r in stored.agg(F.count_distinct("video_id").alias("n")).collect():
            assert dim[r.channel_title].total_videos == r.n
            assert dim[r.channel_title].subscriber_count is None
    assert set(dim) == {"ch0", "ch1", "ch2", "ch3"}


def test_channel_dimension_edges(spark):
    schema = "channel_title string, video_id string, category_id int, extra int"
    rows_ = [("a", "v", 10, 1), ("a", "v", 10, 1), ("a", "w", 1, 1), ("a", None, 1, 1),
             ("b", "v", None, 1), (None, "x", 1, 1), ("", "v", 999, 1)]
    got = {r.channel_title: r for r in aggregates.channel_dimension(spark.createDataFrame(rows_, schema)).collect()}
    assert {k: r.total_videos for k, r in got.items()} == {"a": 2, "b": 1, "": 1}
    # a tie between categories 1 and 10 goes to the smaller one
    assert {k: r.channel_type for k, r in got.items()} == {"a": "Film & Animation", "b": None, "": None}
    assert aggregates.channel_dimension(spark.createDataFrame([], schema)).count() == 0


def stored_files(folder):
    return {p.relative_to(folder): p.stat().st_mtime_ns for p in folder.rglob("part-*.orc")}


def test_a_load_rewrites_only_the_partitions_it_touches(spark, raw, tmp_path):
    """A day of January and one of February, then the second country's day of February again."""
    dated = raw.withColumn(
        "trending_date", F.when(F.col("trending_date") == "2024-01-01", "2024-01-31").otherwise("2024-02-01")
    )
    load.job_load(dated, f"{tmp_path}/load")
    folder = tmp_path / "load"
    before = {n: stored_files(folder / n) for n in ("category_trends", "channel_statistics", "facts")}
    country = spark.read.orc(f"{folder}/facts").agg(F.max("country")).first()[0]
    part = load.load_facts(dated).where((F.col("country") == country) & (F.col("trending_date") == "2024-02-01"))
    again = dated.join(part.select("video_id").distinct(), "video_id", "left_semi").where(
        F.col("trending_date") == "2024-02-01"
    )
    countries = {r[0] for r in load.load_facts(again).select("country").distinct().collect()}
    paths = load.job_load(again, f"{tmp_path}/load")
    for name, old in before.items():
        kept = old.items() & stored_files(folder / name).items()
        outside = {
            f for f in old
            if not any(f"country={c}" in str(f) for c in countries)
            or (name == "category_trends" and "month=1" in str(f))
            or (name == "facts" and "2024-01" in str(f))
        }
        assert {f for f, _ in kept} == outside
    whole = aggregates.category_trends(spark.read.orc(paths["facts"]))
    columns = ["category_id", "year", "month", "country", "video_count", "total_views"]
    assert rows(spark.read.orc(paths["category_trends"]).select(*columns)) == rows(whole.select(*columns))


def test_touched_partitions_with_nulls(spark):
    facts = spark.createDataFrame(
        [("2024-01-05", "US"), ("2024-02-05", "US"), ("2024-01-07", None), (None, "GB"), ("2023-01-01", "GB")],
        "trending_date string, country string",
    ).withColumn("trending_date", F.col("trending_date").cast("date"))
    given = facts.withColumn("country", F.coalesce("country", F.lit("")))  # as it is before it is stored
    changes = load.Changes.of(given.where("country = '' OR trending_date IS NULL OR month(trending_date) = 2"))
    by_month = rows(facts.where(changes.touched(["year", "month", "country"])))
    assert {(str(d), c) for d, c in by_month} == {("2024-02-05", "US"), ("2024-01-07", None), ("None", "GB")}
    assert {r[1] for r in facts.where(changes.touched(["country"])).collect()} == {"US", None, "GB"}
    assert facts.where(changes.touched(["country"])).count() == 5
    assert facts.where(changes.touched([])).count() == 5
    assert facts.where(load.Changes(frozenset()).touched(["country"])).count() == 0


def test_batch_enrich_metrics(spark, raw, tmp_path):
    source = raw.withColumn("tags", F.lit("a|b")).withColumns(
        {c: F.col(c).cast("int") for c in ("views", "likes", "comment_count")}
    ).withColumn("dislikes", F.lit(1))
    metrics = load.job_batch_enrich(source, f"{tmp_path}/out")
    assert (metrics.records, metrics.partitions) == (400, 4)
    stored = spark.read.orc(f"{tmp_path}/out")
    before = aggregates.text_size(source).first()[0]
    after = aggregates.text_size(stored).first()[0]
    assert metrics.saved_percent == pytest.approx((1 - after / before) * 100)
    assert stored.filter("views = 0").select("engagement_rate").first()[0] is None


def test_cache_is_the_callers(spark):
    kept = sinks.keep_for_reuse(spark.range(10))
    assert kept.count() == 10 and kept.storageLevel.useMemory and kept.storageLevel.useDisk
    kept.unpersist()


def test_reach_rolls_up_from_stored_sketches(spark, tmp_path):
    """Merged sketches equal one over all rows, within and beyond the exact range."""
    days = spark.range(200_000).select(
        (F.col("id") % 90_000).cast("string").alias("video_id"),
        F.when(F.col("id") % 50 == 0, "small").otherwise("large").alias("channel_title"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 97).cast("int")).alias("trending_date"),
        F.element_at(F.array(F.lit("US"), F.lit("GB")), (F.col("id") % 2 + 1).cast("int")).alias("country"),
    )
    aggregates.channel_reach(days).write.parquet(f"{tmp_path}/reach")
    stored = spark.read.parquet(f"{tmp_path}/reach")
    got = {r[0]: (r[1], r[2]) for r in aggregates.roll_up_reach(stored, "channel_title").collect()}
    exact = {
        r[0]: (r[1], r[2])
        for r in days.groupBy("channel_title").agg(F.count("*"), F.count_distinct("video_id")).collect()
    }
    assert got["small"] == exact["small"]
    assert got["large"][0] == exact["large"][0]
    assert abs(got["large"][1] / exact["large"][1] - 1) < 0.02


def test_what_a_load_names_is_found_in_one_pass(spark, raw, monkeypatch):
    """Channels and partitions come from a stored narrow frame, not from the input again."""
    seen = []
    update, of = load.update_channels, load.Changes.of
    monkeypatch.setattr(load, "update_channels", lambda f, *rest: (seen.append(f), update(f, *rest)))
    monkeypatch.setattr(load.Changes, "of", lambda f: (seen.append(f), of(f))[1])
    load.job_fill_tables(day(raw, 1), "named_once")
    assert len(seen) == 2
    for frame in seen:
        assert frame.columns == ["channel_title", "trending_date", "country"]
        assert frame.inputFiles() and all("/named-" in f for f in frame.inputFiles())
