import json

from pyspark.sql import functions as F

from trendloom.functions import category_name
from trendloom.operators import aggregates, reshape, topics
from trendloom.plans import summary
from trendloom.sources import files, sinks
from trendloom.sources import starschema as star


def test_summary_document(spark, sf_dir, tmp_path):
    facts = star.facts_daily(spark, sf_dir).withColumn(
        "category_name", category_name(unknown="Unknown")
    )
    path = f"{tmp_path}/summary"
    sinks.write_summary(summary.summary_document(facts, exact=True), path)
    (part,) = (tmp_path / "summary").glob("part-*.json")
    doc = json.loads(part.read_text())
    assert doc["total_videos"] == facts.count()
    assert doc["top_category"] == "Unknown"
    assert len(doc["correlations"]) == 3 and len(doc["top_countries"]) == 5
    assert doc["top_categories"][0]["count"] >= doc["top_categories"][-1]["count"]
    assert doc["analysis_date"]


def test_approximate_summary_is_close(spark, sf_dir):
    facts = star.facts_daily(spark, sf_dir)
    near = aggregates.basic_stats(facts).first()["median_views"]
    true = aggregates.basic_stats(facts, exact=True).first()["median_views"]
    assert abs(near - true) / true < 0.01


def test_collection_summary_counts_files(spark, sf_dir):
    inventory = files.file_inventory(spark, sf_dir)
    got = summary.collection_summary(
        {"pages": star.table(spark, sf_dir, "pages"), "none": spark.range(0)}, inventory
    )
    by = {r["source"]: r for r in got.collect()}
    assert by["pages"]["status"] == "complete" and by["none"]["status"] == "missing"
    assert by["total"]["files"] == inventory.count() and by["total"]["bytes"] > 0


def test_monthly_peak_takes_the_earliest(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (DATE'2024-03-01', 5, 1.0), (DATE'2024-01-01', 5, 1.0), "
        "(DATE'2024-02-01', 2, 1.0) AS t(month, videos, avg_views)"
    )
    row = aggregates.monthly_summary(df).first()
    assert (str(row["peak_month"]), row["peak_videos"], row["avg_per_month"]) == (
        "2024-01-01", 5, 4.0,
    )


def test_ties_have_fixed_winners(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 0)], "k string, v int")
    assert aggregates.mode_value(df, "k").first()["k"] == "a"
    assert [r["k"] for r in reshape.top_sums(df, "k", "v", 2).collect()] == ["a", "b"]


def test_tiers_cover_all_rows(spark, sf_dir):
    facts = star.facts_daily(spark, sf_dir)
    tiers = topics.viral_factors(facts)
    assert tiers.agg(F.sum("video_count")).first()[0] == facts.count()
    strategies = topics.channel_strategies(facts)
    profiles = topics.channel_profiles(facts)
    assert strategies.agg(F.sum("channel_count")).first()[0] == profiles.count()


def test_growth_uses_the_previous_month_present(spark):
    df = spark.sql(
        "SELECT DATE'2024-01-05' AS trending_date, 1 AS category_id, 100L AS views, "
        "0.1D AS engagement_rate UNION ALL SELECT DATE'2024-03-09', 1, 150L, 0.1D "
        "UNION ALL SELECT DATE'2024-03-10', 2, 10L, 0.1D"
    )
    (row,) = topics.category_evolution(df).collect()
    assert (str(row["month"]), row["growth_rate"], row["monthly_rank"]) == ("2024-03-01", 50.0, 1)


def test_manifest_filter(spark):
    rows = [
        (1, "a.csv", 5.0, 10), (2, "B.JSON", 99.0, 30), (3, "c.csv", 100.0, 50),
        (4, "d.csv", 0.0, 60), (5, "e.png", 5.0, 70), (6, "f.tsv.gz", 5.0, 20),
    ]
    manifest = spark.createDataFrame(
        rows, "key int, filename string, size_mb double, downloads int"
    )
    usable = reshape.usable_files(manifest)
    assert [r["key"] for r in reshape.most_downloaded(usable, 3).collect()] == [2, 6, 1]
