import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from trendloom.operators import cleaning, reshape
from trendloom.operators.cleaning import CleanConfig, clean


@pytest.fixture(scope="module")
def raw(spark):
    lines = [
        ("a", "t1", "2024-01-01", "10", "1", "1", "10", "PT1M", "US.csv"),
        ("a", "t2", "2024-01-01", "11", "1", "1", "10", "PT1M", "GB.csv"),  # first by file
        ("a", "t3", "2024-01-02", "12", "1", "1", "10", "PT1M", "US.csv"),
        ("b", None, "2024-01-01", "10", "1", "1", "10", "PT1M", "US.csv"),
        ("c", "t5", "never", "x", "3", "", "99", "oops", "US.csv"),
        ("d", "t6", "2024-01-01", "12.9", "0", "0", None, None, "US.csv"),
        ("e", "t7", "2024-01-01", "13", "1", "1", "2", "P0D", "US.csv"),
        ("f", "t8", "2024-01-01", "100000", "1", "1", "2", "P0D", "US.csv"),
    ]
    return spark.createDataFrame(
        lines,
        "video_id string, title string, trending_date string, views string, likes string, "
        "dislikes string, category_id string, duration string, source_file string",
    )


def test_cleaning_in_order(raw):
    # titled views are 0 11 12 12 13 100000: both ends lie outside
    out, report = clean(raw, CleanConfig(exact=True))
    got = {r["title"]: r for r in out.collect()}
    assert set(got) == {"t2", "t3", "t6", "t7"}
    assert got["t6"]["views"] == 12 and got["t6"]["like_ratio"] == 0
    assert got["t2"]["category_name"] == "Music" and got["t2"]["duration_sec"] == 60
    assert tuple(report.first()) == (8, 1, 1, 2, 4, 50.0)


def test_unreadable_values(raw):
    out, _ = clean(raw, CleanConfig(outlier_k=None))
    row = out.filter("title = 't5'").first()
    assert row["views"] == 0 and row["trending_date"] is None
    assert row["engagement_rate"] == 3 and row["like_ratio"] == 1
    assert row["category_name"] == "Unknown" and row["duration_sec"] == 0


def test_key_of_the_video_alone(raw):
    out, report = clean(raw, CleanConfig(keys=("video_id",), outlier_k=None))
    assert report.first()["duplicates"] == 2
    assert out.filter("video_id = 'a'").count() == 1


def test_absent_columns_skip_their_steps(spark):
    df = spark.createDataFrame(
        [("x", "5", "7"), ("x", "6", "8")], "id string, view_count string, like_count string"
    )
    out, report = clean(df)
    assert out.columns == ["id", "view_count", "like_count"]
    assert rows(out) == [("x", 5, 7), ("x", 6, 8)]
    assert report.first()["kept_rows"] == 2


@pytest.mark.parametrize("exact", [True, False])
def test_outlier_bounds_are_inclusive(spark, exact):
    # Q1 = 10, Q3 = 20, so k = 1 keeps [0, 30]
    df = spark.createDataFrame(
        [(v,) for v in (10, 10, 10, 10, 20, 20, 20, 20, 30, 31, 0, -1)], "v long"
    )
    kept = cleaning.iqr_filter(df, "v", 1.0, exact=exact)
    assert -1 not in [r[0] for r in kept.collect()]
    assert {0, 30} <= {r[0] for r in kept.collect()}
    assert 31 not in [r[0] for r in kept.collect()]


def test_outliers_are_kept_when_the_sum_is_not_positive(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (-50,)], "v long")
    assert cleaning.iqr_filter(df, "v", exact=True).count() == 4


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([(2.5, 2)], "d double, i int")
    assert rows(reshape.union_by_name([a, b])) == [(1, "x", None), (2, None, 2.5)]


def test_dedupe_takes_the_first_in_order(spark):
    df = spark.createDataFrame([("k", 2), ("k", 1), ("j", 3)], "k string, o int")
    assert rows(reshape.dedupe_first(df, ["k"], ["o"])) == [("j", 3), ("k", 1)]
    assert rows(reshape.dedupe_first(df, ["k"], [F.col("o").desc()])) == [("j", 3), ("k", 2)]
