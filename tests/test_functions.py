"""Edge rows for the column functions, under ANSI mode."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from trendloom import functions as fn


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(
        [
            (1, 100, 10, 5, 2),
            (2, 0, 10, 5, 2),
            (3, None, 10, 5, 2),
            (4, -5, 10, 5, 2),
            (5, 100, None, 5, 2),
            (6, 100, 0, 0, 2),
            (7, 100, 10, None, None),
        ],
        "id int, views long, likes int, dislikes int, comment_count int",
    )


def values(df, column):
    return [r[0] for r in df.orderBy("id").select(column).collect()]


def test_engagement_variants(facts):
    assert values(facts, fn.engagement_rate()) == [0.12, 0, 0, 0, 0.02, 0.02, 0.1]
    assert values(facts, fn.engagement_rate("unguarded")) == [
        0.12, None, None, -2.4, None, 0.02, None,
    ]
    assert values(facts, fn.engagement_rate("cleaner")) == [0.1, 10, 0, -2, 0, 0, 0.1]
    with pytest.raises(ValueError):
        fn.engagement_rate("other")


def test_like_ratio_variants(facts):
    third = 10 / 15
    assert values(facts, fn.like_ratio()) == [third, third, third, third, 0, 0, 0]
    assert values(facts, fn.like_ratio("unguarded")) == [third] * 4 + [None, None, None]
    assert values(facts, fn.like_ratio("cleaner")) == [third] * 4 + [0, 0, 0]
    assert values(facts, fn.like_ratio("cleaner", dislikes=None)) == [1, 1, 1, 1, 0, 0, 1]


def test_virality_and_growth(facts):
    got = values(facts.withColumn("engagement_rate", F.lit(0.5)), fn.virality_score())
    assert got[0] == pytest.approx(math.log10(100) * 50)
    assert got[1:4] == [None, None, None]
    pairs = facts.sparkSession.createDataFrame(
        [(1, 15, 10), (2, 15, None), (3, 15, 0)], "id int, v long, p long"
    )
    assert values(pairs, fn.growth_pct(F.col("v"), F.col("p"))) == [50.0, 0.0, None]


def test_time_segments(spark):
    hours = spark.createDataFrame([(h,) for h in (0, 5, 6, 11, 12, 17, 18, 23)], "id int")
    assert values(hours, fn.time_segment(F.col("id"))) == [
        "Late Night", "Late Night", "Morning", "Morning",
        "Afternoon", "Afternoon", "Prime Time", "Prime Time",
    ]


@pytest.mark.parametrize(
    ("text", "number"),
    [("12.7", 12), ("-3.9", -3), ("abc", 0), ("", 0), ("NaN", 0), ("1e30", 0), (None, 0),
     (" 42 ", 42)],
)
def test_coerce_long(spark, text, number):
    df = spark.createDataFrame([(1, text)], "id int, t string")
    assert values(df, fn.coerce_long("t")) == [number]


def test_coerce_timestamp(spark):
    df = spark.createDataFrame(
        [(1, "2024-02-29"), (2, "2023-02-29"), (3, "x"), (4, None)], "id int, t string"
    )
    want = [dt.datetime(2024, 2, 29), None, None, None]
    assert values(df, fn.coerce_timestamp("t")) == want
    assert values(df, fn.coerce_timestamp("t", "yyyy-MM-dd")) == want
    odd = spark.createDataFrame([(1, "17.14.11")], "id int, t string")
    assert values(odd, fn.coerce_timestamp("t", "yy.dd.MM")) == [dt.datetime(2017, 11, 14)]


def test_durations(spark):
    cases = {
        "PT1H2M3S": 3723, "PT4M13.5S": 253.5, "PT4M13,5S": 253.5, "P1DT2H": 93600,
        "P2W": 1209600, "P0D": 0, "P1Y": 0, "P1Y2M1D": 86400, "-PT5S": -5, "bad": 0,
        "PT5": 0, "P": 0, "a|b|c|d|e|f": 0, "": 0, None: 0,
    }
    df = spark.createDataFrame(list(enumerate(cases)), "id int, t string")
    assert values(df, fn.iso_duration_seconds("t")) == list(cases.values())


def test_country_patterns(spark):
    df = spark.createDataFrame(
        [(1, "USvideos.csv"), (2, "set_GB.csv"), (3, "nope.csv"), (4, None)],
        "id int, source_file string",
    )
    assert values(df, fn.country_from_file("loose")) == ["US", "GB", "", None]
    assert values(df, fn.country_from_file("strict")) == ["US", "", "", None]
    assert values(df, fn.country_from_file()) == ["US", "", "", "XX"]


def test_category_names(spark):
    df = spark.createDataFrame([(1, 10), (2, 3), (3, None)], "id int, category_id int")
    assert values(df, fn.category_name()) == ["Music", None, None]
    assert values(df, fn.category_name(unknown="Unknown")) == ["Music", "Unknown", "Unknown"]


def test_tags(spark):
    df = spark.createDataFrame([(1, 'a|"b c"|d'), (2, ""), (3, None)], "id int, tags string")
    assert values(df, fn.split_tags()) == [["a", '"b c"', "d"], [""], None]
    assert values(df, F.size(fn.split_tags())) == [3, 1, None]


def test_sizes(spark):
    df = spark.createDataFrame([(1, 3 * 1024**3)], "id int, b long")
    assert values(df, fn.bytes_to_mb(F.col("b"))) == [3072]
    assert values(df, fn.bytes_to_gb(F.col("b"))) == [3]


def test_whole_numbers_from_text(spark):
    text = ["12.7", "3.0", "-1.5", "9007199254740993", "", "abc", "NaN", "1e30", None]
    df = spark.createDataFrame([(t,) for t in text], "t string")
    got = df.select(fn.whole_number("t").alias("a"), fn.coerce_long("t").alias("b"), fn.whole_number("t", "int").alias("c"))
    want = [12, 3, -1, 9007199254740993, None, None, None, None, None]
    assert [r.a for r in got.collect()] == want
    assert [r.b for r in got.collect()] == [w or 0 for w in want]
    assert [r.c for r in got.collect()] == [12, 3, -1, None, None, None, None, None, None]
