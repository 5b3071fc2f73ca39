"""Plans that must hold at scale, and skew-split jobs that must not change rows."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from trendloom.operators import aggregates, joins, reshape, topics
from trendloom.plans import trending
from trendloom.schemas import category_dimension
from trendloom.sources import starschema as star


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def daily(spark, sf_dir):
    return star.facts_daily(spark, sf_dir)


def test_small_dimension_is_broadcast(spark, daily):
    joined = joins.join_dimension(daily, category_dimension(spark), "category_id")
    assert "BroadcastHashJoin" in plan(joined)


def test_large_dimension_is_not_hinted(daily):
    assert joins.broadcast_if_small(daily, limit=1) is daily


def test_tiers_keep_rows_out_of_global_windows(daily):
    text = plan(topics.viral_factors(daily))
    main = text[: text.index("Subquery")] if "Subquery" in text else text
    assert "Window " not in main and "SinglePartition" not in main


def test_dedupe_trims_before_the_shuffle(daily):
    text = plan(reshape.dedupe_first(daily, ["video_id"], star.OBSERVATION_ORDER))
    below = text[text.rindex("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_channel_statistics_reads_facts_once(daily):
    text = plan(aggregates.channel_statistics(daily))
    assert text.count("lineitem.parquet") == 1
    assert "Join" in text  # only the joins to the parents
    assert "SortMergeJoin" not in text


def test_unused_columns_are_not_read(daily):
    text = plan(aggregates.monthly_series(daily))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_extendedprice:double," in text
    assert "l_tax" not in text and "l_quantity" not in text


def test_trending_does_not_depend_on_what_is_hot(daily):
    digits = {"channel_7day_avg": F.round("channel_7day_avg", 6)}
    got = []
    for limit in (10**9, 40):  # none of the keys, most of them
        made = trending.trending_analysis(daily, 3, hot_rows=limit).withColumns(digits)
        got.append(rows(made))
        assert ("_slice" in plan(made)) == (limit == 40)
    assert got[0] == got[1] and got[0]


def test_trending_of_hot_keys_joins_the_sources_once(daily):
    """Each slicing and ranking read and joined the tables, and broadcast the small ones anew."""
    text = plan(trending.trending_analysis(daily, 3, hot_rows=40))
    assert "lineitem.parquet" not in text and "supplier.parquet" not in text


def test_exact_quantiles_order_counts_only(daily):
    """The only windows are over counts of ranges and of single values."""
    text = plan(aggregates.basic_stats(daily, exact=True))
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert windows and all("_n#" in line for line in windows)


def test_left_join_keeps_null_keys_unmatched(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "k string, v int")
    right = spark.createDataFrame([("a", 1), ("a", 2), (None, 1)], "k string, rn int")
    got = joins.left_join_where(left, right, ["k"], F.col("rn") == 1)
    assert rows(got) == [("a", 1, 1), ("c", 3, None), (None, 2, None)]


def test_single_scan_equals_joined_channel_statistics(spark):
    df = spark.createDataFrame(
        [
            ("c", "US", 1, "v1", 10, 1, 0.5), ("c", "US", 2, "v1", 20, 2, None),
            ("c", "US", None, "v2", 30, 3, 0.1), ("c", "US", None, "v3", None, None, 0.2),
            (None, "US", 5, "v4", 5, 1, 0.3), ("d", None, 6, None, 7, 1, 0.4),
            ("e", "GB", 2, "v5", 1, 1, 0.1), ("e", "GB", 1, "v6", 1, 1, 0.1),
        ],
        "channel_title string, country string, category_id int, video_id string, "
        "views long, likes int, engagement_rate double",
    )
    rate = {"avg_engagement_rate": F.round("avg_engagement_rate", 9)}
    joined = rows(aggregates.channel_statistics_joined(df).withColumns(rate))
    assert rows(aggregates.channel_statistics(df).withColumns(rate)) == joined
    mode = aggregates.channel_statistics_mode(df).collect()
    assert {tuple(r)[:2]: r["top_category"] for r in mode} == {("c", "US"): 1, (None, "US"): 5, ("d", None): 6, ("e", "GB"): 1}
