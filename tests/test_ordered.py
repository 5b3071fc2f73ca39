"""Routed windows must equal the built-in ones, whatever makes a key hot."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tests.conftest import rows
from trendloom.operators import ordered as o

#: All keys hot, some of them, none.
HOT = [5, 400, 10**9]


@pytest.fixture(scope="module")
def frame(spark):
    # key 'hot' and the NULL key hold most rows; values repeat and are partly NULL
    return (
        spark.range(3000)
        .withColumn("k", F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL "
                                "ELSE concat('k', id % 40) END"))
        .withColumn("d", F.expr("CASE WHEN id % 13 > 0 THEN cast(id * 7919 % 500 as int) END"))
        .withColumn("v", F.expr("CASE WHEN id % 11 = 0 THEN NULL ELSE id * 31 % 97 END"))
    )


@pytest.mark.parametrize("hot", HOT)
@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_row_windows(frame, keys, hot, direction):
    w = W.partitionBy(*keys).orderBy(F.col("d").asc() if direction == "asc" else F.col("d").desc(), "id")
    want = frame.select(
        "*",
        F.lag("v").over(w).alias("prev"),
        F.round(F.avg("v").over(w.rowsBetween(-7, 0)), 9).alias("mov"),
        F.sum("v").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("run"),
        F.row_number().over(w).cast("bigint").alias("pos"),
    )
    got = o.ordered_windows(
        frame, keys, [("d", direction), "id"], "v",
        previous="prev", moving=("mov", 7), running="run", position="pos", hot_rows=hot,
    ).withColumn("mov", F.round("mov", 9))
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_text_order_and_another_frame_to_read(frame):
    base = frame.withColumn("t", F.concat(F.lit("t"), F.col("id") % 900))
    w = W.partitionBy("k").orderBy("t", "id")
    want = base.select("*", F.lit(1).alias("x"), F.lag("v").over(w).alias("prev"))
    wide = base.withColumn("x", F.lit(1))
    got = o.ordered_windows(wide, ["k"], ["t", "id"], "v", previous="prev", of=base, hot_rows=50)
    assert rows(got) == rows(want)
    with pytest.raises(ValueError, match="downwards"):
        o.ordered_windows(base, ["k"], [("t", "desc")], "v", previous="prev")


def test_several_keys_with_nulls(frame):
    keyed = frame.withColumn("k2", F.expr("CASE WHEN id % 5 > 1 THEN 1 END"))
    w = W.partitionBy("k", "k2").orderBy("d", "id")
    want = keyed.select("*", F.sum("v").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("run"))
    got = o.ordered_windows(keyed, ["k", "k2"], ["d", "id"], "v", running="run", hot_rows=100)
    assert rows(got) == rows(want)


def test_only_hot_keys_are_cut_and_evenly(frame):
    keyed = frame.withColumn("_tie", F.xxhash64("k", "d", "v", "id"))
    key = o._sort_key(keyed, [("d", "asc"), ("id", "asc")])
    hot = o.hot_keys(keyed, [["k"]], 100)[("k",)]
    borders = o._borders(keyed, hot, ["k"], key).cache()
    sizes = o._with_slices(keyed, borders, ["k"], key, "left").groupBy("k", "_slice").count().collect()
    by = {}
    for r in sizes:
        by.setdefault(r["k"], []).append(r["count"])
    assert {k for k, n in by.items() if len(n) > 1} == {"hot", None}
    assert len(by["hot"]) > 6 and max(by["hot"]) < 300  # 1000 rows


def test_ties_and_one_key_are_spread_over_slices(spark):
    df = spark.range(20_000).select(F.lit("a").alias("k"), F.lit(1).alias("d"), F.col("id").alias("v"))
    got = o.ordered_windows(df, ["k"], ["d"], "v", position="pos", hot_rows=1000)
    assert got.agg(F.min("pos"), F.max("pos"), F.countDistinct("pos")).first()[:] == (1, 20_000, 20_000)
    keyed = df.withColumn("_tie", F.xxhash64("k", "d", "v"))
    key = o._sort_key(keyed, [("d", "asc")])
    hot = o.hot_keys(keyed, [["k"]], 1000)[("k",)]
    sliced = o._with_slices(keyed, o._borders(keyed, hot, ["k"], key), ["k"], key, "left")
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert len(sizes) > 12 and max(sizes) < 3_000


def test_no_more_slices_than_may_be_broadcast(frame, monkeypatch):
    monkeypatch.setattr(o, "MOST_SLICES", 6)
    keyed = frame.withColumn("_tie", F.xxhash64("id"))
    key = o._sort_key(keyed, [("d", "asc")])
    hot = o.hot_keys(keyed, [["k"]], 1)[("k",)]
    borders = o._borders(keyed, hot, ["k"], key).agg(F.sum(F.size("_borders"))).first()[0]
    assert 0 < borders <= 12


def test_hot_keys_of_several_sets(frame):
    two = frame.withColumn("z", F.expr("CASE WHEN id % 2 = 0 THEN NULL ELSE id END"))
    found = o.hot_keys(two, [["k"], ["z"], ["k", "z"], ["id"]], 300)
    assert {k: v is not None and rows(v) for k, v in found.items()} == {
        ("k",): [("hot", 300)], ("z",): [(None, 300)], ("k", "z"): [("hot", None, 300)], ("id",): False,
    }


def test_without_hot_keys_the_plan_is_a_plain_window(frame):
    plain = o.ordered_windows(frame, ["k"], ["d", "id"], "v", previous="p")
    text = plain._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in text and text.count("Window [") == 1


def test_copies_of_one_row(spark):
    df = spark.createDataFrame([("a", 1, 2)] * 500 + [("a", 2, 3)] * 500, "k string, d int, v int")
    got = o.ordered_windows(df, ["k"], ["d"], "v", running="run", position="pos", hot_rows=10)
    assert sorted(r["pos"] for r in got.collect()) == list(range(1, 1001))
    assert sorted(r["run"] for r in got.collect()) == [*range(2, 1001, 2), *range(1003, 2501, 3)]


def test_empty_frame(frame):
    none = frame.where("id < 0")
    assert o.ordered_windows(none, ["k"], ["d"], "v", previous="p", hot_rows=1).collect() == []
    assert o.ordered_windows(none, [], ["d"], "v", previous="p", hot_rows=1).collect() == []


@pytest.mark.parametrize("hot", HOT)
def test_rank_and_percent_rank(frame, hot):
    down = W.partitionBy("k").orderBy(F.col("v").desc())
    up = W.partitionBy("k").orderBy("v")
    want = frame.select(
        "*", F.rank().over(down).cast("bigint").alias("r"), F.percent_rank().over(up).alias("p")
    )
    got = o.with_rank(frame, ["k"], "v", "r", hot_rows=hot)
    got = o.with_percent_rank(got, ["k"], "v", "p", hot_rows=hot)
    assert rows(got) == rows(want)
    top = o.with_rank(frame, ["k"], "v", "r", limit=5)
    assert rows(top) == rows(want.filter("r <= 5").drop("p"))


@pytest.mark.parametrize("hot", [3, 10**9])
@pytest.mark.parametrize("kind", ["bigint", "double", "decimal(12,3)"])
def test_exact_quantiles(frame, kind, hot):
    """With few rows a task, ranges are cut again until they hold one value."""
    probs = {"q1": 0.25, "med": 0.5, "p95": 0.95}
    df = frame.withColumn("v", (F.col("v") - 30).cast(kind))
    if kind != "bigint":
        df = df.withColumn("v", (F.col("v") / 7).cast(kind))
    disc = o.exact_quantiles(df, ["k"], "v", probs, hot_rows=hot)
    want = df.groupBy("k").agg(
        *[F.percentile_approx("v", p, 1_000_000).alias(n) for n, p in probs.items()]
    )
    assert rows(disc) == rows(want)
    cont = o.exact_quantiles(df, [], "v", probs, interpolate=True, hot_rows=hot)
    want = df.agg(*[F.percentile("v", p).alias(n) for n, p in probs.items()])
    assert [round(float(x), 9) for x in cont.first()] == [round(x, 9) for x in want.first()]


def test_quantiles_without_values(frame):
    probs = {"med": 0.5}
    none = frame.where("v IS NULL")
    assert o.exact_quantiles(none, [], "v", probs, interpolate=True).first()[:] == (None,)
    assert o.exact_quantiles(none, ["k"], "v", probs).collect() == []


SPECIAL = [0.0, -0.0, 1e-300, 5e-324, 1e300, float("inf"), float("-inf"), float("nan"), 1.0, -1.0]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from(SPECIAL) | st.floats(-1e6, 1e6), min_size=1, max_size=40))
def test_quantiles_of_any_doubles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probs = {"a": 0.0, "b": 0.3, "c": 0.5, "d": 1.0}
    got = o.exact_quantiles(df, [], "v", probs).first()
    order = sorted(values, key=lambda v: (v != v, v))
    want = [order[max(1, -int(-len(order) * p // 1)) - 1] for p in probs.values()]
    assert [str(x + 0.0) for x in got] == [str(x + 0.0) for x in want]


def test_quantiles_of_extreme_whole_numbers(spark):
    values = [-(2**63), -(2**63) + 1, 2**63 - 1, 2**53 + 1, 2**53, 0, -1]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    probs = {f"q{i}": (i + 1) / 7 for i in range(7)}
    assert list(o.exact_quantiles(df, [], "v", probs).first()) == sorted(values)


def test_numbered(frame):
    got = o.numbered(frame.select("id"), ["id"], "place").collect()
    assert sorted((r["id"], r["place"]) for r in got) == [(i, i) for i in range(3000)]
    assert o.numbered(frame.select("id").where("id < 0"), ["id"], "place").collect() == []


def test_top_n_trims_before_the_shuffle(frame):
    plan = o.top_ranks(frame, ["k"], "v", "r", 5)._jdf.queryExecution().executedPlan().toString()
    trims = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert any("Partial" in t for t in trims) and any("Final" in t for t in trims)


def test_a_row_meets_few_borders_however_many_slices_its_key_has(spark):
    """All borders of a key in one array were copied for every row of it."""
    df = spark.range(5000).select(F.lit("a").alias("k"), F.col("id").alias("d"), F.lit(0).alias("_tie"))
    key = o._sort_key(df, [("d", "asc")])
    even = df.where("d % 2 = 0").select("k", key.alias("_key"))
    borders = even.groupBy("k").agg(F.array_sort(F.collect_list("_key")).alias("_borders"))
    sizes = [
        o._level(borders, ["k"], o._FAN ** (n + 1), o._FAN**n).agg(F.max(F.size("_at"))).first()[0]
        for n in range(o._LEVELS)
    ]
    assert max(sizes) < o._FAN and o._FAN**o._LEVELS > o.MOST_SLICES
    sliced = o._with_slices(df, borders, ["k"], key, "left")
    assert sliced.columns == [*df.columns, "_slice"]
    assert [r["_slice"] for r in sliced.orderBy("d").collect()] == [d // 2 + 1 for d in range(5000)]


def test_the_driver_learns_no_keys(frame, monkeypatch):
    """All keys above ``hot_rows`` came to the driver, most of them below the size of a slice."""
    monkeypatch.setattr(o, "MOST_SLICES", 6)
    learnt, collect = [], type(frame).collect

    def counted(df):
        learnt.append(collect(df))
        return learnt[-1]

    monkeypatch.setattr(type(frame), "collect", counted)
    found = o.hot_keys(frame, [["k"], ["id"], ["d"]], 0)
    assert sum(len(r) for r in learnt) <= 4  # one for each set and one for all rows
    assert found["id",] is None and found["d",] is None
    assert rows(found["k",]) == [("hot", 500)]


def test_levels_below_the_root_share_a_broadcast(spark, frame):
    """Each level was a broadcast of its own, held by the driver while the plan runs."""
    keyed = frame.withColumn("_tie", F.xxhash64("id"))
    key = o._sort_key(keyed, [("d", "asc")])
    borders = o.materialise(o._borders(keyed, o.hot_keys(keyed, [["k"]], 100)["k",], ["k"], key), "borders")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else exchanges are shared as they run
    try:
        sliced = o._with_slices(keyed, borders, ["k"], key, "left")
        text = sliced._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    made = [x for x in text.splitlines() if "BroadcastExchange" in x and "Reused" not in x]
    assert text.count("BroadcastHashJoin") == o._LEVELS and len(made) <= 2


def test_ranks_of_hot_keys_count_values_once(frame):
    text = o.value_ranks(frame, ["k"], "v", hot_rows=20)._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in text  # the rows themselves
