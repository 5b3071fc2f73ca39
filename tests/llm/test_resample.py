import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from tests.llm.conftest import EDGE
from trendloom.llm import resample
from trendloom.llm.queries import QUERIES, table


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, target, runs=1, buckets=10_000, seed=2024, percent=10, least=20):
    """From the definition: rows of (doc, n_features, weight, score, rank)."""

    def feats(text):
        w = words(text)
        out = [" ".join(w[i : i + n]) for n in range(1, runs + 1) for i in range(len(w) - n + 1)]
        return len(w), [zlib.crc32(f.encode()) % buckets for f in out]

    s, t = [0] * buckets, [0] * buckets
    made = [(d, *feats(x)) for d, x in docs]
    for _, _, f in made:
        for b in f:
            s[b] += 1
    for x in target:
        for b in feats(x)[1]:
            t[b] += 1
    sa, ta = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sa + buckets) / ((s[b] + 1) * (ta + buckets)))) for b in range(buckets)]
    rows = []
    for i, (d, n, f) in enumerate(made):
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([d, len(f), weight, score, None, n >= least, i])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[6]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted(map(str, (tuple(r[:5]) for r in rows)))


def got(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_query_equals_brute_force(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    target = [r["text"] for r in table(spark, sf_dir, "benchmark").collect()]
    assert got(QUERIES["op11_resample"](spark, sf_dir)) == brute(docs, target)


@pytest.mark.parametrize("runs,percent", [(1, 0), (1, 50), (2, 100), (3, 37)])
def test_edge_rows(spark, edge, runs, percent):
    draw = resample.Draw(runs=runs, buckets=97, seed=5, percent=percent, least_words=3, pivots=2)
    target = ["the of and To", None, "", "ümläut x"]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "_row bigint, text string")
    made = got(resample.resample(edge, frame, draw))
    assert made == brute([(r[0], r[1]) for r in EDGE], target, runs, 97, 5, percent, 3)


def test_empty_tables(spark, nothing, edge):
    target = spark.createDataFrame([], "text string")
    assert resample.resample(nothing, target).collect() == []
    assert got(resample.resample(edge, target)) == brute([(r[0], r[1]) for r in EDGE], [])


@pytest.mark.parametrize("pivots", [1, 4, 15])
def test_kth_key_with_ties(spark, pivots):
    rng = random.Random(pivots)
    rows = [(rng.choice([5, 5, 5, -2, 9, rng.randrange(100)]), rng.choice([None, 3, 3, rng.randrange(40)]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "score bigint, _doc bigint, _row bigint").repartition(4).cache()
    ordered = sorted(rows, key=lambda r: (-r[0], r[1] is not None, r[1] or 0, r[2]))
    for k in (1, 2, 150, 299, 300):
        assert resample.kth_key(df, k, pivots, seed=k) == ordered[k - 1]


def test_gains():
    made = resample.gains(np.array([3, 0, 0]), np.array([0, 0, 7]))
    assert made.tolist() == [math.floor(1000 * math.log(x)) for x in (1 * 6 / (4 * 10), 1 * 6 / 10, 8 * 6 / 10)]


def test_limits():
    for wrong in ({"buckets": 0}, {"buckets": 70_000}, {"runs": 0}, {"pivots": 0}):
        with pytest.raises(ValueError):
            resample.Draw(**wrong)
