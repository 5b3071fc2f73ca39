import math

import numpy as np
import pytest

from tests.llm.conftest import CLASHES
from trendloom.llm import whiten
from trendloom.llm.queries import QUERIES, table


def symmetric(values, seed=0):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    return (q * np.array(values, float)) @ q.T


CASES = {
    "spread": np.linspace(1, 50, 40),
    "geometric": 2.0 ** -np.arange(30),
    "double": [5, 5, 3, 2, 2, 2, 1],
    "near": [4, 4 + 1e-9, 4 + 2e-9, 1, 1 + 1e-7, 0.5],
    "nearer": [1, 1 + 1e-12, 1 + 1e-14, 7],
    "chain": 1 + np.arange(20) * 3e-8,
    "zeros": [3, 2, 0, 0, 0],
    "one": [2.5],
    "equal": [1] * 12,
    "huge": np.array([9, 4, 1]) * 1e14,
}


@pytest.mark.parametrize("name", CASES)
def test_eigenvectors_to_double_precision(name):
    a = symmetric(CASES[name])
    values, x = whiten.refined_eigenvectors(a)
    top = max(abs(np.array(CASES[name], float)))
    assert np.allclose(values, np.sort(np.array(CASES[name], float))[::-1], rtol=0, atol=1e-13 * top * len(values))
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-14 * max(8, len(a))
    assert np.abs((a + a.T) / 2 @ x - x * values).max() < 2e-14 * top * max(8, len(a))


def test_single_precision_alone_would_not_do():
    a = symmetric(CASES["spread"])
    rough = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    _, x = whiten.refined_eigenvectors(a)
    exact = np.linalg.eigh(a)[1][:, ::-1]
    assert np.abs(np.abs(rough.T @ exact[:, ::-1]) - np.eye(40)).max() > 1e-9
    assert np.abs(np.abs(x.T @ exact) - np.eye(40)).max() < 1e-12


def test_no_variance():
    values, x = whiten.refined_eigenvectors(np.zeros((3, 3)))
    assert values.tolist() == [0, 0, 0] and x.tolist() == np.eye(3).tolist()


def brute(rows, components):
    """From the contract, in plain numpy: rows of (vec_id, vector)."""
    good = [
        (i, [math.floor(64 * float(c)) + 1_000_000 for c in v])
        for i, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = np.array(sorted({tuple(x) for _, x in good}), np.int64)
    n, s = len(fit), fit.sum(axis=0)
    centred = (n * fit - s) / n
    v = centred.T @ centred / n
    e, w = np.linalg.eigh(v)
    e, w = e[::-1][:components], w[:, ::-1][:, :components]
    out = {}
    for i, x in good:
        z = ((n * np.array(x) - s) / n) @ w / np.sqrt(e)
        dev = sum(int(n * a - b) ** 2 for a, b in zip(x, s.tolist(), strict=True))
        for k in range(components):
            out.setdefault((i, k + 1), []).append((n, dev, z[k], e[k] / np.trace(v)))
    return out, z


def check(got, wanted, components):
    assert sorted((r["vec_id"], r["component"]) for r in got) == sorted(k for k, v in wanted.items() for _ in v)
    signs = {}
    for r in sorted(got, key=lambda r: -abs(r["whitened"])):
        n, dev, z, share = min(wanted[r["vec_id"], r["component"]], key=lambda w: abs(w[1] - r["deviation"]))
        assert (r["n"], r["deviation"]) == (n, dev)
        sign = signs.setdefault(r["component"], 1 if z * r["whitened"] > 0 else -1)
        assert abs(r["whitened"] - sign * z) < 1e-8
        assert abs(r["explained"] - share) < 1e-10 * share
        assert r["identity_error"] < 1e-10
    assert len({r["identity_error"] for r in got}) == 1


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf_dir, "embeddings").collect()]
    check(QUERIES["op12_whiten"](spark, sf_dir).collect(), brute(rows, 16)[0], 16)


def test_edges(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.standard_normal(6)]) for i in range(60)]
    rows += [(100, rows[0][1]), (0, rows[0][1]), (None, rows[5][1])] + [(200 + i, rows[7][1]) for i in range(30)]
    odd = [
        (300, None), (301, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (302, [float("nan")] + [0.0] * 5),
        (303, [float("-inf")] + [0.0] * 5), (304, []), (305, [1.0, 2.0]),
    ]
    schema = "vec_id bigint, embedding array<double>, " + ", ".join(f"`{c}` int" for c in [*CLASHES, "_x", "n"])
    extra = tuple(range(len(CLASHES) + 2))
    df = spark.createDataFrame([(*r, *extra) for r in rows + odd], schema).repartition(4)
    known = [(-1 if i is None else i, v) for i, v in rows]
    got = [r.asDict() | {"vec_id": -1 if r["vec_id"] is None else r["vec_id"]} for r in whiten.whiten(df, 4).collect()]
    check(got, brute(known, 4)[0], 4)


def test_without_variance_there_are_no_rows(spark):
    schema = "vec_id bigint, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        assert whiten.whiten(spark.createDataFrame(rows, schema)).collect() == []
    flat = whiten.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0])], schema)).collect()
    assert sorted((r["vec_id"], r["component"], round(abs(r["whitened"]), 9)) for r in flat) == [(1, 1, 1.0), (2, 1, 1.0)]


def test_large_entries_stay_exact(spark):
    """The second dimension drowns in the first one's rounding; the squares leave 64 bits."""
    rows = [(i, [float(i % 3) * 2.0**38, float(i)]) for i in range(40)] + [(50, [2.0**41, 0.0])]
    got = whiten.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), 2).collect()
    assert sorted(r["vec_id"] for r in got) == list(range(40))
    assert all(r["deviation"] is None and r["n"] == 40 for r in got)
    near = whiten.whiten(spark.createDataFrame([(i, [i * 1000.0]) for i in range(9)], "vec_id bigint, embedding array<double>"))
    assert {r["vec_id"]: r["deviation"] for r in near.collect()} == {i: (9 * 64000 * (i - 4)) ** 2 for i in range(9)}
