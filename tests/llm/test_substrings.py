import random
from collections import Counter

import numpy as np
import pytest

from trendloom.llm import substrings
from trendloom.llm.substrings import merged, remove_repeats, winnow
from trendloom.llm.suffix import neighbours_share, suffix_array
from tests.llm.conftest import EDGE, prose


def test_suffix_array_and_shared_prefixes():
    rng = random.Random(1)
    for _ in range(3000):
        text = [rng.randint(1, rng.choice([1, 2, 4, 30])) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.3:
            text = text[:5] * 6
        array = suffix_array(np.array(text, np.int64))
        assert array == sorted(range(len(text)), key=lambda i: text[i:])
        text = text + [99]
        array, least = suffix_array(np.array(text, np.int64)), rng.randint(1, 6)
        near = neighbours_share(np.array(text), array, np.arange(len(text)), least)
        for r in range(1, len(array)):
            assert near[r] == (text[array[r - 1] :][:least] == text[array[r] :][:least])


def test_winnowing_is_decided_by_the_window():
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 50, 3000).astype(np.uint64)
    at = set(winnow(hashes, 40).tolist())
    want = {i + j for i in range(len(hashes) - 39) for j in np.flatnonzero(hashes[i : i + 40] == hashes[i : i + 40].min())}
    assert at == want


def brute(rows, length=400):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(t[p : p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for d, t in texts:
        covered = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                covered[p : p + length] = True
        out.append((d, bytes(np.frombuffer(t, np.uint8)[~covered])))
    return sorted(out, key=str)


def passages():
    rng = random.Random(9)
    shared = [prose(100 + i, 150) for i in range(4)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(shared)
            a, n = rng.randrange(len(p) // 2), rng.choice([250, 399, 400, 401, 450, 700, 2000])
            parts += [prose(1000 + 7 * i + len(parts), rng.randint(0, 60)), p[a : a + n]]
        rows.append((i, "é".join(parts)))
    for i, (unit, n) in enumerate([(" the the", 90), (" the the", 120), (" onor thonor er", 50), (" onor thonor er", 70)]):
        rows.append((70 + i, prose(2000 + i, 30) + unit * n + prose(2100 + i, 30 + i) + shared[i] + unit * (n // 2)))
    rows += [(60, "ab" * 900), (61, "z" * 1500), (62, "ba" * 300), (63, prose(100, 150)), (64, prose(100, 150) + "!")]
    return rows


@pytest.mark.parametrize("most", [20_000, 3])
def test_matches_brute_force(spark, most):
    rows = passages()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    done = remove_repeats(df, most_contexts=most).collect()
    assert sorted([(r.doc_id, bytes(r.kept)) for r in done], key=str) == brute(rows)
    for r in done:
        assert r.n_bytes == len(r.kept) + sum(s.end - s.start for s in r.spans)


def test_rounds_change_nothing(monkeypatch):
    texts = [t.encode()[:600] for _, t in passages()]
    places, often = np.arange(len(texts)) << 20, np.zeros(len(texts), bool)
    whole = [sorted(x.tolist()) for x in substrings.repeated_windows(texts, places, often, 400)]
    monkeypatch.setattr(substrings, "ROUND_CONTEXTS", 7)
    assert [sorted(x.tolist()) for x in substrings.repeated_windows(texts, places, often, 400)] == whole
    assert any(whole)


def test_edges(edge, nothing):
    done = remove_repeats(edge).collect()
    assert sorted([(r.doc_id, bytes(r.kept)) for r in done], key=str) == brute([r[:2] for r in EDGE])
    assert remove_repeats(nothing).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(edge, length=100)


def test_merged():
    a, b = merged(np.array([5, 1, 3, 20]), np.array([7, 3, 4, 30]))
    assert a.tolist() == [1, 5, 20] and b.tolist() == [4, 7, 30]
