import random

import numpy as np
import pytest
import xxhash

from trendloom.llm import simhash
from trendloom.llm.components import components
from tests.llm.conftest import EDGE


def slow_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("text", [None, "", " ", "one", "one two", "A b C d", "é ü ñ ß", *[r[1] for r in EDGE[:11]]])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) % (1 << 64) == slow_print(text)


def test_long_lists_are_looked_up_to_the_same_pairs(monkeypatch):
    rng = np.random.default_rng(4)
    shared = rng.integers(0, 1 << 62, dtype=np.uint64)
    list_ = np.unique(shared ^ (rng.integers(0, 1 << 16, 900).astype(np.uint64) << np.uint64(8)))
    pairs = lambda: {tuple(sorted(p)) for p in zip(*map(np.ndarray.tolist, simhash._found(list_, 2)), strict=True)}
    looked_up = pairs()
    monkeypatch.setattr(simhash, "_PAIRWISE", 10_000)
    assert pairs() == looked_up and len(looked_up) > 100


def test_links_connect_what_all_pairs_connect(spark):
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(300)}
    for base in list(prints)[:30]:
        for _ in range(rng.choice([1, 3, 60])):
            base ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            prints.add(base)
    centre = rng.getrandbits(64)
    prints |= {centre ^ (a << 8 | b << 40) for a in range(16) for b in range(16)}  # one large entry
    prints = sorted(signed(p) for p in prints)
    values = np.array(prints, np.int64).view(np.uint64)
    near = [(prints[i], prints[j]) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 2) if i < j]
    got = simhash.links(spark.createDataFrame([(p,) for p in prints], "fingerprint bigint")).collect()
    assert roots(prints, [tuple(r) for r in got]) == roots(prints, near)
    assert {tuple(sorted(r)) for r in got} <= {tuple(sorted(p)) for p in near}


def test_components(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(500, 900), rng.randrange(500, 900)) for _ in range(250)] + [(7, 7), (3, 2)]
    nodes = sorted({n for a, b in pairs if a != b for n in (a, b)})
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()}
    assert got == roots(nodes, [p for p in pairs if p[0] != p[1]])
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_groups(edge, nothing):
    got = simhash.simhash_groups(edge).collect()
    assert len(got) == len(EDGE)
    by_print = {}
    for r in got:
        by_print.setdefault(r.fingerprint, []).append(r)
    zero = by_print[0]
    assert {r.doc_id for r in zero} == {3, 4, 5, None} and {r.component_id for r in zero} == {3}
    assert {r.component_id for r in got if r.doc_id in (1, 2)} == {1}
    assert sum(r.chosen for r in got if r.doc_id == 1) == 2  # a repeated row is one document
    chosen = {(r.doc_id, r.text_hash) for r in got if r.chosen}
    assert len(chosen) == len({r.component_id for r in got if r.component_id is not None}) + sum(
        1 for r in got if r.component_id is None
    ) + (len({r.fingerprint for r in got if r.doc_id == 6}) - 1)
    assert simhash.simhash_groups(nothing).count() == 0
