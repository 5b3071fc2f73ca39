import random
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from trendloom.llm import packing
from trendloom.llm.queries import load_byte_bpe
from tests.llm.conftest import EDGE, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
SLOW = Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="a'sd  \n\t1é中<|endoftext|>\u0085  ", max_size=60))
def test_ids_are_those_of_the_file(text):
    assert load_byte_bpe()(text) == SLOW.encode(text, add_special_tokens=False).ids


def test_every_code_point_gives_the_ids_of_the_file():
    code = load_byte_bpe()
    step = 7  # all of them, but for time, were compared when this was written
    texts = [f"a{c}b1{c} {c}{c}  x{c}'s{c}9" for c in map(chr, [*range(0x3000), *range(0x3000, 0xD800, step), *range(0xE000, 0x20000, step)])]
    slow = SLOW.encode_batch_fast(texts, add_special_tokens=False)
    assert all(code(t) == e.ids for t, e in zip(texts, slow, strict=True))


def test_cut():
    assert packing.cut(5, 10) == [(0, 5)]
    assert packing.cut(20, 10) == [(0, 10), (10, 10)]
    assert packing.cut(23, 10) == [(0, 3), (3, 10), (13, 10)]
    assert packing.cut(0, 10) == []


def check_sequences(rows, size):
    """rows of (sequence, offset, length): gapless and within size."""
    by = {}
    for s, o, n in rows:
        by.setdefault(s, []).append((o, n))
    for places in by.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= size
    return len(by)


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    size = rng.choice([16, 64, 100])
    histogram = np.zeros(size + 1, np.int64)
    for _ in range(rng.choice([0, 1, 40, 3000])):
        histogram[min(size, max(1, int(rng.expovariate(3 / size))))] += 1
    runs = packing.plan(histogram, size).tolist()
    ranks, rows = {}, []
    for length, rank, count, sequence, offset in runs:
        for i in range(count):
            ranks.setdefault(length, []).append(rank + i)
            rows.append((sequence + i, offset, length))
    assert all(sorted(r) == list(range(histogram[n])) for n, r in ranks.items())
    assert sum(map(len, ranks.values())) == histogram.sum()
    used = check_sequences(rows, size)
    total = int((histogram * np.arange(size + 1)).sum())
    assert used <= max(-(-total // size) * 1.05 + 3, int(histogram[size // 2 + 1 :].sum()) * 1.02 + 3)


def test_best_configuration_is_a_knapsack_optimum():
    rng = np.random.default_rng(3)
    for _ in range(20):
        size = 24
        price = np.where(rng.random(size + 1) < 0.4, rng.random(size + 1), -np.inf)
        price[0] = -np.inf
        best = [0.0] * (size + 1)
        for room in range(1, size + 1):
            best[room] = max([best[room - 1], *[price[n] + best[room - n] for n in range(1, room + 1)]])
        counts = packing.best_configuration(price, size)
        held = counts > 0
        assert (counts * np.arange(size + 1)).sum() <= size
        assert (counts[held] * price[held]).sum() == pytest.approx(best[size])


def fewest_sequences(left, size):
    """The exact optimum for a few pieces: every way to fill the longest one's sequence."""

    @lru_cache(maxsize=None)
    def best(pieces):
        if not pieces:
            return 0
        rests = set()

        def fill(rest, at, room):
            rests.add(rest)
            for i in range(at, len(rest)):
                if rest[i] <= room and (i == at or rest[i] != rest[i - 1]):
                    fill(rest[:i] + rest[i + 1 :], i, room - rest[i])

        fill(pieces[1:], 0, size - pieces[0])
        return 1 + min(map(best, rests))

    return best(tuple(sorted(left, reverse=True)))


@pytest.mark.parametrize("seed", range(12))
def test_program_against_the_exact_optimum(seed):
    rng = random.Random(seed)
    size = 20
    pieces = [rng.randint(1, size) for _ in range(rng.randint(1, 13))]
    histogram = np.bincount(pieces, minlength=size + 1)
    uses, bound = packing.solve(histogram, size)
    exact = fewest_sequences(pieces, size)
    assert bound <= exact + 1e-9 and sum(a for a, _ in uses) >= bound - 1e-9
    assert (sum(a * c for a, c in uses) >= histogram - 1e-6).all()
    runs = packing.plan(histogram, size)
    assert exact <= (runs[:, 3] + runs[:, 2]).max() <= exact + 1


@pytest.mark.parametrize("draw", ["uniform", "small", "large", "one length"])
def test_program_covers_all_near_its_bound_and_places_most(draw):
    rng, size = np.random.default_rng(6), 256
    lengths = {
        "uniform": rng.integers(1, size + 1, 5000), "small": rng.lognormal(3.9, 0.8, 20_000),
        "large": rng.integers(size // 3, size * 2 // 3, 5000), "one length": np.full(900, 100),
    }[draw]
    histogram = np.bincount(np.clip(lengths.astype(int), 1, size), minlength=size + 1)
    uses, bound = packing.solve(histogram, size)
    covered = sum(a * c for a, c in uses)
    assert (covered >= histogram * (1 - 1e-9)).all()
    primal = sum(a for a, _ in uses)
    assert bound <= primal <= 1.02 * bound + 1
    assert sum(int(a) * int(c.sum()) for a, c in uses) >= 0.8 * histogram.sum()
    runs = packing.plan(histogram, size)
    assert runs[:, 2].sum() == histogram.sum()
    assert bound <= (runs[:, 3] + runs[:, 2]).max() <= 1.02 * bound + 3


def test_pack(spark, edge, nothing):
    got = packing.pack(edge, load_byte_bpe, size=128).collect()
    want = []
    for d, t, _ in EDGE:
        ids = SLOW.encode(t or "", add_special_tokens=False).ids + [2]
        for k, (s, n) in enumerate(packing.cut(len(ids), 128)):
            want.append((d, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())))
    assert sorted([tuple(r)[:5] for r in got], key=str) == sorted(want, key=str)
    used = check_sequences([(r.sequence_id, r.offset, r.length) for r in got], 128)
    assert used <= sum(r.length for r in got) / 128 + 4
    assert packing.pack(nothing, load_byte_bpe).count() == 0
    many = spark.createDataFrame([(i, prose(i, 5 + i % 60)) for i in range(400)], "doc_id bigint, text string").repartition(7)
    got = packing.pack(many, load_byte_bpe, size=256).collect()
    used = check_sequences([(r.sequence_id, r.offset, r.length) for r in got], 256)
    assert used <= -(-sum(r.length for r in got) // 256) + 3
