import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendloom.llm import hmm
from tests.llm.conftest import EDGE, prose


def random_chain(states, classes, seed=1):
    rng = np.random.default_rng(seed)
    even = lambda x: x / x.sum(axis=-1, keepdims=True)
    return hmm.Chain(even(rng.random(states)), even(rng.random((states, states))), even(rng.random((states, classes))))


def by_paths(chain, seq):
    """Probability and expected counts by adding up all state paths."""
    k = len(chain.start)
    total, starts, moves, emits = 0.0, np.zeros(k), np.zeros((k, k)), np.zeros((chain.emits.shape[1], k))
    for path in itertools.product(range(k), repeat=len(seq)):
        p = chain.start[path[0]]
        for t, s in enumerate(path):
            p *= chain.emits[s, seq[t]] * (chain.moves[path[t - 1], s] if t else 1)
        total += p
        starts[path[0]] += p
        for t, s in enumerate(path):
            emits[seq[t], s] += p
            if t:
                moves[path[t - 1], s] += p
    return total, starts / total, moves / total, emits / total


def test_recursions_match_sums_over_paths():
    chain = random_chain(3, 5)
    rng = np.random.default_rng(2)
    seqs = [rng.integers(0, 5, n).astype(np.uint8) for n in (1, 6, 2, 5, 1, 3)]
    each = [by_paths(chain, s) for s in seqs]
    np.testing.assert_allclose(hmm.log_likelihoods(chain, seqs), [math.log10(x[0]) for x in each], rtol=1e-9)
    got = hmm.expected_counts(chain, seqs)
    for i in range(3):
        np.testing.assert_allclose(got[i], sum(x[i + 1] for x in each), rtol=1e-4)
    assert got[3] == pytest.approx(sum(math.log10(x[0]) for x in each), rel=1e-4)


def test_leading_tokens_only_warm_up():
    """Counts of a window are those of its own tokens and the moves to them, given its lead."""
    chain = random_chain(3, 5)
    usual = hmm.Chain(hmm.usual_states(chain), chain.moves, chain.emits)
    rng = np.random.default_rng(7)
    seqs = [rng.integers(0, 5, n).astype(np.uint8) for n in (6, 2, 5, 4)]
    leads = np.array([2, 0, 1, 4])
    starts, moves, emits = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for s, lead in zip(seqs, leads.tolist()):
        c = usual if lead else chain
        for path in itertools.product(range(3), repeat=len(s)):
            p = c.start[path[0]] * np.prod([c.emits[a, x] for a, x in zip(path, s)])
            p *= np.prod([c.moves[a, b] for a, b in itertools.pairwise(path)])
            p /= by_paths(c, s)[0]
            starts[path[0]] += p * (lead == 0)
            for t in range(lead, len(s)):
                emits[s[t], path[t]] += p
                if t:
                    moves[path[t - 1], path[t]] += p
    got = hmm.expected_counts(chain, seqs, leads)
    for have, want in zip(got, (starts, moves, emits)):
        np.testing.assert_allclose(have, want, rtol=1e-4, atol=1e-6)


def test_windows_cover_every_token_and_move_once():
    texts = [np.arange(n, dtype=np.int64) for n in (1, 255, 256, 257, 700)]
    windows, leads = hmm._windows(texts), hmm._leads(texts)
    assert sum(len(w) - n for w, n in zip(windows, leads)) == sum(map(len, texts))
    assert leads.count(0) == len(texts) and all(w[0] == 0 for w, n in zip(windows, leads) if n == 0)
    moves = Counter(w[t] for w, n in zip(windows, leads) for t in range(max(n, 1), len(w)))
    assert moves == Counter(x for s in texts for x in s[1:].tolist())


def test_training_ends_when_it_gains_little(spark):
    rows = [(bytearray([1, 2] * 20 + [0]),)] * 30
    df = spark.createDataFrame(rows, "classes binary")
    assert len(hmm.train(df, rounds=9, states=2, least_gain=1e9)[1]) == 2
    assert len(hmm.train(df, rounds=3, states=2, least_gain=-1e9)[1]) == 3


def test_words_of_many_groups_of_blocks_are_completed(spark):
    """The same word in blocks far apart: counts are those of all groups."""
    rows = [((g << 40) + b, w.encode(), i, g + 2 * b + i) for g in (0, 1, 5) for b in (0, 1, 1 << 12) for i, w in enumerate(("the", "a", f"w{g}", "\n"))]
    blocks = spark.createDataFrame([(b, bytearray(w), i, n) for b, w, i, n in rows], "block bigint, word binary, nth int, n bigint")
    total = Counter()
    for _, w, _, n in rows:
        total[w] += n
    counts, by_class = hmm._word_counts(blocks)
    assert {(r.block, r.nth): r.c for r in counts.collect()} == {(b, i): total[w] for b, w, i, _ in rows}
    want = Counter()
    for w, n in total.items():
        want[hmm.word_class(w)] += n
    assert {r["class"]: r.n for r in by_class.collect()} == want
    assert sum(r.v for r in by_class.collect()) == len(total)


def test_probabilities_of_all_sequences_add_up():
    chain = random_chain(4, 3)
    seqs = [np.array(s, np.uint8) for s in itertools.product(range(3), repeat=5)]
    assert (10 ** hmm.log_likelihoods(chain, seqs)).sum() == pytest.approx(1)


def corpus():
    langs = [prose, lambda s, n: prose(s, n).upper().translate(str.maketrans("AEIOLNRST", "OUYWKMGDB"))]
    return [(i, langs[i % 2](i, 20 + i % 90)) for i in range(240)]


def test_base_counts_and_gain_on_held_out_texts(spark):
    rows = corpus() + [(1000, None), (1001, ""), (1001, ""), (None, "the of"), (1002, prose(3, 4000))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    got = hmm.score_texts(df, held).collect()
    assert len(got) == len(rows)
    out = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    tokens = lambda t: [*(t or "").encode().lower().split(), b"\n"]
    counts = Counter(w for d, t in rows if not out(d) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    texts = dict(rows)
    for r in got:
        ws = tokens(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out(r.doc_id), len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        assert r.score < 0
    held_out = [r for r in got if r.held_out]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)


def test_training_does_not_lose_likelihood(spark):
    chain = random_chain(3, hmm.CLASSES, 4)
    rng = np.random.default_rng(5)
    rows = [(bytes(rng.integers(1 + 40 * (i % 3), 41 + 40 * (i % 3), 50).astype(np.uint8)) + b"\0",) for i in range(120)]
    _, seen = hmm.train(spark.createDataFrame([(bytearray(r[0]),) for r in rows], "classes binary"), rounds=4, states=3, least_gain=-1)
    assert all(b >= a - 1e-3 * abs(a) for a, b in zip(seen, seen[1:]))
    assert chain.emits.shape == (3, hmm.CLASSES)


def test_edges(edge, nothing):
    got = hmm.score_texts(edge, F.lit(None).cast("boolean")).collect()
    assert len(got) == len(EDGE) and not any(r.held_out for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {1}
    all_held = hmm.score_texts(edge, F.lit(True)).collect()
    assert {r.n_known for r in all_held} == {0} and {r.train_tokens for r in all_held} == {0}
    assert all(math.isfinite(r.score) and r.base_score == 0 for r in all_held)
    assert hmm.score_texts(nothing, F.lit(False)).count() == 0


def test_small_blocks_change_nothing(spark, monkeypatch):
    df = spark.createDataFrame(corpus(), "doc_id bigint, text string").coalesce(1)
    held = F.col("doc_id") % 5 == 0
    whole = {r.doc_id: r for r in hmm.score_texts(df, held).collect()}
    monkeypatch.setattr(hmm, "BLOCK_BYTES", 3000)
    for r in hmm.score_texts(df, held).collect():
        assert r.base_score == pytest.approx(whole[r.doc_id].base_score) and r.n_known == whole[r.doc_id].n_known
