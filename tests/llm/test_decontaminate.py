import random

from trendloom.llm import decontaminate as dc
from tests.llm.conftest import EDGE, prose


def slow_distance(item, text):
    """Least edits of item against any part of text, by dynamic programming."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(row[i] + (x != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def edited(text, n, rng):
    s = list(text)
    for _ in range(n):
        i = rng.randrange(len(s))
        s[i : i + 1] = rng.choice([[], [s[i], "x"], ["q"]])
    return "".join(s)


def test_myers():
    rng = random.Random(1)
    for _ in range(400):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(1, 80)))
        text = edited("".join(rng.choice("abc") for _ in range(20)) + item, 6, rng) if rng.random() < 0.6 else "".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))
        assert dc.myers(item, text) == slow_distance(item, text)


def test_matches_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    items = [(i, prose(50 + i, 25)) for i in range(12)] + [(20, None), (21, ""), (22, "short"), (3, prose(53, 25))]
    docs = []
    for i in range(60):
        body = prose(900 + i, 60)
        if i % 2:
            k = rng.choice([0, 3, 8, 11, 40])
            body = body[:100] + " " + edited(items[i % 12][1].upper(), k, rng).replace(" ", "  ") + body[100:]
        docs.append((i, body))
    want = set()
    for d, text in docs:
        for k, item in items:
            said = dc.normalise(item or "")
            far = slow_distance(said, dc.normalise(text)) if said else 1
            if said and far <= len(said) // dc.ERROR_EVERY:
                want.add((d, k, far, len(said) // dc.ERROR_EVERY))
    tables = [spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")]
    assert {tuple(r) for r in dc.find_leaks(*tables).collect()} == want
    assert {w[2] > 0 for w in want} == {True, False}
    monkeypatch.setattr(dc, "BLOCK_CHARS", 300)  # several blocks
    assert {tuple(r) for r in dc.find_leaks(*tables).collect()} == want


def test_edges(spark, edge, nothing):
    items = spark.createDataFrame([(1, prose(1, 40)), (1, prose(1, 40)), (None, "ümläut"), (2, None)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in dc.find_leaks(edge, items).collect()}
    assert got == {(1, 1), (2, 1), (7, 1), (10, 1), (10, None)}
    assert dc.find_leaks(nothing, items).count() == 0
    assert dc.find_leaks(edge, items.limit(0)).count() == 0
    assert len(EDGE) == edge.count()
