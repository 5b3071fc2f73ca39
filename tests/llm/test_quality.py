from collections import Counter

import numpy as np
import pytest

from trendloom.llm import quality
from tests.llm.conftest import CLASHES, EDGE, prose


def slow_counts(text):
    words = text.encode().split()
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


@pytest.mark.parametrize("text", [r[1] or "" for r in EDGE] + ["a b c a b c", "a a a a", "x\nx\n\n\nx y", "#$ <|> é é \x0b \x1c x"])
def test_base_counts(text):
    assert quality.base_counts(text.encode()) == slow_counts(text)


def test_distance():
    same = np.array([[3.0, 1.0], [0.0, 4.0]]) / 4
    assert quality.jensen_shannon(np.array([30, 10]), same) == pytest.approx(0)
    assert quality.jensen_shannon(np.array([5, 0]), same[1:]) == pytest.approx(1)


def test_verdicts(spark):
    junk = " ".join(f"{w}$$$ ###{i}%" for i, w in enumerate(prose(77, 150).split()))
    rows = [(i, prose(i, 150), "en") for i in range(40)] + [(100, junk, "en"), (101, "buy now " * 80, "en"), (102, prose(3, 20), "en"), (103, junk, "xx"), (104, junk, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in quality.judge(docs, quality.fit_references(docs)).collect()}
    assert all(got[i].kept for i in range(40))
    assert not got[100].kept and not got[100].base_failed and got[100].class_distance > 0.31
    assert got[101].base_failed and got[102].base_failed
    assert got[103].kept and got[103].class_distance is None and not got[104].kept


def test_edges(edge, nothing):
    done = quality.judge(edge, quality.fit_references(edge))
    got = done.collect()
    assert len(got) == len(EDGE) and isinstance(got[0].kept, bool) and got[0]._hash == CLASHES.index("_hash")
    assert all(r.base_failed and not r.kept for r in got if r.doc_id in (3, 4, 5))
    none = quality.fit_references(nothing)
    assert len(none.classes) == 0
    alone = quality.judge(edge, none).collect()
    assert {r.class_distance for r in alone} == {None} and all(r.kept != r.base_failed for r in alone)
    assert quality.judge(nothing, none).count() == 0


def spoken(code, seed, n, share=0.3):
    """``n`` words, of which ``share`` are common words of the language, the frequent ones more often."""
    rng, common = np.random.default_rng(seed), quality.COMMON_WORDS[code].split()
    odds = 1 / np.arange(1, len(common) + 1)
    drawn = rng.choice(common, n, p=odds / odds.sum())
    return [str(w) if rng.random() < share else f"{code}{i}" for i, w in enumerate(drawn)]


def test_words_of_short_texts_count(spark):
    rows = [(i, " ".join(spoken(code, i, 300)), code) for i, code in enumerate(["en", "de", "es", "fr"] * 15)]
    rows += [(100 + n, " ".join(spoken("en", n, n)), "en") for n in (60, 120, 199)]
    rows += [(1000 + n, " ".join(spoken("en", n, n, 0.02)), "en") for n in (60, 120, 199, 200, 900)]
    rows += [(5000, " ".join(spoken("en", 1, 150) + spoken("fr", 2, 150)), "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in quality.judge(docs, quality.fit_references(docs)).collect()}
    assert all((r.class_distance or 0) <= 0.31 and not r.base_failed for r in got.values())
    assert {i for i, r in got.items() if not r.kept} == {1060, 1120, 1199, 1200, 1900}
    limits = [quality.Rules().word_limit(n) for n in (50, 100, 200, 400, 10**6)]
    assert limits == sorted(limits, reverse=True) and limits[-2:] == [0.25, 0.25]


def invented(seed, n, share=0.5):
    """``n`` words of a language without a word list: its own frequent words and rare ones."""
    rng, common = np.random.default_rng(seed), ["qa", "nuv", "ßo", "ile", "wem", "tou", "kiz", "ra", "pel", "d'u"]
    odds = 1 / np.arange(1, len(common) + 1)
    drawn = rng.choice(common, n, p=odds / odds.sum())
    return " ".join(str(w) if rng.random() < share else "".join(rng.choice(list("aeilnrstu"), 6)) for w in drawn)


def test_languages_without_a_list(spark):
    rows = [(i, prose(i, 150), "en") for i in range(30)] + [(100 + i, invented(i, 200), "zz") for i in range(30)]
    rows += [(200, invented(200, 200), None), (201, invented(201, 200), "yy"), (202, prose(202, 200), "zz")]
    rows += [(203, invented(203, 150) + " " + prose(203, 150), "zz")]
    junk = " ".join(f"{w}$$$ ###{i}%" for i, w in enumerate(invented(7, 150).split()))
    rows += [(300, junk, "zz"), (301, junk, "yy"), (302, junk, None), (303, invented(303, 300, 0.0), "zz"), (304, None, "zz")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    references = quality.fit_references(docs, language_words=2000)
    assert list(references.others) == ["zz"]
    zz = references.others["zz"]
    longer = [t.encode() for _, t, code in rows if code == "zz" and t and len(t.split()) >= 50]
    words = Counter(w for t in longer for w in t.lower().split())
    plain = [w for w in words if w.decode().replace("'", "").isalpha()]
    own = [w for w in sorted(plain, key=lambda w: (-words[w], w))[: quality.FREQUENT_WORDS] if w not in quality._VOCABULARY]
    assert list(zz.vocabulary) == [*quality._VOCABULARY, *own]
    english = Counter(w for _, t, code in rows if code == "en" for w in t.encode().lower().split())
    for row, counts in zip(zz.words, (words, english), strict=True):
        listed = [counts[w] for w in zz.vocabulary]
        assert row == pytest.approx(np.array([*listed, sum(counts.values()) - sum(listed)]) / sum(counts.values()))
    classes = sum(quality.class_counts(t) for t in longer)
    assert zz.classes[0] == pytest.approx(classes / classes.sum())
    got = {r.doc_id: r for r in quality.judge(docs, references).collect()}
    assert all(got[i].kept for i in [*range(30), *range(100, 130), 200, 202, 203])
    assert got[201].kept and got[201].class_distance is None  # too few words for a reference
    assert got[301].kept and not got[301].base_failed
    assert not any(got[i].kept for i in (300, 302, 303, 304)) and not got[303].base_failed
    few = quality.fit_references(docs, language_words=1, language_share=0.2)
    assert list(few.others) == ["zz"]
