"""Quality rules: base counts, and divergence from language references.

Two passes over the texts. The first sums, for each language, a histogram of character
classes and one of common words over all documents. The second compares each document
with the nearest reference by Jensen-Shannon distance; words that are far from every
single one also with mixtures, for texts in several languages. The references are those of
``COMMON_WORDS`` and one for every other language that holds enough of all words; the latter's
frequent words are counted in its own documents. Only the references reach the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.llm.arrow import text_bytes, with_text_columns
from trendloom.sources.workspace import materialise

#: The most frequent function words of each language (fixed values).
COMMON_WORDS = {
    "en": "the of and to a in is it you that he was for on are with as his they be at this "
    "from have or by one had not but what all were when we there can an your which",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als "
    "auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o "
    "pero sus le ha me si sin sobre este ya entre cuando todo esta ser son",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se "
    "ce il sont la avec son aux d'une comme mais ont été ou leur cette même elle",
}
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Another language has a reference from so many words and this share of all words on; the
#: share bounds the number of references.
LANGUAGE_WORDS, LANGUAGE_SHARE = 20_000, 0.001
#: How many of its most frequent words the reference of another language lists: about as many
#: as of a list of ``COMMON_WORDS`` are frequent, for which the word limit was chosen.
FREQUENT_WORDS = 20

_VOCABULARY = {
    w.encode(): i
    for i, w in enumerate(dict.fromkeys(w for text in COMMON_WORDS.values() for w in text.split()))
}
_OTHER_WORD = len(_VOCABULARY)


def _byte_classes() -> np.ndarray:
    """The class of a character by its first byte; continuation bytes are no character."""
    of = np.full(256, -1, np.int64)
    groups = [
        b"aeiou", b"bcdfghjklmnpqrstvwxyz", bytes(range(65, 91)), b"0123456789", b" ", b"\t\n\r\x0b\x0c",
        b".,;:!?", b"'\"()-", SYMBOLS + b"@[]{}=+/\\^_`~",
        bytes([0xC3]), bytes([0xC2, *range(0xC4, 0xCC)]), bytes(range(0xCC, 0xE0)), bytes(range(0xE0, 0xF5)),
    ]
    for i, group in enumerate(groups):
        of[list(group)] = i
    rest = [b for b in range(128) if of[b] < 0]
    of[rest] = len(groups)
    return of


_CLASS = _byte_classes()
N_CLASSES = int(_CLASS.max()) + 1


def class_counts(text: bytes) -> np.ndarray:
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    seen = _CLASS >= 0
    return np.bincount(_CLASS[seen], by_byte[seen], N_CLASSES).astype(np.int64)


def common_counts(text: bytes, vocabulary: dict[bytes, int] = _VOCABULARY) -> np.ndarray:
    """How often each word of the vocabulary occurs, and last all other words."""
    ids = [vocabulary.get(w, len(vocabulary)) for w in text.lower().split()]
    return np.bincount(np.array(ids, np.int64), minlength=len(vocabulary) + 1)


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    pairs = ids[:-1] * len(seen) + ids[1:]
    if len(seen) > 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(seen) + ids[2:]
    _, group, counts = np.unique(windows, return_inverse=True, return_counts=True)
    start = counts[group] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= start
    return int(covered.sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(b"".join(words).decode("utf-8", "replace")),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


@dataclass(frozen=True)
class Rules:
    """Distances are in [0, 1]. Texts under the guards are too noisy to compare and pass.

    The words of a short text are a small sample of its language, so their limit falls
    with the root of the length, down to ``max_word_distance``.
    """

    max_class_distance: float = 0.31
    max_word_distance: float = 0.25
    word_offset: float = 0.18
    word_slope: float = 1.3
    min_chars: int = 200
    min_words: int = MIN_WORDS

    def word_limit(self, n_words: int) -> float:
        return max(self.max_word_distance, self.word_offset + self.word_slope / max(n_words, 1) ** 0.5)


@dataclass(frozen=True)
class Language:
    """The references for documents of a language without a word list.

    The vocabulary is that of the lists with the language's own frequent words after it. The
    first row is the language, the others are those of ``COMMON_WORDS`` over the same words.
    """

    classes: np.ndarray
    vocabulary: dict[bytes, int]
    words: np.ndarray


@dataclass(frozen=True)
class References:
    classes: np.ndarray  #: one distribution per language of ``COMMON_WORDS``
    words: np.ndarray
    others: dict[str, Language] = field(default_factory=dict)


def _histograms(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, c0, c1, ...): character classes and common words of all documents by language.

    Every task sums what it reads, so the shuffle holds a row per task and language; a task
    that meets very many languages passes its sums on in portions.
    """
    width = N_CLASSES + _OTHER_WORD + 1
    names = [f"c{i}" for i in range(width)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}

        def portion() -> pa.RecordBatch:
            rows = np.array(list(total.values()), np.int64).reshape(-1, width)
            columns = [pa.array(list(total), pa.string()), *[pa.array(rows[:, i]) for i in range(width)]]
            total.clear()
            return pa.RecordBatch.from_arrays(columns, ["lang", *names])

        for batch in batches:
            for code, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = common_counts(t)
                if counts.sum() >= MIN_WORDS:
                    both = np.concatenate([class_counts(t), counts])
                    total[code] = total[code] + both if code in total else both
                    if len(total) > 4096:
                        yield portion()
        yield portion()

    schema = T.StructType(
        [T.StructField("lang", T.StringType()), *[T.StructField(n, T.LongType()) for n in names]]
    )
    named = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), text_bytes(text).alias("text"))
    parts = named.where(F.col("lang").isNotNull()).mapInArrow(sums, schema)
    return parts.groupBy("lang").agg(*[F.sum(n).alias(n) for n in names])


def _word_counts(docs: DataFrame, codes: list[str], text: str, lang: str) -> DataFrame:
    """(lang, word, n): all words of the languages, counted inside the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        held = 0

        def portion() -> pa.RecordBatch:
            rows = [(code, w, n) for code, words in seen.items() for w, n in words.items()]
            seen.clear()
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.binary(), pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

        for batch in batches:
            for code, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = t.lower().split()
                if len(words) >= MIN_WORDS:
                    seen.setdefault(code, Counter()).update(words)
                    held += len(t)
                    if held > 16 << 20:
                        yield portion()
                        held = 0
        yield portion()

    named = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), text_bytes(text).alias("text"))
    counted = named.where(F.col("lang").isin(codes)).mapInArrow(count, "lang string, word binary, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _frequent_words(counted: DataFrame, codes: list[str]) -> DataFrame:
    """(lang, word, nth): the most frequent words of each language, ties in the order of bytes.

    Only letters, marks and apostrophes make a word here, not symbols of
    damaged texts. The rank is cut in every task before the words of a language meet.
    """
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "word"))
    plain = F.col("lang").isin(codes) & F.col("word").cast("string").rlike(r"^[\p{L}\p{M}'\u2019]+$")
    ranked = counted.where(plain).withColumn("nth", nth)
    return ranked.where(F.col("nth") <= FREQUENT_WORDS).select("lang", "word", "nth")


def _other_languages(
    docs: DataFrame, sums: dict[str, np.ndarray], text: str, lang: str
) -> dict[str, Language]:
    """The references of the languages in ``sums`` that have no word list.

    At most ``FREQUENT_WORDS`` words of each language reach the driver, with their counts in
    it and in the languages of the lists.
    """
    known = [k for k in sums if k in COMMON_WORDS]
    more = [k for k in sums if k not in COMMON_WORDS]
    if not more:
        return {}
    counted = materialise(_word_counts(docs, more + known, text, lang), "words")
    frequent = _frequent_words(counted, more).orderBy("lang", "nth").collect()
    listed = counted.sparkSession.createDataFrame(sorted({(r["word"],) for r in frequent}), "word binary")
    met = {(r["lang"], bytes(r["word"])): r["n"] for r in counted.join(listed, "word").toLocalIterator()}
    own: dict[str, list[bytes]] = {code: [] for code in more}
    for r in frequent:
        if (word := bytes(r["word"])) not in _VOCABULARY:
            own[r["lang"]].append(word)
    out = {}
    for code, words in own.items():
        rows = []
        for k in [code, *known]:
            counts, added = sums[k][N_CLASSES:], np.array([met.get((k, w), 0) for w in words], float)
            rows.append(np.concatenate([counts[:-1], added, [counts[-1] - added.sum()]]))
        vocabulary = _VOCABULARY | {w: _OTHER_WORD + i for i, w in enumerate(words)}
        classes = np.array([sums[k][:N_CLASSES] for k in [code, *known]])
        out[code] = Language(_shares(classes), vocabulary, _shares(np.array(rows)))
    return out


def _shares(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)


def fit_references(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    language_words: int = LANGUAGE_WORDS,
    language_share: float = LANGUAGE_SHARE,
) -> References:
    """Histograms of all documents of at least ``MIN_WORDS`` words, by language.

    Languages without a word list have a reference if their documents hold at least
    ``language_words`` words and ``language_share`` of all words, which are at most
    1 / ``language_share`` languages. Null languages give none.
    """
    table = materialise(_histograms(docs, text, lang), "languages")
    names = table.columns[1:]
    n = sum((F.col(c) for c in names[N_CLASSES:]), F.lit(0))
    least = max(language_words, language_share * (table.agg(F.sum(n)).first()[0] or 0))
    rows = table.where(F.col("lang").isin(*COMMON_WORDS) | (n >= least)).orderBy("lang").collect()
    sums = {r["lang"]: np.array([r[c] for c in names], float) for r in rows}
    sums = {k: v for k, v in sums.items() if v.sum() > 0}
    known = np.array([v for k, v in sums.items() if k in COMMON_WORDS]).reshape(-1, len(names))
    others = _other_languages(docs, sums, text, lang)
    return References(_shares(known[:, :N_CLASSES]), _shares(known[:, N_CLASSES:]), others)


def jensen_shannon(counts: np.ndarray, references: np.ndarray) -> float:
    """The distance (root of the divergence, base 2) to the nearest reference."""
    p = counts / max(counts.sum(), 1)
    m = (p + references) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        right = np.where(references > 0, references * np.log2(references / m), 0).sum(axis=1)
    return float(np.sqrt(np.clip((left + right) / 2, 0, 1)).min())


def mixture(counts: np.ndarray, references: np.ndarray, rounds: int = 20) -> np.ndarray:
    """The mixture of the references that explains the counts best (EM on its weights)."""
    seen = counts > 0
    p, parts = counts[seen] / max(counts.sum(), 1), references[:, seen]
    weights = np.full(len(references), 1 / len(references))
    for _ in range(rounds):
        weights = weights * (parts @ (p / np.maximum(weights @ parts, 1e-300)))
    return weights @ references / max(weights.sum(), 1e-300)


def word_distance(counts: np.ndarray, references: np.ndarray, limit: float) -> float:
    """To the nearest reference or, beyond the limit, to the nearest mixture of several."""
    distance = jensen_shannon(counts, references)
    if distance > limit and len(references) > 1:
        distance = min(distance, jensen_shannon(counts, mixture(counts, references)[None]))
    return distance


_ADDED = T.StructType(
    [
        *[T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        T.StructField("class_distance", T.DoubleType()),
        T.StructField("word_distance", T.DoubleType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


def judge(
    docs: DataFrame,
    references: References,
    rules: Rules = Rules(),
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """``docs`` with base counts, both distances and the verdict.

    A null text is empty and fails the base rules. A distance is null where the text is
    shorter than its guard or there is no reference; it then rejects nothing. So it is
    for documents whose ``lang`` names a language without a reference. Documents of a
    language without a list are compared with its reference and the listed ones, those of
    no language with all. Repeated rows are judged each for itself; columns named like a
    result are replaced.
    """
    lists = [Language(references.classes, _VOCABULARY, references.words)] if len(references.classes) else []

    def fitting(code: str | None) -> list[Language]:
        if code in references.others:
            return [references.others[code]]
        if code is None:
            return [*lists, *references.others.values()]
        return lists if code in COMMON_WORDS else []

    def compute(texts: list[bytes], codes: list[str | None]) -> list:
        rows = []
        for t, code in zip(texts, codes, strict=True):
            base = base_counts(t)
            failed = base[0] < MIN_WORDS or 100 * base[4] > MAX_REPEAT_PERCENT * base[0]
            near = fitting(code)
            by_class = by_word = None
            limit = rules.word_limit(base[0])
            if near and base[1] >= rules.min_chars:
                counts = class_counts(t)
                by_class = min(jensen_shannon(counts, r.classes) for r in near)
            if near and base[0] >= rules.min_words:
                by_word = min(word_distance(common_counts(t, r.vocabulary), r.words, limit) for r in near)
            kept = (
                not failed
                and (by_class is None or by_class <= rules.max_class_distance)
                and (by_word is None or by_word <= limit)
            )
            rows.append((*base, by_class, by_word, failed, kept))
        return list(zip(*rows, strict=True)) if rows else [[] for _ in _ADDED]

    code = F.col(f"`{lang}`").cast("string") if lang in docs.columns else F.lit(None).cast("string")
    return with_text_columns(docs, text, _ADDED, compute, beside=code)
