"""Benchmark decontamination by pigeonhole edit matching.

A test item may differ from its copy in a document by ``len // error_every`` edits. Cut
into one piece more than that, at least one piece survives unchanged. All pieces of a
block of items are searched at once with an Aho-Corasick automaton; around each hit the
item is verified with Myers' bit-parallel distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.llm.arrow import text_bytes
from trendloom.sources.workspace import materialise

#: Characters of one block of items; a block is what tasks receive at once.
BLOCK_CHARS = 4_000_000
ERROR_EVERY = 16


def normalise(text: str) -> str:
    """Lower case, runs of white space as one blank."""
    return " ".join(text.lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of nearly equal length, each with its place."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]  # noqa: B905


def myers(item: str, text: str) -> int:
    """The least edit distance between ``item`` and any part of ``text``."""
    m = len(item)
    eq: dict[str, int] = {}
    for i, c in enumerate(item):
        eq[c] = eq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1) if m else 0
    plus, minus, score = full, 0, m
    best = score
    for c in text:
        match = eq.get(c, 0)
        down = match | minus
        across = ((((match & plus) + plus) ^ plus) | match) & full
        up = minus | (full & ~(across | plus))
        low = plus & across
        if up & top:
            score += 1
        elif low & top:
            score -= 1
            if score < best:
                best = score
        up = up << 1 & full
        low = low << 1 & full
        plus = low | (full & ~(down | up))
        minus = up & down
    return best


class Matcher:
    """The automaton of one block of items."""

    def __init__(self, items: list[tuple[object, str]], error_every: int = ERROR_EVERY):
        self.items = [(key, text, len(text) // error_every) for key, text in items if text]
        found: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text, budget) in enumerate(self.items):
            for at, piece in pieces(text, budget):
                found.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if found:
            self.automaton.make_automaton()

    def search(self, text: str) -> Iterator[tuple[object, int, int]]:
        """(item, distance, budget) for each item within its budget in normalised ``text``."""
        if not self.items:
            return
        starts: dict[int, set[int]] = {}
        for end, (length, places) in self.automaton.iter(text):
            for i, at in places:
                starts.setdefault(i, set()).add(end + 1 - length - at)
        for i, at in starts.items():
            key, item, budget = self.items[i]
            best = min(myers(item, text[a:b]) for a, b in self._regions(sorted(at), len(item), budget))
            if best <= budget:
                yield key, best, budget

    @staticmethod
    def _regions(starts: list[int], length: int, budget: int) -> list[list[int]]:
        """Where the item may lie, overlapping stretches merged."""
        out: list[list[int]] = []
        for s in starts:
            a, b = max(0, s - budget), max(0, s + length + budget)
            if out and a <= out[-1][1]:
                out[-1][1] = max(b, out[-1][1])
            else:
                out.append([a, b])
        return out


def _blocks(items: DataFrame, item: str, text: str) -> Iterator[list[tuple[object, str]]]:
    block, size = [], 0
    rows = items.select(F.col(f"`{item}`").alias("i"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    for row in rows.distinct().toLocalIterator():
        said = normalise(row["t"])
        if block and size + len(said) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((row["i"], said))
        size += len(said)
    yield block


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    doc: str = "doc_id",
    item: str = "item_id",
    text: str = "text",
    error_every: int = ERROR_EVERY,
) -> DataFrame:
    """(doc, item, distance, budget): each item found in each document, at its best.

    Both texts are normalised; null texts are empty, empty items match nothing, items
    shorter than ``error_every`` only match exactly. Repeated rows give one result. The
    items are taken in blocks of ``BLOCK_CHARS``, each one map over all documents; with
    several blocks each result is written before the next block is sent out.
    """
    schema = T.StructType(
        [
            T.StructField(doc, docs.schema[doc].dataType),
            T.StructField(item, items.schema[item].dataType),
            T.StructField("distance", T.LongType()),
            T.StructField("budget", T.LongType()),
        ]
    )
    sc = docs.sparkSession.sparkContext
    plain = docs.select(F.col(f"`{doc}`"), text_bytes(text))

    def run_block(block: list) -> DataFrame:
        sent = sc.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(sent.value, error_every)
            for batch in batches:
                out = []
                for i, t in enumerate(batch.column(1).to_pylist()):
                    said = normalise(t.decode("utf-8", "replace"))
                    out += [(i, *hit) for hit in matcher.search(said)]
                if out:
                    at, keys, far, most = zip(*out, strict=True)
                    kind = pa.int64() if isinstance(schema[item].dataType, T.LongType) else None
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at)), pa.array(keys, kind), pa.array(far), pa.array(most)],
                        schema.fieldNames(),
                    )

        return plain.mapInArrow(run, schema).distinct()

    done: DataFrame | None = None
    blocks = _blocks(items, item, text)
    block = next(blocks)
    while block is not None:
        following = next(blocks, None)
        found = run_block(block)
        if done is not None or following is not None:
            found = materialise(found, "leaks")
        done = found if done is None else done.union(found)
        block = following
    return done
