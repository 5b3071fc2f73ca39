"""SimHash near-dedup over a byte-position inverted index with count filtering.

Two 64-bit fingerprints at a distance of at most ``d`` bits differ in at most ``d`` of
their eight bytes, so they share at least ``8 - d`` positional bytes. The list of one
positional byte holds a 256th of all fingerprints, and tallying its pairs would be
quadratic. The lists are therefore intersected first: an index entry joins ``8 - d``
positional bytes, the guaranteed minimum, so just those pairs meet whose tally can
reach it. An entry's fingerprints differ in ``d`` bytes only, which bounds its list by
256 ** d whatever the data. Within an entry the tally is taken and the bits are counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.llm.arrow import with_text_columns
from trendloom.llm.components import components
from trendloom.sources.workspace import materialise

#: Lists up to this length are compared pair by pair inside the task, longer ones by lookup.
_PAIRWISE = 256


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The fingerprint as a signed 64-bit integer; zero for a text without words.

    A-Z are lower-cased; words are split at ASCII white space; shingles count as often
    as they occur; a bit is set if it is set in over half of the hashes.
    """
    words = text.lower().split()
    if not words:
        return 0
    grams = [words[i:] for i in range(shingle)] if len(words) >= shingle else None
    joined = map(b" ".join, zip(*grams)) if grams else [b" ".join(words)]  # noqa: B905
    hashes = np.array([xxhash.xxh64_intdigest(g, seed) for g in joined], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` with a ``fingerprint`` column (bigint)."""
    schema = T.StructType([T.StructField("fingerprint", T.LongType())])
    return with_text_columns(
        docs, text, schema, lambda texts: [[fingerprint(t, shingle, seed) for t in texts]]
    )


def _found(list_: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of one entry's fingerprints at ``limit`` bits or fewer."""
    if len(list_) <= _PAIRWISE:
        i, j = np.triu_indices(len(list_), 1)
        differ = list_[i] ^ list_[j]
        tally = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        ok = tally >= 8 - limit
        ok[ok] = np.bitwise_count(differ[ok]) <= limit
        return i[ok], j[ok]
    order = np.argsort(list_)
    values = list_[order]
    spread = np.bitwise_or.reduce(values ^ values[0])  # the bits in which the list differs at all
    bits = [1 << b for b in range(64) if int(spread) >> b & 1]
    left, right = [], []
    for n in range(1, limit + 1):
        for flips in combinations(bits, n):
            want = values ^ np.uint64(sum(flips))
            at = np.minimum(np.searchsorted(values, want), len(values) - 1)
            hit = (values[at] == want) & (values < want)
            left.append(order[hit])
            right.append(order[at[hit]])
    return np.concatenate(left), np.concatenate(right)


def _spanning(n: int, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int]]:
    """As few of the pairs as keep the same components."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            yield a, b


def links(prints: DataFrame, limit: int = 2) -> DataFrame:
    """(u, v) between distinct fingerprints that connect whatever is within ``limit`` bits.

    ``prints`` has one ``fingerprint`` column. Links that others of the same entry imply
    by connection are left out, so a group of copies gives a tree and not all its pairs.
    """
    masks = []
    for gone in combinations(range(8), limit):
        keep = sum(0xFF << 8 * b for b in range(8) if b not in gone)
        masks.append(keep - (1 << 64) if keep >> 63 else keep)
    entries = prints.select("fingerprint").distinct().select(
        F.explode(
            F.array(*[
                F.struct(
                    F.lit(i).alias("combo"),
                    F.col("fingerprint").bitwiseAND(F.lit(m).cast("bigint")).alias("shared"),
                    "fingerprint",
                )
                for i, m in enumerate(masks)
            ])
        ).alias("e")
    ).select("e.*")
    dealt = entries.repartition("combo", "shared").sortWithinPartitions("combo", "shared")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            new = [np.asarray(batch.column(i)) for i in range(3)]
            now = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            if not len(now[0]):
                continue
            change = np.flatnonzero((np.diff(now[0]) != 0) | (np.diff(now[1]) != 0)) + 1
            last = change[-1] if len(change) else 0
            held = [x[last:] for x in now]
            yield from _entries(now[2][:last], change)
        if held is not None:
            yield from _entries(held[2], np.array([len(held[2])]))

    def _entries(values: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        values = values.view(np.uint64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        sizes = ends - starts
        two = starts[sizes == 2]
        near = np.bitwise_count(values[two] ^ values[two + 1]) <= limit
        u, v = [values[two[near]]], [values[two[near] + 1]]
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            list_ = values[s : s + n]
            kept = list(_spanning(n, *_found(list_, limit)))
            if kept:
                a, b = np.array(kept).T
                u.append(list_[a])
                v.append(list_[b])
        pairs = [np.concatenate(x).view(np.int64) for x in (u, v)]
        if len(pairs[0]):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in pairs], ["u", "v"])

    return dealt.mapInArrow(run, "u bigint, v bigint").distinct()


def simhash_groups(
    docs: DataFrame,
    shingle: int = 3,
    limit: int = 2,
    doc: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc, text_hash, fingerprint, component_id, chosen), one row per row of ``docs``.

    ``component_id`` is the smallest id in the component, nulls aside. ``chosen`` marks
    its smallest (id, text hash): one document of each component, repeated rows of which
    are all marked. Null texts are empty; texts without words have fingerprint zero and
    are linked like any other. Empty tables give no rows.
    """
    narrow = docs.select(
        F.col(f"`{doc}`").alias(doc),
        F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("text_hash"),
        F.col(f"`{text}`").alias("__text"),
    )
    prints = materialise(fingerprints(narrow, "__text", shingle).drop("__text"), "fingerprints")
    roots = components(links(prints, limit)).withColumnRenamed("node", "fingerprint")
    by_print = prints.groupBy("fingerprint").agg(
        F.min(doc).alias("_least"), F.min(F.struct(doc, "text_hash")).alias("_pick")
    )
    rooted = by_print.join(roots, "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    groups = rooted.groupBy("root").agg(
        F.min("_least").alias("component_id"), F.min("_pick").alias("_pick")
    )
    groups = materialise(groups, "groups")  # a large component's rows can be split in the join
    labelled = rooted.select("fingerprint", "root").join(groups, "root").drop("root")
    picked = F.struct(doc, "text_hash").eqNullSafe(F.col("_pick"))
    return prints.join(labelled, "fingerprint").select(
        doc, "text_hash", "fingerprint", "component_id", picked.alias("chosen")
    )
