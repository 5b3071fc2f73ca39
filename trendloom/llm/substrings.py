"""Removal of every byte covered by a string of 400 bytes that also starts elsewhere.

1. Anchors. The least hash among the ``gram``-byte strings of every window is an anchor
   (winnowing). A long enough string holds an anchor that its own bytes decide, so equal
   strings share one at the same place. What can match around an anchor is its context.
2. Anchors that occur once are done. Contexts that occur twice as a whole are covered as
   a whole. What is left are anchors with differing contexts, one text of each context.
3. Those contexts are cut into phrases where their own bytes say so, the phrases named,
   and a suffix array over the names built by linear grouping. Neighbours in it that
   share enough bytes form a class; windows are compared byte-exactly (by hash) with
   the windows of their class only. Windows without phrases, in stretches of a short
   period, are a class of their own.
4. Covered spans go back to their documents.

An anchor with more than ``MOST_CONTEXTS`` contexts is not gathered in a task: its
windows are hashed, counted with map-side combination, and joined back.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.llm.arrow import text_bytes
from trendloom.llm.suffix import neighbours_share, suffix_array
from trendloom.sources.workspace import materialise

GRAM = 200
MOST_CONTEXTS = 20_000
#: Contexts of one suffix array, as long as a single anchor has no more; contexts whose
#: windows are compared at once.
CHUNK_CONTEXTS, ROUND_CONTEXTS = 1500, 3000
#: Phrases begin at the least hash of PHRASE_GRAM bytes among PHRASE_SPAN places, but in
#: a stretch that repeats itself at the first such place only.
PHRASE_SPAN, PHRASE_GRAM = 64, 16
#: Bytes on either side of a string within which its own bytes do not decide a beginning.
BEFORE, BEHIND = 2 * PHRASE_SPAN + PHRASE_GRAM, PHRASE_SPAN + PHRASE_GRAM

#: Bytes that are hashed at once.
_BLOCK = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_STEP = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Powers of the hash base and of its inverse, as far as any text needed them."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            size = max(n, 2 * len(cls.up), 1 << 16)
            cls.up, cls.down = np.full(size, _BASE, np.uint64), np.full(size, _STEP, np.uint64)
            for powers in (cls.up, cls.down):
                powers[0] = 1
                np.multiply.accumulate(powers, out=powers)
        return cls.up, cls.down


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads polynomial hashes, whose low bits are weak, over all bits."""
    for _ in range(2):
        x = x ^ (x >> np.uint64(32))
        x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Hashes:
    """Hashes of the parts of a byte string, from one running sum.

    ``within`` is each byte's place in its own text where ``data`` joins many texts;
    parts must then lie in one text, and the powers go no further than a text.
    """

    def __init__(self, data: np.ndarray, within: np.ndarray | None = None):
        self.within = np.arange(len(data) + 1) if within is None else np.append(within, 0)
        up, self.down = _Powers.upto(int(self.within.max()) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        terms = self.sums[1:]
        for at in range(0, len(data), _BLOCK):  # in blocks and in place, for memory
            part = data[at : at + _BLOCK].astype(np.uint64) + np.uint64(1)
            part *= up[self.within[at : at + len(part)]]
            terms[at : at + len(part)] = part
        np.cumsum(terms, out=terms)

    def part(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.down[self.within[start]]
        return mix(raw + mix((end - start).astype(np.uint64)))

    def grams(self, size: int, start: int, end: int) -> np.ndarray:
        """Hashes of the strings of ``size`` bytes that begin from ``start`` to ``end``."""
        raw = self.sums[start + size : end + size] - self.sums[start:end]
        raw *= self.down[self.within[start:end]]
        return mix(raw)


def _sliding(values: np.ndarray, span: int, best: np.ufunc, rest: int) -> np.ndarray:
    """``best`` of every ``span`` neighbours."""
    n = len(values)
    grid = np.full(-(-n // span) * span, rest, values.dtype)
    grid[:n] = values
    grid = grid.reshape(-1, span)
    ahead = best.accumulate(grid, axis=1).ravel()
    behind = best.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: n - span + 1], ahead[span - 1 : n])


def winnow(hashes: np.ndarray, span: int) -> np.ndarray:
    """Places that hold the least hash of some ``span`` neighbours."""
    if len(hashes) < span:
        return np.zeros(0, np.int64)
    least = _sliding(hashes, span, np.minimum, np.iinfo(np.uint64).max)
    edge = np.zeros(span - 1, np.uint64)
    return np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), span, np.maximum, 0) == hashes)


def chosen_grams(known: Hashes, size: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the grams that ``winnow`` chooses, a block at a time."""
    n = len(known.sums) - size
    places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for at in range(0, n, _BLOCK) if n >= span else ():
        low, high = max(0, at - span + 1), min(n, at + _BLOCK + span - 1)
        grams = known.grams(size, low, high)
        found = winnow(grams, span)
        found = found[(found + low >= at) & (found + low < at + _BLOCK)]
        places.append(found + low)
        hashes.append(grams[found])
    return np.concatenate(places), np.concatenate(hashes)


def anchors(text: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, hashes, hashes of the contexts) of the anchors of a text."""
    if len(text) < length:
        return (np.zeros(0, np.int64), *[np.zeros(0, np.uint64)] * 2)
    known = Hashes(np.frombuffer(text, np.uint8))
    at, grams = chosen_grams(known, gram, length - gram + 1)
    left = np.maximum(at - (length - gram), 0)
    context = known.part(left, np.minimum(at + length, len(text)))
    return at, grams, mix(context + (at - left).astype(np.uint64))


# --- the suffix-array step ---------------------------------------------------


def least_shared(length: int) -> int:
    """What equal strings share in whole phrases, outside stretches of a short period."""
    return length - BEFORE - BEHIND - 2 * PHRASE_SPAN


def phrase_classes(known: Hashes, edges: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(boundaries, class of the suffix at each) for the texts between ``edges``.

    Suffixes of one class share at least ``least_shared`` bytes, phrase by phrase. -1: no
    other suffix does.
    """
    cuts, grams = chosen_grams(known, PHRASE_GRAM, PHRASE_SPAN)
    if len(cuts):
        again = (grams[1:] == grams[:-1]) & (np.diff(cuts) < PHRASE_SPAN)
        cuts = cuts[np.append(True, ~again)]
    least = least_shared(length)
    owner = np.searchsorted(edges, cuts, "right")
    inner = owner[:-1] == owner[1:]  # a phrase lies between two cuts of one text
    phrases = known.part(cuts[:-1][inner], cuts[1:][inner])
    _, names, counts = np.unique(phrases, return_inverse=True, return_counts=True)
    alone = np.ones(len(cuts), bool)  # ends of texts, and phrases that occur once
    alone[:-1][inner] = counts[names] == 1
    symbols = np.arange(len(cuts))
    symbols[:-1][inner] = np.where(counts[names] == 1, symbols[:-1][inner], len(cuts) + names)
    # nothing matches across a lone symbol, so one stands for a whole run of them
    kept = np.flatnonzero(~alone | np.append(True, ~alone[:-1]))[: len(cuts)]
    array = suffix_array(symbols[kept])
    near = neighbours_share(symbols[kept], array, cuts[kept], least)
    order = kept[np.array(array, np.int64)]
    run = np.cumsum(~near)
    classes = np.full(len(cuts), -1)
    classes[order] = np.where(near | np.append(near[1:], False), run, -1)
    return cuts, classes


def repeated_windows(
    texts: list[bytes], places: np.ndarray, often: np.ndarray, length: int
) -> list[np.ndarray]:
    """For each text the starts of windows that also start elsewhere.

    ``places`` identifies the first byte of each text in the corpus, so that overlapping
    texts of one document do not match themselves; ``often`` marks texts that occur twice.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    edges = np.cumsum(sizes)
    within = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
    known = Hashes(np.frombuffer(b"".join(texts), np.uint8), within)
    cuts, classes = phrase_classes(known, edges, length)
    out: list[list[np.ndarray]] = [[] for _ in texts]
    rounds = 1 + len(texts) // ROUND_CONTEXTS
    for turn in range(rounds):  # each compares a share of the windows, for memory
        key, owner, offset = _keyed_windows(known, cuts, classes, edges - sizes, sizes, length, turn, rounds)
        if not len(key):
            continue
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        place = (places[owner] + offset)[order]
        twice = np.minimum.reduceat(place, first) != np.maximum.reduceat(place, first)
        twice |= np.maximum.reduceat(often[owner][order], first)
        flagged = np.zeros(len(key), bool)
        flagged[order] = np.repeat(twice, np.diff(np.append(first, len(key))))
        ends = np.searchsorted(owner, np.arange(len(texts) + 1))
        for i in np.unique(owner[flagged]).tolist():
            a, b = ends[i], ends[i + 1]
            out[i].append(offset[a:b][flagged[a:b]])
    return [np.concatenate(x) if x else np.zeros(0, np.int32) for x in out]


def _keyed_windows(
    known: Hashes, cuts: np.ndarray, classes: np.ndarray, begins: np.ndarray, sizes: np.ndarray,
    length: int, turn: int, rounds: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, text, offset) of one share of the windows; equal windows have equal keys."""
    least, none = least_shared(length), np.uint64(1 << 40)
    place, of_cut = np.append(cuts, 0), np.append(classes, -1)
    keys, owners, offsets = [], [], []
    for at in range(0, len(sizes), 250):
        counts = np.maximum(sizes[at : at + 250] - length + 1, 0)
        owner = np.repeat(np.arange(at, at + len(counts)), counts)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = offset + begins[owner]
        # the first and the last boundary that the window's bytes decide
        inner = np.searchsorted(cuts, start + BEFORE)
        last = np.searchsorted(cuts, start + length - BEHIND, "right") - 1
        phrased = (place[last] - place[inner] >= least) & (inner < len(cuts)) & (last > inner)
        of = of_cut[inner]
        ahead = np.where(phrased, place[inner] - start, 0).astype(np.uint64)
        key = np.where(phrased, of, 0).astype(np.uint64) + np.where(phrased, np.uint64(0), none)
        key = mix(known.part(start, start + length) + mix(key * np.uint64(1024) + ahead))
        open_ = ((of >= 0) | ~phrased) & (key % np.uint64(rounds) == turn)
        keys.append(key[open_])
        owners.append(owner[open_].astype(np.int32))
        offsets.append(offset[open_].astype(np.int32))
    return tuple(np.concatenate(x) for x in (keys, owners, offsets))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans with overlapping and touching ones joined."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > ends[:-1])
    return starts[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]


# --- the jobs ----------------------------------------------------------------


def _portions(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Small slices of the batches: what is made of one is sent before the next."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


class _Job:
    def __init__(self, docs: DataFrame, length: int, gram: int, most: int, doc: str, text: str):
        self.length, self.gram, self.most, self.doc = length, gram, most, doc
        self.kind = docs.schema[doc].dataType.simpleString()
        self.plain = docs.select(F.col(f"`{doc}`").alias("doc"), text_bytes(text).alias("text"))
        self.spark = docs.sparkSession

    def occurrences(self) -> DataFrame:
        """(hash, ctx, doc, crc, pos): every anchor of every text."""
        length, gram = self.length, self.gram

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _portions(batches):
                index, crc, found = [], [], []
                for i, t in enumerate(batch.column(1)):
                    data = t.as_py()
                    at = anchors(data, length, gram)
                    found.append(at)
                    index.append(np.full(len(at[0]), i))
                    crc.append(np.full(len(at[0]), zlib.crc32(data), np.int64))
                if found:
                    at, hashes, contexts = (np.concatenate(x) for x in zip(*found, strict=True))
                    ids = batch.column(0).take(pa.array(np.concatenate(index)))
                    yield pa.RecordBatch.from_arrays(
                        [_signed(hashes), _signed(contexts), ids, pa.array(np.concatenate(crc)), pa.array(at)],
                        ["hash", "ctx", "doc", "crc", "pos"],
                    )

        return self.plain.mapInArrow(run, f"hash bigint, ctx bigint, doc {self.kind}, crc bigint, pos bigint")

    def packed(self) -> DataFrame:
        """(doc, crc, packed): the texts, compressed for the way."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            press = zstandard.ZstdCompressor(level=3)
            for batch in _portions(batches):
                texts = [t.as_py() for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([zlib.crc32(t) for t in texts], pa.int64()), pa.array([press.compress(t) for t in texts], pa.binary())],
                    ["doc", "crc", "packed"],
                )

        return self.plain.mapInArrow(run, f"doc {self.kind}, crc bigint, packed binary")

    def with_texts(self, wanted: DataFrame, column: str) -> DataFrame:
        """(doc, crc, column, packed) for the documents of ``wanted``; left where all are."""
        texts = self.packed()
        same = texts["doc"].eqNullSafe(wanted["doc"]) & (texts["crc"] == wanted["crc"])
        return texts.join(wanted, same, "left").select(texts["doc"], texts["crc"], column, "packed")

    def contexts(self, wanted: DataFrame) -> DataFrame:
        """The bytes of the contexts in ``wanted`` (hash, doc, crc, pos, often)."""
        back, length = self.length - self.gram, self.length
        asked = wanted.groupBy("doc", "crc").agg(F.collect_list(F.struct("hash", "pos", "often")).alias("asked"))
        schema = f"hash bigint, doc {self.kind}, crc bigint, pos bigint, often boolean, left bigint, bytes binary"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            press = zstandard.ZstdDecompressor()
            for batch in _portions(batches):
                rows = []
                for i, (asked_, packed) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                    if not asked_.is_valid:
                        continue
                    text = press.decompress(packed.as_py())
                    for a in asked_.as_py():
                        left = min(a["pos"], back)
                        part = text[a["pos"] - left : a["pos"] + length]
                        rows.append((a["hash"], i, a["pos"], a["often"], left, part))
                for at in range(0, len(rows), 5000):
                    hashes, index, pos, often, left, parts = zip(*rows[at : at + 5000], strict=True)
                    take = pa.array(index)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes, pa.int64()), batch.column(0).take(take), batch.column(1).take(take),
                         pa.array(pos, pa.int64()), pa.array(often), pa.array(left, pa.int64()), pa.array(parts, pa.binary())],
                        ["hash", "doc", "crc", "pos", "often", "left", "bytes"],
                    )

        # a text is fetched once, also where its row is repeated
        found = self.with_texts(asked, "asked").where(F.col("asked").isNotNull())
        return found.mapInArrow(run, schema)

    def spans_by_array(self, contexts: DataFrame) -> DataFrame:
        """(doc, crc, start, end) of what repeats within the contexts of each anchor."""
        length = self.length
        dealt = contexts.repartition("hash").sortWithinPartitions("hash", "doc", "crc", "pos")

        def spans(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
            docs = chunk.column("doc").combine_chunks()
            crc, pos, left = (chunk.column(n).to_numpy() for n in ("crc", "pos", "left"))
            number = docs.dictionary_encode(null_encoding="encode").indices.to_numpy()
            base = np.unique(np.stack([number, crc]), axis=1, return_inverse=True)[1].ravel()
            first = pos - left
            often = chunk.column("often").to_numpy()
            found = repeated_windows(
                [x.as_py() for x in chunk.column("bytes")], (base.astype(np.int64) << 40) + first, often, length
            )
            index, starts, ends = [], [], []
            for i, at in enumerate(found):
                a, b = merged(at + first[i], at + first[i] + length)
                index += [i] * len(a)
                starts += a.tolist()
                ends += b.tolist()
            if index:
                take = pa.array(index)
                yield pa.RecordBatch.from_arrays(
                    [docs.take(take), pa.array(crc).take(take), pa.array(starts), pa.array(ends)],
                    ["doc", "crc", "start", "end"],
                )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: pa.Table | None = None
            for batch in batches:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table])
                hashes = held.column("hash").to_numpy()
                ends = np.append(np.flatnonzero(np.diff(hashes)) + 1, 0)[:-1]  # the last group may go on
                at = 0
                while len(ends) and ends[-1] - at >= CHUNK_CONTEXTS:
                    end = int(ends[np.searchsorted(ends, at + CHUNK_CONTEXTS)])
                    yield from spans(held.slice(at, end - at))
                    at = end
                held = held.slice(at).combine_chunks()
            if held is not None and len(held):
                yield from spans(held)

        return dealt.mapInArrow(run, f"doc {self.kind}, crc bigint, start bigint, end bigint")

    def spans_by_count(self, contexts: DataFrame) -> DataFrame:
        """The same for anchors with very many contexts: windows are counted, not gathered."""
        length = self.length
        schema = f"key bigint, win bigint, doc {self.kind}, crc bigint, start bigint, often boolean"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, part in enumerate(batch.column("bytes")):
                    data = np.frombuffer(part.as_buffer(), np.uint8)
                    n = len(data) - length + 1
                    if n < 1:
                        continue
                    at, left = np.arange(n), batch.column("left")[i].as_py()
                    window = Hashes(data).part(at, at + length)
                    key = mix(np.uint64(batch.column("hash")[i].as_py() % (1 << 64)) + (left - at).astype(np.uint64))
                    take = pa.array(np.full(n, i))
                    yield pa.RecordBatch.from_arrays(
                        [_signed(key), _signed(window), batch.column("doc").take(take), batch.column("crc").take(take),
                         pa.array(batch.column("pos")[i].as_py() - left + at), batch.column("often").take(take)],
                        ["key", "win", "doc", "crc", "start", "often"],
                    )

        windows = contexts.mapInArrow(run, schema)
        place = F.struct("doc", "crc", "start")
        twice = (
            windows.groupBy("key", "win")
            .agg(F.min(place).alias("a"), F.max(place).alias("b"), F.max("often").alias("o"))
            .where(F.col("o") | ~F.col("a").eqNullSafe(F.col("b")))
        )
        twice = materialise(twice.select("key", "win"), "windows")  # a hot window can be split
        return windows.join(twice, ["key", "win"]).select(
            "doc", "crc", "start", (F.col("start") + length).alias("end")
        )

    def spans(self) -> DataFrame:
        """(doc, crc, start, end); the spans of whole contexts may reach beyond the text."""
        found = materialise(self.occurrences(), "anchors")
        groups = found.groupBy("hash").agg(
            F.count(F.lit(1)).alias("n"), (F.min("ctx") == F.max("ctx")).alias("alike")
        )
        # stored, so that both sides of the join are shuffled and a hot hash can be split
        groups = materialise(groups.where("n > 1").drop("n"), "groups")
        again = materialise(found.join(groups, "hash"), "repeated")
        start, end = F.col("pos") - (self.length - self.gram), F.col("pos") + self.length
        whole = lambda df: df.select("doc", "crc", start.alias("start"), end.alias("end"))
        mixed = again.where(~F.col("alike"))
        kinds = mixed.groupBy("hash", "ctx").agg(
            F.count(F.lit(1)).alias("m"), F.min(F.struct("doc", "crc", "pos")).alias("one")
        )
        kinds = materialise(kinds, "contexts")
        often = kinds.where("m > 1").select("hash", "ctx")
        wanted = kinds.select("hash", "one.doc", "one.crc", "one.pos", (F.col("m") > 1).alias("often"))
        spans = whole(again.where("alike")).union(whole(mixed.join(often, ["hash", "ctx"])))
        by_hash = kinds.groupBy("hash").agg(F.count(F.lit(1)).alias("k"))
        largest = by_hash.agg(F.max("k")).first()[0] or 0
        if largest > self.most:
            hot = by_hash.where(F.col("k") > self.most).select("hash")
            spans = spans.union(self.spans_by_count(self.contexts(wanted.join(hot, "hash", "left_semi"))))
            wanted = wanted.join(hot, "hash", "left_anti")
        return spans.union(self.spans_by_array(self.contexts(wanted)))

    def run(self) -> DataFrame:
        length = self.length
        spans = self.spans().groupBy("doc", "crc").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
        schema = T.StructType.fromDDL(
            f"`{self.doc}` {self.kind}, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"
        )

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            press = zstandard.ZstdDecompressor()
            for batch in _portions(batches):
                sizes, gone, kept = [], [], []
                for spans_, packed in zip(batch.column(2), batch.column(3), strict=True):
                    text = press.decompress(packed.as_py())
                    pairs = np.array([(s["start"], s["end"]) for s in spans_.as_py() or []], np.int64).reshape(-1, 2)
                    a, b = np.clip(pairs, 0, len(text)).T
                    held = b - a >= length  # a context cut short by the text's ends holds no window
                    a, b = merged(a[held], b[held])
                    edges = [0, *np.stack([a, b], axis=1).ravel().tolist(), len(text)]
                    sizes.append(len(text))
                    gone.append([{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)])
                    kept.append(b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, span), pa.array(kept, pa.binary())],
                    schema.fieldNames(),
                )

        return self.with_texts(spans, "spans").mapInArrow(cut, schema)


def remove_repeats(
    docs: DataFrame,
    length: int = 400,
    gram: int | None = None,
    most_contexts: int = MOST_CONTEXTS,
    doc: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc, n_bytes, spans, kept), one row per row of ``docs``.

    Null texts are empty; texts shorter than ``length`` bytes keep all. Repeated rows are
    texts of their own, so each repeats the other. Matches never cross documents, and
    overlaps within one document count. ``length`` must leave room for phrases, about 360.
    Other columns are dropped; an empty table gives no rows.
    """
    if least_shared(length) < 1:
        raise ValueError(f"length {length} is too short for phrases of {PHRASE_SPAN} bytes")
    return _Job(docs, length, gram or length // 2, most_contexts, doc, text).run()
