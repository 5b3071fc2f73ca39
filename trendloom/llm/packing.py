"""Best-fit packing of tokenised documents by a configuration program.

Only the histogram of piece lengths (as many numbers as a sequence has tokens) reaches
the driver. There a configuration linear program, how often to use each way to fill a
sequence, is solved by multiplicative weights with knapsack pricing, rounded down, and
what is left is placed best-fit by length class. The plan is a table of runs: pieces of
one length and consecutive ranks go to consecutive sequences. Tasks look their pieces up
by length and rank; ranks come from counts per input partition and length.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendloom.llm.arrow import text_bytes
from trendloom.sources.workspace import materialise


def _byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=4)
def load_tokenizer(path: str, pattern: str) -> Callable[[str], list[int]]:
    """Text to ids with the byte-level BPE vocabulary of a ``tokenizers`` file.

    tiktoken merges by id, which gives the file's ids where ids follow the merges; that
    is checked, and other files are left to ``tokenizers`` itself, about nine times slower.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocabulary = spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    made = [vocabulary["".join(m)] for m in merges]
    plain = spec["normalizer"] is None and spec["pre_tokenizer"] == {
        "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True,
    }
    if plain and made == sorted(set(made)):
        import tiktoken

        byte = _byte_letters()
        ranks = {bytes(byte[c] for c in w): i for w, i in vocabulary.items() if w not in special}
        coder = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        return lambda text: coder.encode(text, allowed_special="all")
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    return lambda text: slow.encode(text, add_special_tokens=False).ids


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; only the first may be short."""
    first = n % size or min(n, size)
    return [(0, first), *[(s, size) for s in range(first, n, size)]] if n else []


# --- the plan ----------------------------------------------------------------


def best_configuration(price: np.ndarray, size: int) -> np.ndarray:
    """The most valuable multiset of lengths within ``size``: unbounded knapsack.

    ``price[l]`` is the value of length l, minus infinity for lengths not in use.
    """
    best = np.zeros(size + 1)
    choice = np.zeros(size + 1, np.int64)
    backward = price[::-1]
    for room in range(1, size + 1):
        value = backward[size - room : size] + best[:room]  # length room - i beside a fill of i
        i = int(value.argmax())
        if value[i] > best[room - 1]:
            best[room], choice[room] = value[i], room - i
        else:
            best[room] = best[room - 1]
    counts = np.zeros(size + 1, np.int64)
    room = size
    while room > 0:
        if choice[room] == 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= choice[room]
    return counts


def solve(
    histogram: np.ndarray, size: int, step: float = 0.5, rest: float = 0.25, rate: float = 0.1
) -> tuple[list[tuple[float, np.ndarray]], float]:
    """Configurations with their fractional use, and the dual bound on the sum of uses.

    Multiplicative weights over the lengths: a length's price is its size, the optimal
    dual where filling is perfect, with long pieces a little dearer, since short ones fill
    gaps later, times a factor that falls with its coverage. A configuration is used for ``step`` of what its scarcest length still needs, or all of
    it once that is below ``rest`` of the length's pieces; a covered length leaves the
    program. Every round thus finishes a length or halves what it needs, whatever the
    counts are, so rounds are bounded by the lengths in use and all lengths get covered.
    Any prices give a bound: their worth of all pieces by that of the best configuration.
    """
    need = histogram.astype(float)
    left = need.copy()
    out: dict[bytes, list] = {}
    share = np.arange(size + 1) / size
    # priced by size, and by one for pieces of which no two fit together
    bound = max(float(need @ share), float(need[2 * share > 1].sum()))
    while (used := left > 0).any():
        covered = 1 - left[used] / need[used]
        price = np.full(size + 1, -np.inf)
        price[used] = share[used] ** 1.1 * np.exp(-rate * (covered - covered.min()))
        counts = best_configuration(price, size)
        held = np.flatnonzero(counts)
        if np.array_equal(used, need > 0):  # a bound needs prices for all pieces
            bound = max(bound, float(need[used] @ price[used]) / float(counts[held] @ price[held]))
        times = left[held] / counts[held]
        scarce = held[int(times.argmin())]
        whole = left[scarce] <= rest * need[scarce]
        amount = float(times.min()) * (1.0 if whole else step)
        out.setdefault(counts.tobytes(), [0.0, counts])[0] += amount
        left[held] = np.maximum(left[held] - amount * counts[held], 0)
        if whole:
            left[scarce] = 0
    return [tuple(x) for x in out.values()], bound


class Plan:
    """Runs (length, first rank, count, first sequence, offset), in the making."""

    def __init__(self, histogram: np.ndarray, size: int):
        self.size, self.left, self.next = size, histogram.astype(np.int64).copy(), 0
        self.placed = np.zeros(size + 1, np.int64)
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.room: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]

    def put(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.runs.append((length, int(self.placed[length]), count, sequence, offset))
        self.placed[length] += count
        self.left[length] -= count

    def use(self, counts: np.ndarray, times: int) -> None:
        at, offset = self.next, 0
        for length in np.flatnonzero(counts).tolist():
            for _ in range(int(counts[length])):
                self.put(length, times, at, offset)
                offset += length
        self.next += times
        self.room[self.size - offset].append((at, times))

    def best_fit(self) -> None:
        """What is left, longest first, each into the fullest sequences that take it."""
        for length in range(self.size, 0, -1):
            while self.left[length] > 0:
                room = next((r for r in range(length, self.size + 1) if self.room[r]), None)
                if room is None:
                    break
                at, count = self.room[room].pop()
                take = min(count, int(self.left[length]))
                if take < count:
                    self.room[room].append((at + take, count - take))
                self.put(length, take, at, self.size - room)
                self.room[room - length].append((at, take))
            many = self.size // length
            while self.left[length] > 0:
                each = min(many, int(self.left[length]))
                counts = np.zeros(self.size + 1, np.int64)
                counts[length] = each
                self.use(counts, int(self.left[length]) // each)


def plan(histogram: np.ndarray, size: int) -> np.ndarray:
    """The runs for a histogram indexed by length, sorted by length and rank."""
    made = Plan(histogram, size)
    if made.left.sum():
        uses, _ = solve(histogram, size)
        # whole uses first, then once more where the fraction is large and the pieces are left
        down = [(int(amount), counts) for amount, counts in sorted(uses, key=lambda x: -x[0])]
        up = [(1, counts) for amount, counts in sorted(uses, key=lambda x: -(x[0] % 1)) if amount % 1]
        for most, counts in down + up:
            held = counts > 0
            times = min(most, int((made.left[held] // counts[held]).min()))
            if times:
                made.use(counts, times)
        made.best_fit()
    runs = np.array(made.runs, np.int64).reshape(-1, 5)
    return runs[np.lexsort((runs[:, 1], runs[:, 0]))]


# --- the jobs ----------------------------------------------------------------

_PIECE = "piece int, start bigint, length bigint, ids_crc32 bigint, _part int, _nth bigint"


def tokenised_pieces(docs: DataFrame, load: Callable[[], Callable], end_id: int, size: int, doc: str, text: str) -> DataFrame:
    """One row per piece, with its input partition and its place among equals there."""
    kind = docs.schema[doc].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = load(), TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in batches:
            rows = []
            for i, t in enumerate(batch.column(1).to_pylist()):
                ids = np.array([*encode(t.decode("utf-8", "replace")), end_id], "<u4")
                for k, (start, length) in enumerate(cut(len(ids), size)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    rows.append((i, k, start, length, crc, part, int(seen[length])))
                    seen[length] += 1
            if rows:
                at, *columns = zip(*rows, strict=True)
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                made = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                names = [doc, "piece", "start", "length", "ids_crc32", "_part", "_nth"]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *made], names)

    return docs.select(F.col(f"`{doc}`"), text_bytes(text)).mapInArrow(run, f"`{doc}` {kind}, {_PIECE}")


def pack(
    docs: DataFrame,
    load: Callable[[], Callable[[str], list[int]]],
    size: int = 1024,
    end_id: int = 2,
    doc: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    ``load`` gives, in a task, the function from text to ids. Null texts are empty, so
    their only token is ``end_id``. Repeated rows are packed once each. Other columns
    are dropped; an empty table gives no rows.
    """
    pieces = materialise(tokenised_pieces(docs, load, end_id, size, doc, text), "pieces")
    counts = pieces.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    histogram = np.zeros(size + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    runs = docs.sparkSession.sparkContext.broadcast(plan(histogram, size))
    names = [doc, "piece", "start", "length", "ids_crc32"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = runs.value
        keys = (table[:, 0] << 44) + table[:, 1]
        for batch in batches:
            length, rank = np.asarray(batch.column(3)), np.asarray(batch.column(5))
            run = table[np.searchsorted(keys, (length << 44) + rank, "right") - 1]
            columns = [batch.column(i) for i in range(5)]
            made = [pa.array(run[:, 3] + rank - run[:, 1]), pa.array(run[:, 4])]
            yield pa.RecordBatch.from_arrays(columns + made, [*names, "sequence_id", "offset"])

    found = pieces.join(ranked.drop("_n"), ["_part", "length"]).select(
        *[F.col(f"`{n}`") for n in names], (F.col("_base") + F.col("_nth")).alias("_rank")
    )
    kind = docs.schema[doc].dataType.simpleString()
    return found.mapInArrow(
        place,
        f"`{doc}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "sequence_id bigint, offset bigint",
    )
