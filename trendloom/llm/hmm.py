"""A hidden Markov language model over word classes, trained on all training texts.

A word's class is a hash of its last letters, so states share the words of a class. A
text's probability is that of its class sequence under the chain, times that of each
word within its class, which comes from the counts of the whole corpus; an unseen word
takes one unit of its class.

Texts are cut into blocks. A block keeps its texts as numbers into its own word list, so
the word counts are gathered with one row for each block and distinct word, not one for
each word of a text, and travel back to the blocks in the same way. Baum-Welch runs on
the stored class sequences; each task adds up its expected counts, and only sums of a
fixed size (classes times states) reach the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.llm.arrow import text_bytes
from trendloom.sources.workspace import materialise

CLASSES, STATES = 256, 8
#: Training ends with the first round that gains less than ``LEAST_GAIN`` (log10) a token.
ROUNDS, LEAST_GAIN = 12, 0.001
#: Text bytes of a block; tokens of one batch of the recursions.
BLOCK_BYTES, BATCH_TOKENS = 12_000_000, 300_000
#: Tokens of a training window, and those before it that its states are warmed up on.
WINDOW, LEAD = 256, 16
END = b"\n"  #: no word holds white space


def word_class(word: bytes, classes: int = CLASSES) -> int:
    """0 for the end of a text, else a hash of the last three bytes."""
    return 0 if word == END else zlib.crc32(word[-3:]) % (classes - 1) + 1


# --- blocks ------------------------------------------------------------------


def _planes(ids: np.ndarray) -> bytes:
    """32-bit numbers by byte planes; the high ones are mostly zero and compress well."""
    return np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    raw = np.frombuffer(planes, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(raw.T).view("<u4").ravel().astype(np.int64)


class _Block:
    def __init__(self):
        self.words: dict[bytes, int] = {}
        self.rows: list[tuple] = []
        self.train: list[np.ndarray] = []
        self.bytes = 0

    def add(self, doc, held: bool, text: bytes) -> None:
        words, found = self.words, text.lower().split()
        found.append(END)
        ids = np.array([words.setdefault(w, len(words)) for w in found], np.int32)
        self.rows.append((doc, held, ids))
        if not held:
            self.train.append(ids)
        self.bytes += len(text)


def _blocks(docs: DataFrame, doc: str, text: str, held: Column) -> DataFrame:
    """Rows of two kinds: texts (doc, held, ids, classes) and a block's words (word, n)."""
    kind = docs.schema[doc].dataType
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("doc", kind),
            T.StructField("held", T.BooleanType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("classes", T.BinaryType()),
            T.StructField("word", T.BinaryType()),
            T.StructField("nth", T.IntegerType()),
            T.StructField("n", T.LongType()),
        ]
    )
    names = schema.fieldNames()

    def emit(block: _Block, number: int, doc_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        words = list(block.words)
        of = np.array([word_class(w) for w in words], np.uint8)
        n = len(block.rows)
        ids = [r[2] for r in block.rows]
        columns = [
            pa.array([number] * n), pa.array([r[0] for r in block.rows], doc_type),
            pa.array([r[1] for r in block.rows]), pa.array([_planes(x) for x in ids], pa.binary()),
            pa.array([of[x].tobytes() for x in ids], pa.binary()),
            pa.nulls(n, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names)
        counts = np.zeros(len(words), np.int64)
        if block.train:
            counts += np.bincount(np.concatenate(block.train), minlength=len(words))
        for at in range(0, len(words), 50_000):
            part = words[at : at + 50_000]
            m = len(part)
            columns = [
                pa.array([number] * m), pa.nulls(m, doc_type), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.binary()),
                pa.nulls(m, pa.binary()), pa.array(part, pa.binary()),
                pa.array(np.arange(at, at + m, dtype=np.int32)), pa.array(counts[at : at + m]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number, doc_type = _Block(), TaskContext.get().partitionId() << 32, pa.null()
        for batch in batches:
            doc_type = batch.column(0).type
            docs_, held_ = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, text_ in enumerate(batch.column(2)):
                block.add(docs_[i], held_[i], text_.as_py())
                if block.bytes >= BLOCK_BYTES:
                    yield from emit(block, number, doc_type)
                    block, number = _Block(), number + 1
        if block.rows:
            yield from emit(block, number, doc_type)

    plain = docs.select(F.col(f"`{doc}`"), F.coalesce(held, F.lit(False)), text_bytes(text))
    return materialise(plain.mapInArrow(run, schema), "blocks")


def _word_counts(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(block, nth, c): each block word's count in all training texts; and (class, n, v).

    A frequent word has a row in every block. Rows meet by word and group of blocks, whose
    number bounds what meets in one task; the words that several groups hold are then
    completed from the sums of their groups, a row for each word and group.
    """
    block = F.col("block")  # input partition and number within it
    group = F.shiftright(block, 40) * (1 << 20) + F.shiftright(block.bitwiseAND(F.lit((1 << 32) - 1)), 12)
    words = blocks.where(F.col("word").isNotNull()).select("block", "nth", "word", "n", group.alias("group"))
    same = Window.partitionBy("word", "group")
    summed = materialise(
        words.select(
            "block", "nth", "word", "group",
            F.sum("n").over(same).alias("part"),
            (F.row_number().over(same.orderBy("block")) == 1).alias("first"),
        ),
        "summed",
    )
    tail = F.when(F.length("word") > 3, F.substring("word", -3, 3)).otherwise(F.col("word"))
    kind = F.when(F.col("word") == F.lit(END), 0).otherwise(F.crc32(tail) % (CLASSES - 1) + 1)
    everywhere = Window.partitionBy("word")
    totals = materialise(
        summed.where("first").select(
            "word", "group", kind.cast("int").alias("class"),
            F.sum("part").over(everywhere).alias("total"),
            (F.col("group") == F.min("group").over(everywhere)).alias("once"),
            F.count(F.lit(1)).over(everywhere).alias("groups"),
        ),
        "totals",
    )
    # stored, so that Spark plans the join by its size: it is empty within one group
    spread = materialise(totals.where("groups > 1").select("word", "group", "total"), "spread")
    counts = summed.join(spread, ["word", "group"], "left").select(
        "block", "nth", F.coalesce("total", "part").alias("c")
    )
    by_class = totals.where("once").groupBy("class").agg(
        F.sum("total").alias("n"), F.sum(F.expr("int(total > 0)")).alias("v")
    )
    return counts, by_class


# --- Baum-Welch --------------------------------------------------------------


@dataclass(frozen=True)
class Chain:
    start: np.ndarray  #: (states,)
    moves: np.ndarray  #: (states, states), rows add up to 1
    emits: np.ndarray  #: (states, classes), rows add up to 1


def _padded(sequences: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(indices, classes by time and sequence, lengths): similar lengths, longest first."""
    lengths = np.array([len(s) for s in sequences])
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        longest = int(lengths[order[at]])
        most = max(1, BATCH_TOKENS // max(longest, 1))
        part = order[at : at + most]
        part = part[lengths[part] * 2 >= longest]
        grid = np.zeros((longest, len(part)), np.uint8)
        for j, i in enumerate(part):
            grid[: lengths[i], j] = sequences[i]
        yield part, grid, lengths[part]
        at += len(part)


def _active(lengths: np.ndarray, steps: int) -> np.ndarray:
    """How many sequences, longest first, have a token at each step."""
    return np.searchsorted(-lengths, -np.arange(steps), "left")


def log_likelihoods(chain: Chain, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 of each class sequence's probability: the scaled forward recursion, exact."""
    out = np.zeros(len(sequences))
    emits = np.ascontiguousarray(chain.emits.T)
    for part, grid, lengths in _padded(sequences):
        active = _active(lengths, len(grid))
        total = np.zeros(len(part))
        alpha = np.repeat(chain.start[None], len(part), 0)
        for t, n in enumerate(active.tolist()):
            alpha = (alpha[:n] if t == 0 else alpha[:n] @ chain.moves) * emits[grid[t, :n]]
            scale = alpha.sum(axis=1)
            alpha /= scale[:, None]
            total[:n] += np.log10(scale)
        out[part] = total
    return out


def usual_states(chain: Chain) -> np.ndarray:
    """How often the chain is in each state far from a text's start."""
    return chain.start @ np.linalg.matrix_power(chain.moves, 64)


def expected_counts(
    chain: Chain, sequences: list[np.ndarray], leads: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(starts, moves, emissions, log-likelihood) expected under ``chain``.

    A sequence with a lead of n > 0 tokens is cut from the middle of a text: it begins in
    the chain's usual states, and its first n tokens only warm them up. They count for
    nothing but as the origin of the move to the token that follows.
    """
    if leads is None:
        leads = np.zeros(len(sequences), np.int64)
    inner = usual_states(chain)
    k, classes = chain.emits.shape
    moves, emits_t = chain.moves.astype(np.float32), np.ascontiguousarray(chain.emits.T.astype(np.float32))
    starts, pairs, emitted, likelihood = np.zeros(k), np.zeros((k, k)), np.zeros((classes, k)), 0.0
    for part, grid, lengths in _padded(sequences):
        lead = leads[part]
        active = _active(lengths, len(grid)).tolist()
        at = np.concatenate([[0], np.cumsum(active)])
        seen = np.empty((at[-1], k), np.float32)
        scales = np.empty(at[-1], np.float32)
        alpha = np.where(lead[:, None] > 0, inner, chain.start).astype(np.float32)
        for t, n in enumerate(active):
            alpha = (alpha[:n] if t == 0 else alpha[:n] @ moves) * emits_t[grid[t, :n]]
            scale = alpha.sum(axis=1)
            alpha /= scale[:, None]
            seen[at[t] : at[t + 1]], scales[at[t] : at[t + 1]] = alpha, scale
        warming = min(int(lead.max()), len(active))  # from here on every token counts
        counts = np.concatenate([lead[:n] <= t for t, n in enumerate(active[:warming])] or [[]]).astype(bool)
        likelihood += float(np.log10(scales[at[warming] :], dtype=np.float64).sum())
        likelihood += float(np.log10(scales[: at[warming]][counts], dtype=np.float64).sum())
        beta = np.ones((active[-1], k), np.float32)
        for t in range(len(active) - 1, 0, -1):
            n, before = active[t], active[t - 1]
            ahead = emits_t[grid[t, :n]] * beta
            ahead /= scales[at[t] : at[t + 1], None]
            seen[at[t] : at[t + 1]] *= beta
            origin = seen[at[t - 1] : at[t - 1] + n]
            if t < warming:
                pairs += (origin * counts[at[t] : at[t + 1], None]).T @ ahead
            else:
                pairs += origin.T @ ahead
            beta = np.ones((before, k), np.float32)
            np.matmul(ahead, moves.T, out=beta[:n])
        seen[: at[1]] *= beta
        seen[: at[warming]] *= counts[:, None]
        starts += seen[: at[1]].sum(axis=0)
        flat = np.concatenate([grid[t, :n] for t, n in enumerate(active)])
        for s in range(k):
            emitted[:, s] += np.bincount(flat, seen[:, s], classes)
    return starts, pairs * chain.moves, emitted, likelihood


def _sequences(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint8) for x in batch.column(0)]


def _windows(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Texts cut into windows, each but a text's first with the tokens that lead to it."""
    return [s[max(0, i - LEAD) : i + WINDOW] for s in texts for i in range(0, len(s), WINDOW)]


def _leads(texts: list[np.ndarray]) -> list[int]:
    return [min(i, LEAD) for s in texts for i in range(0, len(s), WINDOW)]


def _portions(sequences: list[np.ndarray], tokens: int = BATCH_TOKENS) -> Iterator[list[np.ndarray]]:
    part, size = [], 0
    for s in sequences:
        part.append(s)
        size += len(s)
        if size >= tokens:
            yield part
            part, size = [], 0
    if part:
        yield part


def _neighbours(texts: DataFrame, classes: int) -> np.ndarray:
    """How often each class follows each other within the training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes * classes, np.int64)
        for batch in batches:
            for part in _portions(_sequences(batch), 4 * BATCH_TOKENS):
                flat = np.concatenate(part).astype(np.int64)
                total += np.bincount(flat[:-1] * classes + flat[1:], minlength=classes * classes)
        rows = total.reshape(classes, classes)
        rows[0] = 0  # what follows an end is another text
        used = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array([rows[i].tobytes() for i in used], pa.binary())], ["class", "counts"]
        )

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer(), np.int64) for x in table.column(1))
        return pa.table({"class": table.column(0).slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "class bigint, counts binary"
    out = np.zeros((classes, classes))
    for row in texts.select("classes").mapInArrow(count, schema).groupBy("class").applyInArrow(add, schema).collect():
        out[row["class"]] = np.frombuffer(row["counts"], np.int64)
    return out


def first_chain(follows: np.ndarray, states: int) -> Chain:
    """Classes with like followers begin in the same state: weighted k-means on the rows."""
    classes = len(follows)
    weight = np.maximum(follows.sum(axis=1), follows.sum(axis=0))
    points = np.sqrt(follows / np.maximum(follows.sum(axis=1, keepdims=True), 1))
    centres = points[[int(weight.argmax())]]
    for _ in range(states - 1):
        far = ((points[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1) * np.sqrt(weight)
        centres = np.vstack([centres, points[int(far.argmax())]])
    for _ in range(20):
        nearest = ((points[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        for s in range(states):
            w = weight * (nearest == s)
            if w.sum():
                centres[s] = (points * w[:, None]).sum(axis=0) / w.sum()
    share = np.full((states, classes), 0.3 / states)
    share[nearest, np.arange(classes)] += 0.7
    share[:, 0] = 1 / states
    emits = share * (weight + 1)
    moves = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Chain(np.full(states, 1 / states), moves, emits / emits.sum(axis=1, keepdims=True))


def _round(texts: DataFrame, chain: Chain) -> tuple[Chain, float, float]:
    """One step of Baum-Welch over all training texts; their likelihood before, their tokens."""
    states, classes = chain.emits.shape
    names = [f"s{i}" for i in range(states)]
    sent = texts.sparkSession.sparkContext.broadcast(chain)

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((classes + states + 2, states))
        for batch in batches:
            for part in _portions(_sequences(batch)):
                found = expected_counts(sent.value, _windows(part), np.array(_leads(part)))
                starts, moves, emitted, likelihood = found
                table[:classes] += emitted
                table[classes : classes + states] += moves
                table[-2] += starts
                table[-1, 0] += likelihood
                table[-1, 1] += sum(map(len, part))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(table))), *[pa.array(table[:, i]) for i in range(states)]], ["row", *names]
        )

    schema = "row bigint, " + ", ".join(f"{n} double" for n in names)
    sums = texts.select("classes").mapInArrow(expect, schema).groupBy("row").agg(*[F.sum(n).alias(n) for n in names])
    table = np.zeros((classes + states + 2, states))
    for row in sums.collect():
        table[row["row"]] = [row[n] for n in names]
    even = lambda x: x / x.sum(axis=-1, keepdims=True)
    new = Chain(even(table[-2] + 1), even(table[classes : classes + states] + 1), even(table[:classes].T + 0.1))
    return new, float(table[-1, 0]), float(table[-1, 1])


def train(
    texts: DataFrame, rounds: int = ROUNDS, states: int = STATES, least_gain: float = LEAST_GAIN
) -> tuple[Chain, list[float]]:
    """The chain, and the training log-likelihood that each round began with.

    ``texts`` has a ``classes`` column. Long texts are trained on in windows: only a
    text's first one tells how texts start, the others are warmed up on the tokens before
    them, and every move within a text is in one window. Rounds end when the last one
    gained less than ``least_gain`` a token, or after ``rounds``; scores never use windows.
    Without texts the chain is uniform over classes.
    """
    chain, seen = first_chain(_neighbours(texts, CLASSES), states), []
    for _ in range(rounds):
        chain, likelihood, tokens = _round(texts, chain)
        seen.append(likelihood)
        if len(seen) > 1 and seen[-1] - seen[-2] < least_gain * tokens:
            break
    return chain, seen


# --- scores ------------------------------------------------------------------


def score_texts(
    docs: DataFrame, held: Column, doc: str = "doc_id", text: str = "text", rounds: int = ROUNDS
) -> DataFrame:
    """(doc, held_out, n_tokens, n_known, train_tokens, base_score, score), a row per row.

    ``held`` marks texts that nothing is learned from; null is false. A-Z are lower-cased,
    words split at ASCII white space, and every text ends with one end token, so an empty
    or null text has one token. ``base_score`` is the add-one unigram score. Repeated rows
    count and are scored each; an empty table gives no rows.
    """
    blocks = _blocks(docs, doc, text, held)
    counts, by_class = _word_counts(blocks)
    texts = blocks.where(F.col("ids").isNotNull())
    tokens, kinds = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for row in by_class.collect():
        tokens[row["class"]], kinds[row["class"]] = row["n"], row["v"]
    chain, _ = train(texts.where("not held"), rounds)
    total, distinct = int(tokens.sum()), int(kinds.sum())
    sent = docs.sparkSession.sparkContext.broadcast((chain, np.log10(tokens + kinds + 1.0)))
    base_unit = float(np.log10(total + distinct + 1))
    kind = docs.schema[doc].dataType.simpleString()
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        chain, class_unit = sent.value
        c = np.zeros(len(right), np.int64)
        c[right.column("nth").to_numpy()] = right.column("c").to_numpy()
        up, known = np.log10(c + 1.0), (c > 0).astype(np.int64)
        rows, parts = [], []
        for x, y in zip(left.column("ids"), left.column("classes"), strict=True):
            ids, of = _numbers(x.as_py()), np.frombuffer(y.as_py(), np.uint8)
            said, word = up[ids].sum(), (up[ids] - class_unit[of])[of > 0].sum()
            rows.append((len(ids), int(known[ids].sum()), total, said - len(ids) * base_unit, word))
            parts.append(of)
        columns = [list(x) for x in zip(*rows, strict=True)]
        columns[4] = np.array(columns[4]) + log_likelihoods(chain, parts)
        made = dict(zip(names, map(pa.array, columns), strict=True))
        return pa.table({doc: left.column("doc"), "held_out": left.column("held"), **made})

    schema = (
        f"`{doc}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, "
        "train_tokens bigint, base_score double, score double"
    )
    left = texts.select("block", "doc", "held", "ids", "classes").groupBy("block")
    right = counts.select("block", "nth", "c").groupBy("block")
    return left.cogroup(right).applyInArrow(score, schema)
