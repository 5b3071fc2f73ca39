"""Drawing the documents that look most like a target, by importance resampling.

Features are runs of words hashed into buckets. A bucket's gain is the logarithm of how
much likelier it is in the target than in the corpus; a document's weight is the sum of
the gains of its features, looked up in an array of all buckets. Adding Gumbel noise from
a hash of the document's number to the weights and taking the highest scores is the same
as drawing without replacement with probabilities in proportion to exp(weight).

The k-th highest score comes from a distributed quickselect: pivots drawn at random from
the rows still in question cut them in pieces, one job counts exactly the rows above and
at each pivot, and the piece that holds the k-th row is what is left. Only the winners
are then sorted, and ranked by the sizes of their sorted parts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.llm.arrow import text_bytes
from trendloom.sources.workspace import materialise

#: ASCII letters and digits, and everything beyond ASCII, in lower-cased UTF-8.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Distinct runs of words whose buckets a task remembers.
_REMEMBERED = 1 << 18


@dataclass(frozen=True)
class Draw:
    """``runs`` words at most form a feature; ``percent`` of the documents that have
    ``least_words`` are drawn, with the noise of ``seed``."""

    runs: int = 1
    buckets: int = 10_000
    seed: int = 2024
    percent: int = 10
    least_words: int = 20
    pivots: int = 15

    def __post_init__(self):
        if not 1 <= self.buckets <= 1 << 16 or self.runs < 1 or self.pivots < 1:
            raise ValueError("1 to 65536 buckets, at least one word a run and one pivot a round")


class _Buckets(dict):
    """Run of words to bucket."""

    def __init__(self, count: int):
        self.count = count

    def __missing__(self, run: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        made = self[run] = zlib.crc32(run) % self.count
        return made


def features(text: bytes, buckets: _Buckets, runs: int) -> tuple[int, np.ndarray]:
    """The number of words of a text, and the bucket of each of its features."""
    words = _WORD.findall(text.lower())  # of bytes, this lowers A-Z only
    found = [np.fromiter(map(buckets.__getitem__, words), np.uint16, len(words))]
    for n in range(2, runs + 1):
        several = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
        found.append(np.fromiter(map(buckets.__getitem__, several), np.uint16, len(several)))
    return len(words), np.concatenate(found) if runs > 1 else found[0]


def bucketed(docs: DataFrame, draw: Draw, doc: str, text: str) -> DataFrame:
    """(_row, _doc, n_words, n_features, buckets): 16-bit buckets, little-endian."""
    kind = docs.schema[doc].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Buckets(draw.buckets)
        for batch in batches:
            texts = batch.column(2)
            made = [features(texts[i].as_py(), known, draw.runs) for i in range(batch.num_rows)]
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array([n for n, _ in made], pa.int64()),
                pa.array([len(f) for _, f in made], pa.int64()),
                pa.array([f.astype("<u2").tobytes() for _, f in made], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["_row", "_doc", "n_words", "n_features", "buckets"])

    numbered = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(f"`{doc}`").alias("_doc"), text_bytes(text)
    )
    return numbered.mapInArrow(
        run, f"_row bigint, _doc {kind}, n_words bigint, n_features bigint, buckets binary"
    )


def histogram(found: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket, over all rows: one number a bucket leaves each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_py(), "<u2"), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    parts = found.select("buckets").where(F.length("buckets") > 0).mapInArrow(run, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the logarithm of each bucket's likelihood ratio, rounded down."""
    s, t, b = corpus.astype(float), target.astype(float), len(corpus)
    ratio = (t + 1) * (float(corpus.sum()) + b) / ((s + 1) * (float(target.sum()) + b))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """(_row, _doc, n_words, n_features, weight)."""
    table = found.sparkSession.sparkContext.broadcast(gain)
    kind = found.schema["_doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_row", "_doc", "n_words", "n_features", "weight"]
        for batch in batches:
            held = [v.as_py() for v in batch.column(4)]
            sums = [int(table.value[np.frombuffer(v, "<u2")].sum()) for v in held]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sums, pa.int64())], names)

    return found.mapInArrow(run, f"_row bigint, _doc {kind}, n_words bigint, n_features bigint, weight bigint")


def gumbel(seed: int, doc: Column) -> Column:
    """A thousand times standard Gumbel noise, from a hash of seed and number."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


# --- quickselect -------------------------------------------------------------

#: The composite key: high scores first, then small numbers (null first), then the row.
_KEY = ("score", "_doc", "_row")


def _literal(key: tuple, kind: str) -> tuple[Column, Column, Column]:
    return F.lit(key[0]), F.lit(key[1]).cast(kind), F.lit(key[2])


def _above(key: tuple, kind: str) -> Column:
    """Whether a row's key comes before ``key`` in the order of the draw."""
    score, doc, row = _literal(key, kind)
    if key[1] is None:
        earlier, same = F.lit(False), F.col("_doc").isNull()
    else:
        earlier = F.col("_doc").isNull() | (F.col("_doc") < doc)
        same = F.col("_doc") == doc
    tie = F.coalesce(same, F.lit(False)) & (F.col("_row") < row)
    return (F.col("score") > score) | ((F.col("score") == score) & (earlier | tie))


def _at(key: tuple, kind: str) -> Column:
    score, doc, row = _literal(key, kind)
    return (F.col("score") == score) & F.col("_doc").eqNullSafe(doc) & (F.col("_row") == row)


def kth_key(rows: DataFrame, k: int, pivots: int = 15, seed: int = 0) -> tuple:
    """The k-th key of ``rows`` (columns ``_KEY``), from 1, in the order of the draw.

    A round reads the rows between two known keys, which the files' statistics narrow
    too, and leaves about one in ``pivots`` of them. ``k`` is at most the rows' number.
    """
    kind = rows.schema["_doc"].dataType.simpleString()
    rows = rows.select(*_KEY)
    low = high = None
    before, turn = 0, 0
    while True:
        live = rows
        if low is not None:
            live = live.where((F.col("score") <= low[0]) & ~(_above(low, kind) | _at(low, kind)))
        if high is not None:
            live = live.where((F.col("score") >= high[0]) & _above(high, kind))
        order = F.xxhash64("_row", F.lit(seed), F.lit(turn))
        drawn = [tuple(r) for r in live.orderBy(order, "_row").limit(pivots).collect()]
        keys = sorted(drawn, key=lambda r: (-r[0], r[1] is not None, 0 if r[1] is None else r[1], r[2]))
        counts = live.agg(
            *[F.count_if(_above(key, kind)).alias(f"above{i}") for i, key in enumerate(keys)],
            *[F.count_if(_at(key, kind)).alias(f"at{i}") for i, key in enumerate(keys)],
        ).first()
        start = before
        for i, key in enumerate(keys):
            upto = start + counts[f"above{i}"]
            if k <= upto:
                high = key
                break
            if k <= upto + counts[f"at{i}"]:
                return key
            low, before = key, upto + counts[f"at{i}"]
        turn += 1


def resample(
    docs: DataFrame,
    target: DataFrame,
    draw: Draw = Draw(),
    *,
    doc: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank), one row per document.

    ``rank`` numbers the documents drawn from 1, highest score first, smaller numbers
    first among equals (null before all); it is null for all others. Null texts have no
    words. Repeated rows are documents of their own, so that copies may be drawn more
    than once; rows of one number share their noise. An empty target gives each bucket
    the gain of its rarity alone, empty documents give no rows. Other columns are
    dropped.
    """
    found = materialise(bucketed(docs, draw, doc, text), "features")
    wanted = bucketed(target.select(F.lit(0).alias("_no"), F.col(f"`{target_text}`")), draw, "_no", target_text)
    gain = gains(histogram(found, draw.buckets), histogram(wanted, draw.buckets))
    score = F.col("weight") + gumbel(draw.seed, F.col("_doc"))
    scored = materialise(weighed(found, gain).withColumn("score", score.cast("bigint")), "scored")
    able = F.col("n_words") >= draw.least_words
    k = draw.percent * scored.where(able).count() // 100
    names = [F.col("_doc").alias(doc), "n_features", "weight", "score"]
    if k == 0:
        return scored.select(*names, F.lit(None).cast("bigint").alias("rank"))
    kind = scored.schema["_doc"].dataType.simpleString()
    last = kth_key(scored.where(able), k, draw.pivots, draw.seed)
    wins = able & (_above(last, kind) | _at(last, kind))
    return ranked(scored.where(wins)).select(*names, "rank").unionByName(
        scored.where(~wins).select(*names, F.lit(None).cast("bigint").alias("rank"))
    )


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` with their place in the order of the draw as ``rank``.

    Each sorted part is numbered on its own; one row per part tells what is before it.
    """
    order = [F.col("score").desc(), F.col("_doc").asc_nulls_first(), F.col("_row").asc()]
    parts = winners.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    numbered = parts.withColumns(
        {"_part": F.shiftright(place, 33), "_nth": place.bitwiseAND(F.lit((1 << 33) - 1))}
    )
    kept = materialise(numbered, "winners")
    sizes = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return kept.join(bases, "_part").withColumn("rank", F.col("_base") + F.col("_nth") + 1)
