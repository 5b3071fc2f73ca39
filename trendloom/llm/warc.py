"""WARC archives with revisit records, and their capture index by external merge.

Archives are written and read through Spark's own file sources, so they can lie in any
store Spark reaches. Every record is a gzip member of its own, so that a reader can start at
the place that the index names. A row of the text writer is a whole archive; the line
separator that the writer adds is a gzip member without content.

The index is an external merge sort. Reading tasks sort their captures by URL key and
timestamp into runs of bounded length and write them; the key space is cut into ranges at
sampled captures; in each range a loser tree merges the slices of all runs.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.llm.arrow import to_arrow, with_text_columns
from trendloom.sources.workspace import materialise, new_path

BREAK = "\r\n"
#: An archive ends at the first of these; one longer record makes an archive of its own.
RECORDS_PER_FILE, FILE_BYTES = 10_000, 16 << 20
#: A gzip member without content (a fixed value of the format).
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff0300" + "00" * 8)
#: Captures of one sorted run, and those that a task deals out to nested ranges at a time.
RUN_CAPTURES = DEAL_CAPTURES = 50_000
#: Captures of one merged range, and the most ranges whose borders go to every task:
#: beyond these, the ranges are cut again at borders of their own.
CAPTURES_PER_RANGE, MOST_BORDERS = 1000, 20_000
#: Captures drawn for each range to set its borders.
_DRAWN = 20
_READ_BYTES = 1 << 14

CAPTURE = T.StructType(
    [
        T.StructField("url_key", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("archive", T.StringType()),
        T.StructField("record_offset", T.LongType()),
        T.StructField("record_length", T.LongType()),
    ]
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str) -> str:
    """Host labels from the right, then path and query, lower case, without ``www``."""
    try:
        parts = urlsplit(url.strip().lower())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.strip().lower()
    labels = host.removeprefix("www.").split(".")
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(labels)) + (f":{port}" if port not in (None, 80, 443) else "") + ")" + tail


# --- writing -----------------------------------------------------------------


def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, _digest, _bytes, _response): who holds each payload.

    Of equal payloads of at least ``least_bytes`` the largest page id is the response;
    ``_response`` is null for payloads that are shorter, all of which are kept. Repeated
    rows of the largest id are responses each; null ids come after all others.
    """
    schema = T.StructType([T.StructField("_digest", T.StringType()), T.StructField("_bytes", T.LongType())])
    plain = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    known = with_text_columns(plain, "html", schema, lambda t: [[digest(x) for x in t], [len(x) for x in t]])
    holder = known.select("_digest", "_bytes", "page_id").where(F.col("_bytes") >= least_bytes)
    holder = holder.groupBy("_digest", "_bytes").agg(F.max("page_id").alias("_response"))
    # stored, so that both sides of the join are shuffled and a hot payload can be split
    holder = materialise(holder, "payloads")
    return known.join(holder, ["_digest", "_bytes"], "left")


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))


def record(date: Column) -> Column:
    """The text of a record of ``plan_records``, without the break that ends it."""
    revisit = F.coalesce(F.col("_response") != F.col("page_id"), F.col("_response").isNotNull())
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}"),
        _header("Content-Length", F.col("_bytes").cast("string")),
        F.lit(BREAK),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    line = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", "%0A")
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    return F.concat(
        F.lit(f"WARC/1.1{BREAK}"),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", F.coalesce(urn(F.col("page_id")), F.lit("<urn:page:none>"))),
        _header("WARC-Target-URI", line),
        _header("WARC-Date", date),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
        F.when(
            revisit,
            F.concat(
                _header("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                _header("WARC-Refers-To", urn(F.col("_response"))),
            ),
        ).otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{BREAK}"),
        _header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(BREAK),
        block,
    )


def write_archives(pages: DataFrame, path: str, date: Column, least_bytes: int = 0) -> None:
    """Write ``pages`` (page_id, url, html) as archives of gzip members below ``path``.

    Null pages are empty payloads, null URLs are empty, line breaks in URLs are encoded.
    """
    most, limit = RECORDS_PER_FILE, FILE_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, size = [], 0
        for batch in batches:
            for text in batch.column(0):
                members.append(gzip.compress(text.as_py() + BREAK.encode() * 2, 6, mtime=0))
                size += len(members[-1])
                if len(members) >= most or size >= limit:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], ["value"])
                    members, size = [], 0
        if members:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], ["value"])

    planned = plan_records(pages, least_bytes)
    made = planned.select(record(date).cast("binary").alias("record")).mapInArrow(run, "value binary")
    # the text writer puts out a string's bytes as they are; the encoding is that of the separator
    lines = made.select(F.col("value").cast("string")).write
    lines.options(maxRecordsPerFile=1, encoding="ISO-8859-1").text(path, lineSep=EMPTY_MEMBER.decode("latin-1"))


# --- reading -----------------------------------------------------------------


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each gzip member that has content."""
    view, at = memoryview(data), 0
    while at < len(view):
        unpack, parts, end = zlib.decompressobj(31), [], at
        while not unpack.eof:
            if end >= len(view):
                raise ValueError(f"the member at {at} is cut off")
            parts.append(unpack.decompress(view[end : end + _READ_BYTES]))
            end = min(end + _READ_BYTES, len(view))
        end -= len(unpack.unused_data)
        if content := b"".join(parts):
            yield at, end - at, content
        at = end


def parse_archive(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of each record of an uncompressed archive."""
    at, gap = 0, BREAK.encode()
    while at < len(data):
        head_end = data.index(gap * 2, at)
        lines = data[at:head_end].decode("utf-8", "replace").split(BREAK)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}: {lines[0][:40]!r}")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start = head_end + 4
        end = start + int(headers["content-length"])
        if data[end : end + 4] != gap * 2:
            raise ValueError(f"record at {at} does not end at {end}")
        yield at, headers, data[start:end]
        at = end + 4


def read_record(archive: bytes, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Headers and block of the record that a capture's offset and length name."""
    _, headers, block = next(parse_archive(gzip.decompress(archive[offset : offset + length])))
    return headers, block


def _urn(value: str | None) -> int | None:
    body = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(body) if body.lstrip("-").isdigit() else None


def _capture(archive: str, offset: int, length: int, headers: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition((BREAK * 2).encode())
    kind, known = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        size = len(payload)
        if digest(payload) != known:
            raise ValueError(f"{archive}: payload at {offset} differs from its digest")
    else:  # a revisit keeps the response's HTTP header, not its payload
        fields = dict(x.split(": ", 1) for x in http.decode().split(BREAK)[1:])
        size = int(fields["Content-Length"])
    uri = headers["warc-target-uri"]
    stamp = "".join(c for c in headers["warc-date"] if c.isdigit())
    return (
        url_key(uri), stamp, _urn(headers["warc-record-id"]), uri, kind, size, known,
        _urn(headers.get("warc-refers-to")), archive, offset, length,
    )


def _order(capture: tuple) -> tuple:
    """URL key, timestamp, page id (none first), place: total but for repeated records."""
    return capture[0], capture[1], capture[2] is not None, capture[2] or 0, capture[8], capture[9]


def sorted_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives in sorted runs: (_run, _nth, ...).

    A task starts a new run every ``RUN_CAPTURES`` captures, so it never holds more. In
    archives whose members hold several records, these share their member's place.
    """
    schema = T.StructType([T.StructField("_run", T.LongType()), T.StructField("_nth", T.LongType()), *CAPTURE])
    types, most = to_arrow(schema), RUN_CAPTURES

    def captures(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1), strict=True):
                name = archive.as_py().rpartition("/")[2]
                for at, length, data in members(content.as_buffer()):
                    for _, headers, block in parse_archive(data):
                        yield _capture(name, at, length, headers, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, number = captures(batches), TaskContext.get().partitionId() << 32
        while part := sorted(islice(found, most), key=_order):
            for at in range(0, len(part), 10_000):
                rows = [(number, at + i, *c) for i, c in enumerate(part[at : at + 10_000])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], schema.fieldNames()
                )
            number += 1

    files = spark.read.format("binaryFile").load(path).where(F.col("length") > 0)
    return files.select("path", "content").mapInArrow(run, schema)


# --- the merge ---------------------------------------------------------------


class LoserTree:
    """Merges k sorted lists: the root holds the winner, every inner node a loser."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at = runs, [0] * len(runs)
        self.leaves = 1
        while self.leaves < max(1, len(runs)):
            self.leaves *= 2
        self.node = [-1] * self.leaves
        self.winner = self._play(1) if runs else -1

    def _head(self, run: int) -> tuple | None:
        if run < 0 or run >= len(self.runs) or self.at[run] >= len(self.runs[run]):
            return None
        return self.runs[run][self.at[run]]

    def _beats(self, a: int, b: int) -> bool:
        x, y = self._head(a), self._head(b)
        return y is None or (x is not None and (x, a) < (y, b))

    def _play(self, node: int) -> int:
        if node >= self.leaves:
            return node - self.leaves
        a, b = self._play(2 * node), self._play(2 * node + 1)
        win, lose = (a, b) if self._beats(a, b) else (b, a)
        self.node[node] = lose
        return win

    def __iter__(self) -> Iterator[tuple]:
        while (head := self._head(self.winner)) is not None:
            yield head
            self.at[self.winner] += 1
            run, node = self.winner, (self.winner + self.leaves) // 2
            while node:
                if self._beats(self.node[node], run):
                    run, self.node[node] = self.node[node], run
                node //= 2
            self.winner = run


_NAMES = CAPTURE.fieldNames()
_DEALT = ["_run", "_nth", *_NAMES, "_range"]


def _rows(table: pa.Table | pa.RecordBatch) -> list[tuple]:
    return list(zip(*[table.column(n).to_pylist() for n in _NAMES], strict=True))


def _cut_again(dealt: DataFrame, parts: int) -> DataFrame:
    """``dealt`` with every range cut into ranges of about ``CAPTURES_PER_RANGE`` captures.

    Only the captures drawn from a range meet in one task, one for every ``step`` of its
    own. The borders go to the ``parts`` that a hash divides the range into.
    """
    one_in = max(1, CAPTURES_PER_RANGE // _DRAWN)
    step = max(1, CAPTURES_PER_RANGE // one_in)
    place = T.StructType([T.StructField("_range", T.LongType()), *CAPTURE])

    def borders(table: pa.Table) -> pa.Table:
        rows = _rows(table)
        order = sorted(range(len(rows)), key=lambda i: _order(rows[i]))
        return table.select(place.fieldNames()).take(pa.array(order[step - 1 :: step], pa.int64()))

    def deal(table: pa.Table, cuts: pa.Table) -> pa.Table:
        keys = sorted(_order(r) for r in _rows(cuts))
        old = table.column("_range").to_pylist()
        new = [r << 32 | bisect_right(keys, _order(c)) for r, c in zip(old, _rows(table), strict=True)]
        return table.select(_DEALT[:-1]).append_column("_range", pa.array(new, pa.int64()))

    drawn = dealt.where(F.pmod(F.xxhash64("_nth", "_run"), F.lit(one_in)) == 0)
    cuts = drawn.select(*place.fieldNames()).groupBy("_range").applyInArrow(borders, place)
    cuts = cuts.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    parted = dealt.withColumn("_part", F.pmod(F.xxhash64("_run", "_nth"), F.lit(parts)).cast("int"))
    both = parted.groupBy("_range", "_part").cogroup(cuts.groupBy("_range", "_part"))
    return both.applyInArrow(deal, dealt.schema)


def merge_runs(runs: DataFrame) -> DataFrame:
    """All captures in global order: (_range, _position) is the place of each.

    ``runs`` is a stored result of ``sorted_runs``. The range borders are captures drawn
    by hash, about 20 for each range; they only decide which task merges what. Borders of
    at most ``MOST_BORDERS`` ranges are broadcast; where more ranges are needed, each of
    these is cut again, so a merged range has the same size however many captures there are.
    """
    spark = runs.sparkSession
    n = runs.count()
    ranges = max(1, n // CAPTURES_PER_RANGE)
    first = min(ranges, MOST_BORDERS)
    one_in = max(1, n // (_DRAWN * first))
    drawn = runs.where(F.pmod(F.xxhash64("_run", "_nth"), F.lit(one_in)) == 0) if first > 1 else runs.limit(0)
    keys = sorted(_order(tuple(r)) for r in drawn.select(*_NAMES).toLocalIterator())
    borders = spark.sparkContext.broadcast([keys[len(keys) * i // first] for i in range(1, first)] if keys else [])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranged = pa.array([bisect_right(borders.value, _order(c)) for c in _rows(batch)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, ranged], _DEALT)

    def merge(table: pa.Table) -> pa.Table:
        run, nth = (table.column(n).to_numpy() for n in ("_run", "_nth"))
        order = np.lexsort((nth, run))  # puts the slices that the shuffle cut up together again
        cuts = np.flatnonzero(np.diff(run[order])) + 1
        rows = _rows(table)
        slices = [[(_order(rows[i]), i) for i in part.tolist()] for part in np.split(order, cuts)]
        merged = pa.array([i for _, i in LoserTree(slices)], pa.int64())
        out = table.select(["_range", *_NAMES]).take(merged)
        return out.append_column("_position", pa.array(range(len(merged)), pa.int64()))

    plain = runs.select(*_DEALT[:-1])
    dealt = plain.mapInArrow(deal, T.StructType([*plain.schema, T.StructField("_range", T.LongType())]))
    if ranges > first:
        dealt = _cut_again(dealt, -(-n // (first * DEAL_CAPTURES)))
    out = T.StructType([T.StructField("_range", T.LongType()), *CAPTURE, T.StructField("_position", T.LongType())])
    return dealt.groupBy("_range").applyInArrow(merge, out)


def capture_index(spark: SparkSession, path: str) -> DataFrame:
    """The capture histories of the archives below ``path``, in global order."""
    return merge_runs(materialise(sorted_runs(spark, path), "runs"))


def archive_and_index(pages: DataFrame, date: Column, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` into new archives in the shared folder and index what is read back."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(pages, path, date, least_bytes)
    return capture_index(spark, path)
