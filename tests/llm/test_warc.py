import glob
import gzip
import random

import pytest
from pyspark.sql import functions as F

from trendloom.llm import warc

SCHEMA = "page_id bigint, url string, html string"


def index(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    date = F.concat(F.lit("2024-01-0"), (F.coalesce("page_id", F.lit(0)) % 7 + 1).cast("string"), F.lit("T00:00:00Z"))
    return warc.archive_and_index(df, date, **kw)


def test_loser_tree():
    rng = random.Random(2)
    for k in (0, 1, 2, 3, 7, 16, 33):
        runs = [sorted((rng.randrange(20), i) for _ in range(rng.randrange(12))) for i in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert warc.url_key("http://www.Example.com:80/A?b=C#top") == "com,example)/a?b=c"
    assert warc.url_key("https://a.b.org:8443") == "org,b,a:8443)/"
    assert warc.url_key("") == ")/"
    assert warc.url_key("http://[bad") == "http://[bad"


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 7)
    monkeypatch.setattr(warc, "CAPTURES_PER_RANGE", 10)
    rng = random.Random(3)
    bodies = ["", "\r\n\r\nWARC/1.1\r\n\r\n", "<p>é</p>" * 50, "x" * 100_000, *[f"<b>{i}</b>\r\n" for i in range(40)]]
    rows = [(i, f"http://h{rng.randrange(5)}.org/p{rng.randrange(9)}", rng.choice(bodies)) for i in range(200)]
    rows += [(300, None, None), (301, "a\r\nWARC-Type: evil", "<p>"), (302, "http://[bad", "")]
    best = {}
    for i, _, h in rows:
        best[h or ""] = max(best.get(h or "", -1), i)
    got = index(spark, rows).collect()
    assert {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == {
        (i, len((h or "").encode()), warc.digest((h or "").encode()), "response" if best[h or ""] == i else "revisit", None if best[h or ""] == i else best[h or ""])
        for i, _, h in rows
    }
    placed = sorted(got, key=lambda r: (r._range, r._position))
    keys = [(r.url_key, r.timestamp, r.page_id) for r in placed]
    assert keys == sorted(keys) and len({r._range for r in got}) > 5


def test_edges(spark):
    rows = [(5, "u", "same"), (5, "u", "same"), (4, "u", "same"), (None, "v", "same"), (None, "w", None)]
    got = index(spark, rows).collect()
    kinds = sorted((r.page_id or -1, r.record_type, r.refers_to) for r in got)
    assert kinds == sorted([(5, "response", None)] * 2 + [(4, "revisit", 5), (-1, "revisit", 5), (-1, "response", None)])
    small = index(spark, rows, least_bytes=5).collect()
    assert {r.record_type for r in small} == {"response"}
    assert index(spark, []).count() == 0


def by_hand(path):
    """Every record of the archives below ``path``, found by a reader of its own and sorted at once."""
    out = []
    for name in glob.glob(f"{path}/part-*"):
        with open(name, "rb") as f:
            data = gzip.decompress(f.read())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            size = int(fields["Content-Length"])
            stamp = "".join(filter(str.isdigit, fields["WARC-Date"]))
            page = fields["WARC-Record-ID"][10:-1]
            out.append((warc.url_key(fields["WARC-Target-URI"]), stamp, int(page), fields["WARC-Type"], rest[:size]))
            data = rest[size + 4 :]
    return sorted(out)


@pytest.mark.parametrize("most_borders", [20_000, 3])
def test_index_against_brute_force(spark, monkeypatch, tmp_path, most_borders):
    """One URL holds a third of all captures; ranges are cut once, or cut again."""
    for name, value in dict(
        RECORDS_PER_FILE=60, RUN_CAPTURES=13, CAPTURES_PER_RANGE=20, DEAL_CAPTURES=40, MOST_BORDERS=most_borders
    ).items():
        monkeypatch.setattr(warc, name, value)
    rng = random.Random(8)
    urls = ["http://hot.org/", *[f"https://www.h{i % 9}.org/{i}" for i in range(60)]]
    rows = [(i, urls[0] if i % 3 == 0 else rng.choice(urls), f"<p>{rng.randrange(80)}</p>" * rng.randrange(40)) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    path = str(tmp_path / "archives")
    date = F.concat(F.lit("2024-01-0"), (F.col("page_id") % 7 + 1).cast("string"), F.lit("T00:00:00Z"))
    warc.write_archives(df, path, date)
    runs = warc.sorted_runs(spark, path)
    assert max(r["count"] for r in runs.groupBy("_run").count().collect()) == 13
    got = warc.capture_index(spark, path).orderBy("_range", "_position").collect()
    expected = by_hand(path)
    assert [(r.url_key, r.timestamp, r.page_id, r.record_type) for r in got] == [e[:4] for e in expected]
    sizes = {}
    for r in got:
        sizes[r._range] = sizes.get(r._range, 0) + 1
    assert len(sizes) > 12 and max(sizes.values()) < 120
    blocks = {e[2]: e[4] for e in expected}
    for r in got:
        with open(f"{path}/{r.archive}", "rb") as f:
            headers, block = warc.read_record(f.read(), r.record_offset, r.record_length)
        assert block == blocks[r.page_id] and headers["warc-record-id"] == f"<urn:page:{r.page_id}>"


def test_members():
    parts = [b"a" * 100_000, random.Random(1).randbytes(70_000), b"x"]
    data = b"".join(gzip.compress(p) + warc.EMPTY_MEMBER for p in parts)
    found = list(warc.members(data))
    assert [c for _, _, c in found] == parts
    assert all(gzip.decompress(data[a : a + n]) == c for a, n, c in found)
    assert list(warc.members(b"")) == []
    with pytest.raises(ValueError, match="cut off"):
        list(warc.members(data[:-30]))
