import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from trendloom.llm import tokenfile
from trendloom.llm.queries import QUERIES, load_byte_bpe, table
from trendloom.sources.workspace import new_path

IDS = st.lists(st.integers(0, 50_256) | st.integers(0, 2**32 - 1) | st.just(7), min_size=1, max_size=700)


@settings(max_examples=150, deadline=None)
@given(IDS, st.sampled_from([8, 64, 256]), st.sampled_from([0.01, 0.5, 0.9, 1.0]), st.data())
def test_any_range_of_a_file_comes_back(ids, block, share, data):
    made = tokenfile.encode_file(3, 9, [5], [len(ids)], np.array(ids), block, share)
    file = tokenfile.TokenFile.open(made + b"\n")
    assert (file.part, file.nth, file.n_ids, file.documents) == (3, 9, len(ids), [5])
    assert file.ids().tolist() == ids
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids) + 3))
    assert file.ids(a, b).tolist() == ids[a:b]


def test_a_range_reads_only_its_blocks():
    ids = np.random.default_rng(1).integers(0, 50_000, 10_000)
    made = tokenfile.encode_file(0, 0, [1], [len(ids)], ids)
    file = tokenfile.TokenFile.open(made)
    damaged = file.data.copy()
    damaged[int(file.index[20]) :] = 0  # everything from block 20 on
    torn = tokenfile.TokenFile(damaged, 0, 0, file.n_ids, 1, 256)
    assert torn.ids(256 * 3 + 5, 256 * 20).tolist() == ids[256 * 3 + 5 : 256 * 20].tolist()


def test_few_large_ids_do_not_widen_a_block():
    ids = np.arange(256) % 16 + 1000
    plain = tokenfile.encode_file(0, 0, [1], [256], ids)
    ids[[3, 77]] = 4_000_000_000
    patched = tokenfile.encode_file(0, 0, [1], [256], ids)
    assert len(patched) == len(plain) + 2 * 5  # position and high bits of two exceptions
    assert tokenfile.TokenFile.open(patched).ids().tolist() == ids.tolist()


def test_damage_is_noticed():
    made = bytearray(tokenfile.encode_file(0, 0, [1], [300], np.arange(300)))
    made[-10] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        tokenfile.TokenFile.open(bytes(made))
    with pytest.raises(ValueError, match="not a token file"):
        tokenfile.TokenFile.open(b"x" * 100)
    with pytest.raises(ValueError):
        tokenfile.encode_file(0, 0, [1], [1], np.arange(1), block=512)


def expected(rows):
    """By brute force: (doc_id, start, n_tokens, crc32) in ascending order of ids."""
    slow, at, out = Tokenizer.from_file(__import__("public_tokenizers").path("byte_bpe_50k.json")), 0, []
    for doc, text in rows:
        ids = np.array([*slow.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("file_ids", [1, 500, 1 << 24])
def test_edge_rows_round_trip(spark, edge, file_ids):
    path = new_path(spark, "tokens")
    tokenfile.write_token_files(table_like(spark, edge), path, load_byte_bpe, file_ids=file_ids)
    back = tokenfile.read_token_files(spark, path)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], zlib.crc32(r["ids"])) for r in back.collect())
    assert [r[1] for r in got] == sorted((r["doc_id"] for r in edge.collect()), key=lambda d: (d is not None, d or 0))
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    alone = sorted((d, n, crc) for r in edge.collect() for d, _, n, crc in expected([(r["doc_id"] or -1, r["text"])]))
    assert sorted((d or -1, n, crc) for _, d, n, crc in got) == alone
    again = tokenfile.read_token_files(spark, path).collect()
    assert sorted((r["start"], r["n_tokens"]) for r in again) == [(s, n) for s, _, n, _ in got]


def table_like(spark, df):
    table(spark, "/root/testdata/sf0.001", "documents")  # workers learn where the package is
    return df


def test_nothing(spark, nothing):
    assert tokenfile.write_and_read(nothing, load_byte_bpe).collect() == []


def test_query_equals_the_tokenizers_library(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").orderBy("doc_id").collect()]
    got = sorted(tuple(r) for r in QUERIES["op13_token_files"](spark, sf_dir).collect())
    assert got == expected(docs)


def test_hot_document_number(spark):
    rng = random.Random(4)
    rows = [(i if i % 3 else 7, "same text") for i in range(300)] + [(7, f"t{rng.random()}") for _ in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in tokenfile.write_and_read(docs, load_byte_bpe).collect())
    assert [d for _, _, d in got] == sorted(d for d, _ in rows)
    assert all(a[0] + a[1] == b[0] for a, b in zip(got, got[1:]))
