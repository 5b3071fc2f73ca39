import gzip
import json

import pytest

from tests.conftest import rows
from trendloom.sources import files, sinks


def test_csv_folder_with_odd_files(spark, tmp_path):
    (tmp_path / "USvideos.csv").write_bytes(
        b'a,b,c\n1,2,3\n1,2\n1,2,3,4\n1,2,,4\n1,2,3,,\n"x\ny, ""z""",2,3\n'
    )
    (tmp_path / "FRvideos.csv").write_bytes("c,a\ncafé,7\n".encode("latin-1"))
    (tmp_path / "DEvideos.csv").write_bytes("﻿a,b,c\nwü,8,9\n".encode())
    (tmp_path / "notes.txt").write_text("a,b,c\n0,0,0\n")
    got = files.read_csv_dir(spark, str(tmp_path), multiline=True)
    got = got.select("a", "b", "c", "source_file")
    assert rows(got) == sorted(
        [
            ("1", "2", "3", "USvideos.csv"),
            ("1", "2", None, "USvideos.csv"),
            ('x\ny, "z"', "2", "3", "USvideos.csv"),
            ("7", None, "café", "FRvideos.csv"),
            ("wü", "8", "9", "DEvideos.csv"),
        ],
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )
    assert files.read_csv_dir(spark, str(tmp_path), multiline=True).count() == 5


def test_csv_folder_line_by_line(spark, tmp_path):
    (tmp_path / "USvideos.csv").write_bytes(
        b'a,b,c\n1,2,3\n1,2\n1,2,3,4\n1,2,,4\n\n"x, ""z""",2,3\na,b,c\n'
    )
    with gzip.open(tmp_path / "FRvideos.csv.gz", "wb") as f:
        f.write("c,a\ncafé,7\nplain,8\n".encode("latin-1"))
    (tmp_path / "DEvideos.csv").write_bytes("\ufeffa,b,c\nwü,8,9\n".encode())
    (tmp_path / "none.csv").write_bytes(b"")
    (tmp_path / "notes.txt").write_text("a,b,c\n0,0,0\n")
    got = files.read_csv_dir(spark, str(tmp_path)).select("a", "b", "c", "source_file")
    want = [
        ("1", "2", "3", "USvideos.csv"), ("1", "2", None, "USvideos.csv"),
        ('x, "z"', "2", "3", "USvideos.csv"), ("7", None, "café", "FRvideos.csv.gz"),
        ("8", None, "plain", "FRvideos.csv.gz"), ("wü", "8", "9", "DEvideos.csv"),
    ]
    assert rows(got) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("multiline", [True, False])
def test_csv_folder_without_a_header(spark, tmp_path, multiline):
    (tmp_path / "empty.csv").write_bytes(b"")
    with pytest.raises(FileNotFoundError):
        files.read_csv_dir(spark, str(tmp_path), multiline=multiline)


def test_gzipped_csv_is_first_choice(spark, tmp_path):
    with gzip.open(tmp_path / "x.csv.gz", "wt") as f:
        f.write("a,b\n1,2\n")
    (tmp_path / "y.csv").write_text("a,b\n3,4\n")
    first = [f"{tmp_path}/x.csv.gz", f"{tmp_path}/*.csv"]
    assert rows(files.read_first_available(spark, first, infer=True)) == [(1, 2)]
    second = [f"{tmp_path}/none.csv.gz", f"{tmp_path}/*.csv"]
    assert rows(files.read_first_available(spark, second)) == [("3", "4")]
    with pytest.raises(FileNotFoundError):
        files.read_first_available(spark, [f"{tmp_path}/none.csv"])


def test_tsv_and_jsonl(spark, tmp_path):
    with gzip.open(tmp_path / "x.tsv.gz", "wt") as f:
        f.write("a\tb\n1\tp,q\n")
    assert rows(files.read_tsv(spark, f"{tmp_path}/*.tsv.gz")) == [("1", "p,q")]
    with gzip.open(tmp_path / "x.jsonl.gz", "wt") as f:
        f.writelines(json.dumps({"i": i}) + "\n" for i in range(1500))
    path = f"{tmp_path}/*.jsonl.gz"
    assert files.read_jsonl(spark, path, n=1000).count() == 1000
    assert files.read_jsonl(spark, path).count() == 1500


def test_json_arrays_and_api_items(spark, tmp_path):
    item = {
        "id": "v1",
        "statistics": {"viewCount": "12", "likeCount": "3"},
        "contentDetails": {"duration": "PT1M"},
        "snippet": {"title": "t", "categoryId": "10", "publishedAt": "2024-01-01T00:00:00Z",
                    "channelId": "c"},
    }
    (tmp_path / "one.json").write_text(json.dumps([item, {**item, "id": "v2"}], indent=2))
    (tmp_path / "two.json").write_text(json.dumps({**item, "id": "v3"}))
    assert files.read_json_arrays(spark, f"{tmp_path}/*.json").count() == 3
    got = files.read_api_items(spark, f"{tmp_path}/*.json")
    assert rows(got)[0] == (
        "v1", "t", "10", "2024-01-01T00:00:00Z", "c", "12", "3", None, "PT1M",
    )


def test_inventory_counts_without_reading(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.bin").write_bytes(b"x" * 10)
    (tmp_path / "sub" / "b.bin").write_bytes(b"x" * (2 * 1024 * 1024))
    found = files.file_inventory(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    got = {r["folder"].rsplit("/", 1)[1]: r for r in files.inventory_summary(found).collect()}
    assert got["sub"]["size_mb"] == 2 and got["sub"]["large_files"] == 1
    assert got[tmp_path.name]["bytes"] == 10 and got[tmp_path.name]["large_files"] == 0
    assert [r["file"] for r in files.large_files(found).collect()] == ["b.bin"]


def test_profile(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0)], "i int, s string, d double")
    row = files.profile(df).first()
    assert (row["rows"], row["columns"], row["first_columns"]) == (2, 3, ["i", "s", "d"])
    assert row["type_counts"] == {"int": 1, "string": 1, "double": 1}


def test_samples_and_summary(spark, tmp_path):
    df = spark.range(100)
    sinks.write_sample(df, f"{tmp_path}/s", 10)
    assert spark.read.json(f"{tmp_path}/s").count() == 10
    sinks.write_sample(df, f"{tmp_path}/t", 7, "csv", sep="\t", header=True)
    assert files.read_tsv(spark, f"{tmp_path}/t").count() == 7
    sinks.write_summary(df.limit(1), f"{tmp_path}/doc")
    assert len(list((tmp_path / "doc").glob("part-*"))) == 1


def test_lines_of_a_file_are_not_gathered_to_meet_its_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n3,4\n")
    (tmp_path / "b.csv").write_text("y\n5\n")
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")  # as if nothing were known of the headers' size
    try:
        df = files.read_csv_dir(spark, str(tmp_path))
        found = sorted((r["x"] or "", r["y"], r["source_file"]) for r in df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(setting, before)
    assert found == [("", "5", "b.csv"), ("1", "2", "a.csv"), ("3", "4", "a.csv")]
    assert "Exchange hashpartitioning" not in plan
