"""Run registered queries beside their SQL twins and compare the rows.

    python -m tests.compare [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
_SHARED = {"BIGINT", "DOUBLE", "VARCHAR", "DATE", "TIMESTAMP", "BOOLEAN"}
_TYPES = {
    "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def _sorted_rows(rows, order):
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when names, types and rows agree, else what differs."""
    rel = con.sql(sql)
    names = spark_df.columns
    if sorted(names) != sorted(rel.columns):
        return f"columns {sorted(names)} vs {sorted(rel.columns)}"
    theirs = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for n, t in spark_df.dtypes:
        if theirs[n] not in _SHARED and theirs[n] != '"NULL"' or _TYPES.get(t) != theirs[n]:
            return f"type of {n}: {t} vs {theirs[n]}"
    ours = _sorted_rows(spark_df.collect(), sorted(range(len(names)), key=lambda i: names[i]))
    other = list(rel.columns)
    want = _sorted_rows(rel.fetchall(), sorted(range(len(other)), key=lambda i: other[i]))
    if len(ours) != len(want):
        return f"{len(ours)} rows vs {len(want)}"
    wrong = [(a, b) for a, b in zip(ours, want) if a != b]
    return f"{len(wrong)} of {len(ours)} rows, e.g. {wrong[0]}" if wrong else None


def main(argv):
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sql:
                verdict = difference(df, con, sql[name])
            else:
                verdict = None if df.count() >= 0 else "no rows"
        except Exception as e:  # report and go on with the next query
            verdict = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += verdict is not None
        kind = "ok" if name in sql else "ok (rows only)"
        print(f"{time.time() - start:6.2f}s {name}: {verdict or kind}", flush=True)
    print(f"{bad} differ; without SQL: {sorted(set(entry.queries()) - set(sql))}")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
