import pytest

import corpus_pipeline
from tests.llm.conftest import EDGE, prose


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing",
    ]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_edges(spark, sf_dir, edge, nothing, name, stage):
    done = stage(spark, edge, sf_dir)
    if name == "best-fit packing":
        assert done.count() >= len(EDGE)
        assert stage(spark, nothing, sf_dir).count() == 0
        return
    assert done.schema == edge.schema or done.dtypes == edge.dtypes
    got = done.collect()
    assert {r.kept for r in got} <= {0} and {r.piece for r in got} <= {9}  # the clashing columns pass through
    if name == "SimHash near-dedup":
        keys = [(r.doc_id, r.text) for r in got]
        assert len(keys) == len(set(keys)) and sum(r.doc_id in (1, 2) for r in got) == 1
    if name in ("line dedup", "benchmark decontamination"):
        assert len(got) == len(EDGE)
    assert stage(spark, nothing, sf_dir).count() == 0


def test_decisions_take_effect(spark, tmp_path):
    folder = str(tmp_path)
    item = prose(40, 30)
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    base = [prose(100 + i, 200) for i in range(12)]
    near = base[3].split(" ")
    near[50] = "changed"
    rows = [(i, t) for i, t in enumerate(base)] + [
        (20, base[0]), (21, " ".join(near)), (22, base[5][:300] + " " + item.upper() + " " + base[6][:300]), (23, "too short"),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{folder}/documents.parquet")
    read = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        read = stage(spark, read, folder).cache()
        kept[name] = {r.doc_id for r in read.collect()}
    assert 23 not in kept["quality rules"] and set(range(12)) <= kept["quality rules"]
    assert kept["SimHash near-dedup"] >= set(range(12)) and 22 not in kept["benchmark decontamination"]
    assert set(range(12)) <= kept["benchmark decontamination"]
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} == kept["benchmark decontamination"]
