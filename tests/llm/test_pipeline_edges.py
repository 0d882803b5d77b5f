"""Every stage of the pipeline on nulls, repeats, long and empty texts, clashing names, and no rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("edges")
    labels = [(i, 1, int(i % 4 == 0)) for i in range(12)] + [(None, 1, 1), (3, 1, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, "vovo kaka lolo mimi nene susu tata rere"), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return str(base)


@pytest.mark.parametrize("name,stage", cp.STAGES[:-1], ids=[n for n, _ in cp.STAGES[:-1]])
def test_stage(spark, folder, docs, empty, name, stage):
    table = docs.filter("length(text) < 20000 OR text IS NULL").withColumns({c: F.lit(1) for c in ("score", "gone", "label", "component_id", "text_sha256")})
    before = {(r.doc_id, r.text) for r in table.collect()}
    got = stage(spark, table, folder)
    assert got.columns == table.columns
    after = {(r.doc_id, r.text) for r in got.collect()}
    assert after <= before and after
    if name == "exact dedup":
        assert (401, "") in after and (400, None) not in after
    elif name == "n-gram Jaccard join":
        assert {(400, None), (401, "")} <= after
    elif name == "benchmark decontamination":
        assert after == before
    assert stage(spark, empty, folder).collect() == []


def test_last_stage(spark, folder, docs, empty):
    got = cp.encode(spark, docs.filter("length(text) < 20000 OR text IS NULL"), folder).collect()
    assert all(r.exact for r in got) and sum(r.doc_id is None for r in got) == 1
    assert cp.encode(spark, empty, folder).collect() == []
