"""Written shards hold every row once, whatever its id and columns."""

from collections import Counter

from pyspark.sql import functions as F

from wayweave.llm.sharding import assign_shards, write_shards


def test_written_rows(spark, tmp_path):
    rows = [(None, "a"), (1, "b"), (1, "b"), (1, "c"), *[(i, f"t{i}") for i in range(2, 60)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("own"))
    write_shards(docs, str(tmp_path / "out"), 5)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.columns == ["doc_id", "text", "shard", "shard_"] and {r.shard for r in got.collect()} == {"own"}
    want = {(r.doc_id, r.size, r.shard) for r in assign_shards(docs, 5).collect()}
    assert {(r.doc_id, len(r.text) + 1, r.shard_) for r in got.collect()} == want
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(rows)
    write_shards(docs.drop("shard").filter("false"), str(tmp_path / "none"))
