"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A stable key and the number of shards decide the shard; there is no ring table. Appending a
shard moves a row only into the new shard. Slots number the rows of a shard without gaps: rows
are dealt into fine buckets by key, bucket counts give offsets, and a row's slot is its
bucket's offset plus its place in the bucket, so no task ever holds a whole shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayweave.plans.workspace import Workspace, free_name

MULTIPLIER = np.uint64(2862933555777941757)  # fixed value of the published method


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(live):
            s = state[live] * MULTIPLIER + np.uint64(1)
            state[live] = s
            step = (2.0**31) / ((s >> np.uint64(33)).astype(np.float64) + 1.0)
            after = ((shard[live] + 1) * step).astype(np.int64)
            moving = after < shards
            live = live[moving]
            shard[live] = after[moving]
    return shard


def stable_key(col: Column) -> Column:
    """60 bits of the MD5 of the key's text; a null key is the empty text."""
    text = F.coalesce(col.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def shard_of(key: Column, shards: int) -> Column:
    """Column with the jump-hash shard of a stable 64-bit key."""

    @F.pandas_udf("int")
    def jump(k: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(k.to_numpy(np.int64), shards).astype(np.int32))

    return jump(key)


def assign_shards(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = 1024,
) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 1 (null text: 1), text_crc32 that of the same bytes
    (null: of none). grown_shard is the shard when one shard is appended. Rows that repeat an
    id share its shard and take slots of their own; which of them comes first follows size and
    crc. A null id has the key of the empty string. An empty table gives no rows; other columns
    are ignored. ``buckets`` is the number of pieces in which each shard is numbered: it
    bounds the rows a task sorts together, not the rows that are handled.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        stable_key(F.col(id_col)).alias("key"),
    )
    rows = rows.withColumns(
        {
            "shard": shard_of(F.col("key"), shards),
            "grown_shard": shard_of(F.col("key"), shards + 1),
            "bucket": F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"),
        }
    )
    rows = Workspace(docs.sparkSession, "sharding").save(rows, "rows")
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(
        "shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("shard", "bucket").orderBy(
        "key", "doc_id", "size", "text_crc32"
    )
    return (
        rows.withColumn("place", F.row_number().over(inside).cast("long") - 1)
        .join(F.broadcast(offsets), ["shard", "bucket"])  # at most shards * buckets rows
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("offset") + F.col("place")).alias("slot"),
            "grown_shard",
        )
    )


def write_shards(docs: DataFrame, path: str, shards: int = 8, id_col: str = "doc_id", files: int = 16) -> None:
    """Write every row of ``docs`` once, with all its columns, under ``path/shard=K``.

    A row's shard follows from its own id as in ``assign_shards``, so null and repeated ids are
    rows like others and nothing is joined. The rows of a shard are dealt over ``files`` tasks by
    what is in them and stand by id within a file. Where ``docs`` has a column named shard, the folders'
    name gets underscores behind it. An empty table writes no rows.
    """
    shard = free_name(docs, "shard")
    of = F.to_json(F.struct(*[F.col(c) for c in docs.columns]))
    dealt = docs.withColumn(shard, shard_of(stable_key(F.col(id_col)), shards))
    dealt = dealt.repartition(F.col(shard), F.pmod(F.xxhash64(of), F.lit(files)))
    dealt.sortWithinPartitions(shard, id_col).write.partitionBy(shard).parquet(path)
