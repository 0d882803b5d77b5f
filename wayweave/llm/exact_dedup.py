"""Exact deduplication by skew-safe combining, in DataFrame operations only.

Three stages, each of which groups by the whole text beside its digest, so equal digests never
stand in for equal texts:

1. within a task, equal texts collapse (map-side aggregation before the shuffle);
2. the rows of a digest are dealt over ``salts`` groups, so a text that a third of all rows
   share is merged by many tasks;
3. the winners of the salts, at most ``salts`` rows a text, are combined.

The winners go back to their rows by digest. Stage 3 has counted the distinct contents behind
each digest pair; a pair with two contents stops the job instead of merging them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayweave.plans.workspace import Workspace, free_name

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32
) -> DataFrame:
    """One row per input row: its id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts
    the largest id stays. Repeated ids with equal text: each repeated row is a member and is
    counted, and all rows that carry the kept id are marked kept. An empty table gives no rows;
    other columns of ``docs`` are ignored. A null id takes part and loses to any id.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("content"),
    ).withColumns(
        {
            "text_sha256": F.sha2(F.col("content").cast("binary"), 256),
            "mark": F.xxhash64("content"),
        }
    )
    salted = (
        rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
        .groupBy("text_sha256", "mark", "content", "salt")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))
    )
    winners = salted.groupBy("text_sha256", "mark", "content").agg(
        F.max("keep_id").alias("keep_id"), F.sum("n").alias("n")
    )
    by_digest = winners.groupBy("text_sha256", "mark").agg(
        F.max("keep_id").alias("keep_id"),
        F.sum("n").alias("group_size"),
        F.count("*").alias("contents"),
    )
    groups = Workspace(docs.sparkSession, "exact-dedup").save(by_digest, "groups")
    one = F.col("contents") == 1
    return (
        rows.select("doc_id", "text_sha256", "mark")
        .join(groups, ["text_sha256", "mark"])
        .select(
            "doc_id",
            F.when(one, F.col("keep_id"))
            .otherwise(F.raise_error(F.lit("two texts share both digests")).cast("long"))
            .alias("keep_id"),
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            "text_sha256",
        )
    )


#: Keys of dropped rows to broadcast at most, 48 bytes each; beyond them they are joined by shuffle.
BROADCAST_KEYS = 500_000


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that exact_dedup keeps, with all their columns; rows that repeat id and text all stay.

    Columns of any name may be there.
    """
    ws = Workspace(docs.sparkSession, "drop-copies")
    found = exact_dedup(docs, id_col, text_col).filter("NOT kept")
    name = free_name(docs, "gone")
    gone = ws.save(found.select(F.struct(F.col("doc_id").alias("id"), F.col("text_sha256").alias("digest")).alias(name)).distinct(), "gone")
    few = gone.count() <= BROADCAST_KEYS
    digest = F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).cast("binary"), 256)
    own = F.struct(F.col(id_col).alias("id"), digest.alias("digest"))
    return docs.join(F.broadcast(gone) if few else gone, own.eqNullSafe(F.col(name)), "left_anti")
