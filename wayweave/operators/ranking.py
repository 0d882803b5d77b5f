"""Places of items in linked lists and rings, by pointer doubling.

Each round an item's pointer goes twice as far, so the longest list takes as many rounds as its
length has bits. A round is one equi-join of the items that have not reached their end, and only these are
written anew. Items that are no whole numbers are numbered first, so that rounds move whole numbers. No list is ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayweave.plans.workspace import Workspace


def rank_lists(follow: DataFrame, names: DataFrame | None = None, rounds: int = 60) -> DataFrame:
    """(item, list, place, size, ring) of items (item, next), each next being an item or null.

    No item may be next of two. A list that ends is named by its last item and counts places from
    its first; a ring is named by its smallest item and counts from that. Items may be structs.
    ``names`` (item, name) are names of items that are numbers already, and stand for them in the result.
    """
    ws = Workspace(follow.sparkSession, "ranking", release=False)
    steps = F.when(F.col("jump").isNull(), 0).otherwise(1).cast("long")
    whole = dict(follow.dtypes)["item"] == "bigint"
    given = names.select(F.col("item").alias("id"), F.col("name").alias("item")) if names is not None else None
    if whole:
        begun = follow.select(F.col("item").alias("id"), F.col("next").alias("jump"))
    else:
        given = ws.save(follow.select(F.monotonically_increasing_id().alias("id"), "item", "next"), "items")
        ahead = given.filter("next IS NOT NULL").select("id", F.col("next").alias("item")).join(given.select(F.col("id").alias("jump"), "item"), "item")
        begun = ahead.select("id", "jump").unionByName(given.filter("next IS NULL").select("id", F.lit(None).cast("long").alias("jump")))
    begun = begun.select("id", "jump", steps.alias("steps"), F.col("id").alias("tail"), F.col("id").alias("least"), F.lit(0).cast("long").alias("off"), F.lit(False).alias("open"))
    now = ws.save(begun, "round000")
    for i in range(1, rounds):
        # items that have ended stay in the table of the round that ended them
        told = now.filter("jump IS NOT NULL").unionByName(ws.all_of("round*", begun).filter("jump IS NULL"))
        far = told.select(F.col("id").alias("jump"), *[F.col(c).alias(f"j_{c}") for c in ("jump", "steps", "tail", "least", "off")])
        # the windows before and behind the pointer are two halves of the next round's window
        lower = F.col("j_least") < F.col("least")
        moved = now.filter("jump IS NOT NULL").join(far, "jump").select(
            "id", F.col("j_jump").alias("jump"), (F.col("steps") + F.col("j_steps")).alias("steps"), F.col("j_tail").alias("tail"),
            F.when(lower, F.col("j_least")).otherwise(F.col("least")).alias("least"),
            F.when(lower, F.col("steps") + F.col("j_off")).otherwise(F.col("off")).alias("off"),
            (F.col("j_jump").isNotNull() & (F.col("j_least") != F.col("least"))).alias("open"),
        )
        now, state = ws.save_and_tell(moved, f"round{i:03d}", open=F.bool_or("open"))
        if not state["open"]:
            break
    else:
        raise RuntimeError(f"lists have not ended after {rounds} rounds")
    told = now.filter("jump IS NOT NULL").unionByName(ws.all_of("round*", begun).filter("jump IS NULL"))
    ring = F.col("jump").isNotNull()
    told = told.select("id", ring.alias("ring"), F.when(ring, F.col("least")).otherwise(F.col("tail")).alias("k"), F.when(ring, F.col("off")).otherwise(F.col("steps")).alias("back"))
    told = told.withColumnRenamed("id", "item") if given is None else ws.save(told.join(given.select("id", "item"), "id").drop("id"), "told")
    # a ring's places were counted from its smallest number and are counted from its smallest item
    named = F.when(F.bool_or("ring"), F.min(F.struct("item", "back"))).otherwise(F.min_by(F.struct("item", "back"), "back"))
    lists = told.groupBy("k").agg((F.max("back") + 1).alias("size"), named.alias("first"))
    place = F.when(F.col("ring"), F.pmod(F.col("first.back") - F.col("back"), F.col("size"))).otherwise(F.col("size") - 1 - F.col("back"))
    return told.join(lists, "k").select("item", F.col("first.item").alias("list"), place.alias("place"), "size", "ring")
