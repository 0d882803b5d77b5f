"""Connected components by alternating large-star and small-star rounds.

Nodes with a single neighbour go with that neighbour and take no part in the rounds. The rounds
contract long chains quickly and never gather a component in one task: every step is
an aggregation with map-side combining and an equi-join that Spark may split when skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayweave.plans.workspace import Workspace


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (
        near.join(least, "u")
        .filter("v > u AND v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )  # a small star follows and leaves out what repeats


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _settled(edges: DataFrame, ws: Workspace, rounds: int) -> DataFrame:
    """(u, v): every node that is not the smallest of its component, with the smallest."""
    now, seen = edges, None
    for i in range(rounds):
        now, state = ws.save_and_tell(_small_star(_large_star(now)), f"round{i}", n=F.count("*"), mark=F.bit_xor(F.xxhash64("u", "v")))
        if i:
            ws.drop(f"round{i - 1}")
        if state == seen:
            return now
        seen = state
    raise RuntimeError(f"components have not settled after {rounds} rounds")


def peeled(edges: DataFrame, rounds: int = 60) -> tuple[DataFrame, DataFrame]:
    """Components as two tables, by edges (u, v): the hubs (hub, component) and the leaves (node, hub).

    Every node that has one neighbour only is a leaf of that neighbour; the smaller of two that have but each
    other is their hub. All other nodes are hubs. The component is the smallest node reachable, leaves included.
    """
    ws = Workspace(edges.sparkSession, "components")
    near = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", F.when(F.col("e.u") != F.col("e.v"), F.col("e.v")).alias("v"))
    nodes = ws.save(near.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high")), "nodes")
    single = nodes.filter("low = high").select(F.col("u").alias("node"), F.col("low").alias("hub"))
    inner = ws.save(nodes.filter("low IS NULL OR low <> high").select("u"), "inner")
    inner_v = inner.select(F.col("u").alias("v"))
    core = ws.save(edges.filter("u <> v").join(inner, "u", "left_semi").join(inner_v, "v", "left_semi").select("u", "v").distinct(), "core")
    label = _settled(core, ws, rounds)
    # leaves by hub; two nodes that have only each other make a hub of the smaller
    told = single.groupBy("hub").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    hubs = inner.join(told.withColumnRenamed("hub", "u"), "u", "left").join(label, "u", "left").select("u", F.coalesce("v", "u").alias("root"), F.least("u", "least").alias("least"))
    least = hubs.groupBy("root").agg(F.min("least").alias("component"))
    hubs = hubs.join(least, "root").select(F.col("u").alias("hub"), "component")
    lone = told.join(inner.withColumnRenamed("u", "hub"), "hub", "left_anti").filter("hub < least").select("hub", F.col("hub").alias("component"))
    hubs = ws.save(hubs.unionByName(lone), "hubs")
    return hubs, single.join(lone.select(F.col("hub").alias("node")), "node", "left_anti")


def connected_components(edges: DataFrame, u: str = "u", v: str = "v", rounds: int = 60) -> DataFrame:
    """(node, component) for every node with an edge; component is the smallest node reachable.

    Self-loops keep their node as a component of its own. Null ends are ignored.
    """
    given = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).dropna()
    hubs, leaves = peeled(given, rounds)
    return hubs.select(F.col("hub").alias("node"), "component").unionByName(leaves.join(hubs, "hub").select("node", "component"))


def component_sizes(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(component, n): nodes of each component, by edges (u, v)."""
    hubs, leaves = peeled(edges.dropna(subset=["u", "v"]), rounds)
    sizes = leaves.groupBy("hub").agg(F.count("*").alias("n"))
    return hubs.join(sizes, "hub", "left").groupBy("component").agg(F.sum(F.coalesce("n", F.lit(0)) + 1).alias("n"))
