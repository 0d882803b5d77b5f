"""Routable networks: noding, diagonals, degrees, chains, contraction, components.

Everything is keyed by ``ward`` and node key, so wards are independent and nothing needs a dense
node number.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayweave.functions.numeric import round_scaled
from wayweave.operators.components import component_sizes, connected_components
from wayweave.operators.ranking import rank_lists
from wayweave.plans.workspace import Workspace

#: Coordinates are kept to half a metre; the key has x and y, shifted to be positive.
GRID, SHIFT, MUL = 2, 1_000_000, 10_000_000


def grid_index(c: Column) -> Column:
    return F.rint(c * GRID).cast("long") + SHIFT


def node_key(x: Column, y: Column) -> Column:
    return grid_index(x) * MUL + grid_index(y)


def key_point(key: Column) -> Column:
    """struct(x, y) of a node key."""
    high = (key - F.pmod(key, F.lit(MUL))) / MUL
    return F.struct(((high - SHIFT) / GRID).alias("x"), ((F.pmod(key, F.lit(MUL)) - SHIFT) / GRID).alias("y"))


def two_point_segments(lines: DataFrame, line: str = "line") -> DataFrame:
    """Adds x0, y0, x1, y1 to lines that have to be of two points; one of any other length, or none, stops the job."""
    whole = F.coalesce(F.size(line), F.lit(-1)) == 2
    told = F.assert_true(whole, F.concat(F.lit("a line of two points was expected, not of "), F.coalesce(F.size(line).cast("string"), F.lit("none"))))
    a, b = F.try_element_at(F.col(line), F.lit(1)), F.try_element_at(F.col(line), F.lit(2))
    ends = {"x0": a["x"], "y0": a["y"], "x1": b["x"], "y1": b["y"]}
    return lines.withColumns({k: F.when(told.isNull(), v) for k, v in ends.items()})


def node_segments(segs: DataFrame) -> DataFrame:
    """Adds u, v and length to segments (ward, seg_id, x0, y0, x1, y1, width_m)."""
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    return segs.withColumns(
        {
            "u": node_key(F.col("x0"), F.col("y0")),
            "v": node_key(F.col("x1"), F.col("y1")),
            "length": F.sqrt(dx * dx + dy * dy),
        }
    )


def ends(edges: DataFrame) -> DataFrame:
    """(ward, node) for each end of each edge."""
    return edges.select("ward", F.col("u").alias("node")).unionAll(edges.select("ward", F.col("v").alias("node")))


def drop_diagonals(edges: DataFrame) -> DataFrame:
    """Without self-loops, and without diagonals that have a right-angled way round.

    A diagonal goes if either corner of its box is a node of the ward; a corner's edges are not
    looked at.
    """
    ux, uy = F.expr(f"u div {MUL}"), F.pmod("u", F.lit(MUL))
    vx, vy = F.expr(f"v div {MUL}"), F.pmod("v", F.lit(MUL))
    nodes = ends(edges).distinct()
    is_diagonal = (ux != vx) & (uy != vy)
    cornered = (
        edges.filter(is_diagonal)
        .select("ward", "seg_id", F.explode(F.array(ux * MUL + vy, vx * MUL + uy)).alias("node"))
        .join(nodes, ["ward", "node"], "left_semi")
        .select("ward", "seg_id")
        .distinct()
    )
    return edges.filter("u <> v").join(cornered, ["ward", "seg_id"], "left_anti")


def degrees(edges: DataFrame) -> DataFrame:
    """(ward, node, degree)."""
    return ends(edges).groupBy("ward", "node").agg(F.count("*").alias("degree"))


def _ward_pairs(edges: DataFrame) -> DataFrame:
    pair = lambda c: F.struct("ward", F.col(c).alias("node"))
    return edges.select(pair("u").alias("u"), pair("v").alias("v"))


def ward_components(edges: DataFrame) -> DataFrame:
    """(ward, node, component): components of each ward's graph."""
    found = connected_components(_ward_pairs(edges))
    return found.select("node.ward", "node.node", F.col("component.node").alias("component"))


def chains(edges: DataFrame) -> DataFrame:
    """Adds chain, place, forward, u_inner and v_inner to edges (ward, seg_id, u, v, ...): one chain per street between junctions.

    Nodes of degree 2 are inside a street, which its smallest inner node names; an edge between two
    junctions is a street of its own. Each way along an edge is an item whose next item leaves the
    inner node at its end; ranks along these lists give an edge's place in its street, in the way
    that starts at the smaller end; ``forward`` tells whether that way runs from u to v.
    """
    ws = Workspace(edges.sparkSession, "chains", release=False)
    # edges are numbered in order of their keys; the two ways along edge e are the items 2 e and 2 e + 1
    edges = ws.save(edges.sort("ward", "seg_id").withColumn("_e", F.monotonically_increasing_id()), "edges")
    way = lambda at, to, ahead: edges.select("ward", F.col(at).alias("at"), F.col(to).alias("to"), (F.col("_e") * 2 + ahead).alias("item"))
    out = way("u", "v", 1).unionAll(way("v", "u", 0))
    pairs = out.groupBy("ward", "at").agg(F.count("*").alias("n"), F.min("item").alias("p"), F.max("item").alias("q")).filter("n = 2")
    pairs = ws.save(pairs.select("ward", "at", "p", "q"), "pairs")
    back = lambda i: i.bitwiseXOR(F.lit(1).cast("long"))
    p, q = F.col("p"), F.col("q")
    turns = pairs.select(F.explode(F.array(F.struct(back(p).alias("item"), q.alias("next")), F.struct(back(q).alias("item"), p.alias("next")))).alias("t")).select("t.*")
    ranked = rank_lists(out.select("item").join(turns, "item", "left")).select("item", "list", "place")
    inner = pairs.select(F.explode(F.array("p", "q")).alias("item"), F.lit(True).alias("inner"))
    told = out.select("item", "at", "to").join(inner, "item", "left").join(ranked, "item")
    ends = told.groupBy("list").agg(F.min(F.when(F.col("inner"), F.col("at"))).alias("least"), F.min_by("at", "place").alias("start"), F.max_by("to", "place").alias("stop"))
    ends = ends.select("list", "least", (F.col("start") > F.col("stop")).alias("down"))
    ahead = F.pmod("item", F.lit(2)) == 1
    told = told.join(ends, "list").select(F.expr("item div 2").alias("_e"), F.struct("down", "list", "place", ahead.alias("ahead"), "least").alias("way"), F.when(ahead, F.col("inner").isNotNull()).alias("u_in"), F.when(~ahead, F.col("inner").isNotNull()).alias("v_in"))
    each = told.groupBy("_e").agg(F.min("way").alias("way"), F.max("u_in").alias("u_inner"), F.max("v_in").alias("v_inner"))
    each = each.select("_e", "u_inner", "v_inner", F.col("way.least").alias("least"), F.col("way.place").alias("place"), F.col("way.ahead").alias("forward"))
    solo = F.concat(F.lit("s"), F.col("seg_id").cast("string"))
    told = edges.join(each, "_e").withColumn("chain", F.coalesce(F.col("least").cast("string"), solo))
    return told.select(*[c for c in edges.columns if c != "_e"], "u_inner", "v_inner", "chain", "place", "forward")


def contract(edges: DataFrame, told: DataFrame | None = None) -> DataFrame:
    """(ward, chain, u, v, length_m, width_m): streets with two different ends; u < v.

    Closed rings and streets with one end are dropped. Parallel streets are all kept. ``told``
    is ``chains(edges)`` where that is at hand.
    """
    if told is None:
        ws = Workspace(edges.sparkSession, "contract", release=False)
        told = ws.save(chains(edges), "chains")
    sums = told.groupBy("ward", "chain").agg(
        F.sum("length").alias("length"), F.sum(F.col("length") * F.col("width_m")).alias("by_width")
    )
    out = told.filter("NOT u_inner").select("ward", "chain", F.col("u").alias("node"))
    out = out.unionAll(told.filter("NOT v_inner").select("ward", "chain", F.col("v").alias("node")))
    two = out.groupBy("ward", "chain").agg(F.min("node").alias("u"), F.max("node").alias("v")).filter("u <> v")
    return sums.join(two, ["ward", "chain"]).select(
        "ward", "chain", "u", "v",
        round_scaled(F.col("length"), 2).alias("length_m"),
        round_scaled(F.col("by_width") / F.greatest("length", F.lit(1e-9)), 1).alias("width_m"),
    )


def street_lines(edges: DataFrame, tolerance: float = 0.5, told: DataFrame | None = None) -> DataFrame:
    """(ward, chain, line): each street's points in order along it, simplified; a ring ends where it begins.

    The order is that of ``chains``; ``told`` is ``chains(edges)`` where that is at hand.
    """
    told = chains(edges) if told is None else told
    end = lambda x, y, c: F.struct(F.when(F.col("forward") == c, F.col(f"{x}0")).otherwise(F.col(f"{x}1")).alias(x), F.when(F.col("forward") == c, F.col(f"{y}0")).otherwise(F.col(f"{y}1")).alias(y))
    steps = told.select("ward", "chain", F.struct("place", end("x", "y", True).alias("from"), end("x", "y", False).alias("to")).alias("s"))
    whole = steps.groupBy("ward", "chain").agg(F.array_sort(F.collect_list("s")).alias("s"))
    line = F.concat(F.transform("s", lambda v: v["from"]), F.array(F.element_at("s", -1)["to"]))
    return simplify_lines(whole.select("ward", "chain", line.alias("line")), "line", tolerance).select("ward", "chain", F.col("simple").alias("line"))


def simplify(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas-Peucker: points farther than the tolerance from the chord stay, and both ends."""
    keep = np.zeros(len(points), bool)
    keep[[0, -1]] = True
    todo = [(0, len(points) - 1)]
    while todo:
        i, j = todo.pop()
        if j - i < 2:
            continue
        a, b, inner = points[i], points[j], points[i + 1 : j]
        d = b - a
        size = float(d @ d)
        t = np.clip((inner - a) @ d / size, 0, 1)[:, None] if size else np.zeros((len(inner), 1))
        gap = np.hypot(*(inner - (a + t * d)).T)
        k = int(gap.argmax())
        if gap[k] > tolerance:
            keep[i + 1 + k] = True
            todo += [(i, i + 1 + k), (i + 1 + k, j)]
    return points[keep]


def simplify_lines(df: DataFrame, line: str, tolerance: float, out: str = "simple") -> DataFrame:
    """Adds the simplified line of a line column."""

    @F.pandas_udf("array<struct<x:double,y:double>>")
    def run(lines: pd.Series) -> pd.Series:
        return lines.map(
            lambda v: None if v is None else [{"x": x, "y": y} for x, y in simplify(np.array([(p["x"], p["y"]) for p in v], float).reshape(-1, 2), tolerance)] if len(v) else []
        )

    return df.withColumn(out, run(F.col(line)))


def nodes_of(edges: DataFrame) -> DataFrame:
    """(ward, node, x, y) of the nodes that edges use."""
    used = ends(edges).distinct()
    return used.select("ward", "node", key_point(F.col("node")).alias("p")).select("ward", "node", "p.x", "p.y")


def largest_component_pct(edges: DataFrame) -> DataFrame:
    """(ward, lcc_pct): share of nodes in the ward's largest component, to a tenth of a percent."""
    sizes = component_sizes(_ward_pairs(edges)).select(F.col("component.ward").alias("ward"), "n")
    return sizes.groupBy("ward").agg(round_scaled(F.max("n") * 100.0 / F.sum("n"), 1).alias("lcc_pct"))
