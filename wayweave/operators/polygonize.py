"""Faces of linework: noding, half-edges in rings, and islands taken off the faces around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayweave.operators import overlay
from wayweave.operators.graph import GRID, MUL, SHIFT
from wayweave.plans.workspace import Workspace

#: Ends are kept to half a metre, as node keys are.
STEP = 1 / GRID


def _key(p: Column) -> Column:
    return (p["x"] + SHIFT) * MUL + p["y"] + SHIFT


def _place(key: Column) -> Column:
    y = F.pmod(key, F.lit(MUL))
    return F.struct((((key - y) / MUL).cast("long") - SHIFT).alias("x"), (y - SHIFT).alias("y"))


def node_lines(segs: DataFrame, size: float) -> DataFrame:
    """(u, v) node keys of the segments cut where they meet, each once; ends are kept to half a metre.

    segs have their ends x0, y0, x1, y1; they meet in grid cells of ``size``.
    """
    lines = segs.select(F.lit(0).alias("grp"), F.lit(0).alias("layer"), "x0", "y0", "x1", "y1")
    noded = overlay.node(overlay.on_step(lines, STEP, overlay.once), size / STEP, overlay.once)
    a, b = _key(F.col("a")), _key(F.col("b"))
    return noded.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))


def _chained(edges: DataFrame) -> DataFrame:
    """``overlay.rings`` of both ways along the edges (u, v), without edges that bound no face.

    An edge with one ring on both sides is a dangle or a bridge: no face ends there.
    """
    ws = Workspace(edges.sparkSession, "polygonize", release=False)
    ends = edges.select(F.lit(0).alias("grp"), _place(F.col("u")).alias("a"), _place(F.col("v")).alias("b"))
    half = ends.unionByName(ends.select("grp", F.col("b").alias("a"), F.col("a").alias("b")))
    first, every = ws.save_and_tell(overlay.rings(ws.save(half, "half")), "first", n=F.count("*"))
    back = first.select("grp", F.col("b").alias("a"), F.col("a").alias("b"), F.col("ring").alias("other"))
    kept, bounding = ws.save_and_tell(first.join(back, ["grp", "a", "b"]).filter("ring <> other").select("grp", "a", "b"), "kept", n=F.count("*"))
    return first if bounding == every else ws.save(overlay.rings(kept), "second")


def faces(edges: DataFrame, size: float = 200.0) -> DataFrame:
    """(face, u, v, area): directed border edges of the bounded faces of a noded planar graph (u, v).

    A face has its shell and the rings of the islands in it, which its area leaves out. ``size``
    is the height in metres of the rows in which islands are held against the faces around them.
    """
    chained = _chained(edges)
    areas = Workspace(edges.sparkSession, "polygonize", release=False).save(overlay.ring_areas(chained), "areas")
    owned = overlay.hole_owners(chained, areas, size / STEP).select("grp", F.col("hole").alias("ring"), F.col("owner").alias("face"))
    member = areas.filter("area2 > 0").select("grp", "ring", F.col("ring").alias("face")).union(owned).join(areas, ["grp", "ring"])
    total = member.groupBy("face").agg((F.sum("area2") * (STEP * STEP / 2.0)).alias("area"))
    sides = chained.join(member.select("grp", "ring", "face"), ["grp", "ring"]).join(total, "face")
    name = F.concat_ws("/", "face.a.x", "face.a.y", "face.b.x", "face.b.y")
    return sides.select(name.alias("face"), _key(F.col("a")).alias("u"), _key(F.col("b")).alias("v"), "area")


def polygonize(segs: DataFrame, size: float, least_area: float = 0.0) -> DataFrame:
    """(face, area) of the faces that segments enclose, larger than ``least_area``, without their islands."""
    found = faces(node_lines(segs, size), size)
    return found.groupBy("face").agg(F.first("area").alias("area")).filter(F.col("area") > least_area)


def face_polygons(segs: DataFrame, size: float, least_area: float = 0.0) -> DataFrame:
    """(polygon, area) of the faces that segments enclose: the shell first, then the islands' rings."""
    return overlay.polygons_of(_chained(node_lines(segs, size)), size, STEP, least_area).select("polygon", "area")
