"""Spatial joins as equi-joins on grid cells with an exact refinement.

Every geometry is put into the cells its bounding box touches; sides meet on the cell, the exact
predicate decides, and a pair that meets in several cells is one pair. A layer's cell size is a
parameter: near the size of its features. No join here is a nested loop, and skewed cells are
left to Spark's adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayweave.functions import geom


def cell(x: Column, size: float) -> Column:
    """Index of the cell that holds a coordinate (floor, so negatives go down)."""
    return F.floor(x / size)


def cells(x0: Column, y0: Column, x1: Column, y1: Column, size: float) -> Column:
    """Array of the cells that a box touches."""
    xs = F.sequence(cell(x0, size), cell(x1, size))
    ys = F.sequence(cell(y0, size), cell(y1, size))
    return F.flatten(F.transform(xs, lambda i: F.transform(ys, lambda j: F.struct(i.alias("cx"), j.alias("cy")))))


def box_of(line: Column) -> list[Column]:
    """x0, y0, x1, y1 of a line or ring."""
    xs, ys = F.transform(line, lambda p: p["x"]), F.transform(line, lambda p: p["y"])
    return [F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)]


def with_cells(df: DataFrame, box: list[Column], size: float) -> DataFrame:
    """One row for each cell of the box, as columns cx and cy."""
    return df.withColumn("_cell", F.explode(cells(*box, size))).withColumns({"cx": F.col("_cell.cx"), "cy": F.col("_cell.cy")}).drop("_cell")


def through_cells(df: DataFrame, size: float, ends: tuple[str, str, str, str] = ("x0", "y0", "x1", "y1")) -> DataFrame:
    """One row for each cell that a segment goes through, as columns cx and cy.

    The segment is cut into its rows of cells, so a long diagonal lists the cells along it, not
    those of its box.
    """
    x0, y0, x1, y1 = (F.col(c) for c in ends)
    low, high = F.least(y0, y1), F.greatest(y0, y1)
    rows = df.withColumn("cy", F.explode(F.sequence(cell(low, size), cell(high, size))))
    at = lambda y: x0 + (x1 - x0) * (F.greatest(F.least(y, high), low) - y0) / F.when(y0 == y1, F.lit(1)).otherwise(y1 - y0)
    flat, p, q = y0 == y1, at(F.col("cy") * size), at((F.col("cy") + 1) * size)
    left = F.when(flat, F.least(x0, x1)).otherwise(F.least(p, q)) / size - 1e-9
    right = F.when(flat, F.greatest(x0, x1)).otherwise(F.greatest(p, q)) / size + 1e-9
    return rows.withColumn("cx", F.explode(F.sequence(F.floor(left), F.floor(right)))).select(*df.columns, "cx", "cy")


def segments(df: DataFrame, key: str, line: str) -> DataFrame:
    """(key, i, x0, y0, x1, y1): the segments of a line column."""
    n = F.size(line)
    at = F.when(n >= 2, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    s = df.select(key, F.col(line), F.explode(at).alias("i"))
    a, b = F.element_at(line, F.col("i")), F.element_at(line, F.col("i") + 1)
    return s.select(key, "i", a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1"))


def first_covering(points: DataFrame, areas: DataFrame, size: float, name: str = "name") -> DataFrame:
    """Adds to points (x, y) the smallest name of the polygons that hold them; null where none does.

    points need a unique point_id; areas have name and polygon.
    """
    shell = box_of(F.col("polygon")[0])
    tiles = with_cells(areas.select(F.col(name).alias("_name"), "polygon"), shell, size)
    own = points.select("point_id", "x", "y").withColumns({"cx": cell(F.col("x"), size), "cy": cell(F.col("y"), size)})
    hits = (
        own.join(tiles, ["cx", "cy"])
        .filter(geom.in_polygon(F.col("x"), F.col("y"), F.col("polygon")))
        .groupBy("point_id")
        .agg(F.min("_name").alias(name))
    )
    return points.join(hits, "point_id", "left")


def first_meeting(lines: DataFrame, areas: DataFrame, size: float, name: str = "name") -> DataFrame:
    """Lines that meet an area, with the smallest name of those: whole features, not cut.

    lines have line_id and line; areas have name and polygon. A line meets an area if it crosses
    the border or lies inside.
    """
    own = segments(lines, "line_id", "line")
    ring = F.explode("polygon")
    border = segments(areas.select(F.col(name).alias("_name"), ring.alias("ring")), "_name", "ring")
    seg = lambda df: [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    box = lambda: [F.least("x0", "x1"), F.least("y0", "y1"), F.greatest("x0", "x1"), F.greatest("y0", "y1")]
    left = with_cells(own, box(), size)
    right = with_cells(border.withColumnsRenamed({"i": "j"}), box(), size).withColumnsRenamed({c: f"b{c}" for c in ("x0", "y0", "x1", "y1")})
    crossing = (
        left.join(right, ["cx", "cy"])
        .filter(geom.segments_meet(seg(left), [F.col(f"b{c}") for c in ("x0", "y0", "x1", "y1")]))
        .select("line_id", "_name")
    )
    starts = lines.select("line_id", F.col("line")[0]["x"].alias("x"), F.col("line")[0]["y"].alias("y"))
    starts = starts.withColumns({"cx": cell(F.col("x"), size), "cy": cell(F.col("y"), size)})
    tiles = with_cells(areas.select(F.col(name).alias("_name"), "polygon"), box_of(F.col("polygon")[0]), size)
    inside = starts.join(tiles, ["cx", "cy"]).filter(geom.in_polygon(F.col("x"), F.col("y"), F.col("polygon"))).select("line_id", "_name")
    first = crossing.union(inside).groupBy("line_id").agg(F.min("_name").alias(name))
    return lines.join(first, "line_id")


def crossing_flag(lines: DataFrame, barriers: DataFrame, size: float, flag: str = "barrier_cross") -> DataFrame:
    """Adds whether a line meets any barrier line; lines have line_id and line, barriers line."""
    box = lambda: [F.least("x0", "x1"), F.least("y0", "y1"), F.greatest("x0", "x1"), F.greatest("y0", "y1")]
    names = ("x0", "y0", "x1", "y1")
    left = with_cells(segments(lines, "line_id", "line"), box(), size)
    bar = segments(barriers.withColumn("_b", F.lit(0)).select("_b", "line"), "_b", "line").distinct()
    right = with_cells(bar, box(), size).select("cx", "cy", *[F.col(c).alias(f"b{c}") for c in names])
    hit = (
        left.join(right, ["cx", "cy"])
        .filter(geom.segments_meet([F.col(c) for c in names], [F.col(f"b{c}") for c in names]))
        .select("line_id")
        .distinct()
        .withColumn(flag, F.lit(True))
    )
    return lines.join(hit, "line_id", "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def nearest_capped(points: DataFrame, targets: DataFrame, limit: float, group: list[str] | None = None) -> DataFrame:
    """Adds to points (point_id, x, y) the distance to the nearest target (x, y), ``limit`` at most.

    Cells are ``limit`` wide, so only the three by three around a point can matter. With
    ``group`` only targets with equal group columns count.
    """
    group = group or []
    near = F.sequence(F.lit(-1), F.lit(1))
    spread = points.select(*group, "point_id", "x", "y", cell(F.col("x"), limit).alias("px"), cell(F.col("y"), limit).alias("py"))
    spread = spread.withColumn("dx", F.explode(near)).withColumn("dy", F.explode(near))
    spread = spread.withColumns({"cx": F.col("px") + F.col("dx"), "cy": F.col("py") + F.col("dy")}).drop("px", "py", "dx", "dy")
    goal = targets.select(*group, F.col("x").alias("tx"), F.col("y").alias("ty"), cell(F.col("x"), limit).alias("cx"), cell(F.col("y"), limit).alias("cy")).distinct()
    gap = F.sqrt((F.col("x") - F.col("tx")) * (F.col("x") - F.col("tx")) + (F.col("y") - F.col("ty")) * (F.col("y") - F.col("ty")))
    best = spread.join(goal, [*group, "cx", "cy"]).groupBy("point_id").agg(F.min(gap).alias("_d"))
    return points.join(best, "point_id", "left").withColumn("dist", F.least(F.coalesce("_d", F.lit(limit)), F.lit(limit))).drop("_d")


def keep_first(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")
