"""Planar overlay: union, difference, repair and clipping of areas as equi-joins on grid cells.

Borders are directed edges with their area on the left. Edges of a group are cut where they meet,
and of each piece every layer keeps how often it runs one way more than the other; pieces met from
both sides cancel. How often a layer goes round a place (its winding number) comes from the place's
cell: from a reference point of the cell, known by running sums along the row of cells, and the
edges in the cell between the two. A piece with different answers on its sides is a border of the
result, and such pieces are chained into rings by pointer doubling.

Coordinates are whole multiples of STEP metres here, so cuts and turns are exact. A place on a
border belongs to the area whose left or lower border it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayweave.functions import geom
from wayweave.operators.grid import through_cells
from wayweave.operators.ranking import rank_lists
from wayweave.plans.workspace import Workspace

STEP = 1 / 64
#: Where in a cell its reference point is: on no multiple of STEP.
AT_X, AT_Y = 0.41421356237, 0.38196601125
ENDS = ("ax", "ay", "bx", "by")


def borders(areas: DataFrame, grp: Column, layer: Column) -> DataFrame:
    """(grp, layer, x0, y0, x1, y1): directed edges of areas (polygon), shells made counter-clockwise, holes clockwise.

    Rings that are not closed are closed; null polygons and rings of under three points have none.
    """
    ring = F.col("ring")
    rings = areas.select(grp.alias("grp"), layer.alias("layer"), F.posexplode("polygon").alias("hole", "ring")).filter(F.size(ring) >= 3)
    rings = rings.withColumn("ring", F.when(ring[0] == F.element_at(ring, -1), ring).otherwise(F.concat(ring, F.array(ring[0]))))
    wrong = (geom.signed_area(ring) > 0) != (F.col("hole") == 0)
    rings = rings.select("grp", "layer", F.when(wrong, F.reverse(ring)).otherwise(ring).alias("ring"))
    edges = rings.select("grp", "layer", "ring", F.explode(F.sequence(F.lit(1), F.size(ring) - 1)).alias("i"))
    a, b = F.element_at(ring, F.col("i")), F.element_at(ring, F.col("i") + 1)
    return edges.select("grp", "layer", a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1"))


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))


def _ends() -> list[Column]:
    return [F.col("a")["x"].alias("ax"), F.col("a")["y"].alias("ay"), F.col("b")["x"].alias("bx"), F.col("b")["y"].alias("by")]


def _summed(directed: DataFrame) -> DataFrame:
    """(grp, layer, a, b, n) with a < b: how often a layer goes from a to b more than back; never 0."""
    on = F.col("a") < F.col("b")
    told = directed.filter("a <> b").select("grp", "layer", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(on, F.col("n")).otherwise(-F.col("n")).alias("n"))
    return told.groupBy("grp", "layer", "a", "b").agg(F.sum("n").alias("n")).filter("n <> 0")


def once(edges: DataFrame) -> DataFrame:
    """(grp, layer, a, b, n) with a < b and n = 1: linework, whose direction means nothing."""
    return edges.filter("a <> b").select("grp", "layer", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit(1).cast("long").alias("n")).distinct()


def on_step(edges: DataFrame, step: float = STEP, total: Callable[[DataFrame], DataFrame] = _summed) -> DataFrame:
    """(grp, layer, a, b, n) of directed edges (grp, layer, x0, y0, x1, y1), on the grid and summed."""
    at = lambda c: F.rint(F.col(c) / step)
    return total(edges.select("grp", "layer", _point(at("x0"), at("y0")).alias("a"), _point(at("x1"), at("y1")).alias("b"), F.lit(1).cast("long").alias("n")))


def _cuts(geo: DataFrame, cell: float) -> DataFrame:
    """(grp, a, b, stops): edges (grp, a, b) that another edge of the group meets, with the points (t, c) inside them, in order."""
    spread = through_cells(geo.select("grp", *_ends()), cell, ENDS)
    other = spread.select("grp", "cx", "cy", *[F.col(c).alias(f"o{c}") for c in ENDS])
    ax, ay, bx, by, px, py, qx, qy = (F.col(c) for c in (*ENDS, *[f"o{c}" for c in ENDS]))
    dx, dy, ex, ey = bx - ax, by - ay, qx - px, qy - py
    apart = (F.greatest(ax, bx) < F.least(px, qx)) | (F.greatest(px, qx) < F.least(ax, bx)) | (F.greatest(ay, by) < F.least(py, qy)) | (F.greatest(py, qy) < F.least(ay, by))
    met = spread.join(other, ["grp", "cx", "cy"]).filter(((ax != px) | (ay != py) | (bx != qx) | (by != qy)) & ~apart)
    met = met.select("grp", *ENDS, *[f"o{c}" for c in ENDS]).withColumn("cross", dx * ey - dy * ex)
    up, down = (px - ax) * ey - (py - ay) * ex, (px - ax) * dy - (py - ay) * dx
    bottom = F.when(F.col("cross") == 0, F.lit(1)).otherwise(F.col("cross"))
    t, s = up / bottom, down / bottom
    crossing = F.when((t > 0) & (t < 1) & (s >= 0) & (s <= 1), F.array(F.struct(t.alias("t"), _point(F.rint(ax + dx * t), F.rint(ay + dy * t)).alias("c"))))
    size2 = dx * dx + dy * dy

    def resting(x: Column, y: Column) -> Column:  # an end of the other edge on the line of this one
        along = ((x - ax) * dx + (y - ay) * dy) / size2
        return F.struct(F.when(((x - ax) * dy == (y - ay) * dx) & (along > 0) & (along < 1), along).alias("t"), _point(x, y).alias("c"))

    found = F.when(F.col("cross") != 0, crossing).otherwise(F.array(resting(px, py), resting(qx, qy)))
    cut = met.select("grp", _point(ax, ay).alias("a"), _point(bx, by).alias("b"), F.explode(found).alias("k")).select("grp", "a", "b", "k.t", "k.c")
    # dealt by edge once, for both sums
    every = cut.filter("t IS NOT NULL AND c <> a AND c <> b").repartition("grp", "a", "b").groupBy("grp", "a", "b", "c").agg(F.min("t").alias("t"))
    return every.groupBy("grp", "a", "b").agg(F.array_sort(F.collect_list(F.struct("t", "c"))).alias("stops"))


def node(edges: DataFrame, cell: float, total: Callable[[DataFrame], DataFrame] = _summed, rounds: int = 12) -> DataFrame:
    """Edges (grp, layer, a, b, n) cut until none meets another but at ends; layers' pieces are summed.

    A cut goes to the nearest grid point, which can move an edge by less than a step and make it
    meet a further one, so cutting goes on until nothing is left to cut.
    """
    ws = Workspace(edges.sparkSession, "noding", release=False)
    now = ws.save(edges, "edges0")
    for i in range(1, rounds):
        cuts, told = ws.save_and_tell(_cuts(now, cell), f"cuts{i}", n=F.count("*"))
        if not told["n"]:
            return now
        inner = F.coalesce(F.transform("stops", lambda k: k["c"]), F.array().cast("array<struct<x:bigint,y:bigint>>"))
        pieces = F.zip_with(F.concat(F.array("a"), inner), F.concat(inner, F.array("b")), lambda p, q: F.struct(p.alias("a"), q.alias("b")))
        cut = now.join(cuts, ["grp", "a", "b"], "left").select("grp", "layer", "n", F.explode(pieces).alias("p"))
        now = ws.save(total(cut.select("grp", "layer", "p.a", "p.b", "n")), f"edges{i}")
        ws.drop(f"edges{i - 1}", f"cuts{i}")
    raise RuntimeError(f"edges still meet after {rounds} rounds")


def covered_cells(edges: DataFrame, cell: float) -> DataFrame:
    """(grp, layer, cx, cy, w): cells whose reference point a layer goes round, w times.

    edges are (grp, layer, ax, ay, bx, by, n). Each row of cells is swept by its crossings; the
    cells are as many as a layer's area has.
    """
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    first, last = F.ceil(low / cell - AT_Y), F.ceil(high / cell - AT_Y) - 1
    rows = edges.filter(last >= first).select("grp", "layer", *ENDS, "n", F.explode(F.sequence(first, last)).alias("cy"))
    y = (F.col("cy") + AT_Y) * cell
    x = F.col("ax") + (F.col("bx") - F.col("ax")) * (y - F.col("ay")) / (F.col("by") - F.col("ay"))
    turn = F.when(F.col("by") > F.col("ay"), -F.col("n")).otherwise(F.col("n"))
    row = Window.partitionBy("grp", "layer", "cy").orderBy("x")
    swept = rows.select("grp", "layer", "cy", x.alias("x"), turn.alias("turn")).groupBy("grp", "layer", "cy", "x").agg(F.sum("turn").alias("turn"))
    swept = swept.select("grp", "layer", "cy", "x", F.lead("x").over(row).alias("to"), F.sum("turn").over(row.rowsBetween(Window.unboundedPreceding, 0)).alias("w")).filter("w <> 0 AND to IS NOT NULL")
    start, stop = F.floor(F.col("x") / cell - AT_X) + 1, F.floor(F.col("to") / cell - AT_X)
    return swept.filter(stop >= start).select("grp", "layer", F.explode(F.sequence(start, stop)).alias("cx"), "cy", "w")


def winding_at(points: DataFrame, edges: DataFrame, cell: float) -> DataFrame:
    """(grp, id, layer, w), w not 0: how often each layer of its group goes round each point.

    points are (grp, id, x, y), edges (grp, layer, ax, ay, bx, by, n). From the cell's reference
    point the way goes up or down to the point's height, then along it.
    """
    return _turns(points, edges, cell).groupBy("grp", "id", "layer").agg(F.sum("w").alias("w")).filter("w <> 0")


def _turns(points: DataFrame, edges: DataFrame, cell: float) -> DataFrame:
    """(grp, id, layer, w): what ``winding_at`` sums.

    What hangs on an edge and a cell alone is told before the join. That leaves a pair little to do, in
    a generated method short enough for Java to compile (8,000 bytes; longer ones are interpreted).
    """
    own = points.select("grp", "id", "x", "y", F.floor(F.col("x") / cell).alias("cx"), F.floor(F.col("y") / cell).alias("cy"))
    near = through_cells(edges.select("grp", "layer", *ENDS, "n"), cell, ENDS)
    rx, ry = (F.col("cx") + AT_X) * cell, (F.col("cy") + AT_Y) * cell
    ax, ay, bx, by, n, x, y = (F.col(c) for c in (*ENDS, "n", "x", "y"))
    over = (ax <= rx) != (bx <= rx)
    yc = ay + (by - ay) * (rx - ax) / F.when(ax == bx, F.lit(1)).otherwise(bx - ax)
    # an edge on the way up or down has yc; a level one elsewhere is on no way
    near = near.filter(over | (ay != by)).select(
        "grp", "layer", "cx", "cy", "ax", "ay", "bx", "by", F.when(over, yc).alias("yc"), F.when(bx > ax, n).otherwise(-n).alias("up"), F.when(by > ay, -n).otherwise(n).alias("side"),
    )
    yc, xc = F.col("yc"), ax + (bx - ax) * (y - ay) / F.when(ay == by, F.lit(1)).otherwise(by - ay)
    rise = F.when((yc > ry) & (yc <= y), F.col("up")).when((yc <= ry) & (yc > y), -F.col("up")).otherwise(0)
    run = F.when((ay <= y) != (by <= y), F.when(xc > rx, F.when(xc <= x, 1).otherwise(0)).otherwise(F.when(xc > x, -1).otherwise(0)) * F.col("side")).otherwise(0)
    beside = own.join(near, ["grp", "cx", "cy"]).select("grp", "id", "layer", (rise + run).alias("w")).filter("w <> 0")
    base = own.join(covered_cells(edges, cell), ["grp", "cx", "cy"]).select("grp", "id", "layer", "w")
    return base.unionByName(beside)


def _beside(a: Column, b: Column, gap: float = 1e-4) -> tuple[Column, Column]:
    """A point just left of the middle of an edge."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    size = F.sqrt(dx * dx + dy * dy)
    return (a["x"] + b["x"]) / 2.0 - dy / size * gap, (a["y"] + b["y"]) / 2.0 + dx / size * gap


def overlay(edges: DataFrame, layers: list[str], inside: Callable[..., Column], size: float, step: float = STEP) -> DataFrame:
    """(grp, a, b): directed border of the area where ``inside`` of the layers' winding numbers holds.

    edges are (grp, layer, x0, y0, x1, y1) with areas on the left; ``inside`` takes one column a
    layer, in order. Cells are ``size`` metres wide.
    """
    cell = size / step
    ws = Workspace(edges.sparkSession, "overlay", release=False)
    noded = ws.save(node(on_step(edges, step), cell), "noded")
    x, y = _beside(F.col("id")["a"], F.col("id")["b"])
    ids = noded.select("grp", F.struct("a", "b").alias("id"))
    points = (ids.distinct() if len(layers) > 1 else ids).select("grp", "id", x.alias("x"), y.alias("y"))
    turns = _turns(points, noded.select("grp", "layer", *_ends(), "n"), cell)
    none = F.lit(0).cast("long")
    both = turns.select("grp", "id", "layer", F.col("w").cast("long").alias("w"), none.alias("n")).unionByName(noded.select("grp", F.struct("a", "b").alias("id"), "layer", none.alias("w"), "n"))
    of = lambda v: [F.sum(F.when(F.col("layer") == k, F.col(v)).otherwise(0)).alias(f"{v}{i}") for i, k in enumerate(layers)]
    told = both.groupBy("grp", "id").agg(*of("w"), *of("n")).select("grp", "id.a", "id.b", *[f"{v}{i}" for v in "wn" for i in range(len(layers))])
    w = [F.col(f"w{i}") for i in range(len(layers))]
    here, there = inside(*w), inside(*[v - F.col(f"n{i}") for i, v in enumerate(w)])
    border = told.filter(here != there).select("grp", F.when(here, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(here, F.col("b")).otherwise(F.col("a")).alias("b"))
    return ws.save(border, "border")


def _follow(border: DataFrame) -> DataFrame:
    """(item, next), both ids of border edges (id, grp, a, b): after edge (a, b) comes the edge that leaves b first clockwise of b to a."""
    angle = lambda p, q: F.atan2((q["y"] - p["y"]).cast("double"), (q["x"] - p["x"]).cast("double"))
    a, b, none = F.col("a"), F.col("b"), F.lit(None).cast("long")
    out = border.select("grp", a.alias("at"), angle(a, b).alias("angle"), F.col("id").alias("to"), none.alias("come"))
    come = border.select("grp", b.alias("at"), angle(b, a).alias("angle"), none.alias("to"), F.col("id").alias("come"))
    turn = Window.partitionBy("grp", "at").orderBy("angle", F.col("to").isNotNull())  # an edge's own way back comes last
    before, whole = turn.rowsBetween(Window.unboundedPreceding, -1), turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    goal = F.coalesce(F.last("to", True).over(before), F.last("to", True).over(whole))
    return out.unionByName(come).withColumn("goal", goal).filter("come IS NOT NULL").select(F.col("come").alias("item"), F.col("goal").alias("next"))


def rings(border: DataFrame) -> DataFrame:
    """(grp, ring, place, a, b): the directed border edges (grp, a, b) in order along their rings.

    Rings keep to the area on their left: where rings touch in a point, each turns back to its own side.
    """
    own = Workspace(border.sparkSession, "follow", release=False).save(border.select(F.monotonically_increasing_id().alias("id"), "grp", "a", "b"), "edges")
    told = rank_lists(_follow(own), own.select(F.col("id").alias("item"), F.struct("grp", "a", "b").alias("name")))
    return told.select(F.col("item.grp").alias("grp"), F.struct("list.a", "list.b").alias("ring"), "place", F.col("item.a").alias("a"), F.col("item.b").alias("b"))


def ring_areas(chained: DataFrame) -> DataFrame:
    """(grp, ring, area2): twice the signed area in square steps, exact."""
    a, b = F.col("a"), F.col("b")
    ox, oy = F.col("ring")["a"]["x"], F.col("ring")["a"]["y"]
    part = (a["x"] - ox) * (b["y"] - oy) - (b["x"] - ox) * (a["y"] - oy)
    return chained.groupBy("grp", "ring").agg(F.sum(part).alias("area2"))


def hole_owners(chained: DataFrame, areas: DataFrame, cell: float) -> DataFrame:
    """(grp, hole, owner): each clockwise ring with the least counter-clockwise ring around it.

    A point just left of the hole's first edge is held against the rings' edges to the left of
    it, row by row of cells: an odd number means around. Holes around which there is no ring are left out.
    """
    holes = areas.filter("area2 < 0").select("grp", F.col("ring").alias("hole"))
    x, y = _beside(F.col("hole")["a"], F.col("hole")["b"])
    points = holes.select("grp", "hole", x.alias("x"), y.alias("y")).withColumn("cy", F.floor(F.col("y") / cell))
    shells = areas.filter("area2 > 0").select("grp", "ring", "area2")
    ax, ay, bx, by = (F.col(c) for c in ENDS)
    rows = F.sequence(F.floor(F.least(ay, by) / cell), F.floor(F.greatest(ay, by) / cell))
    sides = chained.join(shells, ["grp", "ring"]).select("grp", "ring", "area2", *_ends()).filter("ay <> by").withColumn("cy", F.explode(rows))
    xc = ax + (bx - ax) * (F.col("y") - ay) / (by - ay)
    hit = points.join(sides, ["grp", "cy"]).filter(((ay <= F.col("y")) != (by <= F.col("y"))) & (xc < F.col("x")))
    around = hit.groupBy("grp", "hole", "ring", "area2").count().filter("count % 2 = 1")
    return around.groupBy("grp", "hole").agg(F.min_by("ring", F.struct("area2", "ring")).alias("owner"))


def polygons(border: DataFrame, size: float, step: float = STEP, least_area: float = 0.0) -> DataFrame:
    """(grp, polygon, area): one row for each connected part, shell first, then its holes.

    border is that of ``overlay``. Parts of less than ``least_area`` square metres are left out. A
    row holds one part's points, as a polygon column has to.
    """
    ws = Workspace(border.sparkSession, "rings", release=False)
    return polygons_of(ws.save(rings(border), "chained"), size, step, least_area)


def polygons_of(chained: DataFrame, size: float, step: float = STEP, least_area: float = 0.0) -> DataFrame:
    """``polygons`` of saved ``rings``."""
    areas = Workspace(chained.sparkSession, "rings", release=False).save(ring_areas(chained), "areas")
    owners = hole_owners(chained, areas, size / step)
    xy = F.struct((F.col("a")["x"] * step).alias("x"), (F.col("a")["y"] * step).alias("y"))
    lines = chained.groupBy("grp", "ring").agg(F.array_sort(F.collect_list(F.struct("place", xy.alias("p")))).alias("s"))
    points = F.transform("s", lambda v: v["p"])
    lines = lines.select("grp", "ring", F.concat(points, F.slice(points, 1, 1)).alias("line")).join(areas, ["grp", "ring"])
    holes = lines.filter("area2 < 0").withColumnRenamed("ring", "hole").join(owners, ["grp", "hole"])
    holes = holes.groupBy("grp", F.col("owner").alias("ring")).agg(F.array_sort(F.collect_list("line")).alias("holes"), F.sum("area2").alias("hole2"))
    whole = lines.filter("area2 > 0").join(holes, ["grp", "ring"], "left")
    area = (F.col("area2") + F.coalesce("hole2", F.lit(0))) * (step * step / 2.0)
    told = whole.select("grp", F.concat(F.array("line"), F.coalesce("holes", F.array().cast(geom.POLYGON))).alias("polygon"), area.alias("area"))
    return told.filter(F.col("area") >= least_area)


def dissolve(areas: DataFrame, size: float, name: str = "name", step: float = STEP) -> DataFrame:
    """(name, polygon, area): areas of one name as their union, one row for each connected part.

    Adjoining and overlapping areas grow together, rings that cross themselves become the parts
    they go round, and null names and polygons are left out. Ends are kept to ``step``.
    """
    named = areas.filter(F.col(name).isNotNull() & F.col("polygon").isNotNull())
    border = overlay(borders(named, F.col(name), F.lit("area")), ["area"], lambda w: w != 0, size, step)
    return polygons(border, size, step).withColumnRenamed("grp", name)


def repair(areas: DataFrame, size: float, key: str, step: float = STEP) -> DataFrame:
    """``dissolve`` by a unique key: each area without crossings of its own, in one or more parts."""
    return dissolve(areas, size, key, step)


def difference(areas: DataFrame, taken: DataFrame, size: float, name: str = "name", least_area: float = 0.0, step: float = STEP) -> DataFrame:
    """(name, polygon, area): areas of each name without the areas of ``taken`` (polygon).

    Only those of ``taken`` are used in a name that share a cell with it. Parts of less than
    ``least_area`` square metres are left out.
    """
    cell = size / step
    ws = Workspace(areas.sparkSession, "difference", release=False)
    own = borders(areas.filter(F.col(name).isNotNull()), F.col(name), F.lit("own"))
    less = ws.save(borders(taken.withColumn("_key", F.monotonically_increasing_id()), F.col("_key"), F.lit("less")), "less")

    def cells(edges: DataFrame) -> DataFrame:
        kept = on_step(edges, step).select("grp", "layer", *_ends(), "n")
        return through_cells(kept, cell, ENDS).select("grp", "cx", "cy").union(covered_cells(kept, cell).select("grp", "cx", "cy")).distinct()

    pairs = cells(own).withColumnRenamed("grp", "to").join(cells(less), ["cx", "cy"]).select("to", "grp").distinct()
    both = own.unionByName(less.join(pairs, "grp").drop("grp").withColumnRenamed("to", "grp").select(*own.columns))
    border = overlay(both, ["own", "less"], lambda a, b: (a != 0) & (b == 0), size, step)
    return polygons(border, size, step, least_area).withColumnRenamed("grp", name)
