"""Parts of segments inside areas of any shape, or within reach of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayweave.operators.grid import through_cells
from wayweave.operators.overlay import borders, winding_at

NAMES = ("x0", "y0", "x1", "y1")
#: Parameters along a segment are kept to this many digits, so a corner met twice is one cut.
DIGITS = 12


def _borders(areas: DataFrame) -> DataFrame:
    edges = borders(areas.filter("name IS NOT NULL"), F.lit(0), F.col("name"))
    return edges.filter("x0 <> x1 OR y0 <> y1").select("layer", *[F.col(a).alias(b) for a, b in zip(NAMES, ("ax", "ay", "bx", "by"), strict=True)])


def _cuts(segs: DataFrame, border: DataFrame, size: float) -> DataFrame:
    """(seg_id, name, t): where along a segment it meets an area's border, ends left out."""
    met = through_cells(segs, size).join(through_cells(border, size, ("ax", "ay", "bx", "by")), ["cx", "cy"])
    x0, y0, x1, y1, ax, ay, bx, by = (F.col(c) for c in (*NAMES, "ax", "ay", "bx", "by"))
    dx, dy, ex, ey = x1 - x0, y1 - y0, bx - ax, by - ay
    cross = dx * ey - dy * ex
    bottom = F.when(cross == 0, F.lit(1.0)).otherwise(cross)
    t, s = ((ax - x0) * ey - (ay - y0) * ex) / bottom, ((ax - x0) * dy - (ay - y0) * dx) / bottom
    along = lambda x, y: F.when((x - x0) * dy == (y - y0) * dx, ((x - x0) * dx + (y - y0) * dy) / (dx * dx + dy * dy))
    crossing = F.when((s >= -1e-12) & (s <= 1 + 1e-12), F.array(t))
    found = met.select("seg_id", F.col("layer").alias("name"), F.explode(F.when(cross != 0, crossing).otherwise(F.array(along(ax, ay), along(bx, by)))).alias("t"))
    return found.withColumn("t", F.round("t", DIGITS)).filter("t > 0 AND t < 1").distinct()


def inside_parts(segs: DataFrame, areas: DataFrame, size: float) -> DataFrame:
    """(seg_id, name, lo, hi): parts of segments inside areas, as shares of the way along.

    segs have a unique seg_id and their ends, areas name and polygon (shells and holes of any
    shape; several rows of a name are one area). A segment is cut where it meets a border and
    each part is kept if its middle lies inside, that is every other one where it crosses; parts
    that join are one. Parts along a border count as ``overlay`` says.
    """
    segs = segs.select("seg_id", *NAMES).filter("x0 <> x1 OR y0 <> y1")
    border = _borders(areas)
    cuts = _cuts(segs, border, size)
    met = cuts.select("seg_id", "name").distinct()
    ends = met.select("seg_id", "name", F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("lo"))
    order = Window.partitionBy("seg_id", "name").orderBy("lo")
    parts = cuts.withColumnRenamed("t", "lo").union(ends).withColumn("hi", F.lead("lo").over(order)).filter("hi IS NOT NULL")
    whole = segs.select("seg_id", F.lit(None).cast(parts.schema["name"].dataType).alias("name"), F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))
    mid = (F.col("lo") + F.col("hi")) / 2.0
    at = lambda a, b: F.col(a) + (F.col(b) - F.col(a)) * mid
    points = parts.union(whole).join(segs, "seg_id").select(F.lit(0).alias("grp"), F.struct("seg_id", "name", "lo", "hi").alias("id"), at("x0", "x1").alias("x"), at("y0", "y1").alias("y"))
    found = winding_at(points, border.select(F.lit(0).alias("grp"), "*", F.lit(1).cast("long").alias("n")), size).select("id.*", "layer")
    cut = found.filter("name = layer").select("seg_id", "name", "lo", "hi")
    uncut = found.filter("name IS NULL").select("seg_id", F.col("layer").alias("name"), "lo", "hi").join(met, ["seg_id", "name"], "left_anti")
    return _joined(cut.union(uncut))


def _joined(parts: DataFrame) -> DataFrame:
    """Parts (seg_id, name, lo, hi) that touch or overlap, as one."""
    before = Window.partitionBy("seg_id", "name").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("hi").over(before)
    starts = parts.withColumn("new", F.when(F.col("lo") <= reach, 0).otherwise(1))
    runs = starts.withColumn("run", F.sum("new").over(Window.partitionBy("seg_id", "name").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("seg_id", "name", "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo < hi").drop("run")


def _ends(parts: DataFrame, segs: DataFrame) -> DataFrame:
    at = lambda a, b, t: F.col(a) + (F.col(b) - F.col(a)) * F.col(t)
    met = parts.join(segs.select("seg_id", *NAMES), "seg_id")
    return met.select("seg_id", "name", at("x0", "x1", "lo").alias("x0"), at("y0", "y1", "lo").alias("y0"), at("x0", "x1", "hi").alias("x1"), at("y0", "y1", "hi").alias("y1"))


def clip_segments(segs: DataFrame, areas: DataFrame, size: float) -> DataFrame:
    """(seg_id, name, x0, y0, x1, y1): the parts of segments inside areas; see ``inside_parts``."""
    return _ends(inside_parts(segs, areas, size), segs)


def _between(start: Column, slope: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """The t for which start + t * slope lies from low to high; null bounds where there is none."""
    safe = F.when(slope == 0, F.lit(1.0)).otherwise(slope)
    p, q = (low - start) / safe, (high - start) / safe
    level = (slope == 0) & (start >= low) & (start <= high)
    lo = F.when(slope != 0, F.least(p, q)).when(level, F.lit(-1e18))
    return lo, F.when(slope != 0, F.greatest(p, q)).when(level, F.lit(1e18))


def clip_near(segs: DataFrame, areas: DataFrame, reach: float, size: float) -> DataFrame:
    """(seg_id, name, x0, y0, x1, y1): the parts of segments inside areas or within ``reach`` metres of them.

    A border edge with its reach is a band with round ends, which a segment is in from one
    parameter to another; edges are met in the cells around those they go through.
    """
    own = segs.select("seg_id", *NAMES).filter("x0 <> x1 OR y0 <> y1")
    halo = F.sequence(F.lit(-int(-(-reach // size))), F.lit(int(-(-reach // size))))
    edge = ("ax", "ay", "bx", "by")
    wide = through_cells(_borders(areas), size, edge).withColumn("i", F.explode(halo)).withColumn("j", F.explode(halo))
    wide = wide.select("layer", *edge, (F.col("cx") + F.col("i")).alias("cx"), (F.col("cy") + F.col("j")).alias("cy")).distinct()
    met = through_cells(own, size).join(wide, ["cx", "cy"]).drop("cx", "cy").dropDuplicates(["seg_id", "layer", *edge])
    x0, y0, x1, y1, ax, ay, bx, by = (F.col(c) for c in (*NAMES, *edge))
    dx, dy, ex, ey = x1 - x0, y1 - y0, bx - ax, by - ay
    size2 = ex * ex + ey * ey
    side = F.sqrt(size2) * reach
    lo1, hi1 = _between((x0 - ax) * ex + (y0 - ay) * ey, dx * ex + dy * ey, F.lit(0.0), size2)
    lo2, hi2 = _between(ex * (y0 - ay) - ey * (x0 - ax), ex * dy - ey * dx, -side, side)
    there = lo1.isNotNull() & lo2.isNotNull() & (F.greatest(lo1, lo2) <= F.least(hi1, hi2))
    los, his = [F.when(there, F.greatest(lo1, lo2))], [F.when(there, F.least(hi1, hi2))]
    for cx, cy in ((ax, ay), (bx, by)):
        a, b, c = dx * dx + dy * dy, dx * (x0 - cx) + dy * (y0 - cy), (x0 - cx) * (x0 - cx) + (y0 - cy) * (y0 - cy) - reach * reach
        root = F.when(b * b >= a * c, F.sqrt(F.greatest(b * b - a * c, F.lit(0.0))))
        los.append((-b - root) / a)
        his.append((-b + root) / a)
    lo, hi = F.greatest(F.least(*los), F.lit(0.0)), F.least(F.greatest(*his), F.lit(1.0))
    band = met.select("seg_id", F.col("layer").alias("name"), lo.alias("lo"), hi.alias("hi"), F.least(*los).isNotNull().alias("met")).filter("met AND lo < hi").drop("met")
    return _ends(_joined(inside_parts(own, areas, size).union(band)), own)
