"""Geometry as columns: a line is array<struct<x,y>>, a polygon array of rings, the shell first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LINE = "array<struct<x:double,y:double>>"
POLYGON = "array<array<struct<x:double,y:double>>>"


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Closed ring of a rectangle, as a polygon."""
    return F.array(F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0)))


def first_point(line: Column) -> Column:
    return F.try_element_at(line, F.lit(1))


def last_point(line: Column) -> Column:
    return F.try_element_at(line, F.lit(-1))


def _pairs(line: Column, f) -> Column:
    """f(a, b) of each pair of consecutive points; empty for fewer than two."""
    n = F.size(line)
    return F.when(
        n >= 2,
        F.zip_with(F.slice(line, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(line, F.lit(2), F.greatest(n - 1, F.lit(0))), f),
    ).otherwise(F.array().cast("array<double>"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def distance(a: Column, b: Column) -> Column:
    return F.sqrt((a["x"] - b["x"]) * (a["x"] - b["x"]) + (a["y"] - b["y"]) * (a["y"] - b["y"]))


def line_length(line: Column) -> Column:
    return _sum(_pairs(line, distance))


def _cross(a: Column, b: Column) -> Column:
    return a["x"] * b["y"] - b["x"] * a["y"]


def signed_area(ring: Column) -> Column:
    """Shoelace area of a closed ring; positive when counter-clockwise."""
    return _sum(_pairs(ring, _cross)) / 2.0


def polygon_area(polygon: Column) -> Column:
    """Area of the shell without the holes."""
    shell = F.abs(signed_area(polygon[0]))
    holes = F.aggregate(F.slice(polygon, F.lit(2), F.size(polygon)), F.lit(0.0), lambda a, r: a + F.abs(signed_area(r)))
    return F.when(F.size(polygon) > 0, shell - holes)


def centroid(ring: Column) -> Column:
    """Area-weighted centroid of a closed ring; the first point where the area is 0."""
    area = signed_area(ring)
    x = _sum(_pairs(ring, lambda a, b: (a["x"] + b["x"]) * _cross(a, b)))
    y = _sum(_pairs(ring, lambda a, b: (a["y"] + b["y"]) * _cross(a, b)))
    safe = F.when(area == 0, F.lit(1.0)).otherwise(area * 6.0)
    start = first_point(ring)
    return F.when(area == 0, start).otherwise(point(x / safe, y / safe))


def inner_point(ring: Column, gap: float = 1e-3) -> Column:
    """A point inside a counter-clockwise ring, just left of the middle of its first side."""
    a, b = ring[0], ring[1]
    dx, dy, size = b["x"] - a["x"], b["y"] - a["y"], distance(a, b)
    return point((a["x"] + b["x"]) / 2.0 - dy / size * gap, (a["y"] + b["y"]) / 2.0 + dx / size * gap)


def point_along(line: Column, share: float) -> Column:
    """Point at a share of the line's length; null for fewer than two points."""
    whole = line_length(line)
    goal = whole * share
    start = F.struct(F.lit(0.0).alias("done"), first_point(line).alias("at"), F.lit(None).cast("struct<x:double,y:double>").alias("hit"))

    def step(acc: Column, p: Column) -> Column:
        d = distance(acc["at"], p)
        t = F.when(d > 0, (goal - acc["done"]) / F.when(d > 0, d).otherwise(1.0)).otherwise(0.0)
        here = point(acc["at"]["x"] + (p["x"] - acc["at"]["x"]) * t, acc["at"]["y"] + (p["y"] - acc["at"]["y"]) * t)
        hit = F.when(acc["hit"].isNull() & (acc["done"] + d >= goal), here).otherwise(acc["hit"])
        return F.struct((acc["done"] + d).alias("done"), p.alias("at"), hit.alias("hit"))

    run = F.aggregate(F.slice(line, F.lit(2), F.greatest(F.size(line) - 1, F.lit(0))), start, step)
    return F.when(F.size(line) >= 2, F.coalesce(run["hit"], last_point(line)))


def midpoint(line: Column) -> Column:
    return point_along(line, 0.5)


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Crossing-number test; a point on the lower or left border is inside, on the others not."""

    def crosses(a: Column, b: Column) -> Column:
        spans = (a["y"] > y) != (b["y"] > y)
        rise = F.when(a["y"] == b["y"], F.lit(1.0)).otherwise(b["y"] - a["y"])
        return F.when(spans & (x < a["x"] + (b["x"] - a["x"]) * (y - a["y"]) / rise), 1.0).otherwise(0.0)

    return _sum(_pairs(ring, crosses)) % 2 == 1


def in_polygon(x: Column, y: Column, polygon: Column) -> Column:
    """Even-odd over all rings, so holes are outside."""
    return F.aggregate(polygon, F.lit(False), lambda a, r: a != in_ring(x, y, r))


def orient(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    """Sign of the turn a, b, c."""
    return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def segments_meet(p: list[Column], q: list[Column]) -> Column:
    """Whether two segments, each (x0, y0, x1, y1), share a point."""
    a, b, c, d = (p[0], p[1]), (p[2], p[3]), (q[0], q[1]), (q[2], q[3])
    o1, o2, o3, o4 = orient(*a, *b, *c), orient(*a, *b, *d), orient(*c, *d, *a), orient(*c, *d, *b)

    def within(u, v, w) -> Column:
        return (F.least(u[0], v[0]) <= w[0]) & (w[0] <= F.greatest(u[0], v[0])) & (F.least(u[1], v[1]) <= w[1]) & (w[1] <= F.greatest(u[1], v[1]))

    touch = ((o1 == 0) & within(a, b, c)) | ((o2 == 0) & within(a, b, d)) | ((o3 == 0) & within(c, d, a)) | ((o4 == 0) & within(c, d, b))
    return ((o1 != o2) & (o3 != o4)) | touch


def to_segment(px: Column, py: Column, s: list[Column]) -> Column:
    """Distance from a point to a segment (x0, y0, x1, y1)."""
    dx, dy = s[2] - s[0], s[3] - s[1]
    size = dx * dx + dy * dy
    t = F.when(size > 0, ((px - s[0]) * dx + (py - s[1]) * dy) / F.when(size > 0, size).otherwise(1.0)).otherwise(0.0)
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    ex, ey = px - (s[0] + t * dx), py - (s[1] + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def geometry_of(points: Column, surface: Column) -> Column:
    """Kind of a parsed feature: Polygon, LineString, Point, or null to drop it."""
    n = F.size(points)
    return F.when(surface & (n >= 4), "Polygon").when(n >= 2, "LineString").when(n == 1, "Point")


def parse_positions(text: Column) -> Column:
    """``lat lon lat lon ...`` to points with x = lon and y = lat; a trailing odd number is dropped."""
    v = F.filter(F.split(F.trim(text), r"\s+"), lambda s: s != "")
    n = F.floor(F.size(v) / 2).cast("int")
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: point(v[i * 2 + 1].try_cast("double"), v[i * 2].try_cast("double")))
