"""Geometry, projection, raster and polygonize against brute force and invariants."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayweave.functions import crs, geom
from wayweave.operators import graph, grid, polygonize, raster


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first()


def ring(*pts):
    return F.array(*[geom.point(F.lit(float(x)), F.lit(float(y))) for x, y in pts])


def test_measures(spark):
    shell, hole = ring((0, 0), (4, 0), (4, 3), (0, 3), (0, 0)), ring((1, 1), (2, 1), (2, 2), (1, 2), (1, 1))
    r = one(
        spark, area=geom.polygon_area(F.array(shell, hole)), c=geom.centroid(shell), length=geom.line_length(shell), mid=geom.midpoint(ring((0, 0), (2, 0), (2, 2))),
        none=geom.line_length(ring((1, 1))), inside=geom.in_polygon(F.lit(0.5), F.lit(0.5), F.array(shell, hole)), in_hole=geom.in_polygon(F.lit(1.5), F.lit(1.5), F.array(shell, hole)),
    )
    assert (r.area, r.length, r.none, r.inside, r.in_hole) == (11, 14, 0, True, False)
    assert (r.c.x, r.c.y, r.mid.x, r.mid.y) == (2, 1.5, 2, 0)


def test_positions(spark):
    df = spark.createDataFrame([(" 35.1 139.1\n35.2 139.2 35.3",), ("",)], "t string")
    got = [r[0] for r in df.select(geom.parse_positions(F.col("t"))).collect()]
    assert [(p.x, p.y) for p in got[0]] == [(139.1, 35.1), (139.2, 35.2)] and got[1] == []


def test_projection(spark):
    rng = random.Random(5)
    pts = [(crs.LON0, crs.LAT0)] + [(138.5 + 3 * rng.random(), 34.5 + 3 * rng.random()) for _ in range(200)]
    df = spark.createDataFrame(pts, "lon double, lat double").withColumn("p", crs.to_plane(F.col("lon"), F.col("lat")))
    got = df.withColumn("q", crs.to_degrees(F.col("p.x"), F.col("p.y"))).collect()
    assert abs(got[0].p.x) < 1e-6 and abs(got[0].p.y) < 1e-6
    assert all(abs(r.q.lon - r.lon) < 1e-10 and abs(r.q.lat - r.lat) < 1e-10 for r in got)
    # a short step north on the central meridian is the meridian radius times the scale
    a, b = (one(spark, p=crs.to_plane(F.lit(crs.LON0), F.lit(lat))).p for lat in (36.0, 36.001))
    f = 1 / crs.INVERSE_F
    e2 = f * (2 - f)
    m = crs.A * (1 - e2) / (1 - e2 * math.sin(math.radians(36.0005)) ** 2) ** 1.5
    assert b.y - a.y == pytest.approx(m * math.radians(0.001) * crs.K0, rel=1e-9)


def test_nearest_and_joins(spark):
    rng = random.Random(9)
    own = [(i, rng.uniform(-200, 200), rng.uniform(-200, 200)) for i in range(80)]
    goal = [(rng.uniform(-200, 200), rng.uniform(-200, 200)) for _ in range(40)]
    got = grid.nearest_capped(spark.createDataFrame(own, "point_id long, x double, y double"), spark.createDataFrame(goal, "x double, y double"), 50.0).collect()
    at = {i: (x, y) for i, x, y in own}
    for r in got:
        x, y = at[r.point_id]
        assert r.dist == pytest.approx(min(50.0, min(math.hypot(x - a, y - b) for a, b in goal)))


def test_edt_and_thinning():
    rng = np.random.default_rng(1)
    for _ in range(4):
        mask = rng.random((24, 30)) < 0.8
        off = np.argwhere(~mask)
        want = np.array([[0 if not mask[y, x] else min(math.hypot(y - a, x - b) for a, b in off) for x in range(30)] for y in range(24)])
        assert np.allclose(raster.edt(mask), want)
    block = np.zeros((5, 5), bool)
    block[1:4, 1:4] = True
    assert raster.edt(block)[2, 2] == 2 and raster.edt(block)[1, 1] == 1 and raster.edt(block)[0, 0] == 0
    road = np.zeros((40, 60), bool)
    road[15:24, 5:55] = True
    road[5:35, 27:34] = True
    bone = raster.thin(road)
    assert bone.sum() and not (bone & ~road).any()
    assert not (bone[:-1, :-1] & bone[1:, :-1] & bone[:-1, 1:] & bone[1:, 1:]).any()  # one pixel wide
    seen, todo = set(), [tuple(np.argwhere(bone)[0])]
    while todo:
        y, x = todo.pop()
        if (y, x) in seen or not bone[y, x]:
            continue
        seen.add((y, x))
        todo += [(y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    assert len(seen) == bone.sum()  # connected


def test_rasterise(spark):
    tri = [(0.2, 0.3), (9.7, 1.1), (4.4, 8.8), (0.2, 0.3)]
    df = spark.range(1).select(F.lit(7).alias("poly_id"), F.array(ring(*tri)).alias("polygon"))
    got = {(r.px, r.py) for r in raster.rasterise(df).collect()}

    def inside(x, y):
        odd = False
        for (ax, ay), (bx, by) in zip(tri, tri[1:], strict=False):
            if (ay > y) != (by > y) and x < ax + (bx - ax) * (y - ay) / (by - ay):
                odd = not odd
        return odd

    assert got == {(i, j) for i in range(-1, 12) for j in range(-1, 12) if inside(i + 0.5, j + 0.5)}


def test_mask_to_centrelines(spark):
    edge = lambda y: (0.0, y, 60.0, y)
    edges = spark.createDataFrame([edge(20.0), edge(28.0)], "x0 double, y0 double, x1 double, y1 double")
    square = lambda i, x0, y0, x1, y1: spark.range(1).select(F.lit(i).alias("poly_id"), F.array(ring((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))).alias("polygon"))
    blocks = square(1, -40, -40, 100, 20).unionAll(square(2, -40, 28, 100, 90))
    water = square(3, 25, 0, 35, 60)
    mask = raster.road_mask(edges, blocks, water).filter("px BETWEEN 0 AND 59")
    wet = {(r.px, r.py) for r in mask.filter("px BETWEEN 26 AND 33").collect()}
    assert wet  # the bridge stays: all of the street is within 6 m of its edges
    tiles = raster.into_tiles(mask, side=100.0, pad=10.0)
    lines = raster.centrelines(raster.skeleton_pixels(tiles, 120), side=100.0, pad=10.0).collect()
    assert len(lines) > 40
    assert all(23 <= r.y0 <= 25 for r in lines if 8 < r.x0 < 50)
    assert 7 <= np.median([r.width_m for r in lines]) <= 9


def test_pixels_beside_a_long_diagonal(spark):
    segs = [(3.3, -7.1, 260.4, 190.2), (10.0, 5.0, 10.0, 5.0), (-20.0, 40.0, 60.0, 40.0)]
    got = {(r.px, r.py) for r in raster.near_pixels(spark.createDataFrame(segs, "x0 double, y0 double, x1 double, y1 double"), 4.0).collect()}

    def gap(x, y, s):
        dx, dy = s[2] - s[0], s[3] - s[1]
        t = min(max(((x - s[0]) * dx + (y - s[1]) * dy) / (dx * dx + dy * dy), 0), 1) if dx or dy else 0
        return math.hypot(x - s[0] - t * dx, y - s[1] - t * dy)

    assert got == {(i, j) for i in range(-30, 270) for j in range(-20, 200) if min(gap(i + 0.5, j + 0.5, s) for s in segs) <= 4.0}


def test_two_point_lines_only(spark):
    line = "seg_id long, line array<struct<x:double,y:double>>"
    two = [{"x": 0.0, "y": 1.0}, {"x": 2.0, "y": 3.0}]
    r = graph.two_point_segments(spark.createDataFrame([(1, two)], line)).first()
    assert (r.x0, r.y0, r.x1, r.y1) == (0.0, 1.0, 2.0, 3.0)
    for bad in (two[:1], two + two[:1], None):
        with pytest.raises(Exception, match="two points"):
            graph.two_point_segments(spark.createDataFrame([(1, bad)], line)).collect()


def test_polygonize(spark):
    segs = [(0, 0, 2, 0), (2, 0, 2, 1), (2, 1, 0, 1), (0, 1, 0, 0), (1, -1, 1, 2), (2, 1, 3, 2)]
    df = spark.createDataFrame([(i, *map(float, s)) for i, s in enumerate(segs)], "seg_id long, x0 double, y0 double, x1 double, y1 double")
    assert sorted(r.area for r in polygonize.polygonize(df, 5.0).collect()) == [1.0, 1.0]
    noded = polygonize.node_lines(df, 5.0)
    found = polygonize.faces(noded)
    assert found.select("face").distinct().count() == 2


def test_simplify():
    line = np.array([(0, 0), (1, 0.1), (2, -0.1), (3, 5), (4, 6), (5, 7), (6, 8.1), (7, 9)], float)
    kept = graph.simplify(line, 0.5)
    assert kept.tolist() == [[0, 0], [2, -0.1], [3, 5], [7, 9]]
    assert graph.simplify(line[:2], 9).tolist() == line[:2].tolist()


def test_elevation_priority(spark):
    dem = [("m1", "A", 0, 0, 5.0), ("m1", "B", 0, 0, 9.0), ("m1", "B", 0, 1, 7.0), ("m1", "A", 0, 1, None), ("m2", "A", 1, 1, 3.0)]
    meta = [("m1", 35.0, 139.0, 1.0, 1.0, 2, 2), ("m2", 35.0, 139.0, 1.0, 1.0, 2, 2)]
    pts = [(1, 35.9, 139.1), (2, 35.9, 139.9), (3, 35.1, 139.9), (4, 35.1, 139.1), (5, 40.0, 139.0)]
    got = raster.sample_elevation(
        spark.createDataFrame(pts, "point_id long, lat double, lon double"),
        spark.createDataFrame(meta, "mesh string, lat0 double, lon0 double, lat_span double, lon_span double, rows int, cols int"),
        spark.createDataFrame(dem, "mesh string, kind string, row int, col int, elev double"), ["A", "B", "C"],
    )
    assert {r.point_id: r.elev for r in got.collect()} == {1: 5.0, 2: 7.0, 3: 3.0, 4: None, 5: None}


def test_dijkstra_and_route_shares(spark):
    from wayweave.operators import routes, stats

    edges = [("w", 0, 1, 2, 1.0, 3.0, 0.5), ("w", 1, 2, 3, 1.0, 5.0, 0.0), ("w", 2, 1, 3, 5.0, 9.0, 0.0), ("w", 3, 7, 8, 1.0, 9.0, 0.0)]
    e = spark.createDataFrame(edges, "ward string, edge_id long, u long, v long, length_m double, width_m double, blockage_risk double")
    trips = spark.createDataFrame([("w", 0, 1, 3), ("w", 1, 1, 8), ("w", 2, 2, 2)], "ward string, trip_id long, origin long, goal long")
    paths = routes.shortest_paths(e, trips, "length_m")
    assert {(r.trip_id, r.cost, tuple(r.path)) for r in paths.collect()} == {(0, 2.0, (0, 1)), (2, 0.0, ())}
    r = stats.route_shares(paths, e).first()
    assert (r.narrow_pct, r.blockage) == (50.0, 0.25)
