"""Ranking, overlay, rings, clipping against brute force on small grids and random shapes."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from wayweave.operators import clip, overlay, polygonize
from wayweave.operators.ranking import rank_lists

AREAS = "name string, polygon array<array<struct<x:double,y:double>>>"


def ring(*pts):
    return [{"x": float(x), "y": float(y)} for x, y in (*pts, pts[0])]


def box(x0, y0, x1, y1):
    return ring((x0, y0), (x1, y0), (x1, y1), (x0, y1))


def inside(x, y, rings):
    odd = False
    for r in rings:
        for a, b in itertools.pairwise(r):
            if (a["y"] > y) != (b["y"] > y) and x < a["x"] + (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]):
                odd = not odd
    return odd


def area_of(rings):
    """Shell less holes; rings have to be closed and wound the other way round as holes."""
    total = [sum(a["x"] * b["y"] - b["x"] * a["y"] for a, b in itertools.pairwise(r)) / 2 for r in rings]
    assert total[0] > 0 and all(v < 0 for v in total[1:]) and all(r[0] == r[-1] for r in rings)
    return sum(total)


def regions(cells, corners):
    """Connected sets of grid cells, by edges or also by corners."""
    left, out = set(cells), []
    while left:
        todo, seen = [left.pop()], set()
        while todo:
            x, y = todo.pop()
            seen.add((x, y))
            for dx, dy in itertools.product((-1, 0, 1), repeat=2):
                if (corners or not dx or not dy) and (x + dx, y + dy) in left:
                    left.remove((x + dx, y + dy))
                    todo.append((x + dx, y + dy))
        out.append(seen)
    return out


def as_dicts(polygon):
    return [[{"x": p.x, "y": p.y} for p in r] for r in polygon]


def test_ranks(spark):
    rng = random.Random(1)
    rows, want, n = [], {}, 0
    for k in range(30):
        size, is_ring = rng.choice((1, 2, 3, 7, 64, 65, 200)), k % 2 == 0
        ids = list(range(n, n + size))
        n += size
        rng.shuffle(ids)
        rows += [(v, ids[i + 1] if i + 1 < size else (ids[0] if is_ring else None)) for i, v in enumerate(ids)]
        shift = ids.index(min(ids)) if is_ring else 0
        name = min(ids) if is_ring else ids[-1]
        want |= {ids[(i + shift) % size]: (name, i, size, is_ring) for i in range(size)}
    rng.shuffle(rows)
    got = rank_lists(spark.createDataFrame(rows, "item long, next long")).collect()
    assert {r["item"]: (r["list"], r["place"], r["size"], r["ring"]) for r in got} == want


def test_dissolve_of_squares(spark):
    """Adjoining squares of a name become its connected parts, with the holes they leave."""
    rng = random.Random(2)
    cells = {(x, y): rng.choice("aab") for x in range(9) for y in range(9)}
    rows = [(n, [box(x * 10, y * 10, x * 10 + 10, y * 10 + 10)]) for (x, y), n in cells.items()]
    rows += [("a", [box(0, 0, 10, 10)[::-1]]), ("c", [box(3, 3, 7, 7), box(4, 4, 5, 5)]), ("c", [box(4, 4, 5, 5)]), (None, [box(0, 0, 1, 1)]), ("d", None)]
    got = overlay.dissolve(spark.createDataFrame(rows, AREAS), 25.0).collect()
    by = {n: [r for r in got if r.name == n] for n in "abc"}
    assert len(got) == sum(map(len, by.values()))
    assert [(r.area, len(r.polygon)) for r in by["c"]] == [(16.0, 1)]
    grid = set(itertools.product(range(-1, 10), repeat=2))
    for n in "ab":
        own = {c for c, v in cells.items() if v == n} | ({(0, 0)} if n == "a" else set())
        parts, outside = regions(own, False), regions(grid - own, True)
        assert sorted(r.area for r in by[n]) == sorted(100.0 * len(p) for p in parts)
        assert sum(len(r.polygon) - 1 for r in by[n]) == len(outside) - 1
        for r in by[n]:
            rings = as_dicts(r.polygon)
            assert area_of(rings) == r.area
            x, y = next(c for c in own if inside(c[0] * 10 + 5, c[1] * 10 + 5, rings))
            part = next(p for p in parts if (x, y) in p)
            assert {c for c in grid if inside(c[0] * 10 + 5, c[1] * 10 + 5, rings)} == part


def random_shapes(rng, n, names):
    out = []
    for _ in range(n):
        cx, cy, k = rng.uniform(-60, 60), rng.uniform(-60, 60), rng.randint(3, 7)
        turn = [2 * math.pi * (i + rng.random() * 0.8) / k for i in range(k)]
        pts = [(cx + rng.uniform(8, 35) * math.cos(t), cy + rng.uniform(8, 35) * math.sin(t)) for t in turn]
        out.append((rng.choice(names), [ring(*(pts if rng.random() < 0.5 else pts[::-1]))]))
    return out


def test_dissolve_and_difference_of_random_shapes(spark):
    rng = random.Random(3)
    own, taken = random_shapes(rng, 14, "ab"), random_shapes(rng, 8, "t")
    union = overlay.dissolve(spark.createDataFrame(own, AREAS), 30.0).collect()
    less = overlay.difference(spark.createDataFrame(own, AREAS), spark.createDataFrame(taken, AREAS), 30.0).collect()
    parts = {k: [as_dicts(r.polygon) for r in v if r.name == n] for n in "ab" for k, v in ((f"u{n}", union), (f"l{n}", less))}
    near = lambda x, y: any(abs((b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])) < 0.1 * math.dist((a["x"], a["y"]), (b["x"], b["y"])) for _, p in own + taken for a, b in itertools.pairwise(p[0]))
    tried = 0
    for _ in range(1500):
        x, y = rng.uniform(-90, 90), rng.uniform(-90, 90)
        if near(x, y):
            continue
        tried += 1
        gone = any(inside(x, y, p) for _, p in taken)
        for n in "ab":
            here = any(inside(x, y, p) for m, p in own if m == n)
            assert sum(inside(x, y, p) for p in parts[f"u{n}"]) == here
            assert sum(inside(x, y, p) for p in parts[f"l{n}"]) == (here and not gone)
    assert tried > 300
    assert all(abs(area_of(as_dicts(r.polygon)) - r.area) < 1e-6 for r in union + less)


def test_repair_of_crossing_ring(spark):
    rows = [("bow", [ring((0, 0), (10, 10), (10, 0), (0, 10))]), ("twice", [ring((20, 0), (30, 0), (30, 10), (20, 10), (20, 0), (30, 0), (30, 10), (20, 10))])]
    got = overlay.repair(spark.createDataFrame(rows, AREAS), 8.0, "name").collect()
    assert sorted((r.name, r.area) for r in got) == [("bow", 25.0), ("bow", 25.0), ("twice", 100.0)]


def test_difference_leaves_small_parts_out(spark):
    own = [("w", [box(0, 0, 100, 100)]), ("inner", [box(40, 40, 60, 60)]), (None, [box(0, 0, 5, 5)])]
    taken = [("t", [box(10, 10, 90, 90)]), ("t", [box(96, -10, 97, 110)]), ("t", [box(200, 0, 300, 10)]), ("t", None)]
    table = lambda rows: spark.createDataFrame(rows, AREAS)
    got = overlay.difference(table(own), table(taken), 20.0, least_area=300).collect()
    assert sorted((r.name, r.area, len(r.polygon)) for r in got) == [("w", 300.0, 1), ("w", 9600.0 - 80 * 80, 2)]
    border = overlay.overlay(overlay.borders(table(own[:1]), F.col("name"), F.lit("own")), ["own"], lambda w: w != 0, 20.0)
    assert overlay.polygons(border, 20.0, least_area=10000.5).collect() == []


def test_faces_take_islands_off(spark):
    """Nested squares, a bridge, dangles and an island in an island."""
    squares = [(0, 0, 100, 100), (20, 20, 80, 80), (40, 40, 60, 60), (200, 0, 210, 10)]
    segs = []
    for x0, y0, x1, y1 in squares:
        segs += [(x0, y0, x1, y0), (x1, y0, x1, y1), (x1, y1, x0, y1), (x0, y1, x0, y0)]
    segs += [(60, 60, 70, 70), (100, 50, 130, 60), (130, 60, 131, 80), (-5, 50, 10, 50)]
    df = spark.createDataFrame([(i, *map(float, s)) for i, s in enumerate(segs)], "seg_id long, x0 double, y0 double, x1 double, y1 double")
    got = polygonize.face_polygons(df, 30.0).collect()
    assert sorted((r.area, len(r.polygon)) for r in got) == [(100.0, 1), (400.0, 1), (3200.0, 2), (6400.0, 2)]
    assert all(area_of(as_dicts(r.polygon)) == r.area for r in got)
    bridge = spark.createDataFrame([(99, 80.0, 50.0, 100.0, 50.0)], df.schema)
    assert sorted(r.area for r in polygonize.polygonize(df.union(bridge), 30.0).collect()) == [100.0, 400.0, 3200.0, 6400.0]


def test_faces_of_random_lines(spark):
    """Euler: faces of a connected arrangement of long lines in a frame."""
    rng = random.Random(4)
    segs = [(0, 0, 0, 200), (0, 200, 200, 200), (200, 200, 200, 0), (200, 0, 0, 0)]
    segs += [(0, rng.randint(1, 199), 200, rng.randint(1, 199)) for _ in range(6)] + [(rng.randint(1, 199), 0, rng.randint(1, 199), 200) for _ in range(5)]
    df = spark.createDataFrame([(i, *map(float, s)) for i, s in enumerate(segs)], "seg_id long, x0 double, y0 double, x1 double, y1 double")
    noded = polygonize.node_lines(df, 40.0).collect()
    nodes = {n for r in noded for n in (r.u, r.v)}
    got = polygonize.polygonize(df, 40.0).collect()
    assert len(got) == len(noded) - len(nodes) + 1
    assert sum(r.area for r in got) == 40000.0


SEGS = "seg_id long, x0 double, y0 double, x1 double, y1 double"


def brute_parts(seg, rings, reach=0.0, steps=4000):
    """Shares of the way that lie inside or within reach, by sampling."""
    x0, y0, x1, y1 = seg
    hits = []
    for k in range(steps):
        t = (k + 0.5) / steps
        x, y = x0 + (x1 - x0) * t, y0 + (y1 - y0) * t
        here = inside(x, y, rings)
        if not here and reach:
            for r in rings:
                for a, b in itertools.pairwise(r):
                    ex, ey = b["x"] - a["x"], b["y"] - a["y"]
                    s = min(max(((x - a["x"]) * ex + (y - a["y"]) * ey) / (ex * ex + ey * ey), 0), 1)
                    here |= math.dist((x, y), (a["x"] + s * ex, a["y"] + s * ey)) <= reach
        hits.append(here)
    return sum(h and not p for h, p in zip(hits, [False, *hits], strict=False)), sum(hits) / steps


@pytest.mark.parametrize("reach", [0.0, 7.0])
def test_clip_to_concave_areas_with_holes(spark, reach):
    rng = random.Random(5)
    star = [(math.cos(2 * math.pi * i / 14) * (60 if i % 2 else 22), math.sin(2 * math.pi * i / 14) * (60 if i % 2 else 22)) for i in range(14)]
    comb = [(0, 0), (100, 0), (100, 50), (80, 50), (80, 10), (60, 10), (60, 50), (40, 50), (40, 10), (20, 10), (20, 50), (0, 50)]
    rings = {"star": [ring(*star), ring((-6, -6), (-6, 6), (6, 6), (6, -6))], "comb": [ring(*[(x - 50, y - 30) for x, y in comb])]}
    areas = spark.createDataFrame([(n, r) for n, r in rings.items()], AREAS)
    segs = [tuple(rng.uniform(-75, 75) for _ in range(4)) for _ in range(40)] + [(-2.0, -2.0, 2.0, 2.0), (-48.5, -25.3, -44.1, -22.7), (3.0, 3.0, 3.0, 3.0), (900.0, 900.0, 950.0, 900.0)]
    table = spark.createDataFrame(list(enumerate(map(tuple, segs))), "seg_id long, s struct<x0:double,y0:double,x1:double,y1:double>").select("seg_id", "s.*")
    got = (clip.clip_near(table, areas, reach, 25.0) if reach else clip.clip_segments(table, areas, 25.0)).collect()
    many = 0
    for i, seg in enumerate(segs):
        for name, r in rings.items():
            own = [g for g in got if g.seg_id == i and g.name == name]
            whole = math.dist(seg[:2], seg[2:])
            parts, share = brute_parts(seg, r, reach) if whole else (0, 0.0)
            assert len(own) == parts, (seg, name)
            assert sum(math.dist((g.x0, g.y0), (g.x1, g.y1)) for g in own) == pytest.approx(share * whole, abs=whole / 1000 + 1e-9)
            many += len(own) > 2
    assert many


def test_borders_belong_to_one_side(spark):
    """Lines along the left and lower border of an area are in it, along the right and upper one not, and so for holes."""
    areas = spark.createDataFrame([("a", [box(0.25, 0.25, 90.5, 70.5), box(20, 20, 40, 40)])], AREAS)
    segs = [(5, 0.25, 9, 0.25), (0.25, 5, 0.25, 9), (5, 70.5, 9, 70.5), (90.5, 5, 90.5, 9), (22, 20, 30, 20), (20, 22, 20, 30), (22, 40, 30, 40), (40, 22, 40, 30)]
    table = spark.createDataFrame([(i, *map(float, s)) for i, s in enumerate(segs)], SEGS)
    for size in (7.0, 50.0, 1000.0):
        assert sorted(r.seg_id for r in clip.clip_segments(table, areas, size).collect()) == [0, 1, 6, 7]


def test_long_diagonals_list_the_cells_along_them(spark):
    from wayweave.operators.grid import through_cells

    rng = random.Random(6)
    segs = [tuple(rng.uniform(-500, 500) for _ in range(4)) for _ in range(30)] + [(0.0, 0.0, 100.0, 100.0), (5.0, -30.0, 5.0, 30.0), (-30.0, 20.0, 30.0, 20.0)]
    table = spark.createDataFrame(list(enumerate(segs)), "seg_id long, s struct<x0:double,y0:double,x1:double,y1:double>").select("seg_id", "s.*")
    got = {}
    for r in through_cells(table, 20.0).collect():
        got.setdefault(r.seg_id, set()).add((r.cx, r.cy))
    for i, (x0, y0, x1, y1) in enumerate(segs):
        hit = {(math.floor((x0 + (x1 - x0) * k / 5000) / 20), math.floor((y0 + (y1 - y0) * k / 5000) / 20)) for k in range(5001)}
        assert hit <= got[i] and len(got[i]) <= 3 * (abs(x1 - x0) + abs(y1 - y0)) / 20 + 6
