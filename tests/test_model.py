"""Hand-computed values of the cost model, statistics and numeric conventions."""

import pytest
from pyspark.sql import functions as F

from wayweave.functions import cost
from wayweave.functions.numeric import round_scaled
from wayweave.operators import graph, stats

EDGES = [  # length, width, slope, density, barrier, blockage, the four costs
    (10.0, 6.0, 0.0, 0.0, False, 0.0, 10, 10, 10, 10),
    (10.0, 2.0, 5.0, 0.45, False, 0.833, 20, 66.875, 36.66, 83.535),
    (20.0, 1.0, 0.0, 0.9, True, 0.944, 53.75, 730.9375, 91.51, 768.6975),
    (100.0, None, 2.0, 0.3, False, 0.5, 110, 140, 210, 240),
    (10.0, 4.0, 0.0, 0.45, True, 0.667, 10, 10, 23.34, 23.34),
    (10.0, 1.5, 0.0, None, False, 0.0, 21.71875, 83.2421875, 21.71875, 83.2421875),
]


@pytest.mark.parametrize("penalty", [0.0, 1.0])
def test_costs(spark, penalty):
    shape = "i int, length_m double, width_m double, slope_pct double, bld_density double, barrier_cross boolean"
    edges = spark.createDataFrame([(i, *e[:5]) for i, e in enumerate(EDGES)], shape)
    got = cost.add_costs(edges, cost.WEIGHTS | {"bridge_penalty": penalty}).orderBy("i").collect()
    for r, e in zip(got, EDGES, strict=True):
        factor = 1 + penalty if e[4] else 1
        assert r.blockage_risk == e[5]
        assert [r[c] for c in cost.COSTS] == pytest.approx([x * factor for x in e[6:]])


def test_slope_and_elevation(spark):
    rows = [(10.0, 11.0, 10.0, 5.0, 10.5), (10.0, 11.0, 30.0, 2.5, 10.5), (10.0, 10.2, 5.0, 0.0, 10.1), (0.0, 20.0, 10.0, 40.0, 10.0), (None, 5.0, 20.0, 0.0, None), (3.0, 9.0, 100.0, 5.75, 6.0)]
    df = spark.createDataFrame(rows, "h0 double, h1 double, l double, s double, e double")
    for r in df.select("*", cost.slope_pct(F.col("h0"), F.col("h1"), F.col("l")).alias("gs"), cost.elevation(F.col("h0"), F.col("h1")).alias("ge")).collect():
        assert (r.gs, r.ge) == (r.s, r.e)


def test_ward_stats(spark):
    edges = [("A", 100, 3, 0.5, 6, 10), ("A", 300, 5, 0.1, 2, 20), ("A", 100, 8, 0, 9, 30), ("B", 50, 2, 1, 0, None), ("B", 150, 4, 0.2, 5, 4)]
    df = spark.createDataFrame([(w, *map(lambda v: None if v is None else float(v), x)) for w, *x in edges], "ward string, length_m double, width_m double, blockage_risk double, slope_pct double, elev_m double")
    got = {r.ward: [r[c] for c in stats.METRICS] for r in stats.ward_stats(df).collect()}
    assert got["A"] == pytest.approx([0.5, 5, 20, 0.16, 40, 20]) and got["B"] == pytest.approx([0.2, 3, 25, 0.4, 0, 4])


def test_rounding_and_keys(spark):
    df = spark.createDataFrame([(0.285, 0.28), (1.015, 1.01), (2.675, 2.68), (0.125, 0.12)], "x double, y double")
    assert all(r.g == r.y for r in df.select("y", round_scaled(F.col("x"), 2).alias("g")).collect())
    keys = [(0.5, 0.5, 10000011000001), (-0.5, 1.5, 9999991000003), (1234.5, -6789.5, 10024690986421)]
    df = spark.createDataFrame(keys, "x double, y double, k long").withColumn("g", graph.node_key(F.col("x"), F.col("y")))
    for r in df.withColumn("p", graph.key_point(F.col("g"))).collect():
        assert r.g == r.k and (r.p.x, r.p.y) == (r.x, r.y)


TOYS = {
    "T": ([(0, 0, 1, 0, 4), (1, 0, 2, 0, 6), (2, 0, 3, 0, 5), (2, 0, 2, 1, 3), (2, 1, 2, 2, 3)], {((0, 0), (2, 0), 2.0, 5.0), ((2, 0), (2, 2), 2.0, 3.0), ((2, 0), (3, 0), 1.0, 5.0)}),
    "stair": ([(0, 0, 1, 0, 4), (1, 0, 1, 1, 4), (0, 0, 1, 1, 4), (1, 1, 2, 1, 4)], {((0, 0), (2, 1), 3.0, 4.0)}),
    "diagonal": ([(0, 0, 1, 1, 4), (1, 1, 2, 2, 8)], {((0, 0), (2, 2), 2.83, 6.0)}),
    "lollipop": ([(0, 0, 1, 0, 4), (1, 0, 2, 0, 4), (2, 0, 2, 1, 4), (2, 1, 1, 1, 4), (1, 1, 1, 0, 4)], {((0, 0), (1, 0), 1.0, 4.0)}),
    "ring": ([(0, 0, 1, 0, 4), (1, 0, 1, 1, 4), (1, 1, 0, 1, 4), (0, 1, 0, 0, 4)], set()),
}


def test_toy_networks(spark):
    rows = [(w, i, *map(float, s)) for w, (segs, _) in TOYS.items() for i, s in enumerate(segs)]
    segs = spark.createDataFrame(rows, "ward string, seg_id long, x0 double, y0 double, x1 double, y1 double, width_m double")
    edges = graph.drop_diagonals(graph.node_segments(segs))
    found = graph.contract(edges)
    p, q = graph.key_point(F.col("u")), graph.key_point(F.col("v"))
    got = {w: set() for w in TOYS}
    for r in found.select("ward", p.alias("p"), q.alias("q"), "length_m", "width_m").collect():
        got[r.ward].add(((r.p.x, r.p.y), (r.q.x, r.q.y), r.length_m, r.width_m))
    assert got == {w: want for w, (_, want) in TOYS.items()}
    lines = [[(p.x, p.y) for p in r.line] for r in graph.street_lines(edges).collect() if r.ward == "T"]
    assert sorted(lines) == [[(0.0, 0.0), (2.0, 0.0)], [(2.0, 0.0), (2.0, 2.0)], [(2.0, 0.0), (3.0, 0.0)]]
