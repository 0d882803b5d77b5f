"""Cases of the findings of round 3."""

import duckdb
import pytest
from pyspark.sql import functions as F

from wayweave.queries import ORACLES, QUERIES


def against_sql(spark, root, name, **tables):
    """Rows of a query and of its SQL over tables given as SELECTs."""
    con = duckdb.connect()
    for k, select in tables.items():
        con.execute(f"copy ({select}) to '{root}/{k}.parquet' (format parquet)")
        con.execute(f"create view {k} as select * from read_parquet('{root}/{k}.parquet')")
    df = QUERIES[name](spark, str(root))
    cur = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLES[name]})")
    return sorted(map(tuple, df.collect()), key=repr), sorted(cur.fetchall(), key=repr)


EVENTS = "select i::bigint as event_id, (i // 10)::bigint as user_id, 'click' as event_type, {value}::double as value, timestamp '2024-01-01' + interval (i % 40) hour as ts from range({n}) t(i)"


def test_f2_points_beyond_the_first_mesh_have_elevations(spark, tmp_path):
    got, want = against_sql(spark, tmp_path, "dem_priority_sample", events=EVENTS.format(value="(i * 37 % 1200)", n=600))
    assert got == want and any(e is not None and i * 37 % 1200 >= 500 for i, e in got)


def test_f1_rounds_do_not_follow_the_cells_on_a_path(spark):
    from wayweave.operators import routes

    edges = spark.range(160).select(F.lit("w").alias("ward"), F.col("id").alias("edge_id"), F.col("id").alias("u"), (F.col("id") + 1).alias("v"), F.lit(1.0).alias("length_m"))
    trips = spark.createDataFrame([("w", 0, 158, 2)], "ward string, trip_id long, origin long, goal long")
    (got,) = routes.shortest_paths(edges, trips, "length_m", lambda node: F.floor(node / 4).cast("string"), rounds=12).collect()
    assert got.cost == 156.0 and got.path == list(range(157, 1, -1))


def test_f6_f13_leaves_take_no_part_in_the_rounds(spark):
    import random

    from wayweave.operators.components import component_sizes, connected_components, peeled

    rng = random.Random(4)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)] + [(1000, 1000), (2001, 2000), (2000, 2001), (3005, 3001), (3001, 3002), (3001, 3001), (None, 5)]
    edges = spark.createDataFrame(pairs, "u long, v long")
    root = {n: n for p in pairs if None not in p for n in p}
    for _ in root:
        for u, v in pairs:
            if u is not None:
                root[u] = root[v] = min(root[u], root[v])
    assert {tuple(r) for r in connected_components(edges).collect()} == set(root.items())
    want = {c: sum(x == c for x in root.values()) for c in set(root.values())}
    assert {tuple(r) for r in component_sizes(edges).collect()} == set(want.items())
    hubs, leaves = peeled(spark.range(50).selectExpr("id + 100 as u", "id % 3 as v"))
    assert (hubs.count(), leaves.count()) == (3, 50)


def test_f7_items_that_have_ended_are_not_written_again(spark, monkeypatch):
    from wayweave.operators import ranking

    rows = []
    plain = ranking.Workspace.save_and_tell

    def counting(self, df, name, **what):
        saved, told = plain(self, df, name, **what)
        rows.append(saved.count())
        return saved, told

    monkeypatch.setattr(ranking.Workspace, "save_and_tell", counting)
    pairs = [((k, i), (k, i + 1) if i < (99 if k == 0 else 1) else None) for k in range(200) for i in range(100 if k == 0 else 2)]
    got = ranking.rank_lists(spark.createDataFrame(pairs, "item struct<k:long,i:long>, next struct<k:long,i:long>")).collect()
    assert all((r["item"].i, r["list"].k) == (r["place"], r["item"].k) for r in got) and len(got) == 498
    assert max(rows[1:]) < 110


def test_f14_distances_go_down_columns_in_bands(spark):
    from wayweave.operators import raster

    off = {(263, 1), (270, 4), (2, 0)}
    mask = spark.range(300).select(F.lit(0).alias("tile"), F.col("id").alias("iy"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(5).cast("long"))).alias("ix"))
    mask = mask.withColumn("on", ~F.struct("iy", "ix").isin([F.struct(F.lit(y).cast("long").alias("iy"), F.lit(x).cast("long").alias("ix")) for y, x in sorted(off)]))
    found = raster.distance_rows(mask, 3)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    d2 = {(y, x): min((y - a) ** 2 + (x - b) ** 2 for a, b in off) for y in range(300) for x in range(6) if (y, x) not in off}
    assert {(r.iy, r.ix): round(r.dist**2) for r in found.collect()} == {k: v for k, v in d2.items() if v <= 9}


def test_f4_f5_small_cells_go_to_python_in_packs(spark, monkeypatch):
    from wayweave.operators import routes

    taken = spark.sparkContext.accumulator(0)

    def counted(f):
        def run(one, other):
            taken.add(1)
            return f(one, other)

        return run

    for name in ("_shrink", "_open"):
        monkeypatch.setattr(routes, name, counted(getattr(routes, name)))
    wards = spark.range(40).select(F.concat(F.lit("w"), "id").alias("ward"), F.explode(F.expr("sequence(0L, 7L)")).alias("u"))
    edges = wards.select("ward", F.col("u").alias("edge_id"), "u", (F.col("u") + 1).alias("v"), F.lit(2.0).alias("length_m"))
    trips = edges.select("ward").distinct().select("ward", F.lit(3).alias("trip_id"), F.lit(8).alias("origin"), F.lit(1).alias("goal"))
    got = routes.shortest_paths(edges, trips, "length_m", lambda node: F.floor(node / 4).cast("string")).collect()
    assert len(got) == 40 and all(r.cost == 14.0 and r.path == list(range(7, 0, -1)) for r in got)
    assert 0 < taken.value < 40  # before, a call for each of 40 wards' cells on every level


def test_f12_pixels_go_through_shuffles_as_words(spark):
    import contextlib
    import io

    from wayweave.operators import raster

    rows = [(0.0, 0.5, 700.0, 0.5), (-130.3, 4.0, -61.0, 9.0), (3.0, 3.0, 3.0, 3.0)]
    segs = spark.createDataFrame(rows, "x0 double, y0 double, x1 double, y1 double")

    def near(px, py, reach):
        x, y = px + 0.5, py + 0.5
        for x0, y0, x1, y1 in rows:
            size = (x1 - x0) ** 2 + (y1 - y0) ** 2
            t = min(max(((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / size, 0.0), 1.0) if size else 0.0
            if (x - x0 - t * (x1 - x0)) ** 2 + (y - y0 - t * (y1 - y0)) ** 2 <= reach * reach:
                return True
        return False

    every = [(px, py) for px in range(-180, 760) for py in range(-30, 40)]
    box = lambda a, b, c, d: f"array(array({', '.join(f'named_struct({chr(39)}x{chr(39)}, {x}D, {chr(39)}y{chr(39)}, {y}D)' for x, y in ((a, b), (c, b), (c, d), (a, d), (a, b)))}))"
    polygons = lambda *p: spark.sql(f"select 1 as poly_id, {box(*p)} as polygon")
    mask = raster.road_mask(segs, polygons(-70, 2, 130, 12), polygons(190, -20, 330, 20))
    want = {(x, y) for x, y in every if near(x, y, 25.0) and not (-70 <= x < 130 and 2 <= y < 12) and (not (190 <= x < 330 and -20 <= y < 20) or near(x, y, 6.0))}
    got = [(r.px, r.py) for r in mask.collect()]
    assert len(got) == len(want) and set(got) == want
    told = io.StringIO()
    with contextlib.redirect_stdout(told):
        mask.explain()
    assert not any("Exchange" in line and "px#" in line for line in told.getvalue().splitlines())


def test_f17_a_feature_is_written_and_read_once(spark, tmp_path):
    tables = {
        "nation": "select 1::int as n_nationkey, 'A' as n_name, 0::int as n_regionkey",
        "supplier": "select 1::bigint as s_suppkey, 1::int as s_nationkey, 1.0::double as s_acctbal",
        "part": "select i::bigint as p_partkey, i::int as p_size from range(1, 40) t(i)",
        "lineitem": "select i::bigint as l_orderkey, (i % 39 + 1)::bigint as l_partkey, 1::bigint as l_suppkey, (i % 50 + 1)::double as l_quantity, (i * 731 % 90000)::double as l_extendedprice, (i % 11) / 100.0::double as l_discount, (i % 9) / 100.0::double as l_tax, 'R' as l_returnflag from range(300) t(i)",
    }
    got, want = against_sql(spark, tmp_path, "geojson_features", **tables)
    assert got == want
    plan = QUERIES["geojson_features"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("StructsToJsonEvaluator") == 1


def test_f8_f15_f16_rings_are_ranked_by_numbers_of_their_edges(spark, monkeypatch):
    from wayweave.operators import overlay

    kinds, plain = [], overlay.rank_lists

    def seen(follow, *rest):
        kinds.append({k: t for k, t in follow.dtypes})
        return plain(follow, *rest)

    monkeypatch.setattr(overlay, "rank_lists", seen)
    sides = [((0, 0), (4, 0)), ((4, 0), (4, 4)), ((4, 4), (0, 4)), ((0, 4), (0, 0)), ((4, 4), (6, 4)), ((6, 4), (6, 6)), ((6, 6), (4, 4))]
    border = spark.createDataFrame([("g", a, b) for a, b in reversed(sides)], "grp string, a struct<x:long,y:long>, b struct<x:long,y:long>")
    got = sorted((tuple(r.ring.a), r.place, tuple(r.a)) for r in overlay.rings(border).collect())
    assert got == [((0, 0), 0, (0, 0)), ((0, 0), 1, (4, 0)), ((0, 0), 2, (4, 4)), ((0, 0), 3, (0, 4)), ((4, 4), 0, (4, 4)), ((4, 4), 1, (6, 4)), ((4, 4), 2, (6, 6))]
    assert kinds == [{"item": "bigint", "next": "bigint"}]  # before, structs of a group and two points
