"""Queries over the standard tables, each with its DuckDB SQL where SQL can express it.

The tables hold no geometry, so streets, points, pixels and grids are proxies computed from
their columns (``roads``, ``lattice``, ...); they exercise the operators, not real streets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayweave.functions import cost, crs, geom
from wayweave.functions.numeric import clip, nan_to_null, round_scaled
from wayweave.operators import graph, grid, overlay, polygonize, raster, routes, stats
from wayweave.operators.clip import clip_near, clip_segments
from wayweave.operators.components import connected_components
from wayweave.plans import export, stages
from wayweave.sources import archives, layers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r(x: str, digits: int) -> str:
    """SQL of round_scaled."""
    return f"(round_even(({x}) * 1e{digits}, 0) / 1e{digits})"


# ---------------------------------------------------------------- proxies


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streets: lineitem with a ward from the supplier's nation and an elevation from the part."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    wards = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("ward"))
    return (
        line.join(wards, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part.select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "ward",
            F.col("l_quantity").alias("length_m"),
            F.when(F.col("p_size") % 11 != 0, 1.0 + F.col("l_extendedprice") / 7500.0).alias("width_m"),
            (F.col("l_tax") * 100.0).alias("slope_pct"),
            F.when(F.col("p_size") % 13 != 0, F.col("l_discount") * 9.0).alias("bld_density"),
            (F.col("l_returnflag") == "R").alias("barrier_cross"),
            F.when(F.col("p_size") % 10 != 0, F.col("p_size").cast("double")).alias("elev_m"),
            F.col("p_size").cast("double").alias("size"),
        )
    )


ROADS = """roads AS (SELECT n_name AS ward, l_quantity AS length_m,
  CASE WHEN p_size % 11 <> 0 THEN 1.0 + l_extendedprice / 7500.0 END AS width_m, l_tax * 100.0 AS slope_pct,
  CASE WHEN p_size % 13 <> 0 THEN l_discount * 9.0 END AS bld_density, l_returnflag = 'R' AS barrier_cross,
  CASE WHEN p_size % 10 <> 0 THEN p_size::DOUBLE END AS elev_m, p_size::DOUBLE AS size
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)"""


def _narrow(w: str = "w") -> str:
    return f"3.0 * power(least(greatest((4.0 - {w}) / 4.0, 0.0), 1.0), 2)"


COSTED = f"""{ROADS}, filled AS (SELECT *, coalesce(width_m, 4.0) AS w,
    12.0 * least(greatest(coalesce(bld_density, 0.0) / 0.45, 0.0), 1.5) AS debris FROM roads),
  risky AS (SELECT *, {r("least(greatest(CASE WHEN debris > 0 THEN (debris - w) / debris ELSE 0.0 END, 0.0), 1.0)", 3)} AS blockage_risk,
    {_narrow()} AS narrow, 2.5 * {_narrow()} + CASE WHEN w < 1.5 THEN 10.0 ELSE 0.0 END AS narrow_wc FROM filled),
  costed AS (SELECT *, length_m * (1 + narrow + 0.5 * slope_pct / 10.0) AS cost_general,
    length_m * (1 + 2.5 * narrow_wc + 2.0 * slope_pct / 10.0) AS cost_wheelchair,
    length_m * (1 + narrow + 0.5 * slope_pct / 10.0 + 2.0 * blockage_risk) AS cost_quake,
    length_m * (1 + 2.5 * narrow_wc + 2.0 * slope_pct / 10.0 + 2.0 * blockage_risk) AS cost_quake_wc FROM risky)"""


def costed(spark: SparkSession, sf_dir: str, **weights: float) -> DataFrame:
    return cost.add_costs(roads(spark, sf_dir), cost.WEIGHTS | weights)


STATS = f"""{COSTED}, stats AS (SELECT ward, sum(length_m) / 1000.0 AS length_km, median(width_m) AS width_med,
    100.0 * coalesce(sum(CASE WHEN width_m < 4 THEN length_m END), 0) / sum(length_m) AS narrow_pct,
    sum(blockage_risk * length_m) / sum(length_m) AS blockage,
    100.0 * coalesce(sum(CASE WHEN slope_pct > 5 THEN length_m END), 0) / sum(length_m) AS slope5, median(elev_m) AS elev
  FROM costed GROUP BY ward)"""
STATS_COLUMNS = ", ".join(f"{r(c, 4)} AS {c}" for c in stats.METRICS)


@query(f"WITH {STATS} SELECT ward, {STATS_COLUMNS} FROM stats")
def ward_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.ward_stats(costed(spark, sf_dir))
    return found.select("ward", *[round_scaled(F.col(c), 4).alias(c) for c in stats.METRICS])


@query(f"WITH {STATS} SELECT ward, {', '.join(f'{r(c, 2)} AS {c}' for c in stats.METRICS)} FROM stats")
def ward_summary_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.ward_summary(stats.ward_stats(costed(spark, sf_dir)))


@query(
    f"WITH {STATS} SELECT * FROM (SELECT ward, {r('blockage', 4)} AS value, 'top' AS which FROM stats ORDER BY blockage DESC, ward LIMIT 3)"
    f" UNION ALL SELECT * FROM (SELECT ward, {r('blockage', 4)}, 'bottom' FROM stats ORDER BY blockage, ward LIMIT 1)"
)
def top3_bottom1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.top_and_bottom(stats.ward_stats(costed(spark, sf_dir)), "blockage")
    return found.withColumn("value", round_scaled(F.col("value"), 4))


def _cost_query(name: str, penalty: float = 0.0, key: str | None = None) -> None:
    factor = f" * (CASE WHEN barrier_cross THEN {1 + penalty} ELSE 1.0 END)" if penalty else ""
    sql = f"WITH {COSTED} SELECT ward, length_m, {r('width_m', 4)} AS width_m, {r(name + factor, 4)} AS {name} FROM costed"

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = costed(spark, sf_dir, bridge_penalty=penalty)
        return found.select("ward", "length_m", round_scaled(F.col("width_m"), 4).alias("width_m"), round_scaled(F.col(name), 4).alias(name))

    QUERIES[key or name], ORACLES[key or name] = run, sql


for _name in cost.COSTS:
    _cost_query(_name)
_cost_query("cost_quake", 1.0, "bridge_penalty")


@query(f"WITH {COSTED} SELECT ward, {r('narrow', 6)} AS narrow, {r('narrow_wc', 6)} AS narrow_wc FROM costed")
def narrow_penalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.col("width_m")
    return roads(spark, sf_dir).select(
        "ward", round_scaled(cost.lack_of_width(w), 6).alias("narrow"), round_scaled(cost.lack_of_width(w, cost.ON_WHEELS), 6).alias("narrow_wc")
    )


@query(f"WITH {COSTED} SELECT ward, length_m, blockage_risk FROM costed")
def blockage_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return costed(spark, sf_dir).select("ward", "length_m", "blockage_risk")


@query(
    f"""WITH {ROADS} SELECT ward, length_m,
      CASE WHEN elev_m IS NULL THEN 0.0 ELSE {r("least(greatest(greatest(abs(elev_m + slope_pct - size * 0.9) - 0.25, 0.0) / greatest(length_m, 15.0) * 100.0, 0.0), 40.0)", 2)} END AS slope,
      {r("(size * 0.9 + elev_m + slope_pct) / 2.0", 1)} AS elev FROM roads"""
)
def slope_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    h0, h1 = F.col("size") * 0.9, F.col("elev_m") + F.col("slope_pct")
    return roads(spark, sf_dir).select("ward", "length_m", cost.slope_pct(h0, h1, F.col("length_m")).alias("slope"), cost.elevation(h0, h1).alias("elev"))


def _pct(c: str) -> str:
    return r(f"avg(CASE WHEN {c} THEN 1.0 ELSE 0.0 END) * 100.0", 1)


@query(
    f"""WITH {ROADS} SELECT ward, count(*) AS segments, {r("median(width_m)", 1)} AS width_med, {_pct("width_m < 4")} AS lt4,
    {_pct("width_m >= 4 AND width_m < 6")} AS w4_6, {_pct("width_m >= 6 AND width_m < 12")} AS w6_12, {_pct("width_m >= 12")} AS ge12
    FROM roads WHERE width_m IS NOT NULL GROUP BY ward"""
)
def width_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.width_bins(roads(spark, sf_dir))


@query(
    f"""WITH {ROADS} SELECT ward, {r("median(elev_m)", 1)} AS elev_med, {_pct("slope_pct > 5")} AS over5, {_pct("slope_pct > 8")} AS over8,
    {r("quantile_cont(slope_pct, 0.95)", 1)} AS slope_p95 FROM roads GROUP BY ward"""
)
def slope_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.slope_report(roads(spark, sf_dir))


@query(
    f"""WITH {ROADS} SELECT ward, {r("avg(CASE WHEN elev_m IS NOT NULL THEN 1.0 ELSE 0.0 END) * 100.0", 1)} AS coverage_pct,
    min(elev_m) AS least, max(elev_m) AS largest FROM roads GROUP BY ward"""
)
def elevation_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.coverage(roads(spark, sf_dir), "elev_m")


@query(
    f"""WITH {ROADS} SELECT ward, {r("sum(length_m * 100.0) / 1e6", 4)} AS measured_km2, {r("count(*) * 0.0025", 4)} AS nominal_km2,
    {r("100.0 * (sum(length_m * 100.0) / 1e6) / (count(*) * 0.0025)", 1)} AS ratio_pct FROM roads GROUP BY ward"""
)
def area_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = roads(spark, sf_dir)
    measured = each.groupBy("ward").agg((F.sum(F.col("length_m") * 100.0) / 1e6).alias("measured_km2"))
    nominal = each.groupBy("ward").agg((F.count("*") * 0.0025).alias("nominal_km2"))
    found = stats.area_ratio(measured, nominal)
    return found.withColumns({c: round_scaled(F.col(c), 4) for c in ("measured_km2", "nominal_km2")})


@query(
    f"""WITH {STATS} SELECT ward, '<tr><td><a href="map_' || ward || '.html">' || ward || '</a></td><td>' || format('{{:,.0f}}', length_km)
    || '</td><td>' || printf('%.1f', width_med) || '</td><td>' || printf('%.1f', narrow_pct) || '</td><td>' || printf('%.2f', blockage)
    || '</td><td>' || printf('%.1f', slope5) || '</td><td>' || coalesce(printf('%.1f', elev), '') || '</td></tr>' AS row FROM stats"""
)
def html_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.index_rows(stats.ward_stats(costed(spark, sf_dir)))


# ---------------------------------------------------------------- points and cells


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as places in a plane of about 4,900 by 3,000 metres."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("point_id"), (F.col("value") * 10.0).alias("x"), (F.col("user_id") * 20.0 + F.col("value") / 7.0).alias("y"),
        F.col("value").alias("area"), "event_type",
    )


POINTS = "points AS (SELECT event_id AS point_id, value * 10.0 AS x, user_id * 20.0 + value / 7.0 AS y, value AS area, event_type FROM events)"


@query(
    f"""WITH {POINTS} SELECT floor(x / 250)::BIGINT AS mesh_x, floor(y / 250)::BIGINT AS mesh_y, count(*) AS bld_count,
    {r("sum(area)", 4)} AS bld_area_m2, {r("sum(area) / 62500.0", 6)} AS bld_density FROM points GROUP BY 1, 2"""
)
def mesh_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.mesh_density(points(spark, sf_dir))
    return found.withColumns({"bld_area_m2": round_scaled(F.col("bld_area_m2"), 4), "bld_density": round_scaled(F.col("bld_density"), 6)})


@query(
    f"""WITH {POINTS}, dens AS (SELECT floor(x / 250)::BIGINT AS mx, floor(y / 250)::BIGINT AS my, sum(area) / 62500.0 AS d FROM points
      WHERE event_type = 'click' GROUP BY 1, 2)
    SELECT point_id, {r("coalesce(d, 0.0)", 6)} AS bld_density FROM points LEFT JOIN dens ON floor(x / 250)::BIGINT = mx AND floor(y / 250)::BIGINT = my"""
)
def mesh_lookup_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = points(spark, sf_dir)
    found = stats.density_at(own, stats.mesh_density(own.filter("event_type = 'click'")))
    return found.select("point_id", round_scaled(F.col("bld_density"), 6).alias("bld_density"))


@query(
    f"""WITH {POINTS}, near AS (SELECT a.point_id, min(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) AS d
      FROM points a JOIN points b ON b.event_type = 'purchase' AND abs(a.x - b.x) <= 50 AND abs(a.y - b.y) <= 50 WHERE a.event_type <> 'purchase' GROUP BY 1)
    SELECT p.point_id, {r("least(coalesce(d, 50.0), 50.0)", 4)} AS dist FROM points p LEFT JOIN near USING (point_id) WHERE event_type <> 'purchase'"""
)
def nearest_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = points(spark, sf_dir)
    found = grid.nearest_capped(own.filter("event_type <> 'purchase'"), own.filter("event_type = 'purchase'"), 50.0)
    return found.select("point_id", round_scaled(F.col("dist"), 4).alias("dist"))


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping squares, one for each nation."""
    k = F.col("n_nationkey")
    x0, y0 = (k % 5) * 1000.0, F.floor(k / 5) * 600.0
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), geom.box(x0, y0, x0 + 1200.0, y0 + 700.0).alias("polygon"))


AREAS = "areas AS (SELECT n_name AS name, (n_nationkey % 5) * 1000.0 AS ax, floor(n_nationkey / 5) * 600.0 AS ay FROM nation)"


@query(
    f"""WITH {POINTS}, {AREAS} SELECT point_id, (SELECT min(name) FROM areas WHERE x >= ax AND x < ax + 1200 AND y >= ay AND y < ay + 700) AS name FROM points"""
)
def point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.first_covering(points(spark, sf_dir), areas(spark, sf_dir), 500.0).select("point_id", "name")


def _stroke_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("line")
    return strokes(spark, sf_dir).select(F.col("line_id").alias("seg_id"), line[0]["x"].alias("x0"), line[0]["y"].alias("y0"), line[1]["x"].alias("x1"), line[1]["y"].alias("y1"))


def _length() -> Column:
    return F.sqrt((F.col("x1") - F.col("x0")) ** 2 + (F.col("y1") - F.col("y0")) ** 2)


def strokes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short lines from points."""
    x, y = F.col("x"), F.col("y")
    line = F.array(geom.point(x, y), geom.point(x + 40.0, y + (F.col("point_id") % 7 - 3) * 15.0))
    return points(spark, sf_dir).select(F.col("point_id").alias("line_id"), line.alias("line"))


@query(
    f"""WITH {POINTS}, s AS (SELECT point_id AS line_id, x AS x0, x + 40 AS x1, y AS y0, y + (point_id % 7 - 3) * 15.0 AS y1 FROM points),
      walls AS (SELECT (n_nationkey % 5) * 1000.0 + 500 AS wx, floor(n_nationkey / 5) * 600.0 AS wy FROM nation),
      hits AS (SELECT DISTINCT line_id FROM s JOIN walls ON x0 <= wx AND wx <= x1 AND y0 + (y1 - y0) * (wx - x0) / (x1 - x0) BETWEEN wy AND wy + 450)
    SELECT line_id, line_id IN (SELECT line_id FROM hits) AS barrier_cross FROM s"""
)
def segment_intersects(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    wx, wy = (k % 5) * 1000.0 + 500.0, F.floor(k / 5) * 600.0
    walls = table(spark, sf_dir, "nation").select(F.array(geom.point(wx, wy), geom.point(wx, wy + 450.0)).alias("line"))
    return grid.crossing_flag(strokes(spark, sf_dir), walls, 200.0).select("line_id", "barrier_cross")


@query(
    f"""WITH {POINTS}, {AREAS}, s AS (SELECT point_id AS line_id, x AS x0, x + 40 AS x1, y AS y0, y + (point_id % 7 - 3) * 15.0 AS y1 FROM points),
      c AS (SELECT line_id, name, greatest(0.0, (ax - x0) / 40.0, CASE WHEN y1 > y0 THEN (ay - y0) / (y1 - y0) WHEN y1 < y0 THEN (ay + 700 - y0) / (y1 - y0) ELSE 0.0 END) AS lo,
        least(1.0, (ax + 1200 - x0) / 40.0, CASE WHEN y1 > y0 THEN (ay + 700 - y0) / (y1 - y0) WHEN y1 < y0 THEN (ay - y0) / (y1 - y0) ELSE 1.0 END) AS hi,
        y0, y1, ay FROM s, areas)
    SELECT line_id, min(name) AS name FROM c WHERE lo <= hi AND NOT (y0 = y1 AND (y0 < ay OR y0 > ay + 700)) GROUP BY 1"""
)
def first_meeting_ward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.first_meeting(strokes(spark, sf_dir), areas(spark, sf_dir), 500.0).select("line_id", "name")


@query(
    f"""WITH {POINTS}, {AREAS}, s AS (SELECT point_id AS seg_id, x AS x0, x + 40 AS x1, y AS y0, y + (point_id % 7 - 3) * 15.0 AS y1 FROM points),
      c AS (SELECT seg_id, name, greatest(0.0, (ax - x0) / 40.0, CASE WHEN y1 > y0 THEN (ay - y0) / (y1 - y0) WHEN y1 < y0 THEN (ay + 700 - y0) / (y1 - y0) ELSE 0.0 END) AS lo,
        least(1.0, (ax + 1200 - x0) / 40.0, CASE WHEN y1 > y0 THEN (ay + 700 - y0) / (y1 - y0) WHEN y1 < y0 THEN (ay - y0) / (y1 - y0) ELSE 1.0 END) AS hi, y0, y1, ay FROM s, areas)
    SELECT name, count(*) AS pieces, {r("sum((hi - lo) * sqrt(1600 + (y1 - y0) * (y1 - y0)))", 2)} AS length FROM c
    WHERE lo < hi AND NOT (y0 = y1 AND (y0 < ay OR y0 > ay + 700)) GROUP BY 1"""
)
def clip_to_wards(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = clip_segments(_stroke_segments(spark, sf_dir), areas(spark, sf_dir), 500.0)
    return cut.groupBy("name").agg(F.count("*").alias("pieces"), round_scaled(F.sum(_length()), 2).alias("length"))


@query("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k FROM events) WHERE k = 1")
def keep_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = grid.keep_first(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"])
    return first.select("user_id", "event_type", "event_id")


@query("SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS hit FROM orders")
def exists_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("hit", F.lit(True))
    return table(spark, sf_dir, "orders").select("o_orderkey").join(hit, "o_orderkey", "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


@query("SELECT n_name FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)")
def missing_wards(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("name"))
    seen = table(spark, sf_dir, "supplier").filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("n_nationkey"))
    return stages.missing_names(names.join(seen, "n_nationkey"), names.select("name")).select(F.col("name").alias("n_name"))


@query(
    f"""WITH {POINTS} SELECT point_id, key, ((key - key % 10000000) / 10000000 - 1000000) / 2.0 AS x, (key % 10000000 - 1000000) / 2.0 AS y FROM (SELECT point_id,
      (round_even((x - 2000) * 2, 0)::BIGINT + 1000000) * 10000000 + round_even((y - 1500) * 2, 0)::BIGINT + 1000000 AS key FROM points)"""
)
def grid_key_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = points(spark, sf_dir).select("point_id", graph.node_key(F.col("x") - 2000.0, F.col("y") - 1500.0).alias("key"))
    return keyed.withColumn("p", graph.key_point(F.col("key"))).select("point_id", "key", "p.x", "p.y")


@query(
    f"""WITH {POINTS}, b AS (SELECT min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM points)
    SELECT tx, ty, {r("x0 + tx * 2000.0", 4)} AS x0, {r("y0 + ty * 2000.0", 4)} AS y0 FROM b,
      (SELECT unnest(range(20)) AS tx), (SELECT unnest(range(20)) AS ty)
    WHERE tx < greatest(ceil((x1 - x0) / 2000.0), 1) AND ty < greatest(ceil((y1 - y0) / 2000.0), 1)"""
)
def tile_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = points(spark, sf_dir).agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))
    found = raster.tile_grid(b)
    return found.select("tx", "ty", round_scaled(F.col("x0"), 4).alias("x0"), round_scaled(F.col("y0"), 4).alias("y0"))


# ---------------------------------------------------------------- overlay


@query(f"WITH {POINTS} SELECT point_id AS line_id, x AS x0, y AS y0, x + 40.0 AS x1, y + (point_id % 7 - 3) * 15.0 AS y1 FROM points")
def two_point_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.two_point_segments(strokes(spark, sf_dir)).select("line_id", "x0", "y0", "x1", "y1")


@query(
    f"""WITH {ROADS}, {POINTS}, d AS (SELECT sum(area) / 62500.0 AS d FROM points GROUP BY floor(x / 250), floor(y / 250))
    SELECT (SELECT count(*) FROM roads) AS edges, (SELECT {r("sum(length_m) / 1000.0", 3)} FROM roads) AS km, (SELECT count(*) FROM roads WHERE barrier_cross) AS crossings,
      (SELECT count(*) FROM d) AS cells, (SELECT {r("avg(d)", 6)} FROM d) AS mean_density"""
)
def network_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.totals(roads(spark, sf_dir), stats.mesh_density(points(spark, sf_dir)))
    return found.withColumns({"km": round_scaled(F.col("km"), 3), "mean_density": round_scaled(F.col("mean_density"), 6)})


@query(
    """WITH c AS (SELECT c_custkey % 50 AS x, c_custkey // 50 AS y, 'r' || (c_nationkey % 5) AS name FROM customer),
      f AS (SELECT name, (name, x + 1, y) IN (SELECT (name, x, y) FROM c) AS e, (name, x, y + 1) IN (SELECT (name, x, y) FROM c) AS n, (name, x + 1, y + 1) IN (SELECT (name, x, y) FROM c) AS d FROM c)
    SELECT name, 100.0 * count(*) AS area, 10.0 * (4 * count(*) - 2 * sum(e::INT + n::INT)) AS perimeter, (count(*) - sum(e::INT + n::INT) + sum((e AND n AND d)::INT))::BIGINT AS parts_less_holes FROM f GROUP BY 1"""
)
def dissolve_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' squares, dissolved by name."""
    x, y = (F.col("c_custkey") % 50) * 10.0, F.floor(F.col("c_custkey") / 50) * 10.0
    squares = table(spark, sf_dir, "customer").select(F.concat(F.lit("r"), (F.col("c_nationkey") % 5).cast("string")).alias("name"), geom.box(x, y, x + 10.0, y + 10.0).alias("polygon"))
    rim = F.aggregate("polygon", F.lit(0.0), lambda a, line: a + geom.line_length(line))
    found = overlay.dissolve(squares, 30.0)
    return found.groupBy("name").agg(F.sum("area").alias("area"), F.sum(rim).alias("perimeter"), F.sum(2 - F.size("polygon")).alias("parts_less_holes"))


@query(
    """WITH p AS (SELECT (p_partkey % 100) * 20.0 AS x, (p_partkey // 100) * 20.0 AS y, p_size > 25 AS island FROM part)
    SELECT x, y, CASE WHEN island THEN 240.0 ELSE 256.0 END AS area, CASE WHEN island THEN 2 ELSE 1 END AS rings FROM p UNION ALL SELECT x + 6, y + 6, 16.0, 1 FROM p WHERE island"""
)
def face_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faces of the outlines of parts' plots, some with an island."""
    x, y = (F.col("p_partkey") % 100) * 20.0, F.floor(F.col("p_partkey") / 100) * 20.0
    outline = F.when(F.col("p_size") > 25, F.array(geom.box(x, y, x + 16.0, y + 16.0)[0], geom.box(x + 6.0, y + 6.0, x + 10.0, y + 10.0)[0])).otherwise(F.array(geom.box(x, y, x + 16.0, y + 16.0)[0]))
    lines = table(spark, sf_dir, "part").select("p_partkey", F.explode(outline).alias("line"))
    found = polygonize.face_polygons(grid.segments(lines, "p_partkey", "line"), 40.0)
    corner = F.array_min(F.col("polygon")[0])
    return found.select(corner["x"].alias("x"), corner["y"].alias("y"), "area", F.size("polygon").alias("rings"))


CONCAVE = """shapes AS (SELECT n_name AS name, (n_nationkey % 5) * 1000.0 + 0.37 AS ax, floor(n_nationkey / 5) * 600.0 + 0.37 AS ay FROM nation),
  boxes AS (SELECT name, 1 AS sign, ax AS l, ay AS b, ax + 1200 AS r, ay + 700 AS t FROM shapes UNION ALL SELECT name, -1, ax + 600, ay + 350, ax + 1200, ay + 700 FROM shapes
    UNION ALL SELECT name, -1, ax + 100, ay + 100, ax + 300, ay + 250 FROM shapes)"""


@query(
    f"""WITH {POINTS}, {CONCAVE}, s AS (SELECT x AS x0, y AS y0, y + (point_id % 7 - 3) * 15.0 AS y1 FROM points),
      c AS (SELECT name, sign, y0, y1, b, t, greatest(0.0, (l - x0) / 40.0, CASE WHEN y1 > y0 THEN (b - y0) / (y1 - y0) WHEN y1 < y0 THEN (t - y0) / (y1 - y0) ELSE 0.0 END) AS lo,
        least(1.0, (r - x0) / 40.0, CASE WHEN y1 > y0 THEN (t - y0) / (y1 - y0) WHEN y1 < y0 THEN (b - y0) / (y1 - y0) ELSE 1.0 END) AS hi FROM s, boxes)
    SELECT name, {r("sum(sign * (hi - lo) * sqrt(1600 + (y1 - y0) * (y1 - y0)))", 2)} AS length FROM c WHERE lo < hi AND NOT (y0 = y1 AND (y0 < b OR y0 > t)) GROUP BY 1"""
)
def clip_concave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths of strokes inside L-shaped areas with a hole."""
    k = F.col("n_nationkey")
    x, y = (k % 5) * 1000.0 + 0.37, F.floor(k / 5) * 600.0 + 0.37
    corners = [(0, 0), (1200, 0), (1200, 350), (600, 350), (600, 700), (0, 700), (0, 0)]
    shell = F.array(*[geom.point(x + float(a), y + float(b)) for a, b in corners])
    hole = geom.box(x + 100.0, y + 100.0, x + 300.0, y + 250.0)[0]
    shapes = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.array(shell, hole).alias("polygon"))
    cut = clip_segments(_stroke_segments(spark, sf_dir), shapes, 200.0)
    return cut.groupBy("name").agg(round_scaled(F.sum(_length()), 2).alias("length"))


@query(
    f"""WITH {POINTS}, {AREAS}, d AS (SELECT name, x, ax, greatest(ay - y, y - ay - 700, 0.0) AS dy FROM points, areas),
      c AS (SELECT name, greatest(x, ax - sqrt(2500 - dy * dy)) AS lo, least(x + 40, ax + 1200 + sqrt(2500 - dy * dy)) AS hi FROM d WHERE dy <= 50)
    SELECT name, {r("sum(hi - lo)", 2)} AS length FROM c WHERE lo < hi GROUP BY 1"""
)
def near_wards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths of level strokes inside areas or within 50 metres of them."""
    segs = points(spark, sf_dir).select(F.col("point_id").alias("seg_id"), F.col("x").alias("x0"), F.col("y").alias("y0"), (F.col("x") + 40.0).alias("x1"), F.col("y").alias("y1"))
    return clip_near(segs, areas(spark, sf_dir), 50.0, 200.0).groupBy("name").agg(round_scaled(F.sum(_length()), 2).alias("length"))


@query(
    """WITH h AS (SELECT 10.0 * (max(c_custkey) // 100 + 1) AS h FROM customer), w AS (SELECT unnest(range(5)) AS k),
      s AS (SELECT DISTINCT s_suppkey * 3 AS j FROM supplier, h WHERE s_suppkey * 30 + 6 <= h), b AS (SELECT c_custkey % 100 // 20 AS k, c_custkey // 100 AS j FROM customer WHERE c_acctbal > 0),
      n AS (SELECT k, count(*) AS blocks, sum(CASE WHEN j IN (SELECT j FROM s) THEN 1 ELSE 0 END) AS wet FROM b GROUP BY 1)
    SELECT 'w' || w.k AS name, 200 * h - 64.0 * coalesce(blocks, 0) - 400.0 * (SELECT count(*) FROM s) + 16.0 * coalesce(wet, 0) AS area FROM w LEFT JOIN n USING (k), h"""
)
def road_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What customers' blocks and strips of water leave of five wards."""
    customer = table(spark, sf_dir, "customer")
    high = customer.agg(((F.floor(F.max("c_custkey") / 100) + 1) * 10.0).alias("h"))
    k = F.col("k")
    wards = high.select("h", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k")).select(F.concat(F.lit("w"), k.cast("string")).alias("name"), geom.box(k * 200.0, F.lit(0.0), k * 200.0 + 200.0, F.col("h")).alias("polygon"))
    x, y = (F.col("c_custkey") % 100) * 10.0, F.floor(F.col("c_custkey") / 100) * 10.0
    blocks = customer.filter("c_acctbal > 0").select(geom.box(x + 1.0, y + 1.0, x + 9.0, y + 9.0).alias("polygon"))
    low = F.col("s_suppkey") * 30.0 + 4.0
    water = table(spark, sf_dir, "supplier").join(high, F.col("s_suppkey") * 30 + 6 <= F.col("h")).select(geom.box(F.lit(-5.0), low, F.lit(1005.0), low + 2.0).alias("polygon"))
    return stages.road_space(wards, blocks, water, 30.0).groupBy("name").agg(F.sum("area").alias("area"))


# ---------------------------------------------------------------- graphs


def lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streets on a strip of seven lanes that grows with the orders, in wards of 5,000 units.

    Every line item is a unit segment: most go on along their lane, which makes long chains, one
    in fifty leads to the next lane and one in fifty goes there diagonally.
    """
    turn = F.col("l_partkey") % 50
    segs = table(spark, sf_dir, "lineitem").select(
        F.floor(F.col("l_orderkey") / 4).alias("x"), F.col("l_linenumber").alias("y"),
        F.when(turn == 48, 1).when(turn == 49, 2).otherwise(0).alias("d"), "l_quantity",
    )
    segs = segs.groupBy("x", "y", "d").agg(F.max("l_quantity").cast("double").alias("width_m"))
    ex, ey = F.when(F.col("d") != 1, 1).otherwise(0), F.when(F.col("d") != 0, 1).otherwise(0)
    return segs.select(
        F.floor(F.col("x") / 5000).alias("ward"), ((F.col("x") * 10 + F.col("y")) * 10 + F.col("d")).alias("seg_id"), F.col("x").cast("double").alias("x0"),
        F.col("y").cast("double").alias("y0"), (F.col("x") + ex).cast("double").alias("x1"), (F.col("y") + ey).cast("double").alias("y1"), "width_m",
    )


LATTICE = """seg0 AS (SELECT l_orderkey // 4 AS x, l_linenumber AS y, CASE l_partkey % 50 WHEN 48 THEN 1 WHEN 49 THEN 2 ELSE 0 END AS d, max(l_quantity)::DOUBLE AS width_m
    FROM lineitem GROUP BY 1, 2, 3),
  seg1 AS (SELECT x // 5000 AS ward, (x * 10 + y) * 10 + d AS seg_id, x, y, x + CASE WHEN d <> 1 THEN 1 ELSE 0 END AS x1, y + CASE WHEN d <> 0 THEN 1 ELSE 0 END AS y1, width_m FROM seg0),
  seg AS (SELECT *, (x * 2 + 1000000) * 10000000 + y * 2 + 1000000 AS u, (x1 * 2 + 1000000) * 10000000 + y1 * 2 + 1000000 AS v,
    sqrt(((x1 - x) * (x1 - x) + (y1 - y) * (y1 - y))::DOUBLE) AS length FROM seg1),
  node AS (SELECT ward, u AS n FROM seg UNION SELECT ward, v FROM seg),
  kept AS (SELECT * FROM seg WHERE NOT (x <> x1 AND y <> y1 AND
    ((ward, (x * 2 + 1000000) * 10000000 + y1 * 2 + 1000000) IN (SELECT (ward, n) FROM node) OR (ward, (x1 * 2 + 1000000) * 10000000 + y * 2 + 1000000) IN (SELECT (ward, n) FROM node)))),
  deg AS (SELECT ward, n, count(*) AS degree FROM (SELECT ward, u AS n FROM kept UNION ALL SELECT ward, v FROM kept) GROUP BY 1, 2)"""


def noded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.drop_diagonals(graph.node_segments(lattice(spark, sf_dir)))


@query(f"WITH {LATTICE} SELECT ward, seg_id, u, v FROM kept")
def diagonal_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noded(spark, sf_dir).select("ward", "seg_id", "u", "v")


@query(f"WITH {LATTICE} SELECT ward, n AS node, degree FROM deg")
def node_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.degrees(noded(spark, sf_dir))


CHAINS = f"""WITH RECURSIVE {LATTICE}, inner_ AS (SELECT ward, n FROM deg WHERE degree = 2),
  both_ AS (SELECT ward, u, v FROM kept WHERE (ward, u) IN (SELECT (ward, n) FROM inner_) AND (ward, v) IN (SELECT (ward, n) FROM inner_)),
  way AS (SELECT ward, u, v FROM both_ UNION SELECT ward, v, u FROM both_),
  reach(ward, n, m) AS (SELECT ward, n, n FROM inner_ UNION SELECT r.ward, r.n, w.v FROM reach r JOIN way w ON r.ward = w.ward AND r.m = w.u),
  label AS (SELECT ward, n, min(m) AS chain FROM reach GROUP BY 1, 2),
  told AS (SELECT k.*, coalesce(a.chain::VARCHAR, b.chain::VARCHAR, 's' || seg_id) AS chain, a.chain IS NOT NULL AS u_inner, b.chain IS NOT NULL AS v_inner
    FROM kept k LEFT JOIN label a ON k.ward = a.ward AND k.u = a.n LEFT JOIN label b ON k.ward = b.ward AND k.v = b.n)"""


@query(f"{CHAINS} SELECT ward, seg_id, chain FROM told")
def chain_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.chains(noded(spark, sf_dir)).select("ward", "seg_id", "chain")


@query(
    f"""{CHAINS}, ends_ AS (SELECT ward, chain, u AS n FROM told WHERE NOT u_inner UNION ALL SELECT ward, chain, v FROM told WHERE NOT v_inner),
      two AS (SELECT ward, chain, min(n) AS u, max(n) AS v FROM ends_ GROUP BY 1, 2 HAVING min(n) <> max(n)),
      sums AS (SELECT ward, chain, sum(length) AS length, sum(length * width_m) AS lw FROM told GROUP BY 1, 2)
    SELECT ward, chain, u, v, {r("length", 2)} AS length_m, {r("lw / greatest(length, 1e-9)", 1)} AS width_m FROM sums JOIN two USING (ward, chain)"""
)
def edge_contraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.contract(noded(spark, sf_dir)).select("ward", "chain", "u", "v", "length_m", "width_m")


@query(f"{CHAINS} SELECT ward, chain, count(*) AS edges, (count(*) - 1)::BIGINT AS last_place, 0::BIGINT AS breaks FROM told GROUP BY 1, 2")
def line_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streets' edges by their places: each begins where the one before it ends."""
    told = graph.chains(noded(spark, sf_dir))
    start, stop = F.when(F.col("forward"), F.col("u")).otherwise(F.col("v")), F.when(F.col("forward"), F.col("v")).otherwise(F.col("u"))
    after = F.lead("start").over(Window.partitionBy("ward", "chain").orderBy("place"))
    told = told.withColumn("start", start).withColumn("gap", F.when(after != stop, 1).otherwise(0))
    return told.groupBy("ward", "chain").agg(F.count("*").alias("edges"), F.max("place").alias("last_place"), F.sum("gap").alias("breaks"))


@query(
    f"""{CHAINS}, ends_ AS (SELECT ward, chain, u AS n FROM told WHERE NOT u_inner UNION ALL SELECT ward, chain, v FROM told WHERE NOT v_inner),
      two AS (SELECT ward, chain, min(n) AS u, max(n) AS v FROM ends_ GROUP BY 1, 2 HAVING min(n) <> max(n)), used AS (SELECT ward, u AS node FROM two UNION SELECT ward, v FROM two)
    SELECT ward, node, ((node - node % 10000000) / 10000000 - 1000000) / 2.0 AS x, (node % 10000000 - 1000000) / 2.0 AS y FROM used"""
)
def used_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the junctions that contracted streets end in."""
    return graph.nodes_of(graph.contract(noded(spark, sf_dir)))


TREES = """t AS (SELECT 'i' || l_suppkey || '-' || l_orderkey || '-' || l_linenumber AS node, s_nationkey AS k FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    UNION SELECT 's' || s_suppkey, s_nationkey FROM supplier UNION SELECT 'n' || s_nationkey, s_nationkey FROM supplier)"""


def trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges (ward, u, v) of one tree a nation, a ward a region: items to suppliers to nations."""
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    at = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_regionkey").alias("ward"), "s_suppkey", "s_nationkey")
    name = lambda kind, *keys: F.concat(F.lit(kind), F.concat_ws("-", *[F.col(k).cast("string") for k in keys]))
    items = table(spark, sf_dir, "lineitem").join(at, F.col("l_suppkey") == F.col("s_suppkey"))
    items = items.select("ward", name("i", "l_suppkey", "l_orderkey", "l_linenumber").alias("u"), name("s", "l_suppkey").alias("v"))
    return items.union(at.select("ward", name("s", "s_suppkey"), name("n", "s_nationkey")))


@query(f"WITH {TREES} SELECT node, min(node) OVER (PARTITION BY k) AS component FROM t")
def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connected_components(trees(spark, sf_dir))


@query(
    f"""WITH {TREES}, s AS (SELECT n_regionkey AS ward, k, count(*) AS n FROM t JOIN nation ON k = n_nationkey GROUP BY 1, 2)
    SELECT ward, {r('max(n) * 100.0 / sum(n)', 1)} AS lcc_pct FROM s GROUP BY 1"""
)
def largest_component_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.largest_component_pct(trees(spark, sf_dir))


def streets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid of 14 by 14 streets in each ward, with lengths from the parts; as many wards as those fill."""
    n = 14
    ward = F.concat(F.lit("w"), F.floor(F.col("p_partkey") / (n * n)).cast("string"))
    part = table(spark, sf_dir, "part").select(ward.alias("ward"), "p_partkey", (F.col("p_partkey") % (n * n)).alias("k"), "p_size")
    here = part.withColumns({"x": F.col("k") % n, "y": F.floor(F.col("k") / n)})
    east = here.filter(F.col("x") < n - 1).withColumns({"v": F.col("k") + 1, "d": F.lit(0)})
    north = here.filter(F.col("y") < n - 1).withColumns({"v": F.col("k") + n, "d": F.lit(1)})
    return east.unionAll(north).select(
        "ward", (F.col("p_partkey") * 2 + F.col("d")).alias("edge_id"), F.col("k").alias("u"), "v",
        (F.col("p_size") + F.col("d") * 3.0).alias("length_m"), (1.0 + (F.col("k") % 9)).alias("width_m"), ((F.col("k") % 10) / 10.0).alias("blockage_risk"),
    )


def _trips(edges: DataFrame) -> DataFrame:
    """Twenty trips in each ward."""
    each = edges.select("ward").distinct().select("ward", F.explode(F.sequence(F.lit(0), F.lit(19))).alias("trip_id"))
    return each.select("ward", "trip_id", (F.col("trip_id") * 7 % 90 + 1).alias("origin"), (195 - F.col("trip_id") * 5).alias("goal"))


def _quarter(node: Column) -> Column:
    """Cell of a street node: a square of seven by seven."""
    return F.concat_ws("/", F.floor(node % 14 / 7).cast("string"), F.floor(node / 98).cast("string"))


STREETS = """c AS (SELECT 'w' || (p_partkey // 196) AS ward, p_partkey % 196 AS k, p_size FROM part),
  st AS (SELECT ward, k AS u, k + 1 AS v, p_size::DOUBLE AS len FROM c WHERE k % 14 < 13 UNION ALL SELECT ward, k, k + 14, p_size + 3.0 FROM c WHERE k // 14 < 13)"""


@query(
    f"""WITH RECURSIVE {STREETS}, way AS (SELECT ward, u, v, len FROM st UNION ALL SELECT ward, v, u, len FROM st),
      trips AS (SELECT ward, t AS trip_id, t * 7 % 90 + 1 AS origin, 195 - t * 5 AS goal FROM (SELECT DISTINCT ward FROM st), (SELECT unnest(range(20)) AS t)),
      front(ward, origin, node, cost, step) AS (SELECT DISTINCT ward, origin, origin, 0.0::DOUBLE, 0 FROM trips
        UNION ALL SELECT ward, origin, node, min(cost), any_value(step) FROM (SELECT f.ward, f.origin, w.v AS node, f.cost + w.len AS cost, f.step + 1 AS step FROM front f JOIN way w ON f.ward = w.ward AND f.node = w.u WHERE f.step < 60) GROUP BY 1, 2, 3),
      best AS (SELECT ward, origin, node, min(cost) AS cost FROM front GROUP BY 1, 2, 3)
    SELECT t.ward, trip_id, cost FROM trips t JOIN best b ON t.ward = b.ward AND t.origin = b.origin AND t.goal = b.node"""
)
def shortest_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = streets(spark, sf_dir)
    return routes.shortest_paths(edges, _trips(edges), "length_m", _quarter).select("ward", "trip_id", "cost")


@query()
def weighted_route_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = streets(spark, sf_dir)
    return stats.route_shares(routes.shortest_paths(edges, _trips(edges), "length_m", _quarter), edges)


def strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five wards of four lanes that grow with the parts, with lengths, widths and three costs."""
    key, size = F.col("p_partkey"), F.col("p_size")
    part = table(spark, sf_dir, "part").select(key, size, F.floor(key / 20).alias("x"), (key % 20).alias("y"))
    part = part.select("*", F.floor(F.col("y") / 4).alias("k"), (F.col("x") * 4 + F.col("y") % 4).alias("u"))
    ahead = part.withColumns({"v": F.col("u") + 4, "d": F.lit(0)})
    aside = part.filter("y % 4 < 3").withColumns({"v": F.col("u") + 1, "d": F.lit(1)})
    length = F.col("p_size") + F.col("d") * 3.0
    return ahead.unionAll(aside).select(
        F.concat(F.lit("w"), F.col("k").cast("string")).alias("ward"), (key * 2 + F.col("d")).alias("edge_id"), "u", "v", length.alias("length_m"), (1.0 + F.col("u") % 9).alias("width_m"),
        ((F.col("u") % 10) / 10.0).alias("blockage_risk"), (F.col("u") % 12).cast("double").alias("slope_pct"), (length * (1.0 + F.col("u") % 3)).alias("normal"), (length * (1.0 + F.col("u") % 10)).alias("quake"),
    )


def _stretch(node: Column) -> Column:
    return F.floor(node / 400).cast("string")


@query()
def routing_qc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten drawn trips in each ward: the shortest way, the usual one and the one after a quake."""
    edges = strips(spark, sf_dir)
    ways = {"shortest": "length_m", "normal": "normal", "quake": "quake"}
    return routes.routing_qc(edges, routes.drawn_trips(edges, 10), ways, _stretch)


@query()
def simplify_dp(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = polylines(spark, sf_dir)
    return graph.simplify_lines(lines, "line", 0.3).select("vec_id", F.size("line").alias("n_before"), F.size("simple").alias("n_after"))


@query("SELECT 100.0 AS area FROM nation WHERE n_nationkey % 5 < 4 AND n_nationkey < 20")
def polygonize_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"))
    x, y = (F.col("k") % 5) * 10.0, F.floor(F.col("k") / 5) * 10.0
    across = n.select((F.col("k") * 2).alias("seg_id"), (x - 2.0).alias("x0"), y.alias("y0"), (x + 12.0).alias("x1"), y.alias("y1"))
    along = n.select((F.col("k") * 2 + 1).alias("seg_id"), x.alias("x0"), (y - 2.0).alias("y0"), x.alias("x1"), (y + 12.0).alias("y1"))
    return polygonize.polygonize(across.unionAll(along), 20.0).select(F.col("area"))


# ---------------------------------------------------------------- rasters


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels (tile, iy, ix, v): users by hours since the start of 2024."""
    hour = F.floor((F.unix_timestamp(F.col("ts").cast("timestamp")) - 1704067200) / 3600)
    return table(spark, sf_dir, "events").groupBy(F.lit(0).alias("tile"), F.col("user_id").cast("int").alias("iy"), hour.cast("int").alias("ix")).agg(F.max("value").alias("v"))


PIXELS = "px AS (SELECT 0 AS tile, user_id::INT AS iy, floor((epoch(ts) - 1704067200) / 3600)::INT AS ix, max(value) AS v FROM events GROUP BY 1, 2, 3)"


@query(
    f"""WITH {PIXELS}, s(dy, dx) AS (VALUES (0, 1), (1, 0), (1, 1), (1, -1))
    SELECT a.iy, a.ix, dy, dx, {r("(a.v + b.v) / 2.0", 4)} AS width FROM px a, s, px b WHERE b.iy = a.iy + dy AND b.ix = a.ix + dx"""
)
def pixel_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = raster.adjacent_pixels(pixels(spark, sf_dir), ["tile"], "v")
    return pairs.select("iy", "ix", "dy", "dx", round_scaled((F.col("a") + F.col("b")) / 2.0, 4).alias("width"))


@query(
    f"""WITH {PIXELS}, s(dy, dx) AS (VALUES (0, 1), (-1, 0), (-1, 1), (-1, -1)),
      p AS (SELECT (a.ix + 0.5)::DOUBLE AS x0, (a.iy + 0.5)::DOUBLE AS y0, (b.ix + 0.5)::DOUBLE AS x1, (b.iy + 0.5)::DOUBLE AS y1, (a.v / 8.0 + b.v / 8.0) / 2.0 AS w
        FROM px a, s, px b WHERE b.iy = a.iy + dy AND b.ix = a.ix + dx)
    SELECT x0, y0, x1, y1, {r("w", 1)} AS width_m FROM p WHERE w <= 50"""
)
def core_tile_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles overlap; each pair of pixels belongs to the core of one, so the tiles leave no trace."""
    own = pixels(spark, sf_dir).select(F.col("ix").cast("long").alias("px"), F.col("iy").cast("long").alias("py"), (F.col("v") / 8.0).alias("width_px"))
    return raster.centrelines(raster.into_tiles(own, 100.0, 20.0), 100.0, 20.0)


@query(
    f"""WITH {PIXELS}, m AS (SELECT iy, ix, (iy, ix) NOT IN (SELECT (iy, ix) FROM px WHERE v < 50) AS on_
        FROM (SELECT unnest(range((SELECT max(iy) + 1 FROM px))) AS iy), (SELECT unnest(range((SELECT max(ix) + 1 FROM px))) AS ix)),
      d AS (SELECT a.iy, a.ix, min((a.iy - b.iy) * (a.iy - b.iy) + (a.ix - b.ix) * (a.ix - b.ix)) AS d2
        FROM (SELECT iy, ix FROM m WHERE NOT on_) b, (SELECT unnest(range(-5, 6)) AS dy), (SELECT unnest(range(-5, 6)) AS dx), m a WHERE a.on_ AND a.iy = b.iy + dy AND a.ix = b.ix + dx GROUP BY 1, 2)
    SELECT iy, ix, {r("sqrt(d2)", 6)} AS dist FROM d WHERE d2 <= 25"""
)
def edt_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = pixels(spark, sf_dir)
    off = own.filter("v < 50").select("iy", "ix", F.lit(False).alias("off"))
    ends = own.agg(F.max("iy").alias("h"), F.max("ix").alias("w"))
    rows = ends.select("w", F.explode(F.sequence(F.lit(0), "h")).alias("iy")).repartition("iy")
    dense = rows.select(F.lit(0).alias("tile"), "iy", F.explode(F.sequence(F.lit(0), "w")).alias("ix"))
    mask = dense.join(off, ["iy", "ix"], "left").select("tile", F.col("iy").cast("long").alias("iy"), F.col("ix").cast("long").alias("ix"), F.coalesce("off", F.lit(True)).alias("on"))
    return raster.distance_rows(mask, 5).select("iy", "ix", round_scaled(F.col("dist"), 6).alias("dist"))


@query(
    f"""WITH {POINTS}, {AREAS}, seg AS (SELECT x AS x0, x + 40 AS x1, y AS y0 FROM points),
      wide AS (SELECT *, unnest(range(floor((x0 - 25) / 10)::BIGINT, floor((x1 + 25) / 10)::BIGINT + 1)) AS px FROM seg),
      every_ AS (SELECT *, unnest(range(floor((y0 - 25) / 10)::BIGINT, floor((y0 + 25) / 10)::BIGINT + 1)) AS py FROM wide),
      mid AS (SELECT px, py, (px + 0.5)::DOUBLE * 10 AS cx, (py + 0.5)::DOUBLE * 10 AS cy, x0, x1, y0 FROM every_),
      near AS (SELECT px, py, cx, cy, min(sqrt(power(greatest(x0 - cx, cx - x1, 0.0), 2) + power(cy - y0, 2))) AS d FROM mid GROUP BY 1, 2, 3, 4),
      told AS (SELECT px, py, d, coalesce(bool_or(cx >= ax + 100 AND cx < ax + 500 AND cy >= ay + 100 AND cy < ay + 400), false) AS block,
        coalesce(bool_or(cx >= ax + 600 AND cx < ax + 900 AND cy >= ay + 100 AND cy < ay + 500), false) AS wet FROM near, areas WHERE d <= 25 GROUP BY 1, 2, 3)
    SELECT px, py FROM told WHERE NOT block AND NOT (wet AND d > 6)"""
)
def mask_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("x"), F.col("y")
    edges = points(spark, sf_dir).select(x.alias("x0"), y.alias("y0"), (x + 40.0).alias("x1"), y.alias("y1"))
    k = F.col("n_nationkey")
    ax, ay = (k % 5) * 1000.0, F.floor(k / 5) * 600.0
    boxes = lambda a, b, c, d: table(spark, sf_dir, "nation").select(F.col("n_name").alias("poly_id"), geom.box(ax + a, ay + b, ax + c, ay + d).alias("polygon"))
    return raster.road_mask(edges, boxes(100.0, 100.0, 500.0, 400.0), boxes(600.0, 100.0, 900.0, 500.0), 10.0)


@query()
def thinning(spark: SparkSession, sf_dir: str) -> DataFrame:
    iy, ix = F.col("iy"), F.col("ix")
    tiles = pixels(spark, sf_dir).select(F.floor(iy / 240).alias("tx"), F.floor(ix / 240).alias("ty"), (ix % 240).alias("ix"), (iy % 240).alias("iy"))
    return raster.skeleton_pixels(tiles, 240).select("tx", "ty", "iy", "ix", round_scaled(F.col("width_px"), 3).alias("width_px"))


@query(
    f"""WITH {POINTS}, a AS (SELECT floor(y / 100)::INT AS row_, floor(x / 100)::INT AS col_, avg(area) AS e FROM points WHERE point_id % 3 = 0 GROUP BY 1, 2),
      b AS (SELECT floor(y / 100)::INT AS row_, floor(x / 100)::INT AS col_, max(area) AS e FROM points WHERE point_id % 3 = 1 GROUP BY 1, 2)
    SELECT point_id, {r("coalesce(a.e, b.e)", 4)} AS elev FROM points LEFT JOIN a ON floor(y / 100)::INT = a.row_ AND floor(x / 100)::INT = a.col_
      LEFT JOIN b ON floor(y / 100)::INT = b.row_ AND floor(x / 100)::INT = b.col_"""
)
def dem_priority_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = points(spark, sf_dir)
    at = [F.floor(F.col("y") / 100).cast("int").alias("r"), F.floor(F.col("x") / 100).cast("int").alias("col")]
    third = F.col("point_id") % 3
    both = own.groupBy(*at).agg(F.avg(F.when(third == 0, F.col("area"))).alias("A"), F.max(F.when(third == 1, F.col("area"))).alias("B"))
    # meshes of 5 by 5 kilometres, taken as degrees, as far north and east as the points go; rows count from the north
    mesh = lambda k, j: F.format_string("m%06d-%06d", k, j)
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("elev")) for k in "AB"])).alias("e")
    dem = both.select("r", "col", kinds).select(mesh(F.expr("r div 50"), F.expr("col div 50")).alias("mesh"), "e.kind", (49 - F.col("r") % 50).alias("row"), (F.col("col") % 50).alias("col"), "e.elev").filter("elev IS NOT NULL")
    most = own.agg(F.max(F.floor(F.col("y") / 5000)).alias("n"), F.max(F.floor(F.col("x") / 5000)).alias("e"))
    north = most.select("e", F.explode(F.sequence(F.lit(0).cast("long"), "n")).alias("k")).select("k", F.explode(F.sequence(F.lit(0).cast("long"), "e")).alias("j"))
    five, fifty = F.lit(5.0), F.lit(50)
    meta = north.select(mesh("k", "j").alias("mesh"), (F.col("k") * 5.0).alias("lat0"), (F.col("j") * 5.0).alias("lon0"), five.alias("lat_span"), five.alias("lon_span"), fifty.alias("rows"), fifty.alias("cols"))
    # a cell's centre stands for its points, so that no point is on a border
    mid = lambda c: (F.floor(F.col(c) / 100) + 0.5) / 10.0
    found = raster.sample_elevation(own.select("point_id", mid("y").alias("lat"), mid("x").alias("lon")), meta, dem, ["A", "B"])
    return found.select("point_id", round_scaled(F.col("elev"), 4).alias("elev"))


@query(
    f"""WITH {AREAS}, c AS (SELECT name AS poly_id, (ax + 600)::DOUBLE AS mx, (ay + 350)::DOUBLE AS my, unnest(range((ax / 50)::BIGINT - 2, (ax / 50)::BIGINT + 26)) AS px FROM areas),
      d AS (SELECT *, unnest(range((my / 50)::BIGINT - 9, (my / 50)::BIGINT + 10)) AS py FROM c)
    SELECT poly_id, count(*) AS pixels, min(px) AS first_px, max(py) AS last_py FROM d WHERE abs((px + 0.5) * 50 - mx) / 603.7 + abs((py + 0.5) * 50 - my) / 351.3 < 1 GROUP BY 1"""
)
def rasterise_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels of a diamond for each nation."""
    k = F.col("n_nationkey")
    mx, my = (k % 5) * 1000.0 + 600.0, F.floor(k / 5) * 600.0 + 350.0
    ring = [geom.point(mx + dx, my + dy) for dx, dy in ((603.7, 0.0), (0.0, 351.3), (-603.7, 0.0), (0.0, -351.3), (603.7, 0.0))]
    found = raster.rasterise(table(spark, sf_dir, "nation").select(F.col("n_name").alias("poly_id"), F.array(F.array(*ring)).alias("polygon")), 50.0)
    return found.groupBy("poly_id").agg(F.count("*").alias("pixels"), F.min("px").alias("first_px"), F.max("py").alias("last_py"))


# ---------------------------------------------------------------- shapes and text


def polylines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as lines of 32 points."""
    v = F.col("embedding")
    pts = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: geom.point(v[i * 2], v[i * 2 + 1]))
    return table(spark, sf_dir, "embeddings").select("vec_id", pts.alias("line"))


LINES = "pts AS (SELECT vec_id, i, embedding[2 * i + 1]::DOUBLE AS x, embedding[2 * i + 2]::DOUBLE AS y FROM embeddings, (SELECT unnest(range(32)) AS i)), seg AS (SELECT a.vec_id, a.i, a.x, a.y, b.x AS bx, b.y AS by_ FROM pts a JOIN pts b ON a.vec_id = b.vec_id AND b.i = a.i + 1)"


@query(f"WITH {LINES} SELECT vec_id, {r('sum(sqrt((bx - x) * (bx - x) + (by_ - y) * (by_ - y)))', 5)} AS length FROM seg GROUP BY 1")
def line_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polylines(spark, sf_dir).select("vec_id", round_scaled(geom.line_length(F.col("line")), 5).alias("length"))


@query(
    f"""WITH {LINES}, ring AS (SELECT vec_id, i, x + 3 AS x, y + 3 AS y, bx + 3 AS bx, by_ + 3 AS by_ FROM seg UNION ALL
      SELECT a.vec_id, 31, a.x + 3, a.y + 3, b.x + 3, b.y + 3 FROM pts a JOIN pts b USING (vec_id) WHERE a.i = 31 AND b.i = 0),
      s AS (SELECT vec_id, sum(x * by_ - bx * y) / 2 AS a, sum((x + bx) * (x * by_ - bx * y)) AS cx, sum((y + by_) * (x * by_ - bx * y)) AS cy FROM ring GROUP BY 1)
    SELECT vec_id, {r("abs(a)", 5)} AS area, {r("cx / (6 * a)", 3)} AS x, {r("cy / (6 * a)", 3)} AS y FROM s"""
)
def polygon_area_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.transform("line", lambda p: geom.point(p["x"] + 3.0, p["y"] + 3.0))
    ring = F.concat(moved, F.slice(moved, 1, 1))
    c = geom.centroid(F.col("ring"))
    shapes = polylines(spark, sf_dir).select("vec_id", ring.alias("ring"))
    return shapes.select("vec_id", round_scaled(geom.polygon_area(F.array("ring")), 5).alias("area"), round_scaled(c["x"], 3).alias("x"), round_scaled(c["y"], 3).alias("y"))


@query(
    f"""WITH {LINES}, cum AS (SELECT *, sqrt((bx - x) * (bx - x) + (by_ - y) * (by_ - y)) AS d FROM seg),
      run AS (SELECT *, sum(d) OVER (PARTITION BY vec_id ORDER BY i) AS done, sum(d) OVER (PARTITION BY vec_id) / 2 AS half FROM cum),
      hit AS (SELECT *, (half - (done - d)) / d AS t FROM run WHERE done >= half AND done - d < half)
    SELECT vec_id, {r("x + (bx - x) * t", 5)} AS x, {r("y + (by_ - y) * t", 5)} AS y FROM hit"""
)
def midpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = geom.midpoint(F.col("line"))
    return polylines(spark, sf_dir).select("vec_id", round_scaled(m["x"], 5).alias("x"), round_scaled(m["y"], 5).alias("y"))


@query(f"WITH {LINES} SELECT vec_id, min(CASE WHEN i = 0 THEN x END) AS first_x, min(CASE WHEN i = 31 THEN y END) AS last_y FROM pts GROUP BY 1")
def line_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("line")
    return polylines(spark, sf_dir).select("vec_id", geom.first_point(line)["x"].alias("first_x"), geom.last_point(line)["y"].alias("last_y"))


def _series(outer: str, inner: str) -> str:
    return " + ".join(f"{a!r}::DOUBLE * {outer}({2 * (j + 1)} * xi) * {inner}({2 * (j + 1)} * eta)" for j, a in enumerate(crs.ALPHA))


@query(
    f"""WITH p AS (SELECT vec_id, 139.75::DOUBLE + embedding[1]::DOUBLE / 10 AS lon, 35.68::DOUBLE + embedding[2]::DOUBLE / 10 AS lat FROM embeddings),
      s AS (SELECT *, sin(radians(lat)) AS s, radians(lon - {crs.LON0!r}::DOUBLE) AS d FROM p),
      t AS (SELECT *, sinh(atanh(s) - {crs.E1!r}::DOUBLE * atanh({crs.E1!r}::DOUBLE * s)) AS t FROM s),
      w AS (SELECT *, atan2(t, cos(d)) AS xi, atanh(sin(d) / sqrt(1 + t * t)) AS eta FROM t)
    SELECT vec_id, {r(f"{crs.K0 * crs.RADIUS!r}::DOUBLE * (eta + {_series('cos', 'sinh')})", 2)} AS x,
      {r(f"{crs.K0 * crs.RADIUS!r}::DOUBLE * (xi + {_series('sin', 'cosh')} - {crs._northing0(crs.LAT0)!r}::DOUBLE)", 2)} AS y, {r("lon", 7)} AS lon, {r("lat", 7)} AS lat FROM w"""
)
def projection_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plane coordinates of the first point of each line, and the degrees that they go back to."""
    lon, lat = 139.75 + F.col("line")[0]["x"] / 10.0, 35.68 + F.col("line")[0]["y"] / 10.0
    there = polylines(spark, sf_dir).select("vec_id", crs.to_plane(lon, lat).alias("p"))
    back = there.withColumn("q", crs.to_degrees(F.col("p.x"), F.col("p.y")))
    metres, degrees = [round_scaled(F.col(f"p.{c}"), 2).alias(c) for c in "xy"], [round_scaled(F.col(f"q.{c}"), 7).alias(c) for c in ("lon", "lat")]
    return back.select("vec_id", *metres, *degrees)


@query(
    f"""WITH {COSTED} SELECT ward, count(*) AS features, sum(round_even(length_m, 0))::BIGINT AS metres, {r("sum(width_m)", 3)} AS w, {r("sum(blockage_risk)", 3)} AS b, {r("sum(slope_pct)", 3)} AS s,
      {r("sum(round_even(length_m * 10, 0) / 1e6)", 4)} AS east, {r("sum(round_even(slope_pct * 100, 0) / 1e6)", 4)} AS north FROM costed WHERE length_m >= 10 GROUP BY 1"""
)
def geojson_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of what each feature's text holds."""
    line = F.array(geom.point(F.lit(139.0), F.lit(35.0)), geom.point(F.lit(139.0) + F.rint(F.col("length_m") * 10) / 1e6, F.lit(35.0) + F.rint(F.col("slope_pct") * 100) / 1e6))
    found = export.features(costed(spark, sf_dir).withColumn("line", line), 10.0)
    read = F.from_json("feature", "type string, properties struct<w:double,b:double,s:double,l:long>, geometry struct<type:string,coordinates:array<array<double>>>")
    to = F.col("f.geometry.coordinates")[1]
    # as a generator's rows, texts are written once and read once; as columns they are for each field that is used
    one = lambda c: F.explode(F.array(c))
    own = found.select("ward", one("feature").alias("feature")).select("ward", one(read).alias("f")).filter("f.type = 'Feature' AND f.geometry.type = 'LineString'")
    sums = {"w": F.col("f.properties.w"), "b": F.col("f.properties.b"), "s": F.col("f.properties.s")}
    return own.groupBy("ward").agg(
        F.count("*").alias("features"), F.sum("f.properties.l").alias("metres"), *[round_scaled(F.sum(c), 3).alias(k) for k, c in sums.items()],
        round_scaled(F.sum(to[0] - 139.0), 4).alias("east"), round_scaled(F.sum(to[1] - 35.0), 4).alias("north"),
    )


@query("SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '/([0-9]+)', 1) AS number, split_part(url, '://', 1) AS scheme, split(url, '/')[-1] AS tail FROM pages")
def regex_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract(url, "^[a-z]+://([^/?#]+)", 1).alias("host"), F.regexp_extract(url, "/([0-9]+)", 1).alias("number"),
        F.substring_index(url, "://", 1).alias("scheme"), F.substring_index(url, "/", -1).alias("tail"),
    )


@query("SELECT doc_id, trim(split(text, ',')[-1]) AS tail, starts_with(text, 'The') AS the, list_contains(split('en,de', ','), lang) AS told FROM documents")
def last_comma_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.trim(F.substring_index("text", ",", -1)).alias("tail"), F.startswith("text", F.lit("The")).alias("the"), F.array_contains(F.split(F.lit("en,de"), ","), F.col("lang")).alias("told")
    )


@query(
    """WITH p AS (SELECT event_id, user_id % 40 + 5001 AS mesh, (event_id % 14 + 1)::VARCHAR AS item FROM events)
    SELECT event_id, lpad(mesh::VARCHAR, 6, '0') AS mesh, lpad(item, 2, '0') AS item FROM p WHERE lpad(item, 2, '0') NOT IN ('01', '11')"""
)
def member_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    mesh, item = F.lpad((F.col("user_id") % 40 + 5001).cast("string"), 6, "0"), F.lpad((F.col("event_id") % 14 + 1).cast("string"), 2, "0")
    names = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("FG-GML-"), mesh, F.lit("-"), item, F.lit("-20240101.zip")).alias("member"))
    return archives.select_members(names).select("event_id", "mesh", "item")


def _ramp_sql(value: str, name: str) -> str:
    stops, low, high = cost.RAMPS[name]
    table_ = ", ".join("[" + ", ".join(str(int(s[k : k + 2], 16)) for k in (1, 3, 5)) + "]" for s in stops)
    t = f"least(greatest(({value} - {low}) / ({high} - {low}), 0.0), 1.0) * 4.0"
    part = [f"floor(a[{k}] + (b[{k}] - a[{k}]) * f + 0.5)::INT" for k in (1, 2, 3)]
    return f"""SELECT ward, length_m, CASE WHEN v IS NOT NULL THEN 'rgb(' || {" || ',' || ".join(part)} || ')' END AS colour FROM (SELECT *, s[i + 1] AS a, s[i + 2] AS b, t - i AS f
      FROM (SELECT *, least(floor(t), 3)::INT AS i FROM (SELECT ward, length_m, {value} AS v, {t} AS t, [{table_}] AS s FROM roads)))"""


@query(f"WITH {ROADS} {_ramp_sql('width_m', 'width')}")
def color_ramp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roads(spark, sf_dir).select("ward", "length_m", cost.ramp(F.col("width_m"), "width").alias("colour"))


@query(
    f"""SELECT event_id, {r("35.6 + 0.01 * cos(radians(value))", 8)} AS lat, {r("139.7 + 0.01 * sin(radians(value)) / cos(radians(35.6))", 8)} AS lon,
    {r("(value + 180) % 360", 6)} AS heading, {r("CASE WHEN atan2(value - 40, 15.0 - user_id) < 0 THEN degrees(atan2(value - 40, 15.0 - user_id)) + 360 ELSE degrees(atan2(value - 40, 15.0 - user_id)) END", 6)} AS bearing FROM events"""
)
def camera_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cost.camera(F.lit(35.6), F.lit(139.7), F.col("value"))
    bearing = cost.drag_bearing(F.col("value") - 40.0, F.col("user_id") - 15.0)
    return table(spark, sf_dir, "events").select(
        "event_id", round_scaled(c["lat"], 8).alias("lat"), round_scaled(c["lon"], 8).alias("lon"), round_scaled(c["heading"], 6).alias("heading"), round_scaled(bearing, 6).alias("bearing")
    )


@query(f"SELECT event_id, CASE WHEN value > 100 THEN NULL ELSE value END AS v, {r('least(greatest(value, 10.0), 50.0)', 2)} AS clipped FROM events")
def missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("value") > 100, F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", nan_to_null(raw).alias("v"), round_scaled(clip(F.col("value"), 10, 50), 2).alias("clipped"))


@query("SELECT c_custkey AS key, c_name AS name, c_mktsegment AS kind, NULL::INT AS size FROM customer UNION ALL SELECT p_partkey, p_name, NULL, p_size FROM part")
def layer_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("kind"))
    b = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    return layers.concat([a, b])


@query("SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.partition_counts(table(spark, sf_dir, "lineitem"), ["l_returnflag"])
