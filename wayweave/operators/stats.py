"""Length-weighted statistics by ward, report tables, and their text forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayweave.functions.numeric import holds, round_scaled

METRICS = ["length_km", "width_med", "narrow_pct", "blockage", "slope5", "elev"]


def share(condition: Column, length: Column) -> Column:
    """Percent of the length where the condition holds; null over no length."""
    return F.try_divide(100.0 * F.coalesce(F.sum(F.when(holds(condition), length)), F.lit(0.0)), F.sum(length))


def weighted(value: Column, length: Column) -> Column:
    """Length-weighted mean; null over no length."""
    return F.try_divide(F.sum(value * length), F.sum(length))


def ward_stats(edges: DataFrame) -> DataFrame:
    """One row a ward of six metrics, from length_m, width_m, blockage_risk, slope_pct, elev_m.

    Medians are exact and unweighted; the shares and the mean are by length. All six come from
    one grouping.
    """
    length = F.col("length_m")
    return edges.groupBy("ward").agg(
        (F.sum(length) / 1000.0).alias("length_km"),
        F.median("width_m").alias("width_med"),
        share(F.col("width_m") < 4, length).alias("narrow_pct"),
        weighted(F.col("blockage_risk"), length).alias("blockage"),
        share(F.col("slope_pct") > 5, length).alias("slope5"),
        F.median("elev_m").alias("elev"),
    )


def ward_summary(stats: DataFrame) -> DataFrame:
    """Rounded to two decimals, riskiest first."""
    return stats.select("ward", *[round_scaled(F.col(c), 2).alias(c) for c in METRICS]).orderBy(F.desc("blockage"), "ward")


def top_and_bottom(stats: DataFrame, metric: str, top: int = 3, bottom: int = 1) -> DataFrame:
    """(ward, value, which): the largest few and the smallest few."""
    pick = stats.select("ward", F.col(metric).alias("value")).filter("value IS NOT NULL")
    high = pick.orderBy(F.desc("value"), "ward").limit(top).withColumn("which", F.lit("top"))
    return high.unionAll(pick.orderBy("value", "ward").limit(bottom).withColumn("which", F.lit("bottom")))


def width_bins(lines: DataFrame) -> DataFrame:
    """Segments, median width, and percent of segments (by count) in 0-4, 4-6, 6-12 and from 12 m."""
    w = F.col("width_m")
    pct = lambda c: round_scaled(F.avg(c.cast("double")) * 100.0, 1)
    return lines.filter(w.isNotNull()).groupBy("ward").agg(
        F.count("*").alias("segments"),
        round_scaled(F.median("width_m"), 1).alias("width_med"),
        pct(w < 4).alias("lt4"),
        pct((w >= 4) & (w < 6)).alias("w4_6"),
        pct((w >= 6) & (w < 12)).alias("w6_12"),
        pct(w >= 12).alias("ge12"),
    )


def slope_report(edges: DataFrame) -> DataFrame:
    """Median elevation, percent of edges over 5 and 8 percent, 95th percentile of slope."""
    s = F.col("slope_pct")
    pct = lambda c: round_scaled(F.avg(holds(c).cast("double")) * 100.0, 1)
    return edges.groupBy("ward").agg(
        round_scaled(F.median("elev_m"), 1).alias("elev_med"),
        pct(s > 5).alias("over5"),
        pct(s > 8).alias("over8"),
        round_scaled(F.percentile("slope_pct", F.lit(0.95)), 1).alias("slope_p95"),
    )


def coverage(samples: DataFrame, value: str) -> DataFrame:
    """Percent of rows with a value, least and largest value, by ward."""
    v = F.col(value)
    return samples.groupBy("ward").agg(
        round_scaled(F.avg(v.isNotNull().cast("double")) * 100.0, 1).alias("coverage_pct"), F.min(v).alias("least"), F.max(v).alias("largest")
    )


def totals(edges: DataFrame, cells: DataFrame) -> DataFrame:
    """One row of what a run reports: edges, kilometres, those over a barrier, cells with buildings and their mean density.

    Null flags count as false; without rows counts are 0 and the mean is null.
    """
    none = lambda kind: F.lit(None).cast(kind)
    both = edges.select("length_m", holds(F.col("barrier_cross")).alias("over"), none("double").alias("density"), F.lit(True).alias("edge"))
    both = both.union(cells.select(none("double"), F.lit(False), "bld_density", F.lit(False)))
    return both.agg(
        F.count_if("edge").alias("edges"), F.coalesce(F.sum("length_m") / 1000.0, F.lit(0.0)).alias("km"), F.count_if("over").alias("crossings"),
        F.count_if(~F.col("edge")).alias("cells"), F.avg("density").alias("mean_density"),
    )


def mesh_density(buildings: DataFrame, side: float = 250.0) -> DataFrame:
    """(mesh_x, mesh_y, bld_count, bld_area_m2, bld_density) of buildings with a centre x, y and area.

    A building counts whole in the cell of its centre, so a density may exceed 1.
    """
    return (
        buildings.groupBy(F.floor(F.col("x") / side).alias("mesh_x"), F.floor(F.col("y") / side).alias("mesh_y"))
        .agg(F.count("*").alias("bld_count"), F.sum("area").alias("bld_area_m2"))
        .withColumn("bld_density", F.col("bld_area_m2") / (side * side))
    )


def density_at(points: DataFrame, density: DataFrame, side: float = 250.0) -> DataFrame:
    """Adds bld_density of the cell that holds x, y; 0 where there is none."""
    cells = density.select("mesh_x", "mesh_y", "bld_density")
    own = points.withColumns({"mesh_x": F.floor(F.col("x") / side), "mesh_y": F.floor(F.col("y") / side)})
    return own.join(cells, ["mesh_x", "mesh_y"], "left").withColumn("bld_density", F.coalesce("bld_density", F.lit(0.0))).drop("mesh_x", "mesh_y")


def route_shares(paths: DataFrame, edges: DataFrame) -> DataFrame:
    """(ward, narrow_pct, blockage) over the edges of paths, weighted by length."""
    used = paths.select("ward", "trip_id", F.explode("path").alias("edge_id"))
    met = used.join(edges.select("ward", "edge_id", "length_m", "width_m", "blockage_risk"), ["ward", "edge_id"])
    length = F.col("length_m")
    return met.groupBy("ward").agg(
        round_scaled(share(F.col("width_m") < 4, length), 1).alias("narrow_pct"),
        round_scaled(weighted(F.col("blockage_risk"), length), 3).alias("blockage"),
    )


def area_ratio(measured: DataFrame, nominal: DataFrame) -> DataFrame:
    """(ward, measured_km2, nominal_km2, ratio_pct): measured areas against nominal ones."""
    return measured.join(nominal, "ward").select("ward", "measured_km2", "nominal_km2", round_scaled(F.try_divide(100.0 * F.col("measured_km2"), F.col("nominal_km2")), 1).alias("ratio_pct"))
