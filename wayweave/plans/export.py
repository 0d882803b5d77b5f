"""CSV, GeoJSON and HTML of results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(summary: DataFrame, path: str) -> None:
    """One CSV with a header; for report tables of a row per ward."""
    summary.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def features(edges: DataFrame, min_length: float = 0.0) -> DataFrame:
    """(ward, feature): a GeoJSON feature of each edge with a line of two points or more, in degrees.

    Coordinates have six decimals; properties are w, b, s and the whole metres l.
    """
    if min_length:
        edges = edges.filter(F.col("length_m") >= min_length)
    xy = F.transform("line", lambda p: F.array(F.bround(p["x"], 6), F.bround(p["y"], 6)))
    props = F.struct(
        F.col("width_m").alias("w"), F.col("blockage_risk").alias("b"), F.col("slope_pct").alias("s"), F.rint("length_m").cast("long").alias("l")
    )
    shape = F.struct(F.lit("LineString").alias("type"), xy.alias("coordinates"))
    one = F.struct(F.lit("Feature").alias("type"), props.alias("properties"), shape.alias("geometry"))
    return edges.filter(F.size("line") >= 2).select("ward", F.to_json(one).alias("feature"))


def write_geojson(found: DataFrame, path: str) -> None:
    """Newline-delimited GeoJSON features under ``path/ward=W``; any number of rows."""
    found.write.mode("overwrite").partitionBy("ward").text(path)


def index_rows(stats: DataFrame) -> DataFrame:
    """(ward, row): the HTML table row of each ward."""
    number = lambda c, k: F.format_string(f"%.{k}f", F.col(c))
    cells = [F.format_number("length_km", 0), number("width_med", 1), number("narrow_pct", 1), number("blockage", 2), number("slope5", 1), number("elev", 1)]
    link = F.format_string('<a href="map_%s.html">%s</a>', F.col("ward"), F.col("ward"))
    return stats.orderBy(F.desc("blockage"), "ward").select(
        "ward", F.concat(F.lit("<tr><td>"), link, *[x for c in cells for x in (F.lit("</td><td>"), F.coalesce(c, F.lit("")))], F.lit("</td></tr>")).alias("row")
    )


def index_page(stats: DataFrame, title: str) -> str:
    """An HTML page with the table of wards (a row per ward, so it goes through the driver)."""
    rows = "\n".join(r["row"] for r in index_rows(stats).collect())
    head = "".join(f"<th>{h}</th>" for h in ("ward", "length km", "median width m", "under 4 m %", "blockage", "over 5 % slope", "median elevation m"))
    return f'<!DOCTYPE html><meta charset="utf-8"><title>{title}</title>\n<h1>{title}</h1>\n<table>\n<tr>{head}</tr>\n{rows}\n</table>\n'
