"""A toy town from centrelines and archives to costs, slope and reports."""

import io
import math
import zipfile

import pytest
from pyspark.sql import functions as F

from wayweave.functions import cost, crs, geom
from wayweave.operators import graph
from wayweave.plans import stages
from wayweave.plans.manifest import Manifest
from wayweave.sources import layers


def street(x0, y0, x1, y1, width):
    n = int(max(abs(x1 - x0), abs(y1 - y0)))
    at = [(x0 + (x1 - x0) * k / n, y0 + (y1 - y0) * k / n) for k in range(n + 1)]
    return [("w", *a, *b, width) for a, b in zip(at, at[1:], strict=False)]


@pytest.fixture(scope="module")
def town(spark):
    lines = street(0, 0, 40, 0, 6.0) + street(40, 0, 40, 30, 3.0) + street(0, 0, 0, 30, 3.0) + street(0, 30, 40, 30, 5.0) + street(40, 0, 60, 0, 8.0)
    return spark.createDataFrame(lines, "ward string, x0 double, y0 double, x1 double, y1 double, width_m double")


def test_network_and_costs(spark, town, tmp_path):
    nodes, edges = stages.topology(town)
    edges = edges.cache()
    got = {(r.length_m, r.width_m) for r in edges.collect()}
    # one ring from the junction round is dropped; the spur stays
    assert got == {(20.0, 8.0)}
    more = spark.createDataFrame(street(20, 0, 20, -15, 4.0) + street(20, 30, 20, 45, 2.0), town.schema)
    nodes, edges = stages.topology(town.unionAll(more))
    rows = edges.collect()
    assert sum(r.length_m for r in rows) == pytest.approx(40 + 30 + 30 + 40 + 20 + 15 + 15)
    degree = {(r.node): r.degree for r in graph.degrees(edges).collect()}
    assert all(d != 2 for d in degree.values()) and nodes.count() == len(degree)
    for r in rows:
        assert math.dist(r.line[0], r.line[-1]) <= r.length_m + 1e-9
    buildings = spark.createDataFrame([("w", 30.0, 5.0, 200.0), ("w", 10.0, 25.0, 100.0), ("v", 50.0, 0.0, 90.0)], "ward string, x double, y double, area double")
    wall = spark.range(1).select(F.array(geom.point(F.lit(50.0), F.lit(-5.0)), geom.point(F.lit(50.0), F.lit(5.0))).alias("line"))
    full = stages.enrich(edges, buildings, wall, cost.WEIGHTS)
    assert {r.barrier_cross for r in full.filter("length_m = 20 AND width_m = 8").collect()} == {True}
    assert full.filter("barrier_cross").count() == 1
    assert all(r.bld_density in (0.0, pytest.approx(390 / 62500)) and 0 <= r.dist_to_bld <= 50 for r in full.collect())
    # elevation: a plane that rises one metre in ten to the east
    lo = spark.range(1).select(crs.to_degrees(F.lit(-50.0), F.lit(-50.0)).alias("a"), crs.to_degrees(F.lit(100.0), F.lit(100.0)).alias("b")).first()
    n = 300
    meta = spark.createDataFrame([("m", "DEM5A", lo.a.lat, lo.a.lon, lo.b.lat - lo.a.lat, lo.b.lon - lo.a.lon, n, n)], "mesh string, kind string, lat0 double, lon0 double, lat_span double, lon_span double, rows int, cols int")
    dem = spark.range(n * n).select(F.lit("m").alias("mesh"), F.lit("DEM5A").alias("kind"), (F.col("id") / n).cast("int").alias("row"), (F.col("id") % n).cast("int").alias("col"), ((F.col("id") % n) * 0.05).cast("float").alias("elev"))
    sloped = stages.with_slope(full, dem, meta, cost.WEIGHTS)
    by = {(r.length_m, r.width_m): r for r in sloped.collect()}
    assert by[20.0, 8.0].slope_pct == pytest.approx((2.0 - 0.25) / 20 * 100, abs=1.0) and by[15.0, 4.0].slope_pct == 0.0
    layers.write_layer(sloped, str(tmp_path / "edges_sloped"), ["ward"])
    stages.main(["recost", "--root", str(tmp_path)], spark)
    stages.main(["report", "--root", str(tmp_path)], spark)
    summary = spark.read.option("header", True).csv(str(tmp_path / "reports/ward_summary")).first()
    assert float(summary.length_km) == pytest.approx(0.19)
    assert spark.read.text(str(tmp_path / "reports/web")).count() == len(by) or spark.read.text(str(tmp_path / "reports/web")).count() >= 6


def test_clip(spark):
    p = lambda lon, lat: {"x": lon, "y": lat}
    shape = "member string, file string, ftype string, name string, kind string, line array<struct<x:double,y:double>>"
    ring = lambda a, b, c, d: [p(a, b), p(c, b), p(c, d), p(a, d), p(a, b)]
    rows = [
        ("m", "1", "AdmArea", "North", "Polygon", ring(139.70, 35.60, 139.72, 35.62)),
        ("m", "1", "AdmArea", "South", "Polygon", ring(139.70, 35.58, 139.72, 35.60)),
        ("m", "2", "RdEdg", None, "LineString", [p(139.705, 35.605), p(139.706, 35.606)]),
        ("m", "2", "RdEdg", None, "LineString", [p(139.705, 35.595), p(139.705, 35.605)]),
        ("m", "2", "RdEdg", None, "LineString", [p(139.80, 35.605), p(139.81, 35.606)]),
    ]
    features = spark.createDataFrame(rows, shape)
    wards = stages.wards_of(features)
    got = stages.clip(features.filter("ftype = 'RdEdg'"), wards)
    assert sorted(r.ward for r in got.collect()) == ["North", "North"]
    names = spark.createDataFrame([("North",), ("East",)], "name string")
    assert [r.name for r in stages.missing_names(wards, names).collect()] == ["East"]


def packed(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in files.items():
            z.writestr(name, body)
    return out.getvalue()


def ring(a, b, c, d):
    return [(a, b), (c, b), (c, d), (a, d), (a, b)]


#: Kind of feature, its name, whether it is an area, and its points in metres.
TOWN = [
    ("AdmArea", "North", True, ring(-100, -100, 50, 200)),
    ("AdmArea", "North", True, ring(50, -100, 200, 200)),
    *[("RdEdg", None, False, ring(x, y, x + 40, y + 40)) for x in (0, 46) for y in (0, 46)],
    ("BldA", None, True, ring(10, 10, 20, 20)),
    ("WL", None, False, [(43, -50), (43.5, 30)]),
    ("CommBdry", None, False, ring(-5, -5, 95, 95)),
    ("CommPt", "Block A", False, [(30, 60)]),
]


def archives_of(spark):
    """Nested archives of the town and of ground that rises to the east."""
    points = [p for *_, line in TOWN for p in line] + [(-300, -300)]
    at = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "i int, x double, y double")
    deg = [(r.d.lat, r.d.lon) for r in at.select("i", crs.to_degrees(F.col("x"), F.col("y")).alias("d")).orderBy("i").collect()]
    rows, k = [], 0
    for ftype, name, area, line in TOWN:
        text = " ".join(f"{lat:.12f} {lon:.12f}" for lat, lon in deg[k : k + len(line)])
        k += len(line)
        tag = "pos" if len(line) == 1 else "posList"
        shape = f"<gml:{tag}>{text}</gml:{tag}>"
        rows.append(f"<{ftype}>{f'<name>{name}</name>' if name else ''}<g>{f'<gml:Surface>{shape}</gml:Surface>' if area else shape}</g></{ftype}>")
    xml = f"""<D xmlns="urn:example" xmlns:gml="http://www.opengis.net/gml/3.2">{''.join(rows)}</D>"""
    la, lo = deg[-1]
    ground = "\n".join(f"ground,{c * 3.0}" for _ in range(10) for c in range(10))
    dem = f"""<D xmlns:gml="http://www.opengis.net/gml/3.2"><gml:lowerCorner>{la} {lo}</gml:lowerCorner><gml:upperCorner>{la + 0.01} {lo + 0.01}</gml:upperCorner>
<gml:high>9 9</gml:high><gml:tupleList>
{ground}
</gml:tupleList></D>"""
    return {
        "FG-GML-543900-02-1.zip": packed({"FG-GML-543900-All-1.xml": xml, "FG-GML-543900-Bad-1.xml": "<D><RdEdg>"}),
        "FG-GML-543900-DEM5A-1.zip": packed({"FG-GML-5439-00-00-DEM5A-1.xml": dem}),
    }


def test_archives_to_report(spark, tmp_path):
    """Four blocks of 40 m with streets of 6 m between them, through every stage."""
    (tmp_path / "zips").mkdir()
    (tmp_path / "zips/pack.zip").write_bytes(packed(archives_of(spark)))
    root = str(tmp_path / "town")
    run = lambda stage, *more: stages.main([stage, "--root", root, *more], spark)
    read = lambda name: layers.read_layer(spark, f"{root}/{name}")
    for stage in ("parse", "dem"):
        run(stage, "--archives", str(tmp_path / "zips"))
    features = read("features")
    assert features.count() == len(TOWN)
    for stage in ("clip", "width", "layers", "network", "slope", "recost"):
        run(stage)
    lines = read("centrelines")
    assert {r.ward for r in lines.select("ward").distinct().collect()} == {"North"}
    mid = lines.select(((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y"), "width_m")
    street = mid.filter("x BETWEEN 40 AND 46 AND y BETWEEN 8 AND 32").collect()
    assert len(street) >= 20 and all(4 <= r.width_m <= 8 for r in street)
    assert not mid.filter("x BETWEEN 3 AND 37 AND y BETWEEN 3 AND 37").count()
    assert read("road_space").agg(F.sum("area")).first()[0] == pytest.approx(300 * 300 - 4 * 1600, rel=0.01)
    assert sorted((r.ward, round(r.area, -2)) for r in read("blocks").collect()) == [("North", 1600.0)] * 4
    assert [(r.name, round(r.area, -2)) for r in read("districts").collect()] == [("Block A", 10000.0)]
    edges = read("edges_final")
    assert edges.count() >= 5 and edges.filter("barrier_cross").count() >= 1 and edges.filter("slope_pct > 0").count() >= 1
    run("report", "--min-len", "10")
    assert [r.ward for r in spark.read.option("header", True).csv(f"{root}/reports/ward_summary").collect()] == ["North"]
    assert spark.read.text(f"{root}/reports/web").count() == edges.filter("length_m >= 10").count()

    # a second run leaves what is finished unread
    for part in (tmp_path / "town/centrelines").glob("ward=*/*.parquet"):
        part.write_bytes(b"no longer a table")
    before = {r.edge_id for r in read("edges").collect()}
    run("network", "--skip-done")
    run("parse", "--skip-done", "--archives", str(tmp_path / "zips"))
    assert {r.edge_id for r in read("edges").collect()} == before
    with pytest.raises(Exception, match="(?i)parquet|footer|corrupt"):
        run("network")


def test_manifest_knows_empty_keys(spark, tmp_path):
    log = Manifest(spark, str(tmp_path))
    assert log.pending("network", [("a",), ("b",)]) == [("a",), ("b",)]
    log.finish("network", [("a",)])
    log.finish("network", [])
    Manifest(spark, str(tmp_path), 3).finish("network", [("b",)])
    assert log.pending("network", [("a",), ("b",)]) == [("b",)] and log.pending("slope", [("a",)]) == [("a",)]
