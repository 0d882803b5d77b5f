"""Nested archives written by the tests: discovery, selection, features, elevation, resumable ingest."""

import io
import zipfile

import pytest

from wayweave.plans import export
from wayweave.sources import archives, layers

FEATURES = """<?xml version="1.0" encoding="UTF-8"?>
<Dataset xmlns="urn:example" xmlns:gml="http://www.opengis.net/gml/3.2">
  <gml:description>x</gml:description>
  <RdEdg gml:id="a"><fid>f1</fid><type>edge</type><loc><gml:Curve><gml:segments><gml:LineStringSegment>
    <gml:posList>35.0 139.0
    35.1 139.1</gml:posList></gml:LineStringSegment></gml:segments></gml:Curve></loc></RdEdg>
  <AdmArea gml:id="b"><name>North</name><admCode>13101</admCode><area><gml:Surface><gml:patches><gml:PolygonPatch>
    <gml:posList>35 139 35 140 36 140 35 139</gml:posList><gml:posList>1 2 3 4 5 6</gml:posList></gml:PolygonPatch></gml:patches></gml:Surface></area></AdmArea>
  <ElevPt gml:id="c"><pos><gml:Point><gml:pos>35.5 139.5</gml:pos></gml:Point></pos></ElevPt>
  <WA gml:id="d"><area><gml:Surface><gml:posList>35 139 35 140 36 140</gml:posList></gml:Surface></area></WA>
  <Void gml:id="e"><type></type></Void>
</Dataset>"""

DEM = """<Dataset xmlns:gml="http://www.opengis.net/gml/3.2"><gml:lowerCorner>35.0 139.0</gml:lowerCorner><gml:upperCorner>35.1 139.2</gml:upperCorner>
<gml:low>0 0</gml:low><gml:high>2 1</gml:high><gml:tupleList>
ground,1.5
ground,-9999.
surface,3.25
ground,4.5
</gml:tupleList><gml:startPoint>1 0</gml:startPoint></Dataset>"""


def packed(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in files.items():
            z.writestr(name, body)
    return out.getvalue()


@pytest.fixture
def folder(tmp_path):
    inner = packed({"FG-GML-533925-RdEdg-1.xml": FEATURES, "FG-GML-533925-BldL-1.xml": FEATURES, "fmdid-1.xml": "<x/>"})
    dem = packed({"FG-GML-5339-25-01-DEM5A-1.xml": DEM})
    names = {"FG-GML-533925-02-1.zip": inner, "FG-GML-533925-11-1.zip": inner, "FG-GML-533926-02-1.zip": inner, "FG-GML-533925-DEM5A-1.zip": dem, "readme.txt": b"x"}
    (tmp_path / "a.zip").write_bytes(packed(names))
    (tmp_path / "broken.zip").write_bytes(b"PK nothing")
    return tmp_path


def test_discovery_and_selection(spark, folder, tmp_path_factory):
    found = archives.discover(spark, str(folder))
    assert {r.member for r in found.collect()} == {"FG-GML-533925-02-1.zip", "FG-GML-533925-11-1.zip", "FG-GML-533926-02-1.zip"}
    pick = lambda **k: {r.member for r in archives.select_members(found, **k).collect()}
    assert pick() == {"FG-GML-533925-02-1.zip", "FG-GML-533926-02-1.zip"}
    assert pick(mesh=["533926"]) == {"FG-GML-533926-02-1.zip"} and pick(item=["11"]) == {"FG-GML-533925-11-1.zip"}
    none = tmp_path_factory.mktemp("none")
    (none / "x.zip").write_bytes(packed({"y": b""}))
    with pytest.raises(FileNotFoundError):
        archives.discover(spark, str(none))


def test_features(spark, folder):
    members = archives.select_members(archives.discover(spark, str(folder)), mesh=["533925"])
    rows = archives.parse_features(archives.read_members(spark, members, str(folder))).collect()
    got = {r.ftype: r for r in rows}
    assert len(rows) == 4 and set(got) == {"RdEdg", "AdmArea", "ElevPt", "WA"}
    assert {k: v.kind for k, v in got.items()} == {"RdEdg": "LineString", "AdmArea": "Polygon", "ElevPt": "Point", "WA": "LineString"}
    assert [(p.x, p.y) for p in got["RdEdg"].line] == [(139.0, 35.0), (139.1, 35.1)] and got["RdEdg"].fid == "f1" and got["RdEdg"].type == "edge"
    assert len(got["AdmArea"].line) == 4 and got["AdmArea"].name == "North" and got["ElevPt"].name is None


def test_malformed_files_are_left_out_and_named(spark, tmp_path):
    inner = packed({"FG-GML-533925-A-1.xml": FEATURES, "FG-GML-533925-B-1.xml": FEATURES[:300], "FG-GML-533925-C-1.xml": ""})
    (tmp_path / "a.zip").write_bytes(packed({"FG-GML-533925-02-1.zip": inner, "FG-GML-533926-02-1.zip": b"no archive"}))
    files = archives.read_members(spark, archives.discover(spark, str(tmp_path)), str(tmp_path))
    assert {r.file for r in archives.parse_features(files).collect()} == {"FG-GML-533925-A-1.xml"}
    assert sorted(r.file for r in archives.unreadable_files(files).collect()) == ["FG-GML-533925-B-1.xml", "FG-GML-533925-C-1.xml"]


def test_elevation(spark, folder):
    members = archives.discover(spark, str(folder), pattern=archives.ELEVATION)
    dem, meta = archives.parse_elevation(archives.read_members(spark, members, str(folder)))
    got = {(r.row, r.col): r.elev for r in dem.collect()}
    # sub-mesh row 0 is the south: block row 9; column 1; 3 by 2 cells, starting at cell 1
    assert got == {(18, 4): 1.5, (18, 5): None, (19, 3): 3.25, (19, 4): 4.5}
    m = meta.first()
    assert (m.mesh, m.kind, m.nx, m.ny, m.rows, m.cols) == ("533925", "DEM5A", 3, 2, 20, 30)
    assert m.lat0 == pytest.approx(35.0) and m.lon0 == pytest.approx(138.8)


def test_ingest_reads_once(spark, folder, tmp_path_factory):
    from wayweave.streaming.ingest import ingest

    base = tmp_path_factory.mktemp("ingest")
    for expected in (8, 8):
        ingest(spark, str(folder), f"{base}/out", f"{base}/state")
        assert spark.read.parquet(f"{base}/out").count() == expected
    (folder / "b.zip").write_bytes((folder / "a.zip").read_bytes())
    ingest(spark, str(folder), f"{base}/out", f"{base}/state")
    assert spark.read.parquet(f"{base}/out").count() == 16


def test_layers_and_export(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "ward string, v int")
    path = str(tmp_path / "layer")
    assert layers.done_keys(spark, path, ["ward"]) is None
    layers.write_layer(df, path, ["ward"])
    layers.write_layer(df.filter("ward = 'a'").withColumn("v", df.v + 10), path, ["ward"])
    assert {(r.ward, r.v) for r in layers.read_layer(spark, path).collect()} == {("a", 11), ("b", 2)}
    assert [r.v for r in layers.read_layer(spark, path, ["v"], ward="b").collect()] == [2]
    more = spark.createDataFrame([("b",), ("c",)], "ward string")
    assert [r.ward for r in layers.not_done(more, layers.done_keys(spark, path, ["ward"]), ["ward"]).collect()] == ["c"]
    stats = spark.createDataFrame([("a", 1234.5, 3.25, 20.0, 0.5, 1.0, None), ("b", 1.0, 4.0, 1.0, 0.7, 2.0, 3.0)], "ward string, length_km double, width_med double, narrow_pct double, blockage double, slope5 double, elev double")
    page = export.index_page(stats, "Wards")
    assert page.index("map_b.html") < page.index("map_a.html") and "<td>1,234</td>" in page
    export.write_csv(stats, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
