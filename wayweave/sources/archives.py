"""Nested zip archives of GML as Spark data: discovery by content, member selection, parsed features.

``discover`` lists outer archives with Spark's binary reader and names their inner members;
``read_members`` takes the chosen inner archives out as they are, deals them over all tasks, and
gives one row per XML member, unzipped in memory; nothing is extracted to disk. A task holds one
outer archive while it takes inner ones out, and then one inner archive at a time.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.parsers import expat

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayweave.functions import geom

#: Member names of vector and elevation archives, attributes kept, elements skipped.
VECTOR = r"FG-GML-\d+-\d+-"
VECTOR_PARTS = r"FG-GML-(\d{6})-(\d{2})-"
ELEVATION = r"-DEM\d[A-C]-"
ELEVATION_PARTS = r"FG-GML-(\d{6})-(DEM\d[A-C])-"
SUBMESH = r"FG-GML-\d{4}-\d{2}-(\d)(\d)-DEM"
ATTRIBUTES = ["type", "name", "admCode", "admOffice", "orgGILvl", "vis", "fid"]
SKIP_ELEMENTS = ["fid", "lfSpanFr", "devDate"]
SKIP_FEATURES = ["BldL"]
SKIP_ITEMS = ["01", "11"]
GML = "http://www.opengis.net/gml/3.2"


def discover(spark: SparkSession, *folders: str, pattern: str = VECTOR, required: bool = True) -> DataFrame:
    """(path, member) of the inner archives whose name matches; unreadable archives are left out.

    Raises where no archive holds any, if one is ``required``.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(list(dict.fromkeys(folders)))

    def names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf.path, pdf.content, strict=True):
                try:
                    rows += [(path, n) for n in sorted(zipfile.ZipFile(io.BytesIO(content)).namelist())]
                except zipfile.BadZipFile:
                    continue
            yield pd.DataFrame(rows, columns=["path", "member"])

    found = files.select("path", "content").mapInPandas(names, "path string, member string").filter(F.col("member").rlike(pattern))
    if required and not found.limit(1).count():
        raise FileNotFoundError(f"no archive with members like {pattern}")
    return found


def select_members(members: DataFrame, mesh: list[str] | None = None, item: list[str] | None = None, exclude_item: list[str] | None = None) -> DataFrame:
    """Adds mesh and item from the name and keeps those asked for; items 01 and 11 go unless told otherwise."""
    out = members.withColumns({"mesh": F.regexp_extract("member", VECTOR_PARTS, 1), "item": F.regexp_extract("member", VECTOR_PARTS, 2)})
    out = out.filter("mesh <> ''")
    if mesh:
        out = out.filter(F.col("mesh").isin(mesh))
    if item:
        return out.filter(F.col("item").isin(item))
    return out.filter(~F.col("item").isin(SKIP_ITEMS if exclude_item is None else exclude_item))


def read_members(spark: SparkSession, members: DataFrame, *folders: str) -> DataFrame:
    """(path, member, file, xml): the XML files of the chosen inner archives, metadata files left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(list(dict.fromkeys(folders)))
    wanted = members.groupBy("path").agg(F.collect_set("member").alias("members"))

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content, names in zip(pdf.path, pdf.content, pdf.members, strict=True):
                outer = zipfile.ZipFile(io.BytesIO(content))
                for name in sorted(names):
                    yield pd.DataFrame({"path": [path], "member": [name], "inner": [outer.read(name)]})

    def unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, name, content in zip(pdf.path, pdf.member, pdf.inner, strict=True):
                try:
                    inner = zipfile.ZipFile(io.BytesIO(content))
                except zipfile.BadZipFile:  # as unreadable outer archives, left out
                    continue
                for file in sorted(inner.namelist()):
                    base = file.rsplit("/", 1)[-1]
                    skip = base.startswith("fmdid") or any(f"-{s}-" in base for s in SKIP_FEATURES)
                    if base.endswith(".xml") and not skip:
                        yield pd.DataFrame({"path": [path], "member": [name], "file": [file], "xml": [inner.read(file)]})

    # the list of chosen members is small beside the archives, which must not be shuffled whole
    chosen = files.select("path", "content").join(F.broadcast(wanted), "path").mapInPandas(take, "path string, member string, inner binary")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return chosen.repartition(parts, "path", "member").mapInPandas(unzip, "path string, member string, file string, xml binary")


def _events(xml: bytes):
    return ElementTree.iterparse(io.BytesIO(xml), events=("start", "end"))


def _well_formed(xml: bytes) -> bool:
    parser = expat.ParserCreate()
    try:
        parser.Parse(xml, True)
    except expat.ExpatError:
        return False
    return True


def unreadable_files(files: DataFrame) -> DataFrame:
    """(path, member, file) of XML rows that are not well-formed."""

    def bad(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.loc[[not _well_formed(x) for x in pdf.xml], ["path", "member", "file"]]

    return files.select("path", "member", "file", "xml").mapInPandas(bad, "path string, member string, file string")


def parse_features(files: DataFrame) -> DataFrame:
    """Features of XML rows (member, file, xml): member, file, ftype, seven attributes, kind, line.

    Features are the root's children outside the GML namespace. The first position list, else
    the first position, gives the points; of each attribute the first non-empty value counts.
    Holes and later curve pieces are not read. Features without geometry are dropped, and files
    that are no well-formed XML are left out whole; ``unreadable_files`` names them.
    """
    names = [*ATTRIBUTES, "positions", "position"]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for member, file, xml in zip(pdf.member, pdf.file, pdf.xml, strict=True):
                if not _well_formed(xml):
                    continue
                rows, depth = [], 0
                for event, el in _events(xml):
                    depth += 1 if event == "start" else -1
                    if event == "start" or depth != 1:
                        continue
                    space, _, ftype = el.tag.rpartition("}")
                    if space == "{" + GML or ftype in SKIP_ELEMENTS:
                        continue
                    row = dict.fromkeys(names) | {"member": member, "file": file, "ftype": ftype, "surface": False}
                    for sub in el.iter():
                        space, _, tag = sub.tag.rpartition("}")
                        if space == "{" + GML and tag in ("Surface", "Polygon"):
                            row["surface"] = True
                        elif space == "{" + GML and tag in ("posList", "pos"):
                            key = "positions" if tag == "posList" else "position"
                            row[key] = sub.text if row[key] is None else row[key]
                        elif sub is not el and tag in ATTRIBUTES and sub.text and row[tag] is None:
                            row[tag] = sub.text
                    rows.append(row)
                    el.clear()
                yield pd.DataFrame(rows, columns=["member", "file", "ftype", *names, "surface"])

    shape = ", ".join(f"{c} string" for c in ("member", "file", "ftype", *names)) + ", surface boolean"
    read = files.select("member", "file", "xml").mapInPandas(parse, shape)
    has_list = F.coalesce(F.length("positions") > 0, F.lit(False))
    points = geom.parse_positions(F.when(has_list, F.col("positions")).otherwise(F.coalesce("position", F.lit(""))))
    read = read.withColumn("line", F.filter(points, lambda p: p["x"].isNotNull() & p["y"].isNotNull()))
    kind = F.when(has_list & (F.size("line") < 2), None).otherwise(geom.geometry_of(F.col("line"), F.col("surface") & has_list))
    return read.withColumn("kind", kind).filter("kind IS NOT NULL").drop("positions", "position", "surface")


def parse_elevation(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dem, meta) of elevation XML rows (member, file, xml).

    dem: mesh, kind, row, col, elev, with the north row first; sub-meshes count from the south.
    -9999 is missing. meta: the grid of each mesh and kind.
    """
    text = files.select("member", "file", F.col("xml").cast("string").alias("x"))
    tag = lambda name: F.regexp_extract("x", rf"<(?:\w+:)?{name}>\s*([^<]*?)\s*</", 1)
    pair = lambda c, i: F.split(c, r"\s+")[i]
    part = lambda p, i: F.regexp_extract("file", p, i).cast("int")
    sub = text.filter(F.col("file").rlike(SUBMESH)).select(
        F.regexp_extract("member", ELEVATION_PARTS, 1).alias("mesh"),
        F.regexp_extract("member", ELEVATION_PARTS, 2).alias("kind"),
        part(SUBMESH, 1).alias("r3"), part(SUBMESH, 2).alias("c3"),
        *[pair(tag(t), i).cast("double").alias(n) for t, i, n in (("lowerCorner", 0, "la0"), ("lowerCorner", 1, "lo0"), ("upperCorner", 0, "la1"), ("upperCorner", 1, "lo1"))],
        (pair(tag("high"), 0).cast("int") + 1).alias("nx"), (pair(tag("high"), 1).cast("int") + 1).alias("ny"),
        F.when(tag("startPoint") != "", pair(tag("startPoint"), 0).cast("int")).otherwise(0).alias("sx"),
        F.when(tag("startPoint") != "", pair(tag("startPoint"), 1).cast("int")).otherwise(0).alias("sy"),
        tag("tupleList").alias("body"),
    )
    lines = F.filter(F.split("body", "\n"), lambda s: F.trim(s) != "")
    cells = sub.select("mesh", "kind", "r3", "c3", "nx", "ny", "sx", "sy", F.posexplode(lines).alias("pos", "line"))
    at = F.col("pos") + F.col("sy") * F.col("nx") + F.col("sx")
    value = F.trim(F.substring_index("line", ",", -1)).cast("float")
    dem = cells.filter(at < F.col("nx") * F.col("ny")).select(
        "mesh", "kind",
        ((9 - F.col("r3")) * F.col("ny") + F.floor(at / F.col("nx"))).cast("int").alias("row"),
        (F.col("c3") * F.col("nx") + at % F.col("nx")).cast("int").alias("col"),
        F.nullif(value, F.lit(-9999.0).cast("float")).alias("elev"),
    )
    dlat, dlon = F.col("la1") - F.col("la0"), F.col("lo1") - F.col("lo0")
    own = sub.select("mesh", "kind", "r3", "c3", "nx", "ny", dlat.alias("dlat"), dlon.alias("dlon"), (F.col("la0") - F.col("r3") * dlat).alias("lat0"), (F.col("lo0") - F.col("c3") * dlon).alias("lon0"))
    names = ["nx", "ny", "dlat", "dlon", "lat0", "lon0"]
    first = own.groupBy("mesh", "kind").agg(F.min_by(F.struct(*names), F.struct("r3", "c3")).alias("m")).select("mesh", "kind", "m.*")
    meta = first.withColumns({"lat_span": F.col("dlat") * 10, "lon_span": F.col("dlon") * 10, "rows": F.col("ny") * 10, "cols": F.col("nx") * 10})
    return dem, meta


def member_parts(name: str) -> tuple[str, str] | None:
    """(mesh, item) of a vector archive's member name."""
    m = re.search(VECTOR_PARTS, name)
    return (m[1], m[2]) if m else None
