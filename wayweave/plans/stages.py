"""The stages from archives to reports, as functions over DataFrames and as a command line.

``python -m wayweave.plans.stages parse|dem|clip|width|layers|network|slope|recost|report ...``
Every stage reads and writes Parquet layers under one root; ``--skip-done`` leaves out keys that
the manifest lists as finished, before their input is read.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayweave.functions import cost, crs, geom
from wayweave.operators import clip as clipping
from wayweave.operators import graph, grid, overlay, polygonize, raster, stats
from wayweave.plans import export
from wayweave.plans.manifest import Manifest
from wayweave.plans.workspace import Workspace
from wayweave.sources import archives, layers

#: Least area of a named block and of a part of road space, and how far past its border a ward's road edges count.
LEAST_BLOCK_M2, LEAST_SPACE_M2, BEYOND = 100.0, 20.0, 50.0
MESH_M, WARD_CELL, BLOCK_CELL = 250.0, 500.0, 200.0


def to_plane(features: DataFrame, line: str = "line") -> DataFrame:
    """Coordinates in metres of a line column in degrees."""
    return features.withColumn(line, F.transform(line, lambda p: crs.to_plane(p["x"], p["y"])))


def wards_of(features: DataFrame, names: list[str] | None = None) -> DataFrame:
    """(name, polygon): the named administrative areas, repaired and dissolved by name.

    A name has one row for each connected part, with the holes that its areas leave.
    """
    named = features.filter("ftype = 'AdmArea' AND kind = 'Polygon' AND name IS NOT NULL")
    if names:
        named = named.filter(F.col("name").isin(names))
    return overlay.dissolve(to_plane(named).select("name", F.array("line").alias("polygon")), WARD_CELL).select("name", "polygon")


def missing_names(wards: DataFrame, names: DataFrame) -> DataFrame:
    """The expected names without an area."""
    return names.join(wards.select("name"), "name", "left_anti")


def clip(features: DataFrame, wards: DataFrame, cell: float = WARD_CELL) -> DataFrame:
    """Features that meet a ward, with the smallest ward name; whole features, in metres.

    A feature that occurs again in its file is one feature; line_id is the SHA-256 of what tells it apart.
    """
    parts = ["member", "file", "ftype", "line"]
    text = F.to_json(F.struct(*parts))
    plane = to_plane(features.dropDuplicates(parts).withColumn("line_id", F.sha2(text.cast("binary"), 256))).withColumnRenamed("name", "label")
    return grid.first_meeting(plane, wards, cell).withColumnsRenamed({"name": "ward", "label": "name"})


def segments_of(layer: DataFrame, key: str = "line_id") -> DataFrame:
    """(seg_id, x0, y0, x1, y1) of a layer's lines; seg_id is the key and the segment's number."""
    parts = grid.segments(layer, key, "line")
    return parts.select(F.concat_ws("/", key, "i").alias("seg_id"), "x0", "y0", "x1", "y1")


def road_edges_of(layer: DataFrame, wards: DataFrame, beyond: float = BEYOND) -> DataFrame:
    """(seg_id, name, x0, y0, x1, y1): parts of road edges inside each ward or up to ``beyond`` metres past its border."""
    segs = segments_of(layer.filter("ftype = 'RdEdg'"))
    return clipping.clip_near(segs, wards, beyond, WARD_CELL) if beyond else clipping.clip_segments(segs, wards, WARD_CELL)


def blocks_of(segs: DataFrame, cell: float = BLOCK_CELL) -> DataFrame:
    """(poly_id, polygon, area): the blocks that segments of road edges enclose, islands taken off."""
    found = polygonize.face_polygons(segs, cell)
    shell = F.to_json(F.col("polygon")[0])
    return found.select(F.sha2(shell.cast("binary"), 256).alias("poly_id"), "polygon", "area")


def road_space(wards: DataFrame, blocks: DataFrame, water: DataFrame | None, cell: float = BLOCK_CELL) -> DataFrame:
    """(name, polygon, area): each ward less its blocks and water, in parts of 20 square metres or more."""
    taken = blocks.select("polygon") if water is None else blocks.select("polygon").unionAll(water.select("polygon"))
    return overlay.difference(wards, taken, cell, least_area=LEAST_SPACE_M2)


def centrelines_for(segs: DataFrame, blocks: DataFrame, water: DataFrame | None, side: float = raster.TILE, pad: float = raster.PAD) -> DataFrame:
    """(x0, y0, x1, y1, width_m) of the streets between blocks; see raster.road_mask."""
    mask = raster.road_mask(segs.select("x0", "y0", "x1", "y1").distinct(), blocks, water)
    tiles = raster.into_tiles(mask, side, pad)
    return raster.centrelines(raster.skeleton_pixels(tiles, int((side + 2 * pad) / raster.PIXEL)), side, pad)


def named_blocks(borders: DataFrame, points: DataFrame, cell: float = BLOCK_CELL) -> DataFrame:
    """(poly_id, polygon, area, name): blocks over 100 square metres that border lines enclose, each with the smallest name of the points in it.

    borders are a layer's lines, points its points with a name; a block without one has null.
    """
    blocks = blocks_of(segments_of(borders), cell).filter(F.col("area") > LEAST_BLOCK_M2)
    at = points.filter("name IS NOT NULL").select(F.col("line_id").alias("point_id"), F.col("line")[0]["x"].alias("x"), F.col("line")[0]["y"].alias("y"), "name")
    held = grid.first_covering(at, blocks.select("poly_id", "polygon"), cell, "poly_id")
    names = held.filter("poly_id IS NOT NULL").groupBy("poly_id").agg(F.min("name").alias("name"))
    return blocks.join(names, "poly_id", "left")


def water_of(layer: DataFrame) -> DataFrame:
    """(poly_id, polygon) of water areas."""
    return layer.filter("ftype = 'WA' AND kind = 'Polygon'").select(F.col("line_id").alias("poly_id"), F.array("line").alias("polygon"))


def in_wards(lines: DataFrame, wards: DataFrame, cell: float = WARD_CELL) -> DataFrame:
    """Centrelines that meet a ward, with the smallest ward name."""
    ends = F.array(geom.point(F.col("x0"), F.col("y0")), geom.point(F.col("x1"), F.col("y1")))
    keyed = lines.withColumns({"line_id": F.concat_ws("/", "x0", "y0", "x1", "y1"), "line": ends})
    return grid.first_meeting(keyed, wards, cell).withColumnRenamed("name", "ward").drop("line", "line_id")


def topology(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of centrelines (ward, x0, y0, x1, y1, width_m); edges carry their simplified line."""
    ends = ["x0", "y0", "x1", "y1"]
    numbered = lines.dropDuplicates(["ward", *ends]).withColumn("seg_id", F.concat_ws("/", *ends))
    ws = Workspace(lines.sparkSession, "topology", release=False)
    kept = ws.save(graph.drop_diagonals(graph.node_segments(numbered)), "kept")
    told = ws.save(graph.chains(kept), "chains")
    edges = graph.contract(kept, told).join(graph.street_lines(kept, told=told), ["ward", "chain"])
    edges = ws.save(edges.withColumn("edge_id", F.xxhash64("ward", "chain")), "edges")
    ws.drop("kept", "chains")
    return graph.nodes_of(edges), edges


def buildings_of(layer: DataFrame) -> DataFrame:
    """(ward, x, y, area) of building polygons: centre and area."""
    shape = F.array("line")
    return layer.filter("kind = 'Polygon'").select("ward", geom.centroid(F.col("line")).alias("c"), geom.polygon_area(shape).alias("area")).select("ward", "c.x", "c.y", "area")


def barriers_of(water: DataFrame, rail: DataFrame) -> DataFrame:
    """(barrier_type, line) of water and rail lines."""
    return water.select(F.lit("water").alias("barrier_type"), "line").unionAll(rail.select(F.lit("rail").alias("barrier_type"), "line"))


def enrich(edges: DataFrame, buildings: DataFrame, barriers: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Adds nearest building (same ward), density, crossings and costs; slope starts at 0."""
    mid = geom.midpoint(F.col("line"))
    keyed = edges.withColumns({"point_id": F.col("edge_id"), "line_id": F.col("edge_id"), "x": mid["x"], "y": mid["y"]})
    near = grid.nearest_capped(keyed, buildings, 50.0, ["ward"]).withColumnRenamed("dist", "dist_to_bld")
    dense = stats.density_at(near, stats.mesh_density(buildings, MESH_M), MESH_M)
    flagged = grid.crossing_flag(dense, barriers, MESH_M)
    return cost.add_costs(flagged.withColumn("slope_pct", F.lit(0.0)).drop("point_id", "line_id", "x", "y"), weights)


#: Kinds of elevation grids, the finest first.
KINDS = ["DEM5A", "DEM5B", "DEM5C"]


def elevation_points(edges: DataFrame) -> DataFrame:
    """(point_id, lat, lon): both ends of each edge; point_id is the edge_id and 0 or 1."""
    end = lambda p, k: F.struct(F.concat_ws("/", F.col("edge_id").cast("string"), F.lit(k)).alias("point_id"), crs.to_degrees(p["x"], p["y"]).alias("d"))
    line = F.col("line")
    ends = edges.select(F.explode(F.array(end(geom.first_point(line), "0"), end(geom.last_point(line), "1"))).alias("e"))
    return ends.select("e.point_id", F.col("e.d.lat").alias("lat"), F.col("e.d.lon").alias("lon"))


def with_slope(edges: DataFrame, dem: DataFrame, meta: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Slope and elevation from both ends, and the costs anew; each kind is read on its own grid."""
    high = raster.sample_elevation(elevation_points(edges), meta, dem, KINDS).select("point_id", "elev")
    at = lambda k: high.filter(F.col("point_id").endswith(f"/{k}")).select(F.substring_index("point_id", "/", 1).cast("long").alias("edge_id"), F.col("elev").alias(f"h{k}"))
    met = edges.drop("slope_pct", "elev_m").join(at(0), "edge_id", "left").join(at(1), "edge_id", "left")
    h0, h1 = F.col("h0"), F.col("h1")
    met = met.withColumns({"slope_pct": cost.slope_pct(h0, h1, F.col("length_m")), "elev_m": cost.elevation(h0, h1)}).drop("h0", "h1")
    return cost.add_costs(met.drop("blockage_risk", *cost.COSTS), weights)


def report(edges: DataFrame, out: str, min_len: float = 0.0) -> None:
    """Summary CSV, web features of streets of ``min_len`` metres or more, and the index page's rows."""
    found = stats.ward_stats(edges)
    export.write_csv(stats.ward_summary(found), f"{out}/ward_summary")
    degrees = edges.filter(F.col("length_m") >= min_len).withColumn("line", F.transform("line", lambda p: _lonlat(p)))
    simple = graph.simplify_lines(degrees, "line", 3.0 / 111000.0).drop("line").withColumnRenamed("simple", "line")
    export.write_geojson(export.features(simple), f"{out}/web")
    export.index_rows(found).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{out}/index")


def _lonlat(p: Column) -> Column:
    d = crs.to_degrees(p["x"], p["y"])
    return geom.point(d["lon"], d["lat"])


def weights_from(path: str | None) -> dict[str, float]:
    """Weights of a JSON file over the defaults; keys that begin with an underscore are comments."""
    if not path:
        return dict(cost.WEIGHTS)
    with open(path, encoding="utf-8") as f:
        return cost.WEIGHTS | {k: float(v) for k, v in json.load(f).items() if not k.startswith("_")}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    ap = argparse.ArgumentParser(prog="wayweave")
    ap.add_argument("stage", choices=["parse", "dem", "clip", "width", "layers", "network", "slope", "recost", "report"])
    ap.add_argument("--root", required=True, help="folder of the layers")
    ap.add_argument("--archives", nargs="*", default=[], help="folders of zip archives")
    ap.add_argument("--mesh", nargs="*")
    ap.add_argument("--item", nargs="*")
    ap.add_argument("--exclude-item", nargs="*")
    ap.add_argument("--ward", nargs="*")
    ap.add_argument("--part", choices=["blocks", "space", "lines", "all"], default="all", help="what the width stage makes")
    ap.add_argument("--min-len", type=float, default=0.0, help="shortest street of the web features, in metres")
    ap.add_argument("--weights")
    ap.add_argument("--skip-done", action="store_true")
    ap.add_argument("--tag", type=int, help="version of the written layers")
    a = ap.parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    log = Manifest(spark, a.root, a.tag)
    at = lambda name: f"{a.root}/{name}"
    where = lambda name: at(name) if a.tag is None else f"{at(name)}/version={a.tag}"
    read = lambda name: layers.read_layer(spark, where(name))
    save = lambda df, name, by: layers.write_layer(df, at(name), by, a.tag)

    def wards_todo(stage: str, known: list[str]) -> list[str]:
        asked = [w for w in known if not a.ward or w in a.ward]
        return [k[0] for k in log.pending(stage, [(w,) for w in asked])] if a.skip_done else asked

    def of_wards(stage: str, name: str) -> tuple[list[str], DataFrame | None]:
        """The wards to do, and the layer's partitions of these; no file is opened where there are none."""
        todo = wards_todo(stage, layers.partition_values(spark, where(name), "ward"))
        return todo, layers.read_parts(spark, where(name), "ward", todo) if todo else None

    if a.stage in ("parse", "dem"):
        vector = a.stage == "parse"
        pattern, parts, by = (archives.VECTOR, archives.VECTOR_PARTS, ["mesh", "item"]) if vector else (archives.ELEVATION, archives.ELEVATION_PARTS, ["mesh", "kind"])
        members = archives.discover(spark, *a.archives, pattern=pattern)
        names = {c: F.regexp_extract("member", parts, i + 1) for i, c in enumerate(by)}
        members = archives.select_members(members, a.mesh, a.item, a.exclude_item) if vector else members.withColumns(names)
        keys = [tuple(r) for r in members.select(*by).distinct().collect()]  # a few an archive
        todo = log.pending(a.stage, keys) if a.skip_done else keys
        if not todo:
            return
        members = members.join(F.broadcast(spark.createDataFrame(todo, ", ".join(f"{c} string" for c in by))), by, "left_semi")
        files = archives.read_members(spark, members, *a.archives)
        if vector:
            save(archives.parse_features(files).withColumns(names), "features", ["ftype", *by])
        else:
            dem, meta = archives.parse_elevation(files)
            save(dem.repartition("mesh", "kind").sortWithinPartitions("mesh", "kind", "row", "col"), "elevation", by)
            save(meta, "elevation_grids", by)
        log.finish(a.stage, todo)
    elif a.stage == "clip":
        features = read("features")
        known = [r.name for r in features.filter("ftype = 'AdmArea' AND name IS NOT NULL").select("name").distinct().collect()]  # ward names
        if todo := wards_todo("clip", known):
            save(clip(features, wards_of(features, todo)), "layer", ["ftype", "ward"])
            log.finish("clip", [(w,) for w in todo])
    elif a.stage == "width":
        todo, layer = of_wards(f"width/{a.part}", "layer")
        if not todo:
            return
        ws = Workspace(spark, "width", release=False)
        wards, water = ws.save(wards_of(read("features"), todo), "wards"), water_of(layer)
        if a.part in ("blocks", "space", "all"):
            blocks = ws.save(blocks_of(ws.save(road_edges_of(layer, wards, 0.0), "inner")), "blocks")
            if a.part != "blocks":
                save(road_space(wards, blocks, water).withColumnRenamed("name", "ward"), "road_space", ["ward"])
            own = blocks.withColumn("p", geom.inner_point(F.col("polygon")[0])).withColumns({"point_id": F.col("poly_id"), "x": F.col("p.x"), "y": F.col("p.y")})
            save(grid.first_covering(own, wards.withColumnRenamed("name", "ward"), WARD_CELL, "ward").select("poly_id", "polygon", "area", "ward"), "blocks", ["ward"])
        if a.part in ("lines", "all"):
            lines = ws.save(centrelines_for(road_edges_of(layer, wards), read("blocks"), water), "lines")
            save(in_wards(lines, wards), "centrelines", ["ward"])
        log.finish(f"width/{a.part}", [(w,) for w in todo])
    elif a.stage == "layers":
        if a.skip_done and not log.pending("layers", [("*",)]):  # meshes and blocks go across wards
            return
        known = layers.partition_values(spark, where("layer"), "ward")
        layer = layers.read_parts(spark, where("layer"), "ward", [w for w in known if not a.ward or w in a.ward])
        of = lambda *kinds: layer.filter(F.col("ftype").isin(*kinds))
        save(stats.mesh_density(buildings_of(of("BldA"))).withColumn("part", F.floor(F.col("mesh_x") / 100)), "density", ["part"])
        for border, point, name in (("CommBdry", "CommPt", "districts"), ("SBBdry", "SBAPt", "blocks_named")):
            save(named_blocks(of(border), of(point)), name, [])
        save(barriers_of(of("WL"), of("RailCL")), "barriers", ["barrier_type"])
        log.finish("layers", [("*",)])
    elif a.stage == "network":
        todo, lines = of_wards("network", "centrelines")
        if todo:
            nodes, edges = topology(lines)
            buildings = layers.read_parts(spark, where("layer"), "ward", todo).filter("ftype = 'BldA'")
            save(nodes, "nodes", ["ward"])
            save(enrich(edges, buildings_of(buildings), read("barriers"), weights_from(a.weights)), "edges", ["ward"])
            log.finish("network", [(w,) for w in todo])
    elif a.stage == "slope":
        todo, edges = of_wards("slope", "edges")
        if todo:
            meta = read("elevation_grids")
            meshes = [r.mesh for r in raster.elevation_cells(elevation_points(edges), meta).select("mesh").distinct().collect()]  # those the streets lie in
            dem = layers.read_parts(spark, where("elevation"), "mesh", meshes)
            save(with_slope(edges, dem, meta, weights_from(a.weights)), "edges_sloped", ["ward"])
            log.finish("slope", [(w,) for w in todo])
    elif a.stage == "recost":
        todo, edges = of_wards("recost", "edges_sloped")
        if todo:
            save(cost.add_costs(edges.drop("blockage_risk", *cost.COSTS), weights_from(a.weights)), "edges_final", ["ward"])
            log.finish("recost", [(w,) for w in todo])
    else:
        wards = layers.partition_values(spark, where("edges_final"), "ward")
        report(layers.read_parts(spark, where("edges_final"), "ward", [w for w in wards if not a.ward or w in a.ward]), at("reports"), a.min_len)


if __name__ == "__main__":
    main()
