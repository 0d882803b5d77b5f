"""Raster operators on sparse pixels (tile, iy, ix): masks, distance, thinning, centrelines, elevation.

Rows of iy go down from the tile's upper edge. A tile is a bounded group (its side and padding
are parameters), so per-tile numpy is a safe unit of work; relational forms are used elsewhere.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayweave.functions import geom
from wayweave.functions.numeric import round_scaled

#: Pixel, tile side, padding, widest street, reach of road edges and of bridges, in metres.
PIXEL, TILE, PAD, WIDEST, NEAR, BRIDGE = 1.0, 2000.0, 60.0, 50.0, 25.0, 6.0
#: Rows of a band in which distances go down columns, without the overlaps.
BAND = 256
#: Pixels of a row that a word holds as bits.
WORD = 64
#: East, south, south-east, south-west.
FORWARD = [(0, 1), (1, 0), (1, 1), (1, -1)]


def tile_grid(bounds: DataFrame, side: float = TILE) -> DataFrame:
    """(tx, ty, x0, y0) of the tiles over the bounds (x0, y0, x1, y1) of a layer."""
    n = lambda a, b: F.greatest(F.ceil((F.col(b) - F.col(a)) / side), F.lit(1))
    grid = bounds.select("*", F.explode(F.sequence(F.lit(0), n("x0", "x1") - 1)).alias("tx"))
    grid = grid.select("*", F.explode(F.sequence(F.lit(0), n("y0", "y1") - 1)).alias("ty"))
    return grid.select("tx", "ty", (F.col("x0") + F.col("tx") * side).alias("x0"), (F.col("y0") + F.col("ty") * side).alias("y0"))


def pixel_point(ix: Column, iy: Column, left: Column, top: Column, pixel: float = PIXEL) -> Column:
    """Centre of a pixel in the world; y falls as iy grows."""
    return geom.point(left + (ix + 0.5) * pixel, top - (iy + 0.5) * pixel)


def border_edges(polygons: DataFrame) -> DataFrame:
    """(poly_id, ax, ay, bx, by): the edges of all rings of polygons (poly_id, polygon)."""
    ring = F.explode("polygon")
    edges = polygons.select("poly_id", ring.alias("ring"))
    n = F.size("ring")
    edges = edges.filter(n >= 2).select("poly_id", "ring", F.explode(F.sequence(F.lit(1), n - 1)).alias("i"))
    a, b = F.element_at("ring", F.col("i")), F.element_at("ring", F.col("i") + 1)
    return edges.select("poly_id", a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by"))


def _spans(polygons: DataFrame, pixel: float) -> DataFrame:
    """(poly_id, py, start, stop): runs of pixels whose centre lies in the polygon; see ``rasterise``."""
    edges = (polygons if "ax" in polygons.columns else border_edges(polygons)).filter("ay <> by")
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    first = F.ceil(low / pixel - 0.5)
    last = F.ceil(high / pixel - 0.5) - 1
    cuts = edges.filter(last >= first).select("poly_id", "ax", "ay", "bx", "by", F.explode(F.sequence(first, last)).alias("py"))
    height = (F.col("py") + 0.5) * pixel
    at = F.col("ax") + (F.col("bx") - F.col("ax")) * (height - F.col("ay")) / (F.col("by") - F.col("ay"))
    cuts = cuts.select("poly_id", "py", at.alias("x"))
    row = Window.partitionBy("poly_id", "py").orderBy("x")
    spans = cuts.withColumns({"k": F.row_number().over(row), "to": F.lead("x").over(row)}).filter("k % 2 = 1 AND to IS NOT NULL")
    start, stop = F.ceil(F.col("x") / pixel - 0.5), F.ceil(F.col("to") / pixel - 0.5) - 1
    return spans.filter(stop >= start).select("poly_id", F.col("py").cast("long").alias("py"), start.alias("start"), stop.alias("stop"))


def rasterise(polygons: DataFrame, pixel: float = PIXEL) -> DataFrame:
    """(poly_id, px, py): world pixels whose centre lies in the polygon.

    polygons have poly_id and polygon, or are border edges in any order. Each row of pixels is
    cut by the border at its centre height; pixels between odd and even cuts are inside. Pixels
    are listed per scan line, so the work follows the polygon's area.
    """
    return _spans(polygons, pixel).select("poly_id", F.explode(F.sequence("start", "stop")).alias("px"), "py")


def _filled_words(polygons: DataFrame, pixel: float) -> DataFrame:
    """(wx, py, bits): pixels in any of the polygons, as words."""
    words = _spans(polygons, pixel).select("py", "start", "stop", F.explode(F.sequence(F.floor(F.col("start") / WORD), F.floor(F.col("stop") / WORD))).alias("wx"))
    low, high = f"cast(greatest(start - wx * {WORD}, 0) as int)", f"cast({WORD - 1} - least(stop - wx * {WORD}, {WORD - 1}) as int)"
    return words.groupBy("wx", "py").agg(F.bit_or(F.expr(f"shiftleft(-1L, {low}) & shiftrightunsigned(-1L, {high})")).alias("bits"))


def _near_words(segs: DataFrame, reach: float, pixel: float) -> DataFrame:
    """(wx, py, bits): ``near_pixels`` as words, so that what is kept and sent is a word and not its pixels."""
    ends = ("x0", "y0", "x1", "y1")
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    steps = F.greatest(F.ceil(F.sqrt(dx * dx + dy * dy) / (4.0 * reach + 8.0 * pixel)), F.lit(1))
    parts = segs.select(*ends, steps.alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), steps - 1)).alias("k"))
    at = lambda c, d, k: F.col(c) + d * (k / F.col("n"))
    lo = lambda c, d: F.floor((F.least(at(c, d, F.col("k")), at(c, d, F.col("k") + 1)) - reach) / pixel) - 1
    hi = lambda c, d: F.floor((F.greatest(at(c, d, F.col("k")), at(c, d, F.col("k") + 1)) + reach) / pixel) + 1
    wide = parts.select(*ends, lo("y0", dy).alias("low"), hi("y0", dy).alias("high"), F.explode(F.sequence(lo("x0", dx), hi("x0", dx))).alias("px"))
    wide = wide.select(*ends, "px", F.explode(F.sequence("low", "high")).alias("py"))
    d = geom.to_segment((F.col("px") + 0.5) * pixel, (F.col("py") + 0.5) * pixel, [F.col(c) for c in ends])
    word = F.floor(F.col("px") / WORD).alias("wx")
    return wide.filter(d <= reach).groupBy(word, "py").agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(px, {WORD}) as int))")).alias("bits"))


def _pixels(words: DataFrame) -> DataFrame:
    """(px, py) of the words (wx, py, bits)."""
    each = words.select("wx", "py", "bits", F.explode(F.sequence(F.lit(0), F.lit(WORD - 1))).alias("i")).filter("shiftright(bits, i) & 1 = 1")
    return each.select((F.col("wx") * WORD + F.col("i")).alias("px"), "py")


def _without(words: DataFrame, other: DataFrame) -> DataFrame:
    """(wx, py, bits): the pixels of the words that the other words do not have."""
    met = words.join(other.withColumnRenamed("bits", "less"), ["wx", "py"], "left")
    return met.select("wx", "py", F.expr("bits & ~coalesce(less, 0L)").alias("bits")).filter("bits <> 0")


def near_pixels(segs: DataFrame, reach: float, pixel: float = PIXEL) -> DataFrame:
    """(px, py): world pixels whose centre is within reach of a segment (x0, y0, x1, y1).

    A segment is gone along in steps of a few reaches, so a long diagonal lists the pixels beside
    it, not those of its box; each is held against the whole segment.
    """
    return _pixels(_near_words(segs, reach, pixel))


def road_mask(road_edges: DataFrame, blocks: DataFrame, water: DataFrame | None = None, pixel: float = PIXEL) -> DataFrame:
    """(px, py) of street space: near a road edge, in no block, in no water unless a bridge.

    road_edges are segments, blocks and water polygons or border edges (see rasterise). Water
    stays where a road edge is within the bridge reach. Masks meet as words of pixels.
    """
    mask = _without(_near_words(road_edges, NEAR, pixel), _filled_words(blocks, pixel))
    if water is not None:
        wet = _without(_filled_words(water, pixel), _near_words(road_edges, BRIDGE, pixel))
        mask = _without(mask, wet)
    return _pixels(mask)


def into_tiles(mask: DataFrame, side: float = TILE, pad: float = PAD, pixel: float = PIXEL) -> DataFrame:
    """(tx, ty, ix, iy, ...): world pixels (px, py, ...) in each tile they fall into, padding included."""
    n, p = int(side / pixel), int(pad / pixel)
    span = lambda c: F.sequence(F.floor((F.col(c) - p) / n), F.floor((F.col(c) + p) / n))
    rest = [c for c in mask.columns if c not in ("px", "py")]
    tiles = mask.select("*", F.explode(span("px")).alias("tx")).select("*", F.explode(span("py")).alias("ty"))
    ix = F.col("px") - F.col("tx") * n + p
    iy = F.lit(n + p - 1) - (F.col("py") - F.col("ty") * n)
    return tiles.select("tx", "ty", ix.cast("int").alias("ix"), iy.cast("int").alias("iy"), *rest).filter(f"ix BETWEEN 0 AND {n + 2 * p - 1} AND iy BETWEEN 0 AND {n + 2 * p - 1}")


def distance_rows(mask: DataFrame, reach: int) -> DataFrame:
    """(tile, iy, ix, dist): distance of true pixels to the nearest false one, in pixels, relationally.

    mask has tile, iy, ix and on, with a row for every pixel of a tile. First along rows, by the last and next false pixel; then down
    columns, as the least over ``reach`` rows each way, in bands of rows that overlap by the reach. Distances beyond reach are left out.
    """
    row = Window.partitionBy("tile", "iy").orderBy("ix")
    back = row.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = row.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    off = F.when(~F.col("on"), F.col("ix"))
    flat = mask.select("tile", "iy", "ix", "on").withColumns({"a": F.last(off, ignorenulls=True).over(back), "b": F.first(off, ignorenulls=True).over(ahead)})
    g = F.least(F.col("ix") - F.col("a"), F.col("b") - F.col("ix"))
    flat = flat.select("tile", "iy", "ix", "on", F.when(g <= reach, g * g).alias("g2"))
    high = BAND + 2 * reach
    bands = F.sequence(F.floor((F.col("iy") - reach) / high), F.floor((F.col("iy") + reach) / high))
    banded = flat.select("*", F.explode(bands).alias("band"))
    column = Window.partitionBy("tile", "band", "ix").orderBy("iy")
    # every row of a column is there, so the k-th row before or behind is k pixels away
    near = [F.col("g2"), *[step("g2", k).over(column) + k * k for k in range(1, reach + 1) for step in (F.lag, F.lead)]]
    best = banded.withColumn("d2", F.least(*near) if reach else F.col("g2")).filter(F.col("on") & (F.floor(F.col("iy") / high) == F.col("band")))
    return best.filter(F.col("d2") <= reach * reach).select("tile", "iy", "ix", F.sqrt("d2").alias("dist"))


def edt(mask: np.ndarray) -> np.ndarray:
    """Distance of true pixels to the nearest false pixel; infinite without one. Exact, linear in the pixels.

    Columns first, by the last and the next false pixel. Then along rows, all rows at once: the
    squared distance at x is the least of the parabolas that stand on the row's pixels, whose
    lower envelope is built from left to right and then read off.
    """
    ny, nx = mask.shape
    big = np.float64(1e12)
    g = np.where(mask, big, 0.0)
    for order in (range(1, ny), range(ny - 2, -1, -1)):
        step = -1 if order.step == 1 else 1
        for y in order:
            g[y] = np.minimum(g[y], g[y + step] + 1)
    g = np.where(g >= big, big, g * g)
    feet, starts = np.zeros((ny, nx), np.int32), np.full((ny, nx + 1), np.inf)
    starts[:, 0] = -np.inf
    rows, top = np.arange(ny), np.zeros(ny, np.int64)
    for x in range(1, nx):
        meet, todo = np.empty(ny), rows
        while len(todo):  # take off parabolas that the new one hides
            foot = feet[todo, top[todo]]
            at = (g[todo, x] + x * x - g[todo, foot] - foot.astype(np.float64) ** 2) / (2.0 * (x - foot))
            meet[todo] = at
            todo = todo[at <= starts[todo, top[todo]]]
            top[todo] -= 1
        top += 1
        feet[rows, top], starts[rows, top] = x, meet
    for y in rows[top < nx - 1]:
        starts[y, top[y] + 1 :] = np.inf
    out, at = np.empty((ny, nx)), np.zeros(ny, np.int64)
    for x in range(nx):
        todo = rows
        while len(todo):
            todo = todo[starts[todo, at[todo] + 1] < x]
            at[todo] += 1
        foot = feet[rows, at]
        out[:, x] = g[rows, foot] + (x - foot.astype(np.float64)) ** 2
    return np.where(out >= big, np.inf, np.sqrt(out)) * mask


def thin(mask: np.ndarray) -> np.ndarray:
    """Skeleton by Zhang and Suen's two sub-passes."""
    img = np.pad(mask.astype(np.uint8), 1)
    while True:
        gone = 0
        for odd in (0, 1):
            p = [img[:-2, 1:-1], img[:-2, 2:], img[1:-1, 2:], img[2:, 2:], img[2:, 1:-1], img[2:, :-2], img[1:-1, :-2], img[:-2, :-2]]
            count = sum(p)
            turns = sum(((p[i] == 0) & (p[(i + 1) % 8] == 1)).astype(np.uint8) for i in range(8))
            n, e, s, w = p[0], p[2], p[4], p[6]
            sides = (n * e * s == 0) & (e * s * w == 0) if not odd else (n * e * w == 0) & (n * s * w == 0)
            drop = (img[1:-1, 1:-1] == 1) & (count >= 2) & (count <= 6) & (turns == 1) & sides
            gone += int(drop.sum())
            img[1:-1, 1:-1][drop] = 0
        if not gone:
            return img[1:-1, 1:-1].astype(bool)


def skeleton_pixels(tiles: DataFrame, size: int) -> DataFrame:
    """(tx, ty, ix, iy, width_px): thinned pixels of each tile with twice their distance."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        mask = np.zeros((size, size), bool)
        mask[pdf.iy, pdf.ix] = True
        dist, skeleton = edt(mask), thin(mask)
        iy, ix = np.nonzero(skeleton)
        return pd.DataFrame({"tx": pdf.tx.iloc[0], "ty": pdf.ty.iloc[0], "ix": ix, "iy": iy, "width_px": 2 * dist[iy, ix]})

    return tiles.groupBy("tx", "ty").applyInPandas(run, "tx long, ty long, ix int, iy int, width_px double")


def adjacent_pixels(pixels: DataFrame, tile: list[str], value: str) -> DataFrame:
    """Pairs of neighbouring pixels, each once: (tile..., iy, ix, dy, dx, a, b) with both values."""
    steps = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in FORWARD])
    here = pixels.select(*tile, "iy", "ix", F.col(value).alias("a"), F.explode(steps).alias("s"))
    here = here.select(*tile, "iy", "ix", "a", "s.dy", "s.dx", (F.col("iy") + F.col("s.dy")).alias("jy"), (F.col("ix") + F.col("s.dx")).alias("jx"))
    there = pixels.select(*tile, F.col("iy").alias("jy"), F.col("ix").alias("jx"), F.col(value).alias("b"))
    return here.join(there, [*tile, "jy", "jx"]).drop("jy", "jx")


def centrelines(skeleton: DataFrame, side: float = TILE, pad: float = PAD, pixel: float = PIXEL) -> DataFrame:
    """(x0, y0, x1, y1, width_m) of the skeleton's pixel pairs.

    A pair belongs to the tile whose core holds its midpoint, lower and left borders included;
    wider pairs than the widest street are no street.
    """
    pairs = adjacent_pixels(skeleton, ["tx", "ty"], "width_px")
    left = F.col("tx") * side - pad
    top = F.col("ty") * side + side + pad
    a = pixel_point(F.col("ix"), F.col("iy"), left, top, pixel)
    b = pixel_point(F.col("ix") + F.col("dx"), F.col("iy") + F.col("dy"), left, top, pixel)
    width = (F.col("a") + F.col("b")) / 2.0 * pixel
    lines = pairs.select("tx", "ty", a.alias("p"), b.alias("q"), width.alias("w"))
    mx, my = (F.col("p.x") + F.col("q.x")) / 2.0, (F.col("p.y") + F.col("q.y")) / 2.0
    core = (mx >= F.col("tx") * side) & (mx < (F.col("tx") + 1) * side) & (my >= F.col("ty") * side) & (my < (F.col("ty") + 1) * side)
    return lines.filter(core & (F.col("w") <= WIDEST)).select(
        F.col("p.x").alias("x0"), F.col("p.y").alias("y0"), F.col("q.x").alias("x1"), F.col("q.y").alias("y1"), round_scaled(F.col("w"), 1).alias("width_m")
    )


def dem_cell(lat: Column, lon: Column, lat0: Column, lon0: Column, lat_span: Column, lon_span: Column, rows: Column, cols: Column) -> Column:
    """struct(row, col) of a place in a mesh's grid, north row first, truncated and clipped."""
    r = ((lat0 + lat_span - lat) / lat_span * rows).cast("long")
    c = ((lon - lon0) / lon_span * cols).cast("long")
    inside = lambda v, n: F.least(F.greatest(v, F.lit(0)), n - 1).cast("int")
    return F.struct(inside(r, rows).alias("row"), inside(c, cols).alias("col"))


def sample_elevation(points: DataFrame, meta: DataFrame, dem: DataFrame, kinds: list[str]) -> DataFrame:
    """Adds elev to points (point_id, lat, lon): the first kind with a value, in the first mesh that has one.

    meta is one row per mesh, or per mesh and kind where kinds differ in their grids, met by whole
    degrees; dem has mesh, kind, row, col, elev. Meshes count in order of their id.
    """
    cols = ["lat0", "lon0", "lat_span", "lon_span", "rows", "cols"]
    met = elevation_cells(points, meta.select("mesh", *cols, *[c for c in ("kind",) if c in meta.columns]))
    keys = [c for c in ("mesh", "kind", "row", "col") if c in met.columns]
    rank = F.array_position(F.array(*map(F.lit, kinds)), F.col("kind"))
    values = dem.filter(F.col("elev").isNotNull() & F.col("kind").isin(kinds)).withColumn("rank", rank)
    found = met.join(values, keys).groupBy("point_id").agg(F.min_by("elev", F.struct("mesh", "rank")).alias("elev"))
    return points.join(found, "point_id", "left")


def elevation_cells(points: DataFrame, meta: DataFrame) -> DataFrame:
    """(point_id, mesh, kind, row, col): the grid cells that hold each point; without kind if meta has none."""
    cols = ["lat0", "lon0", "lat_span", "lon_span", "rows", "cols"]
    own = points.select("point_id", "lat", "lon", F.floor("lat").alias("dlat"), F.floor("lon").alias("dlon"))
    deg = lambda a, s: F.explode(F.sequence(F.floor(a), F.floor(F.col(a) + F.col(s))))
    tiles = meta.withColumn("dlat", deg("lat0", "lat_span")).withColumn("dlon", deg("lon0", "lon_span"))
    inside = (F.col("lat") >= F.col("lat0")) & (F.col("lat") < F.col("lat0") + F.col("lat_span")) & (F.col("lon") >= F.col("lon0")) & (F.col("lon") < F.col("lon0") + F.col("lon_span"))
    met = own.join(tiles, ["dlat", "dlon"]).filter(inside)
    keys = ["point_id", "mesh", *[c for c in ("kind",) if c in meta.columns]]
    return met.select(*keys, dem_cell(*[F.col(c) for c in ("lat", "lon", *cols)]).alias("at")).select(*keys, "at.row", "at.col")
