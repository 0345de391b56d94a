"""Queries on regions, grids, resampling, mosaics and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from rasterloom.functions import grid as grids
from rasterloom.functions import projection
from rasterloom.functions.grid import Grid
from rasterloom.functions.polygon import box_ring, ring_area
from rasterloom.operators import blocks as block_ops, footprints, masks as mask_ops, mosaic, regions as region_ops, resample, scenes as scene_ops, spatial
from rasterloom.plans import fixtures as fx
from rasterloom.plans.oracle_geo import lonlat_to_polar, polar_to_utm, utm_to_polar
from rasterloom.plans.registry import query
from rasterloom.plans.rounding import NUDGE, steady

SRC = Grid(0.0, 800.0, 100.0, fx.WIDTH, fx.HEIGHT)
SHIFTED = Grid(25.0, 775.0, 100.0, fx.WIDTH, fx.HEIGHT)
FINER = Grid(-20.0, 820.0, 60.0, 7, 14)
REGION = ("region", "area_km2", "xmin", "ymin", "xmax", "ymax", "utm_grid")


@query("scan_aoi_regions", f"SELECT {', '.join(REGION)} FROM reg", ["reg"])
def _(spark, d):
    return region_ops.scan_aoi_regions(fx.regions(spark, d)).select(*REGION)


@query("order_regions", "SELECT region FROM reg ORDER BY region LIMIT 15 OFFSET 5", ["reg"])
def _(spark, d):
    return region_ops.order_regions(fx.regions(spark, d), 5, 20).select("region")


@query("filter_regions", """
    SELECT region, area_km2 FROM (SELECT * FROM reg WHERE area_km2 >= 300 AND area_km2 < 2300 ORDER BY region LIMIT 13 OFFSET 2)
    WHERE region NOT IN ('007_NATION_7', '010_NATION_10')""", ["reg"])
def _(spark, d):
    return region_ops.filter_regions(
        fx.regions(spark, d), min_area=300, max_area=2300, start=2, end=15, ignore=["007_NATION_7", "010_NATION_10"]
    ).select("region", "area_km2")


@query("join_public_id", """
    SELECT l.field_id, l.iy, l.ix, r.region, 'P' || substr(r.region, 1, 3) AS public_id FROM li l JOIN reg r ON r.region = l.region""",
    ["li", "reg"])
def _(spark, d):
    names = fx.regions(spark, d).select(
        F.col("region").alias("internal_processing_ID"), F.concat(F.lit("P"), F.substring("region", 1, 3)).alias("ID"))
    return region_ops.join_public_id(fx.stack(spark, d), names).select("field_id", "iy", "ix", "region", "public_id")


@query("grid_spec", """
    SELECT region, 100.0 :: DOUBLE AS res, CAST((xmax - xmin) / 100 AS INTEGER) AS width, CAST((ymax - ymin) / 100 AS INTEGER) AS height,
           100.0 :: DOUBLE AS scale_x, -100.0 :: DOUBLE AS scale_y, xmin AS origin_x, ymax AS origin_y FROM reg""", ["reg"])
def _(spark, d):
    return region_ops.grid_spec(fx.regions(spark, d), 100.001, 99.999).select(
        "region", "res", "width", "height", "scale_x", "scale_y", "origin_x", "origin_y")


# Footprints stretched by the account's size, so that their sides are no multiples of 300.
@query("snap_roi_300", """
    SELECT scene_no, x0 AS xmin, y1 AS ymax, x0 + ceil((x1 + w - x0) / 300) * 300 AS xmax, y1 - ceil((y1 - y0 + w) / 300) * 300 AS ymin
    FROM foot JOIN (SELECT c_custkey AS scene_no, CAST(c_custkey % 290 AS DOUBLE) AS w FROM customer) USING (scene_no)""", ["foot"])
def _(spark, d):
    w = (F.col("scene_no") % 290).cast("double")
    boxes = fx.footprints(spark, d).select(
        "scene_no", F.col("x0").alias("xmin"), (F.col("y0") - w).alias("ymin"), (F.col("x1") + w).alias("xmax"), F.col("y1").alias("ymax"))
    return region_ops.snap_roi_300(boxes)


@query("template_grid", """
    SELECT region, CAST(iy AS INTEGER) AS iy, CAST(ix AS INTEGER) AS ix, xmin + (ix + 0.5) * 150 AS x, ymax - (iy + 0.5) * 150 AS y
    FROM (SELECT *, unnest(range(0, CAST((xmax - xmin) / 150 AS BIGINT))) AS ix
          FROM (SELECT *, unnest(range(0, CAST((ymax - ymin) / 150 AS BIGINT))) AS iy FROM reg))""", ["reg"])
def _(spark, d):
    return region_ops.template_grid(fx.regions(spark, d), 150.0)


@query("snap_template", """
    WITH c AS (SELECT l.region, field_id, iy, ix, trunc(xmin + 7.3 + (ix + 0.5) * 10) AS x, trunc(ymax + 4.8 - (iy + 0.5) * 10) AS y, xmin, ymin
               FROM li l JOIN reg r ON r.region = l.region),
    s AS (SELECT region, max(xmin) - (min(x) - 5) AS dx, max(ymin) - (min(y) - 5) AS dy FROM c GROUP BY ALL)
    SELECT c.region, field_id, iy, ix, x + dx AS x, y + dy AS y FROM c JOIN s ON s.region = c.region""", ["li", "reg"])
def _(spark, d):
    regions = fx.regions(spark, d)
    placed = fx.stack(spark, d).join(regions.select("region", "xmin", "ymax"), "region")
    x, y = grids.cell_to_world(F.col("iy"), F.col("ix"), F.col("xmin") + 7.3, F.col("ymax") + 4.8, F.lit(10.0))
    cells = placed.select("region", "field_id", "iy", "ix", x.alias("x"), y.alias("y"))
    return region_ops.snap_template(cells, regions, 10.0)


@query("cell_to_world", """
    SELECT field_id, iy, ix, xmin + (ix + 0.5) * 100 AS x, ymax - (iy + 0.5) * 100 AS y FROM li l JOIN reg r ON r.region = l.region""", ["li", "reg"])
def _(spark, d):
    placed = fx.stack(spark, d).join(fx.regions(spark, d), "region")
    x, y = grids.cell_to_world(F.col("iy"), F.col("ix"), F.col("xmin"), F.col("ymax"), F.lit(100.0))
    return placed.select("field_id", "iy", "ix", x.alias("x"), y.alias("y"))


@query("world_to_cell", """
    SELECT l_orderkey, l_linenumber, CAST(floor((3000 - l_tax * 30000) / 100) AS INTEGER) AS iy, CAST(floor((l_quantity * 61 + 5) / 100) AS INTEGER) AS ix
    FROM lineitem""")
def _(spark, d):
    line = fx.table(spark, d, "lineitem")
    iy, ix = grids.world_to_cell(F.col("l_quantity") * 61 + 5, F.col("l_tax") * 30000, F.lit(0.0), F.lit(3000.0), F.lit(100.0))
    return line.select("l_orderkey", "l_linenumber", iy.alias("iy"), ix.alias("ix"))


UTM_SQL = """
    SELECT c_custkey, CAST(500000 + (c_custkey % 50 - 25) * 4000 AS DOUBLE) AS x,
           CAST(7200000 + ((c_custkey // 50) % 300) * 5000 AS DOUBLE) AS y, 22 + c_custkey % 5 AS zone FROM customer"""


@query("reproject_points", f"SELECT c_custkey, round(px_x, 4) AS px, round(px_y, 4) AS py FROM ({utm_to_polar(UTM_SQL, ['c_custkey'])})")
def _(spark, d):
    c = F.col("c_custkey")
    points = fx.table(spark, d, "customer").select(
        "c_custkey", (500000.0 + (c % 50 - 25) * 4000).alias("x"), (7200000.0 + (F.floor(c / 50) % 300) * 5000).alias("y"),
        (22 + c % 5).alias("zone"))
    x, y = projection.polar_from_utm(F.col("x"), F.col("y"), F.col("zone"))
    return points.select("c_custkey", F.round(x, 4).alias("px"), F.round(y, 4).alias("py"))


EDGES_SQL = """
    SELECT c_custkey AS scene_no, i * 8 + k AS j,
           -50.0 + (c_custkey % 40) * 0.25 + x0 + (x1 - x0) * k / 8 AS lon, 66.0 + ((c_custkey // 40) % 40) * 0.1 + y0 + (y1 - y0) * k / 8 AS lat
    FROM customer, range(8) r(k), (VALUES (0, 0.0, 0.0, 2.5, 0.2), (1, 2.5, 0.2, 2.7, 1.1), (2, 2.7, 1.1, -0.2, 0.9), (3, -0.2, 0.9, 0.0, 0.0)) e(i, x0, y0, x1, y1)"""


@query("project_footprints", f"""
    WITH p AS ({lonlat_to_polar(EDGES_SQL, ['scene_no', 'j'])}),
    n AS (SELECT *, coalesce(lead(px_x) OVER w, first_value(px_x) OVER w) AS nx, coalesce(lead(px_y) OVER w, first_value(px_y) OVER w) AS ny
          FROM p WINDOW w AS (PARTITION BY scene_no ORDER BY j))
    SELECT scene_no, CAST(count(*) AS INTEGER) AS n_points, round(min(px_x), 2) AS x0, round(min(px_y), 2) AS y0, round(max(px_x), 2) AS x1,
           round(max(px_y), 2) AS y1, round(abs(sum(px_x * ny - nx * px_y)) / 2e6, 3) AS area_km2 FROM n GROUP BY ALL""")
def _(spark, d):
    found = footprints.project_footprints(fx.polygons(spark, d))
    return found.select("scene_no", F.size("ring").alias("n_points"), *[F.round(c, 2).alias(c) for c in ("x0", "y0", "x1", "y1")],
                        F.round(ring_area(F.col("ring")) / 1e6, 3).alias("area_km2"))


def mask_tiles(spark, d):
    return fx.footprints(spark, d).withColumnRenamed("scene_no", "tile")


@query("join_extent_intersects", "SELECT scene_no AS tile, region FROM meets", ["meets"])
def _(spark, d):
    return mask_ops.join_extent_intersects(mask_tiles(spark, d), fx.regions(spark, d))


def overlaps(spark, d):
    ring = box_ring(*[F.col(c) for c in ("x0", "y0", "x1", "y1")])
    scenes = fx.footprints(spark, d).withColumn("ring", ring)
    return spatial.join_footprint_overlap(scenes, fx.regions(spark, d)).select("scene_no", "region", "frac")


@query("join_footprint_overlap", "SELECT scene_no, region, round(frac, 9) AS frac FROM meets", ["meets"])
def _(spark, d):
    return overlaps(spark, d).withColumn("frac", F.round("frac", 9))


@query("filter_intersect_fraction", "SELECT scene_no, region, round(frac, 9) AS frac FROM meets WHERE frac > 0.05", ["meets"])
def _(spark, d):
    return spatial.filter_intersect_fraction(overlaps(spark, d)).withColumn("frac", F.round("frac", 9))


@query("merge_mask_tiles", """
    WITH t AS (SELECT scene_no AS tile, x0 + (i + 0.5) * 300 AS x, y0 + (j + 0.5) * 300 AS y, (i + j + scene_no) % 3 <> 0 AS is_ice,
                      (i * j + scene_no) % 7 = 0 AS is_ocean
               FROM (SELECT *, unnest(range(0, CAST((x1 - x0) / 300 AS BIGINT))) AS i
                     FROM (SELECT *, unnest(range(0, CAST((y1 - y0) / 300 AS BIGINT))) AS j FROM foot))),
    p AS (SELECT o.region, CAST(floor((r.ymax - t.y) / 300) AS INTEGER) AS iy, CAST(floor((t.x - r.xmin) / 300) AS INTEGER) AS ix, t.*
          FROM t JOIN meets o ON o.scene_no = t.tile JOIN reg r ON r.region = o.region
          WHERE t.x >= r.xmin AND t.x < r.xmax AND t.y > r.ymin AND t.y <= r.ymax)
    SELECT region, iy, ix, CAST(arg_max(is_ice, tile) AS INTEGER) AS is_ice, CAST(arg_max(is_ocean, tile) AS INTEGER) AS is_ocean
    FROM p GROUP BY ALL""", ["foot", "reg", "meets"])
def _(spark, d):
    tiles = mask_tiles(spark, d)
    cells = (
        tiles.withColumn("j", F.explode(F.sequence(F.lit(0), ((F.col("y1") - F.col("y0")) / 300).cast("int") - 1)))
        .withColumn("i", F.explode(F.sequence(F.lit(0), ((F.col("x1") - F.col("x0")) / 300).cast("int") - 1)))
        .select("tile", (F.col("x0") + (F.col("i") + 0.5) * 300).alias("x"), (F.col("y0") + (F.col("j") + 0.5) * 300).alias("y"),
                ((F.col("i") + F.col("j") + F.col("tile")) % 3 != 0).alias("is_ice"),
                ((F.col("i") * F.col("j") + F.col("tile")) % 7 == 0).alias("is_ocean"))
    )
    merged = mask_ops.merge_mask_tiles(cells, tiles, fx.regions(spark, d), 300.0)
    return merged.withColumns({c: F.col(c).cast("int") for c in ("is_ice", "is_ocean")})


def target_cells(g):
    return f"""SELECT CAST(y AS INTEGER) AS ty, CAST(x AS INTEGER) AS tx, {g.xmin} + (x + 0.5) * {g.res} AS cx, {g.ymax} - (y + 0.5) * {g.res} AS cy
        FROM range({g.height}) a(y), range({g.width}) b(x)"""


@query("resample_nearest", f"""
    WITH t AS ({target_cells(FINER)})
    SELECT p.field_id, p.component, t.ty AS iy, t.tx AS ix, p.value FROM t
    JOIN px p ON p.iy = floor((800 - t.cy) / 100) AND p.ix = floor(t.cx / 100)""", ["px"])
def _(spark, d):
    return resample.resample_nearest(fx.px(spark, d), SRC, FINER).select("field_id", "component", "iy", "ix", "value")


def weighted_sql(wy, wx, support):
    return f"""
    WITH t AS ({target_cells(SHIFTED)}),
    k AS (SELECT t.ty, t.tx, c.iy, c.ix, (800 - t.cy) / 100 - 0.5 - c.iy AS v, t.cx / 100 - 0.5 - c.ix AS u
          FROM t JOIN cells c ON abs((800 - t.cy) / 100 - 0.5 - c.iy) < {support} AND abs(t.cx / 100 - 0.5 - c.ix) < {support}),
    w AS (SELECT ty, tx, iy, ix, ({wy}) * ({wx}) AS w FROM k)
    SELECT p.field_id, p.component, w.ty AS iy, w.tx AS ix,
           round({NUDGE} + CASE WHEN sum(w.w) FILTER (p.value IS NOT NULL) > 1e-6
                      THEN sum(w.w * p.value) / sum(w.w) FILTER (p.value IS NOT NULL) END, 8) AS value
    FROM w JOIN px p ON p.iy = w.iy AND p.ix = w.ix GROUP BY ALL"""


def cubic_sql(t):
    return (f"CASE WHEN abs({t}) <= 1 THEN 1.5 * abs({t}) ** 3 - 2.5 * {t} ** 2 + 1 "
            f"WHEN abs({t}) < 2 THEN -0.5 * abs({t}) ** 3 + 2.5 * {t} ** 2 - 4 * abs({t}) + 2 ELSE 0 END")


def resampled(spark, d, method):
    keys = ["field_id", "component"]
    found, bh, bw = resample.resample_blocks(fx.blocks(spark, d), SRC, SHIFTED, method, keys, fx.HEIGHT, fx.WIDTH)
    return block_ops.scan_blocks(found, keys, ["value"], bh, bw, SHIFTED.height, SHIFTED.width)


@query("resample_bilinear", weighted_sql("1 - abs(v)", "1 - abs(u)", 1), ["px", "cells"])
def _(spark, d):
    return steady(resampled(spark, d, "bilinear"), "value")


@query("resample_cubic", weighted_sql(cubic_sql("v"), cubic_sql("u"), 2), ["px", "cells"])
def _(spark, d):
    return steady(resampled(spark, d, "cubic"), "value")


@query("clip_to_bounds", """
    SELECT field_id, component, iy, ix, value FROM px
    WHERE (ix + 0.5) * 100 BETWEEN 100 AND 330 AND 800 - (iy + 0.5) * 100 BETWEEN 120 AND 640""", ["px"])
def _(spark, d):
    kept = resample.clip_to_bounds(fx.px(spark, d), SRC, (100.0, 120.0, 330.0, 640.0))
    return kept.select("field_id", "component", "iy", "ix", "value")


# Four neighbouring fields form one mosaic of each component; weak cells lie outside their tile.
TILE_SQL = """
    SELECT (field_id // 4) || component AS mosaic_key, field_id AS tile, (field_id * 7) % 4 AS rank, iy, ix,
           CASE WHEN abs(value) >= 1 THEN value END AS value FROM px"""
FIRST_SQL = "arg_min(value, {order}) FILTER (value IS NOT NULL)"


def tile_px(spark, d):
    f = F.col("field_id")
    return fx.px(spark, d).select(
        F.concat(F.floor(f / 4), "component").alias("mosaic_key"), f.alias("tile"), ((f * 7) % 4).alias("rank"), "iy", "ix",
        F.when(F.abs("value") >= 1, F.col("value")).alias("value"))


MOSAIC_SQL = f"SELECT mosaic_key, iy, ix, {FIRST_SQL.format(order='rank')} AS value FROM ({TILE_SQL}) GROUP BY ALL"


@query("mosaic_first_valid", MOSAIC_SQL, ["px"])
def _(spark, d):
    return mosaic.mosaic_first_valid(tile_px(spark, d))


TEMPLATE = Grid(-130.0, 950.0, 70.0, 9, 16)


@query("mosaic_match_template", f"""
    WITH t AS ({target_cells(TEMPLATE)})
    SELECT m.mosaic_key, t.ty AS iy, t.tx AS ix, m.value FROM t
    JOIN ({MOSAIC_SQL}) m ON m.iy = floor((800 - t.cy) / 100) AND m.ix = floor(t.cx / 100)""", ["px"])
def _(spark, d):
    return mosaic.mosaic_match_template(mosaic.mosaic_first_valid(tile_px(spark, d)), SRC, TEMPLATE)


# Tiles of two neighbouring zones at their common meridian, cells of 2 km.
POLAR = Grid(-130000.0, -2000000.0, 2000.0, 40, 200)
EASTS = {22: 612000.0, 23: 384000.0}
TARGETS_SQL = polar_to_utm("""
    SELECT z AS zone, CAST(i AS INTEGER) AS ty, CAST(j AS INTEGER) AS tx, -130000 + (j + 0.5) * 2000.0 AS px, -2000000 - (i + 0.5) * 2000.0 AS py
    FROM range(200) a(i), range(40) b(j), (VALUES (22), (23)) c(z)""", ["zone", "ty", "tx"])


@query("mosaic_two_zone", f"""
    WITH s AS (SELECT *, CASE WHEN rank < 2 THEN 22 ELSE 23 END AS zone FROM ({TILE_SQL})),
    z AS (SELECT DISTINCT mosaic_key, arg_min(zone, rank) OVER (PARTITION BY mosaic_key) AS first_zone FROM s),
    t AS (SELECT *, (x - CASE zone WHEN 22 THEN 612000 ELSE 384000 END) / 2000 - 0.5 AS fx, (7776000 - y) / 2000 - 0.5 AS fy FROM ({TARGETS_SQL})),
    k AS (SELECT t.zone, ty, tx, c.iy, c.ix, fy - c.iy AS v, fx - c.ix AS u FROM t JOIN cells c ON abs(fy - c.iy) < 2 AND abs(fx - c.ix) < 2),
    w AS (SELECT *, ({cubic_sql('v')}) * ({cubic_sql('u')}) AS w, abs(u) <= 0.5 AND abs(v) <= 0.5 AS inside FROM k),
    p AS (SELECT s.mosaic_key, s.tile, s.rank, s.zone, w.ty, w.tx,
                 CASE WHEN bool_or(inside AND s.value IS NOT NULL) AND sum(w.w) FILTER (s.value IS NOT NULL) > 1e-6 THEN sum(w.w * s.value) / sum(w.w) FILTER (s.value IS NOT NULL) END AS value
          FROM w JOIN s ON s.zone = w.zone AND s.iy = w.iy AND s.ix = w.ix GROUP BY ALL HAVING bool_or(inside))
    SELECT mosaic_key, ty AS iy, tx AS ix,
           round({NUDGE} + {FIRST_SQL.format(order='ROW(CASE WHEN zone = first_zone THEN 0 ELSE 1 END, rank, tile)')}, 8) AS value
    FROM p JOIN z USING (mosaic_key) GROUP BY ALL""", ["px", "cells"])
def _(spark, d):
    px = tile_px(spark, d).withColumn("zone", F.when(F.col("rank") < 2, 22).otherwise(23))
    east = F.when(F.col("zone") == 22, EASTS[22]).otherwise(EASTS[23])
    placed = px.withColumns({"x": east + (F.col("ix") + 0.5) * 2000, "y": 7776000.0 - (F.col("iy") + 0.5) * 2000})
    f = F.col("field_id")
    component = F.explode(F.array(F.lit("dx"), F.lit("dy"))).alias("component")
    tiles = fx.fields(spark, d).select("field_id", component).select(
        F.concat(F.floor(f / 4), "component").alias("mosaic_key"), f.alias("tile"), ((f * 7) % 4).alias("rank"),
    ).withColumn("zone", F.when(F.col("rank") < 2, 22).otherwise(23))
    out = mosaic.mosaic_two_zone(placed.select("mosaic_key", "tile", "x", "y", "value"), tiles, 2000.0, POLAR)
    return steady(out, "value")


CELL_M2 = 200e6
AREA_SQL = "SELECT region, field_id, count(*) FILTER (dx > 0) * CAST(200 AS DOUBLE) AS area_covered_km2, min(shipdate) AS acquired FROM li GROUP BY ALL"
COVER_SQL = f"SELECT a.*, a.area_covered_km2 / r.area_km2 AS coverage FROM ({AREA_SQL}) a JOIN reg r ON r.region = a.region"


def coverage(spark, d):
    stack = fx.stack(spark, d)
    areas = scene_ops.coverage_area(stack, ["region", "field_id"], CELL_M2, "dx")
    return scene_ops.coverage_fraction(areas, fx.regions(spark, d)).select("region", "field_id", "area_covered_km2", "coverage")


@query("coverage_area", f"SELECT region, field_id, area_covered_km2 FROM ({AREA_SQL})", ["li"])
def _(spark, d):
    return scene_ops.coverage_area(fx.stack(spark, d), ["region", "field_id"], CELL_M2, "dx")


@query("filter_coverage", f"SELECT region, field_id, coverage FROM ({COVER_SQL}) WHERE coverage > 0.5", ["li", "reg"])
def _(spark, d):
    return scene_ops.filter_coverage(coverage(spark, d)).select("region", "field_id", "coverage")


@query("filter_template_coverage", f"SELECT region, field_id, coverage FROM ({COVER_SQL}) WHERE coverage >= 0.95", ["li", "reg"])
def _(spark, d):
    return scene_ops.filter_template_coverage(coverage(spark, d)).select("region", "field_id", "coverage")


@query("pick_template", f"""
    SELECT region, scene, strftime(acquired, '%Y-%m-%d') AS acquired
    FROM (SELECT region, field_id AS scene, acquired, row_number() OVER (PARTITION BY region ORDER BY acquired, field_id) AS k
          FROM ({COVER_SQL}) WHERE coverage >= 0.95) WHERE k = 1""", ["li", "reg"])
def _(spark, d):
    stack = fx.stack(spark, d)
    areas = stack.groupBy("region", F.col("field_id").alias("scene")).agg(
        (F.count_if(F.col("dx") > 0) * CELL_M2 / 1e6).alias("area_covered_km2"), F.min("shipdate").alias("acquired"))
    picked = scene_ops.pick_template(scene_ops.coverage_fraction(areas, fx.regions(spark, d)))
    return picked.select("region", "scene", F.date_format("acquired", "yyyy-MM-dd").alias("acquired"))
