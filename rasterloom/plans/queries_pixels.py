"""Queries on velocity fields: pixels, offsets, correction, errors, masks."""

from __future__ import annotations

from pyspark.sql import functions as F

from rasterloom.functions import vector
from rasterloom.functions.grid import Grid
from rasterloom.operators import blocks as block_ops, correction, masks as mask_ops, offsets, pairs as pair_ops
from rasterloom.operators.quantiles import largest_group
from rasterloom.operators.rasters import content_digest, shape_uniformity
from rasterloom.plans import fixtures as fx
from rasterloom.plans.registry import query
from rasterloom.plans.rounding import steady, steady_sql
from rasterloom.sources.pixels import scan_pixels
from rasterloom.sources.store import intermediate

W, H = fx.WIDTH, fx.HEIGHT
CELL = ["region", "iy", "ix"]
GRID = Grid(0.0, 800.0, 100.0, W, H)


def masked(spark, d):
    return mask_ops.rock_mask(fx.masks(spark, d))


def made_a_priori(spark, d):
    found = offsets.a_priori_blocks(fx.field_blocks(spark, d), fx.fields(spark, d), H, W, H, W)
    return offsets.to_long(block_ops.scan_blocks(found, ["region"], offsets.COMPONENTS, H, W, H, W))


def a_priori(spark, d):
    """The a priori field where other steps read it: made once for the files it comes from."""
    return intermediate(spark, "a-priori", [fx.table(spark, d, "embeddings")], {"min_fields": pair_ops.MIN_FIELDS}, lambda: made_a_priori(spark, d))


def offset_table(spark, d, reference=None):
    def made():
        return offsets.orbit_pair_offset(fx.px_wide(spark, d), fx.fields(spark, d), a_priori(spark, d) if reference is None else reference)

    return intermediate(spark, "offsets", [fx.table(spark, d, "embeddings")], {"min_fields": pair_ops.MIN_FIELDS}, made)


def corrected(spark, d, reference=None):
    return correction.apply_offset(
        correction.join_offsets(fx.px_wide(spark, d), fx.fields(spark, d), offset_table(spark, d, reference))
    )


def corrected_masked(spark, d, reference=None):
    return mask_ops.join_masks(corrected(spark, d, reference), masked(spark, d))


def ready_to_filter(spark, d):
    reference = a_priori(spark, d)
    return correction.join_flow_reference(
        corrected_masked(spark, d, reference), offsets.flow_reference(reference)
    )


@query("scan_pixels", "SELECT region, field_id, component, iy, ix, value FROM px", ["px"])
def _(spark, d):
    return scan_pixels(fx.chunks(spark, d), W, H, fx.NODATA)


@query("nodata_to_null", """
    SELECT vec_id AS field_id, CAST(p AS INTEGER) AS pos, CASE WHEN abs(e) >= 0.004 THEN round(CAST(e AS DOUBLE) * 10, 6) END AS value
    FROM (SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) - 1 AS p FROM embeddings)""")
def _(spark, d):
    raw = fx._raw(spark, d).select("field_id", F.posexplode("cells").alias("pos", "raw"))
    return raw.select("field_id", "pos", vector.nodata_to_null(F.col("raw"), fx.NODATA).alias("value"))


@query("zero_to_null", """
    SELECT field_id, nullif(dx_mean, 0) AS dx_mean, nullif(n_null, 0) AS n_null
    FROM (SELECT field_id, round(avg(dx), 0) + 0 AS dx_mean, CAST(count(*) - count(dx) AS DOUBLE) AS n_null FROM pw GROUP BY ALL)""", ["pw"])
def _(spark, d):
    stats = fx.px_wide(spark, d).groupBy("field_id").agg(
        (F.round(F.avg("dx"), 0) + 0).alias("dx_mean"),
        (F.count("*") - F.count("dx")).cast("double").alias("n_null"),
    )
    return stats.withColumns({c: vector.zero_to_null(F.col(c)) for c in ("dx_mean", "n_null")})


@query("velocity_magnitude", "SELECT field_id, iy, ix, sqrt(dx*dx + dy*dy) AS vv FROM pw", ["pw"])
def _(spark, d):
    px = fx.px_wide(spark, d)
    return px.select("field_id", "iy", "ix", vector.magnitude(F.col("dx"), F.col("dy")).alias("vv"))


DIRECTION_SQL = """
    SELECT region, field_id, iy, ix, CASE WHEN angle > 180 THEN angle - 360 ELSE angle END AS angle
    FROM (SELECT region, field_id, iy, ix, CASE WHEN dx > 0 THEN degrees(atan(dy / dx)) ELSE degrees(atan(dy / dx)) + 180 END AS angle FROM pw)"""


@query("flow_direction", f"SELECT field_id, iy, ix, round(angle, 9) AS angle FROM ({DIRECTION_SQL})", ["pw"])
def _(spark, d):
    px = fx.px_wide(spark, d)
    angle = vector.flow_direction(F.col("dx"), F.col("dy"))
    return px.select("field_id", "iy", "ix", F.round(angle, 9).alias("angle"))


@query("angular_difference", f"""
    WITH a AS ({DIRECTION_SQL})
    SELECT a.field_id, a.iy, a.ix,
           round(CASE WHEN abs(flow_ref - angle) > 180 THEN 360 - abs(flow_ref - angle)
                      ELSE abs(flow_ref - angle) END, 9) AS diff
    FROM a JOIN flow f ON f.region = a.region AND f.iy = a.iy AND f.ix = a.ix""", ["pw", "flow"])
def _(spark, d):
    angled = fx.px_wide(spark, d).select(
        *CELL, "field_id", vector.flow_direction(F.col("dx"), F.col("dy")).alias("angle")
    )
    joined = angled.join(offsets.flow_reference(a_priori(spark, d)), CELL)
    diff = vector.angular_difference(F.col("flow_ref"), F.col("angle"))
    return joined.select("field_id", "iy", "ix", F.round(diff, 9).alias("diff"))


@query("to_displacement", """
    SELECT p.field_id, p.component, p.iy, p.ix, p.value * f.day_sep AS value
    FROM px p JOIN fields f ON f.field_id = p.field_id""", ["px", "fields"])
def _(spark, d):
    moved = offsets.to_displacement(fx.px(spark, d), fx.fields(spark, d))
    return moved.select("field_id", "component", "iy", "ix", "value")


@query("orbit_pair_label", "SELECT field_id, orbit1, orbit2, orbit_pair, orbit_match FROM fields", ["fields"])
def _(spark, d):
    raw = fx.fields(spark, d).drop("orbit_pair", "orbit_match")
    return pair_ops.orbit_pair_label(raw).select("field_id", "orbit1", "orbit2", "orbit_pair", "orbit_match")


@query("orbit_pair_counts", "SELECT region, orbit_pair, count(*) AS n_fields FROM fields GROUP BY ALL", ["fields"])
def _(spark, d):
    return pair_ops.orbit_pair_counts(fx.fields(spark, d)).orderBy("region", "orbit_pair")


@query("min_samples", "SELECT region, orbit_pair, count(*) AS n_fields FROM fields GROUP BY ALL HAVING count(*) >= 5", ["fields"])
def _(spark, d):
    return pair_ops.min_samples(fx.fields(spark, d))


@query("median_composite", "SELECT region, component, iy, ix, median(value) AS value FROM px GROUP BY ALL", ["px"])
def _(spark, d):
    # The field table bounds the stacks, so the blocks are read once.
    keys, largest = ["region", "component"], largest_group(fx.fields(spark, d), ["region"], "field_id")
    found = block_ops.median_stack(fx.blocks(spark, d), keys, ["value"], H, W, largest)
    return block_ops.scan_blocks(found, keys, ["value"], H, W, H, W)


@query("box_median_3x3", """
    SELECT c.field_id, c.component, c.iy, c.ix, CASE WHEN max(c.value) IS NOT NULL THEN median(n.value) END AS value
    FROM px c JOIN near k ON k.iy = c.iy AND k.ix = c.ix
    JOIN px n ON n.field_id = c.field_id AND n.component = c.component AND n.iy = k.ny AND n.ix = k.nx
    GROUP BY ALL""", ["px", "near"])
def _(spark, d):
    keys = ["field_id", "component"]
    found = block_ops.median_blocks_3x3(fx.blocks(spark, d), keys, ["value"], H, W, H, W)
    return block_ops.scan_blocks(found, keys, ["value"], H, W, H, W)


@query("a_priori_field", "SELECT region, component, iy, ix, value FROM a_priori", ["a_priori"])
def _(spark, d):
    return made_a_priori(spark, d)


@query("join_a_priori", """
    SELECT p.field_id, p.component, p.iy, p.ix, a.value - p.value AS diff
    FROM px p JOIN a_priori a ON a.region = p.region AND a.component = p.component AND a.iy = p.iy AND a.ix = p.ix""",
    ["px", "a_priori"])
def _(spark, d):
    return offsets.join_a_priori(fx.px(spark, d), a_priori(spark, d)).select("field_id", "component", "iy", "ix", "diff")


@query("orbit_pair_offset", "SELECT region, orbit_pair, iy, ix, dx_offset, dy_offset FROM off_wide", ["off_wide"])
def _(spark, d):
    return offsets.orbit_pair_offset(fx.px_wide(spark, d), fx.fields(spark, d), a_priori(spark, d))


@query("offset_magnitude", """
    SELECT region, orbit_pair, iy, ix, sqrt(dx_offset*dx_offset + dy_offset*dy_offset) AS offset_mag FROM off_wide""",
    ["off_wide"])
def _(spark, d):
    return offsets.offset_magnitude(offset_table(spark, d))


@query("join_offsets", """
    SELECT w.field_id, f.orbit_pair, w.iy, w.ix, o.dx_offset, o.dy_offset
    FROM pw w JOIN fields f ON f.field_id = w.field_id
    JOIN off_wide o ON o.region = w.region AND o.orbit_pair = f.orbit_pair AND o.iy = w.iy AND o.ix = w.ix""",
    ["pw", "fields", "off_wide"])
def _(spark, d):
    joined = correction.join_offsets(fx.px_wide(spark, d), fx.fields(spark, d), offset_table(spark, d))
    return joined.select("field_id", "orbit_pair", "iy", "ix", "dx_offset", "dy_offset")


@query("apply_offset", "SELECT field_id, iy, ix, dx, dy FROM cor", ["cor"])
def _(spark, d):
    return corrected(spark, d).select("field_id", "iy", "ix", "dx", "dy")


@query("speed_p95_ceil10", """
    SELECT region, quantile_cont(value, 0.95) AS p95, CAST(ceil(quantile_cont(value, 0.95) / 10) * 10 AS DOUBLE) AS vmax
    FROM a_priori WHERE component = 'dmag' GROUP BY ALL""", ["a_priori"])
def _(spark, d):
    return offsets.speed_p95_ceil10(a_priori(spark, d))


@query("join_flow_reference", """
    SELECT w.field_id, w.iy, w.ix, round(f.flow_ref, 9) AS flow_ref
    FROM pw w LEFT JOIN flow f ON f.region = w.region AND f.iy = w.iy AND f.ix = w.ix""", ["pw", "flow"])
def _(spark, d):
    flow = offsets.flow_reference(a_priori(spark, d))
    joined = correction.join_flow_reference(fx.px_wide(spark, d), flow)
    return joined.select("field_id", "iy", "ix", F.round("flow_ref", 9).alias("flow_ref"))


@query("rock_mask", """
    SELECT region, iy, ix, CAST(is_ice AS INTEGER) AS is_ice, CAST(is_ocean AS INTEGER) AS is_ocean,
           CAST(is_rock AS INTEGER) AS is_rock FROM masks""", ["masks"])
def _(spark, d):
    flags = ("is_ice", "is_ocean", "is_rock")
    return masked(spark, d).withColumns({c: F.col(c).cast("int") for c in flags})


@query("join_masks", """
    SELECT w.field_id, w.iy, w.ix, w.dx, w.dy, CAST(is_ice AS INTEGER) AS is_ice, CAST(is_rock AS INTEGER) AS is_rock
    FROM pw w LEFT JOIN masks m ON m.region = w.region AND m.iy = w.iy AND m.ix = w.ix""", ["pw", "masks"])
def _(spark, d):
    joined = mask_ops.join_masks(fx.px_wide(spark, d), masked(spark, d))
    return joined.select("field_id", "iy", "ix", "dx", "dy", F.col("is_ice").cast("int").alias("is_ice"),
                         F.col("is_rock").cast("int").alias("is_rock"))


@query("apply_field_mask", """
    SELECT w.field_id, w.iy, w.ix, CASE WHEN f.orbit_match = 0 AND (w.iy * 3 + w.ix + w.field_id) % 4 = 0 THEN NULL ELSE dx END AS dx,
           CASE WHEN f.orbit_match = 0 AND (w.iy * 3 + w.ix + w.field_id) % 4 = 0 THEN NULL ELSE dy END AS dy
    FROM pw w JOIN fields f ON f.field_id = w.field_id""", ["pw", "fields"])
def _(spark, d):
    px = fx.px_wide(spark, d)
    # Cross-track fields come with a companion mask.
    owners = fx.fields(spark, d).where("orbit_match = 0").select("region", "field_id")
    mask = px.join(owners, ["region", "field_id"], "left_semi").select(
        "region", "field_id", "iy", "ix",
        F.when((F.col("iy") * 3 + F.col("ix") + F.col("field_id")) % 4 == 0, 0).otherwise(1).alias("mask"),
    )
    return mask_ops.apply_field_mask(px, mask, ["dx", "dy"]).select("field_id", "iy", "ix", "dx", "dy")


@query("landsat_valid", """
    SELECT field_id, iy, ix, CASE WHEN dx NOT IN (0, -9999) THEN dx END AS dx, CASE WHEN dx NOT IN (0, -9999) THEN dy END AS dy
    FROM (SELECT field_id, iy, ix, coalesce(dx, -9999) AS dx, dy FROM pw)""", ["pw"])
def _(spark, d):
    raw = fx.px_wide(spark, d).withColumn("dx", F.coalesce("dx", F.lit(-9999.0)))
    return correction.landsat_valid(raw).select("field_id", "iy", "ix", "dx", "dy")


@query("rock_error_velocity", f"SELECT field_id, {steady_sql(correction.ERROR_COLUMNS)} FROM errors", ["errors"])
def _(spark, d):
    stats = correction.rock_error_velocity(corrected_masked(spark, d))
    return steady(stats, *correction.ERROR_COLUMNS).drop("region")


@query("rock_error_displacement", f"SELECT field_id, {steady_sql(correction.DISPLACEMENT_COLUMNS)} FROM errors", ["errors"])
def _(spark, d):
    stats = correction.rock_error_displacement(corrected_masked(spark, d))
    return steady(stats, *correction.DISPLACEMENT_COLUMNS).drop("region")


LANDSAT_ERROR_SQL = """
    SELECT field_id, nullif(sqrt(avg(dx*dx + dy*dy)), 0) AS mag_rmse, nullif(avg(dx), 0) AS dx_mean,
           nullif(stddev_pop(dx), 0) AS dx_sd, nullif(avg(dy), 0) AS dy_mean, nullif(stddev_pop(dy), 0) AS dy_sd
    FROM (SELECT region, field_id, iy, ix, dx, CASE WHEN dx IS NOT NULL THEN dy END AS dy FROM pw) w
    JOIN masks m ON m.region = w.region AND m.iy = w.iy AND m.ix = w.ix AND m.is_rock GROUP BY ALL"""


@query("rock_error_landsat", f"SELECT field_id, {steady_sql(correction.ERROR_COLUMNS)} FROM ({LANDSAT_ERROR_SQL})", ["pw", "masks"])
def _(spark, d):
    px = mask_ops.join_masks(correction.landsat_valid(fx.px_wide(spark, d)), masked(spark, d))
    return steady(correction.rock_error_landsat(px), *correction.ERROR_COLUMNS).drop("region")


@query("ice_share_landsat", """
    SELECT region, round_even(sum(CAST(is_ice AS DOUBLE)) / count(*) * 100, 2) AS percent_ice_area_notnull FROM masks GROUP BY ALL""",
    ["masks"])
def _(spark, d):
    return correction.ice_share_landsat(fx.masks(spark, d))


@query("flow_filter", "SELECT field_id, iy, ix, vx, vy FROM filtered", ["filtered"])
def _(spark, d):
    filtered = correction.flow_filter(ready_to_filter(spark, d))
    return filtered.select("field_id", "iy", "ix", F.col("dx").alias("vx"), F.col("dy").alias("vy"))


@query("ice_coverage", """
    SELECT field_id, valid_ice_cells, ice_cells, round(valid_ice_cells * 100.0 / ice_cells, 2) AS percent_ice_area_notnull
    FROM coverage""", ["coverage"])
def _(spark, d):
    filtered = correction.flow_filter(ready_to_filter(spark, d))
    return correction.ice_coverage(filtered, fx.masks(spark, d)).select(
        "field_id", "valid_ice_cells", "ice_cells", "percent_ice_area_notnull")


@query("filter_ice_coverage", """
    SELECT f.field_id, f.iy, f.ix, f.vx, f.vy FROM filtered f
    JOIN coverage c ON c.field_id = f.field_id AND c.valid_ice_cells > 0 AND c.valid_ice_cells * 1.0 / c.ice_cells >= 0.2""",
    ["filtered", "coverage"])
def _(spark, d):
    filtered = correction.flow_filter(ready_to_filter(spark, d))
    coverage = correction.ice_coverage(filtered, fx.masks(spark, d))
    kept = correction.filter_ice_coverage(filtered, coverage, threshold=0.2)
    return kept.select("field_id", "iy", "ix", F.col("dx").alias("vx"), F.col("dy").alias("vy"))


# Imagery: whole numbers, so both engines print a cell the same way.
IMAGE_SQL = "SELECT field_id, component, iy, ix, CAST(floor(abs(coalesce(value, 0)) * 1000) AS INTEGER) AS v FROM px"


def imagery(spark, d):
    value = F.floor(F.abs(F.coalesce("value", F.lit(0.0))) * 1000).cast("int")
    return fx.px(spark, d).select("region", "field_id", "component", "iy", "ix", value.alias("v"))


@query("content_digest", f"""
    SELECT field_id, component,
           md5(concat_ws('-', sum(('0x' || substr(h, 1, 7))::BIGINT), sum(('0x' || substr(h, 8, 7))::BIGINT),
                         sum(('0x' || substr(h, 15, 7))::BIGINT), sum(('0x' || substr(h, 22, 7))::BIGINT))) AS digest
    FROM (SELECT field_id, component, md5(concat_ws(':', iy, ix, v)) AS h FROM ({IMAGE_SQL})) GROUP BY ALL""", ["px"])
def _(spark, d):
    return content_digest(imagery(spark, d), ["field_id", "component"], "v")


@query("shape_uniformity", """
    SELECT region, count(DISTINCT shape) = 1 AS uniform, count(*) AS n_rasters
    FROM (SELECT region, field_id, component, max(iy) * 100000 + max(ix) AS shape FROM px GROUP BY ALL) GROUP BY ALL""", ["px"])
def _(spark, d):
    return shape_uniformity(fx.px(spark, d), ["region"], ["field_id", "component"])
