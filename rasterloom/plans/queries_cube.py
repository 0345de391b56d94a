"""Queries on metadata documents and datacubes."""

from __future__ import annotations

from pyspark.sql import functions as F

from rasterloom import schemas
from rasterloom.functions import temporal
from rasterloom.operators import correction, cube as cube_ops, documents, offsets, pairs as pair_ops, regions as region_ops
from rasterloom.operators.quantiles import grouped_quantile
from rasterloom.plans import fixtures as fx
from rasterloom.plans.queries_pixels import a_priori, corrected_masked
from rasterloom.plans.registry import query
from rasterloom.session import scratch_dir
from rasterloom.sources import sinks

FMT = "yyyy-MM-dd HH:mm:ss"
SQL_FMT = "'%Y-%m-%d %H:%M:%S'"
SWITCH = "1998-08-23"


def show(c):
    return F.date_format(c, FMT).alias(c)


# ---- metadata documents ----

def field_documents(spark, d, min_share=correction.MIN_ICE_SHARE):
    reference = a_priori(spark, d)
    px = correction.join_flow_reference(corrected_masked(spark, d, reference), offsets.flow_reference(reference))
    stats = correction.covered_fields(correction.field_statistics(px, fx.masks(spark, d)), min_share)
    known = fx.field_times(spark, d).join(stats, ["region", "field_id"])
    bounds = {"xmin": 0.0, "ymin": 0.0, "xmax": 400.0, "ymax": 800.0}
    named = known.withColumn("id", pair_ops.sentinel_field_id(F.col("region"), F.col("datetime_1"), F.col("datetime_2")))
    return documents.build_field_document(named.withColumns({k: F.lit(v) for k, v in bounds.items()}), 100.0)


DOC_COLUMNS = ("id", "baseline_days", "scene_1_satellite", "scene_2_satellite", "scene_1_orbit", "scene_2_orbit",
               "scene_1_processing_version", "scene_2_processing_version", "percent_ice_area_notnull",
               "error_mag_rmse", "error_dx_mean", "error_dx_sd", "error_dy_mean", "error_dy_sd")
NUMBERS = tuple(c for c in DOC_COLUMNS if c.startswith(("error", "percent", "baseline")))
DOC_SQL = f"""SELECT {', '.join(DOC_COLUMNS)}, strftime(t1, {SQL_FMT}) AS scene_1_datetime, strftime(t2, {SQL_FMT}) AS scene_2_datetime,
    strftime(mid, {SQL_FMT}) AS midpoint_datetime FROM docs"""


def doc_rows(df):
    # -0.0 and 0.0 are one value.
    df = df.withColumns({c: F.col(c) + 0.0 for c in NUMBERS})
    return df.select(*DOC_COLUMNS, *[show(c) for c in ("scene_1_datetime", "scene_2_datetime", "midpoint_datetime")])


@query("build_field_document", """
    SELECT field_id, id, '3413' AS epsg, 400.0 :: DOUBLE AS xmax, strftime(t1, '%Y-%m-%d T%H:%M:%S') AS scene_1_datetime,
           error_mag_rmse AS mag_rmse, error_dx_sd AS dx_sd, percent_ice_area_notnull,
           'Contains modified Copernicus Sentinel data [' || year(mid) || '].' AS credit FROM docs""", ["docs"])
def _(spark, d):
    return field_documents(spark, d).select(
        "field_id", "document.field_info.id", "document.geospatial_info.epsg", "document.geospatial_info.extent.xmax",
        "document.field_info.scene_1_datetime", "document.error_units_velocity.mag_rmse", "document.error_units_velocity.dx_sd",
        "document.field_info.percent_ice_area_notnull",
        F.col("document.project_info")["data_acknowledgement"].alias("credit"))


@query("scan_field_metadata", DOC_SQL, ["docs"])
def _(spark, d):
    return doc_rows(documents.scan_field_metadata(documents.to_json_documents(field_documents(spark, d))))


@query("sink_field_metadata", DOC_SQL, ["docs"])
def _(spark, d):
    out = scratch_dir(spark, "documents")
    sinks.sink_field_metadata(documents.to_json_documents(field_documents(spark, d)), out)
    return doc_rows(documents.scan_field_metadata(spark.read.text(out)))


@query("stack_field_components", """
    SELECT w.region, w.field_id, w.iy, w.ix, w.dx AS vx, w.dy AS vy, t.satellite1 AS scene_1_satellite FROM pw w
    JOIN times t ON t.field_id = w.field_id AND t.orbit_match = 1""", ["pw", "times"])
def _(spark, d):
    meta = fx.field_times(spark, d).where("orbit_match = 1").select(
        "region", "field_id", F.col("satellite1").alias("scene_1_satellite"))
    pixels, fields = cube_ops.stack_field_components(fx.px(spark, d), meta)
    return pixels.join(fields, ["region", "field_id"])


# ---- cubes of two sensors, from the orders ----

def cube_fields(spark, d):
    c = fx.cube(spark, d)
    a, b = F.col("scene_1_datetime"), F.col("scene_2_datetime")
    name = F.concat_ws("_", pair_ops.cube_field_id(F.col("region"), a, b, F.col("sensor")), F.col("field_id").cast("string"))
    return c.withColumns({"id": name, "midpoint_datetime": temporal.midpoint(a, b)})


INDEX_SQL = "SELECT region, id, row_number() OVER (PARTITION BY region ORDER BY scene_1_datetime, scene_2_datetime, id) - 1 AS index FROM {}"


@query("cube_index", INDEX_SQL.format("cube_id"), ["cube_id"])
def _(spark, d):
    return cube_ops.cube_index(cube_fields(spark, d)).select("region", "id", "index")


YEAR_SQL = "SELECT *, CAST(year(midpoint_datetime) AS INTEGER) AS year FROM cube_id WHERE midpoint_datetime <= make_timestamp(year(midpoint_datetime), 12, 31, 0, 0, 0)"


@query("split_years", f"SELECT region, id, year, row_number() OVER (PARTITION BY region, year ORDER BY scene_1_datetime, scene_2_datetime, id) - 1 AS index FROM ({YEAR_SQL})", ["cube_id"])
def _(spark, d):
    return cube_ops.cube_index(cube_ops.split_years(cube_fields(spark, d)), by_year=True).select("region", "id", "year", "index")


@query("union_sensors", """
    SELECT id, sensor, CASE WHEN sensor = 'S2' THEN score END AS percent_ice_area_notnull,
           CASE WHEN sensor = 'L8' THEN score END AS error_mag_rmse FROM cube_id""", ["cube_id"])
def _(spark, d):
    c = cube_fields(spark, d)
    s2 = c.where("sensor = 'S2'").select("id", "sensor", F.col("score").alias("percent_ice_area_notnull"))
    l8 = c.where("sensor = 'L8'").select("id", "sensor", F.col("score").alias("error_mag_rmse"))
    return cube_ops.union_sensors(s2, l8)


@query("split_dem_epoch", f"""
    SELECT epoch, region, iy, ix, count(*) AS n, median(dx) AS dx FROM (
      SELECT *, CASE WHEN shipdate < DATE '{SWITCH}' THEN 'pre' ELSE 'post' END AS epoch FROM li) GROUP BY ALL""", ["li"])
def _(spark, d):
    marked = pair_ops.split_dem_epoch(fx.stack(spark, d), SWITCH, "shipdate")
    counts = marked.groupBy("epoch", "region", "iy", "ix").agg(F.count("*").alias("n"))
    # The mark is one more grouping key: both epochs run in one plan.
    medians = grouped_quantile(marked, ["epoch", "region", "iy", "ix"], {"dx": "dx"})
    return counts.join(medians, ["epoch", "region", "iy", "ix"])


@query("union_dem_epochs", f"""
    WITH y AS (SELECT *, CAST(year(midpoint_datetime) AS INTEGER) AS year FROM cube_id)
    SELECT region, year, id, CASE WHEN scene_1_datetime < TIMESTAMP '{SWITCH}' THEN 'pre' ELSE 'post' END AS epoch,
           row_number() OVER (PARTITION BY region, year ORDER BY scene_1_datetime, scene_2_datetime, id) - 1 AS index FROM y""", ["cube_id"])
def _(spark, d):
    marked = pair_ops.split_dem_epoch(cube_ops.split_years(cube_fields(spark, d), full_year=True), SWITCH, "scene_1_datetime")
    merged = cube_ops.union_dem_epochs(marked.where("epoch = 'pre'"), marked.where("epoch = 'post'"))
    return merged.select("region", "year", "id", "epoch", "index")


@query("date_span", """
    SELECT region, strftime(min(midpoint_datetime), '%Y-%m-%d') AS date_min, strftime(max(midpoint_datetime), '%Y-%m-%d') AS date_max,
           CAST(year(min(midpoint_datetime)) AS INTEGER) AS year_min, CAST(year(max(midpoint_datetime)) AS INTEGER) AS year_max
    FROM cube_t GROUP BY ALL""", ["cube_t"])
def _(spark, d):
    span = cube_ops.date_span(cube_fields(spark, d))
    return span.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("date_min", "date_max")})


NARROW_SQL = """
    SELECT region, id, CAST(date_diff('hour', scene_1_datetime, scene_2_datetime) // 24 AS BIGINT) AS baseline_days,
           CAST(CAST(score AS FLOAT) AS DOUBLE) AS error_mag_rmse, CAST(CAST(score / 7 AS FLOAT) AS DOUBLE) AS error_dx_mean FROM cube_id"""


@query("narrow_types", NARROW_SQL, ["cube_id"])
def _(spark, d):
    wide = cube_fields(spark, d).select(
        "region", "id", temporal.days_between(F.col("scene_1_datetime"), F.col("scene_2_datetime")).alias("baseline_days"),
        F.col("score").alias("error_mag_rmse"), (F.col("score") / 7).alias("error_dx_mean"))
    narrow = cube_ops.narrow_types(wide, schemas.CUBE_FIELDS)
    # Shown as doubles, so that both engines print the narrowed value alike.
    return narrow.withColumns({c: F.col(c).cast("double") for c in ("error_mag_rmse", "error_dx_mean")})


@query("encode_times", """
    SELECT id, epoch_us(scene_1_datetime) // 1000000 AS scene_1_datetime, epoch_us(scene_2_datetime) // 1000000 AS scene_2_datetime,
           epoch_us(midpoint_datetime) / 1000000.0 AS midpoint_datetime FROM cube_id""", ["cube_id"])
def _(spark, d):
    return cube_ops.encode_times(cube_fields(spark, d)).select("id", "scene_1_datetime", "scene_2_datetime", "midpoint_datetime")


@query("attach_attributes", """
    WITH s AS (SELECT region, 'Contains modified Copernicus Sentinel data [' || year(min(midpoint_datetime)) || ' to '
                      || year(max(midpoint_datetime)) || '].' AS credit FROM cube_t GROUP BY ALL)
    SELECT region, 'data_acknowledgement' AS name, credit AS value FROM s
    UNION ALL SELECT region, 'glacier_id', region FROM s UNION ALL SELECT region, 'creation_date', '2026-01-01 00:00:00' FROM s
    UNION ALL SELECT region, 'version', '01.1' FROM s
    UNION ALL SELECT region, 'data', 'ice surface velocity' FROM s UNION ALL SELECT region, 'units', 'm d^{-1}' FROM s
    UNION ALL SELECT region, 'source', 'Landsat-8 and Sentinel-2 optical imagery' FROM s
    UNION ALL SELECT region, 'projection', 'WGS 84 / NSDIC Sea Ice Polar Stereographic North' FROM s
    UNION ALL SELECT region, 'epsg', '3413' FROM s UNION ALL SELECT region, 'coordinate_unit', 'm' FROM s
    UNION ALL SELECT region, 'spatial_resolution', '100 m' FROM s UNION ALL SELECT region, 'Conventions', 'CF-1.7' FROM s""", ["cube_t"])
def _(spark, d):
    tagged = cube_ops.attach_attributes(cube_fields(spark, d))
    return cube_ops.dataset_attributes(tagged, {"version": "01.1"}, created="2026-01-01 00:00:00")


@query("sink_cube_region_year", """
    WITH y AS (SELECT c.*, 'P' || left(region, 3) AS public_id, CAST(year(midpoint_datetime) AS INTEGER) AS year FROM cube_id c
               WHERE midpoint_datetime <= make_timestamp(year(midpoint_datetime), 12, 31, 0, 0, 0)),
    i AS (SELECT *, row_number() OVER (PARTITION BY public_id, year ORDER BY scene_1_datetime, scene_2_datetime, id) - 1 AS index FROM y)
    SELECT i.public_id, i.year, i.index, l.iy, l.ix, CAST(CAST(l.dx AS FLOAT) AS DOUBLE) AS vx, CAST(CAST(l.dy AS FLOAT) AS DOUBLE) AS vy
    FROM i JOIN li l ON l.field_id = i.field_id""", ["cube_id", "li"])
def _(spark, d):
    names = fx.regions(spark, d).select(
        F.col("region").alias("internal_processing_ID"), F.concat(F.lit("P"), F.substring("region", 1, 3)).alias("ID"))
    public = region_ops.join_public_id(cube_ops.split_years(cube_fields(spark, d)), names)
    fields = cube_ops.cube_index(public, by_year=True, group=("public_id",))
    pixels = fx.stack(spark, d).select("field_id", "iy", "ix", F.col("dx").alias("vx"), F.col("dy").alias("vy")).join(
        fields.select("field_id", "public_id", "year", "index"), "field_id").drop("field_id")
    out = scratch_dir(spark, "cube")
    sinks.sink_cube(cube_ops.narrow_types(pixels, schemas.CUBE_PIXELS), fields, out)
    back = spark.read.parquet(f"{out}/pixels")
    return back.select("public_id", "year", "index", "iy", "ix", F.col("vx").cast("double").alias("vx"), F.col("vy").cast("double").alias("vy"))
