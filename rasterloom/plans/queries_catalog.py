"""Queries on saved scene catalogues."""

from __future__ import annotations

from pyspark.sql import functions as F

from rasterloom import schemas
from rasterloom.operators import scenes as scene_ops
from rasterloom.plans import fixtures as fx
from rasterloom.plans.registry import query
from rasterloom.session import scratch_dir
from rasterloom.sources import catalog as cat_ops, sinks


def items(spark, d):
    """Saved search results: one JSON document per item, read back with the declared schema."""
    c = fx.catalog(spark, d)

    def asset(band):
        href = F.concat(F.lit(f"https://example.org/{band}/"), F.col("id"))
        s3 = F.concat(F.lit(f"s3://bucket/{band}/"), F.col("id"))
        return F.struct(href.alias("href"), F.struct(F.struct(s3.alias("href")).alias("s3")).alias("alternate"))

    properties = F.struct(
        "datetime", F.col("cloud_cover").alias("eo:cloud_cover"), F.col("value").alias("view:sun_elevation"), "platform",
        F.array("instrument").alias("instruments"), F.substring("path_row", 1, 3).alias("landsat:wrs_path"),
        F.substring("path_row", 4, 3).alias("landsat:wrs_row"), F.col("scene_id").alias("landsat:scene_id"),
        F.lit("EPSG:32622").alias("proj:code"), F.array(F.lit(7000), F.lit(8000)).alias("proj:shape"),
    )
    x = (F.col("user_id") % 60).cast("double")
    document = F.struct(
        "id", F.array(x, x + 1, x + 2, x + 3).alias("bbox"), F.lit("landsat-c2l1").alias("collection"),
        properties.alias("properties"), F.struct(asset("nir08").alias("nir08"), asset("pan").alias("pan")).alias("assets"),
    )
    return cat_ops.parse_items(c.select(F.to_json(document).alias("json")))


CATALOG_SQL = """
    SELECT id, 'landsat-c2l1' AS collection, datetime, cloud_cover, value AS sun_elevation, platform, instrument AS instruments,
           left(path_row, 3) AS wrs_path, right(path_row, 3) AS wrs_row, scene_id, 'EPSG:32622' AS proj_epsg,
           CAST(user_id % 60 AS DOUBLE) AS west, CAST(user_id % 60 + 3 AS DOUBLE) AS north,
           CASE WHEN platform IN ('LANDSAT_4', 'LANDSAT_5') THEN 'https://example.org/nir08/' ELSE 'https://example.org/pan/' END || id AS href,
           CASE WHEN platform IN ('LANDSAT_4', 'LANDSAT_5') THEN 's3://bucket/nir08/' ELSE 's3://bucket/pan/' END || id AS s3_href
    FROM cat"""
KEPT = "platform IN ('LANDSAT_7', 'LANDSAT_8', 'LANDSAT_9') OR (platform IN ('LANDSAT_4', 'LANDSAT_5') AND instruments LIKE '%TM%')"
SHOWN = ("id", "collection", "datetime", "cloud_cover", "sun_elevation", "platform", "wrs_path", "wrs_row", "scene_id", "proj_epsg",
         "href", "s3_href")


def shown(df):
    """Arrays as text and single corners for the check."""
    return df.select(*SHOWN, F.array_join("instruments", ",").alias("instruments"), F.get("bbox", F.lit(0)).alias("west"),
                     F.get("bbox", F.lit(3)).alias("north"))


@query("scan_scene_catalog", CATALOG_SQL, ["cat"])
def _(spark, d):
    return shown(cat_ops.scan_scene_catalog(items(spark, d)))


@query("filter_platforms", f"SELECT * FROM ({CATALOG_SQL}) WHERE {KEPT}", ["cat"])
def _(spark, d):
    return shown(cat_ops.filter_platforms(cat_ops.scan_scene_catalog(items(spark, d))))


@query("union_nir_pan", f"SELECT * FROM ({CATALOG_SQL}) WHERE {KEPT}", ["cat"])
def _(spark, d):
    return shown(cat_ops.union_nir_pan(items(spark, d)))


@query("scan_scene_assets", """
    SELECT 'item-' || event_id AS scene, strftime(ts, '%Y') AS year, 'https://example.org/' || name || '/B08' AS href,
           name || '_B08.tif' AS filename FROM scenes WHERE NOT is_done""", ["scenes"])
def _(spark, d):
    # Finished scenes come without the band, as some items do.
    links = F.create_map(
        F.lit("red"), F.struct(F.concat(F.lit("https://example.org/"), F.col("name"), F.lit("/B04")).alias("href")),
        F.when(F.col("is_done"), "thumbnail").otherwise("nir"),
        F.struct(F.concat(F.lit("https://example.org/"), F.col("name"), F.lit("/B08")).alias("href")),
    )
    document = F.struct(
        F.concat(F.lit("item-"), F.col("event_id").cast("string")).alias("id"),
        F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("datetime"),
                 F.concat("name", F.lit(".SAFE")).alias("s2:product_uri")).alias("properties"), links.alias("assets"))
    saved = fx.scenes(spark, d).select(F.to_json(document).alias("json"))
    return cat_ops.scan_scene_assets(cat_ops.parse_items(saved, schema=schemas.ASSET_ITEM))


SUBSET_SQL = "SELECT id, strftime(ts, '%Y%m%d%H%M%S') || '_' || scene_id || '_' || id || '_ortho' AS subset_id, event_id, ts, event_id % 25 AS k FROM cat"


def with_subset_id(spark, d):
    return cat_ops.scene_subset_id(fx.catalog(spark, d))


@query("scene_subset_id", f"SELECT id, subset_id FROM ({SUBSET_SQL})", ["cat"])
def _(spark, d):
    return with_subset_id(spark, d).select("id", "subset_id")


def regional_catalog(spark, d):
    k = F.col("event_id") % 25
    region = F.concat(F.lpad(k.cast("string"), 3, "0"), F.lit("_NATION_"), k.cast("string"))
    return with_subset_id(spark, d).withColumn("region", region)


def regional_done(spark, d):
    return regional_catalog(spark, d).join(fx.done(spark, d).select("event_id"), "event_id", "left_semi")


NEW_SQL = f"""
    WITH c AS (SELECT *, lpad(CAST(k AS VARCHAR), 3, '0') || '_NATION_' || k AS region, left(subset_id, 14) AS stamp FROM ({SUBSET_SQL})),
    done AS (SELECT c.region, c.stamp FROM c JOIN scenes s ON s.event_id = c.event_id WHERE s.is_done)
    SELECT region, subset_id FROM c WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.region = c.region AND d.stamp = c.stamp)"""


@query("anti_new_scenes", NEW_SQL, ["cat", "scenes"])
def _(spark, d):
    return scene_ops.anti_new_scenes(regional_catalog(spark, d), regional_done(spark, d)).select("region", "subset_id")


@query("sink_catalog_results", NEW_SQL, ["cat", "scenes"])
def _(spark, d):
    out = scratch_dir(spark, "catalog-results")
    fresh = scene_ops.anti_new_scenes(regional_catalog(spark, d), regional_done(spark, d))
    sinks.sink_catalog_results(fresh.select("region", "subset_id", "platform", "cloud_cover"), out)
    return spark.read.parquet(out).select("region", "subset_id")


@query("sink_failures", """
    SELECT 'scene-' || event_id AS unit, 'unreadable stamp: ' || event_type AS error FROM events WHERE event_type = 'error'""")
def _(spark, d):
    # A scene whose stamp cannot be read is recorded; the others go on.
    stamp = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.date_format("ts", "yyyyMMddHHmmss"))
    units = fx.table(spark, d, "events").select(
        F.concat(F.lit("scene-"), F.col("event_id").cast("string")).alias("unit"), stamp.alias("stamp"))
    read = units.withColumn("acquired", F.try_to_timestamp("stamp", F.lit("yyyyMMddHHmmss")))
    checked = read.withColumn("error", F.when(F.col("acquired").isNull(), F.concat(F.lit("unreadable stamp: "), "stamp")))
    _good, failed = sinks.split_failures(checked)
    out = scratch_dir(spark, "failures")
    for _ in range(2):  # the second is a retry
        sinks.sink_failures(failed.select("unit", "error"), out, "first")
    return spark.read.parquet(out).select("unit", "error")
