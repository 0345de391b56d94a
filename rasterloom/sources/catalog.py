"""Saved scene catalogues and their selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom import schemas
from rasterloom.functions import names

# Path of each flat column inside a catalogue item. The band asset comes apart from it.
FLAT_COLUMNS = {
    "id": "id",
    "bbox": "bbox",
    "collection": "collection",
    "datetime": "properties.datetime",
    "cloud_cover": "properties.`eo:cloud_cover`",
    "sun_azimuth": "properties.`view:sun_azimuth`",
    "sun_elevation": "properties.`view:sun_elevation`",
    "platform": "properties.platform",
    "instruments": "properties.instruments",
    "off_nadir": "properties.`view:off_nadir`",
    "cloud_cover_land": "properties.`landsat:cloud_cover_land`",
    "wrs_type": "properties.`landsat:wrs_type`",
    "wrs_path": "properties.`landsat:wrs_path`",
    "wrs_row": "properties.`landsat:wrs_row`",
    "scene_id": "properties.`landsat:scene_id`",
    "collection_category": "properties.`landsat:collection_category`",
    "collection_number": "properties.`landsat:collection_number`",
    "correction": "properties.`landsat:correction`",
    "proj_epsg": "properties.`proj:code`",
    "proj_shape": "properties.`proj:shape`",
    "proj_transform": "properties.`proj:transform`",
    "created": "properties.created",
    "updated": "properties.updated",
    "geometry_type": "geometry.type",
    "coordinates": "geometry.coordinates",
}
NIR_PLATFORMS = ("LANDSAT_4", "LANDSAT_5")
PAN_PLATFORMS = ("LANDSAT_7", "LANDSAT_8", "LANDSAT_9")


def parse_items(documents: DataFrame, column="json", schema=schemas.CATALOG_ITEM) -> DataFrame:
    return documents.select(F.from_json(column, schema).alias("item")).select("item.*")


def _band_columns(band):
    return {"href": f"assets.{band}.href", "s3_href": f"assets.{band}.alternate.s3.href"}


def flatten_items(items: DataFrame, band: str) -> DataFrame:
    """Flat, renamed scene table with the links of one band."""
    return items.select(*[F.col(p).alias(c) for c, p in {**FLAT_COLUMNS, **_band_columns(band)}.items()])


def scan_scene_catalog(items: DataFrame) -> DataFrame:
    """Flat scene table with the near-infrared links for early platforms, else the panchromatic ones."""
    early = F.col("properties.platform").isin(*NIR_PLATFORMS)
    links = {
        c: F.when(early, F.col(_band_columns("nir08")[c])).otherwise(F.col(_band_columns("pan")[c]))
        for c in ("href", "s3_href")
    }
    return items.select(
        *[F.col(p).alias(c) for c, p in FLAT_COLUMNS.items()], *[v.alias(c) for c, v in links.items()]
    )


def union_nir_pan(items: DataFrame) -> DataFrame:
    """Early platforms by their near-infrared band, later ones by their panchromatic band, in one schema."""
    platform = F.col("properties.platform")
    nir = items.where(platform.isin(*NIR_PLATFORMS) & _has_tm(F.col("properties.instruments")))
    pan = items.where(platform.isin(*PAN_PLATFORMS))
    return flatten_items(nir, "nir08").unionByName(flatten_items(pan, "pan"))


def _has_tm(instruments):
    return F.exists(instruments, lambda i: F.contains(i, F.lit("TM")))


def filter_platforms(catalog: DataFrame) -> DataFrame:
    """Platforms 7 to 9, and 4 and 5 where they carry a thematic mapper. One scan, no union."""
    platform = F.col("platform")
    return catalog.where(
        platform.isin(*PAN_PLATFORMS) | (platform.isin(*NIR_PLATFORMS) & _has_tm(F.col("instruments")))
    )


def scan_scene_assets(items: DataFrame, band: str = "nir") -> DataFrame:
    """Link of one band with the year folder and the file name it is stored under."""
    uri = F.col("properties.`s2:product_uri`")
    stem = F.substring(uri, F.lit(1), F.length(uri) - 5)
    return items.where(F.map_contains_key("assets", band)).select(
        F.col("id").alias("scene"), F.substring("properties.datetime", 1, 4).alias("year"),
        F.try_element_at("assets", F.lit(band))["href"].alias("href"), F.concat(stem, F.lit("_B08.tif")).alias("filename"),
    )


def scene_subset_id(catalog: DataFrame) -> DataFrame:
    acquired = F.try_to_timestamp(F.substring("datetime", 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    return catalog.withColumn("subset_id", names.subset_id(acquired, F.col("scene_id"), F.col("id")))
