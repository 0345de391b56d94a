"""Scene tables: keys, tiles, selection, lineage, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import names


def add_mosaic_key(scenes: DataFrame) -> DataFrame:
    return scenes.withColumn("mosaic_key", names.mosaic_key(F.col("name")))


def add_tile_and_zone(scenes: DataFrame) -> DataFrame:
    return scenes.withColumns({"tile": names.tile_of(F.col("name")), "zone": names.zone_of(F.col("name"))})


def tile_priority(regions: DataFrame) -> DataFrame:
    """Region, tile and the tile's rank in the region's list."""
    return regions.select("region", F.posexplode(F.split("utm_grid", ",")).alias("rank", "tile"))


def filter_tiles(scenes: DataFrame, region_tiles: DataFrame, keys=("region", "tile")) -> DataFrame:
    """Scenes whose tile is on the region's list."""
    return scenes.join(region_tiles.select(*keys), list(keys), "left_semi")


def scenes_per_region(scenes: DataFrame, region_tiles: DataFrame) -> DataFrame:
    """Every scene once per region that lists its tile."""
    return scenes.join(region_tiles, "tile")


def order_scenes(scenes: DataFrame) -> DataFrame:
    """By acquisition time."""
    return scenes.orderBy(names.datetime_to_timestamp(F.get(F.split("name", "_"), F.lit(2))), "name")


def distinct_keys(df: DataFrame, *columns) -> DataFrame:
    return df.select(*columns).distinct()


def skip_processed(todo: DataFrame, done: DataFrame, key="mosaic_key") -> DataFrame:
    """Work whose key is not in the output yet."""
    return todo.join(done.select(key), [key], "left_anti")


def difference_processed(keys: DataFrame, done: DataFrame) -> DataFrame:
    """Set difference of two key tables."""
    return keys.subtract(done)


def anti_new_scenes(catalog: DataFrame, done: DataFrame) -> DataFrame:
    """Scenes whose time stamp (14 characters of the subset id) is not stored yet.

    Only the stamp counts, so a scene is dropped with any stored one of its second; several new scenes
    of one second all stay. ``done`` without a region counts for all regions.
    """
    stamp = F.substring("subset_id", 1, names.STAMP_LENGTH).alias("stamp")
    keys = ["region", "stamp"] if "region" in done.columns else ["stamp"]
    return catalog.withColumn("stamp", stamp).join(done.withColumn("stamp", stamp).select(*keys), keys, "left_anti").drop("stamp")


def shared_tiles(scenes: DataFrame, region_tiles: DataFrame) -> DataFrame:
    """Each needed scene once, with the number of regions that use it.

    The count is per tile, so it is taken on the small list before the scenes are joined.
    """
    users = region_tiles.groupBy("tile").agg(F.count_distinct("region").alias("n_regions"))
    return scenes.select("tile", "name").distinct().join(users, "tile")


def tile_lists(region_tiles: DataFrame, collect=F.collect_set) -> tuple[DataFrame, DataFrame]:
    """Regions with one tile list have the same mosaics: (list and region, list and its ranks and tiles).

    A list is named after the first of its regions. Work on scenes is done once a list, not once a region.
    ``collect_list`` keeps the copies of a region's rows, for counts.
    """
    per_region = region_tiles.groupBy("region").agg(F.sort_array(collect(F.struct("rank", "tile"))).alias("_tiles"))
    lists = per_region.groupBy("_tiles").agg(F.min("region").alias("list"), F.collect_list("region").alias("_regions"))
    return lists.select("list", F.explode("_regions").alias("region")), lists.select("list", F.inline("_tiles"))


def list_lineage(scenes: DataFrame, tiles: DataFrame) -> DataFrame:
    """Sources of every mosaic of a tile list, ``list, rank, tile``, in the list's order, comma-joined.

    Copies fall away first, so the sources are no more than the list's tiles.
    """
    named = scenes_per_region(scenes.select("name", "tile"), tiles)
    unique = named.select("list", names.mosaic_key(F.col("name")).alias("mosaic_key"), "rank", "name").distinct()
    ordered = F.sort_array(F.collect_list(F.struct("rank", "name")))
    return unique.groupBy("list", "mosaic_key").agg(
        F.array_join(F.transform(ordered, lambda s: F.concat(s["name"], F.lit("_B08.tif"))), ",").alias("sources"),
        F.count("*").alias("n_sources"),
    )


def mosaic_lineage(scenes: DataFrame, region_tiles: DataFrame) -> DataFrame:
    """Sources of every mosaic in the region's tile order, comma-joined.

    Regions get their rows in the last step, so scenes are neither told apart nor shuffled once a region.
    """
    members, tiles = tile_lists(region_tiles)
    return list_lineage(scenes, tiles).join(members, "list").select("region", "mosaic_key", "sources", "n_sources")


def funnel_counts(scenes: DataFrame, region_tiles: DataFrame, done: DataFrame) -> DataFrame:
    """Per region: scenes on its tiles, distinct mosaics among them, mosaics left to do.

    Mosaics are counted from a table of distinct keys, so no task holds a region's key set. Keys are told apart
    once a tile list; regions get their list's counts in the last step.
    """
    key = names.mosaic_key(F.col("name")).alias("mosaic_key")
    members, tiles = tile_lists(region_tiles, F.collect_list)
    on_tile = scenes_per_region(scenes.select("tile", key), tiles)
    finished = done.select(key).distinct().withColumn("_done", F.lit(True))
    per_key = on_tile.groupBy("list", "mosaic_key").agg(F.count("*").alias("n")).join(finished, "mosaic_key", "left")
    per_list = per_key.groupBy("list").agg(
        F.sum("n").alias("n_in_tile"), F.count("*").alias("n_unique"),
        F.count_if(F.col("_done").isNull()).alias("n_remaining"),
    )
    return per_list.join(members, "list").select("region", "n_in_tile", "n_unique", "n_remaining")


def pick_template(coverage: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Earliest scene per region whose merged coverage reaches the threshold."""
    good = coverage.where(F.col("coverage") >= threshold)
    return good.groupBy("region").agg(
        F.min_by("scene", F.struct("acquired", "scene")).alias("scene"), F.min("acquired").alias("acquired")
    )


def coverage_area(px: DataFrame, keys, cell_m2: float, value="value") -> DataFrame:
    """Area in km2 of the cells above zero."""
    return px.groupBy(*keys).agg((F.count_if(F.col(value) > 0) * cell_m2 / 1e6).alias("area_covered_km2"))


def coverage_fraction(areas: DataFrame, regions: DataFrame) -> DataFrame:
    """Covered share of the region's stored area."""
    return areas.join(regions.select("region", "area_km2"), "region").withColumn(
        "coverage", F.try_divide("area_covered_km2", "area_km2")
    )


def filter_coverage(coverage: DataFrame, threshold: float = 0.5) -> DataFrame:
    return coverage.where(F.col("coverage") > threshold)


def filter_template_coverage(coverage: DataFrame, threshold: float = 0.95) -> DataFrame:
    return coverage.where(F.col("coverage") >= threshold)
