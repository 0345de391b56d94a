"""The composed jobs a user calls.

Regions, orbit pairs and, where ``Settings.dem_switch`` is set, elevation-model epochs are columns, so one
plan serves all of them. Jobs whose intermediates feed several steps write them while being called.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom import schemas
from rasterloom.functions import names
from rasterloom.functions.grid import Grid
from rasterloom.operators import (
    blocks as block_ops, correction, cube, documents, footprints as footprint_ops, masks as mask_ops, mosaic, offsets, pairs as pair_ops, regions as region_ops,
    resample, scenes as scene_ops, spatial,
)
from rasterloom.session import scratch_dir
from rasterloom.sources import catalog as cat_ops

FIELD = correction.FIELD
MOSAIC = ["region", "mosaic_key"]


@dataclass(frozen=True)
class Settings:
    """Thresholds of the jobs."""

    min_overlap: float = 0.05
    min_coverage: float = 0.5
    template_coverage: float = 0.95
    min_fields: int = pair_ops.MIN_FIELDS
    max_angle: float = correction.MAX_ANGLE
    min_ice_share: float = correction.MIN_ICE_SHARE
    # Least bin of the box index; without one the boxes' own sizes decide.
    finest_bin: float | None = None
    # Day from which pairs were made with another elevation model; offsets are estimated apart before and after.
    dem_switch: str | None = None
    dem_date: str = "datetime_1"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate that several later steps read, and read it back.

    Unlike a cache it outlives lost executors, and it cuts the lineage.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scene_selection(catalog: DataFrame, regions: DataFrame, done: DataFrame, cfg=Settings()) -> DataFrame:
    """Catalogue to new scenes per region: platform, overlap, id, minus what is stored.

    ``catalog`` is flat and carries the footprint ring with its bounding box. ``done`` holds stored
    subset ids, with a ``region`` if they count for that region only.
    """
    usable = cat_ops.filter_platforms(catalog)
    near = spatial.filter_intersect_fraction(spatial.join_footprint_overlap(usable, regions, cfg.finest_bin), cfg.min_overlap)
    return scene_ops.anti_new_scenes(cat_ops.scene_subset_id(near), done)


def scene_selection_from_coordinates(catalog: DataFrame, regions: DataFrame, done: DataFrame, cfg=Settings()) -> DataFrame:
    """``scene_selection`` of a catalogue as it was found: its polygons in degrees are projected here."""
    usable = footprint_ops.project_footprints(cat_ops.filter_platforms(catalog))
    return scene_selection(usable, regions, done, cfg)


def tile_scene_selection(scenes: DataFrame, regions: DataFrame, done: DataFrame, start: str, end: str) -> DataFrame:
    """Scene names to the mosaics still to be made: region, mosaic_key, acquired, n_scenes.

    Scenes of the region's tile list, acquired from ``start`` up to the end of ``end`` (yyyyMMdd), a copy of a scene once, minus the
    mosaics in ``done`` (region, mosaic_key). Scenes are grouped once a tile list; regions get their rows after that.
    """
    members, tiles = scene_ops.tile_lists(scene_ops.tile_priority(regions))
    stamp = F.get(F.split("name", "_"), F.lit(2))
    named = scene_ops.add_tile_and_zone(scene_ops.add_mosaic_key(scenes.select("name").distinct())).withColumn("acquired", names.datetime_to_timestamp(stamp))
    period = named.where(F.substring(stamp, 1, 8).between(start, end))
    listed = scene_ops.scenes_per_region(period, tiles)
    mosaics = listed.groupBy("list", "mosaic_key").agg(F.min("acquired").alias("acquired"), F.count(F.lit(1)).alias("n_scenes"))
    return mosaics.join(members, "list").select(*MOSAIC, "acquired", "n_scenes").join(done.select(*MOSAIC), MOSAIC, "left_anti")


def mosaic_clip(
    px: DataFrame, scenes: DataFrame, regions: DataFrame, src: Grid, template: Grid | float, cell_m2: float, cfg=Settings()
):
    """Tiles to clipped mosaics with enough coverage, and their lineage: (pixels, lineage).

    ``px`` holds ``name, tile, iy, ix, value`` on the grid ``src``; ``scenes`` one row per tile image,
    ``name, tile``. ``template`` is one grid for all regions, or the cell size of each region's own.

    Cells go onto the template before tiles are merged. Nearest neighbour only relabels cells, so the
    result is the same, and what lies outside the region never reaches the shuffle.
    """
    tiles = scene_ops.tile_priority(regions)
    ranked = scene_ops.scenes_per_region(px, tiles).withColumn("mosaic_key", names.mosaic_key(F.col("name")))
    if not isinstance(template, Grid):
        grids = region_ops.grid_spec(regions, template, template).select("region", "xmin", "ymax", "res", "width", "height")
        ranked, template = ranked.join(grids, "region"), Grid.of_columns()
    # Coverage, output and lineage all read the mosaic, so it is stored once.
    clipped = materialise(mosaic.mosaic_first_valid(mosaic.mosaic_match_template(ranked, src, template), MOSAIC), "mosaics")
    areas = scene_ops.coverage_area(clipped, MOSAIC, cell_m2)
    kept = scene_ops.filter_coverage(scene_ops.coverage_fraction(areas, regions), cfg.min_coverage).select(*MOSAIC)
    return clipped.join(kept, MOSAIC, "left_semi"), scene_ops.mosaic_lineage(scenes, tiles).join(kept, MOSAIC, "left_semi")


def mosaic_clip_blocks(
    blocks: DataFrame, scenes: DataFrame, regions: DataFrame, src: Grid, template: Grid, bh: int, bw: int, cell_m2: float, cfg=Settings()
):
    """``mosaic_clip`` from stored blocks, ``name, tile, by, bx, value``, to (pixels, lineage) on one template.

    Tiles are brought onto the template once and merged once a tile list, not once a region, and stay arrays until
    the pixels that are delivered are made. Mosaics are stored once. Pixels carry their mosaic's ``sources``: what is
    known of a mosaic joins its blocks, and rows by region and cell are made last and never shuffled.
    """
    listed = ["list", "mosaic_key"]
    members, tiles = scene_ops.tile_lists(scene_ops.tile_priority(regions))
    placed, oh, ow = resample.nearest_blocks(blocks, src, template, ["name", "tile"], bh, bw)
    ranked = scene_ops.scenes_per_region(placed, tiles).withColumn("mosaic_key", names.mosaic_key(F.col("name")))
    merged = materialise(mosaic.first_valid_blocks(ranked, listed), "mosaics")
    cells = F.sum(F.size(F.filter("value", lambda x: x > 0)))
    areas = merged.groupBy(*listed).agg((cells * cell_m2 / 1e6).alias("area_covered_km2"))
    # Both sides have a row for each mosaic, so neither is for a broadcast, whatever its estimate.
    known = areas.hint("merge").join(scene_ops.list_lineage(scenes, tiles), listed, "left")

    def kept(df):
        return scene_ops.filter_coverage(scene_ops.coverage_fraction(df.join(members, "list"), regions), cfg.min_coverage)

    delivered = kept(merged.hint("merge").join(known.select(*listed, "area_covered_km2", "sources"), listed))
    pixels = block_ops.scan_blocks(delivered, [*MOSAIC, "sources"], ["value"], oh, ow, template.height, template.width)
    return pixels, kept(known.where("sources IS NOT NULL")).select(*MOSAIC, "sources", "n_sources")


def mosaic_regions(px: DataFrame, scenes: DataFrame, regions: DataFrame, res: float, template_res: float, cfg=Settings(), size=block_ops.BLOCK):
    """Tiles of one or two UTM zones to mosaics on each region's polar grid: (pixels, lineage, templates).

    ``px`` holds ``name, x, y, value`` with cells of ``res`` in the tile's zone, ``scenes`` one row per tile image with
    ``name`` and the time ``acquired``. Mosaics whose tiles lie in one zone take their nearest cells; those of two
    zones are brought onto the grid by the cubic kernel, the zone of the region's first tile in front. Mosaics that
    cover more than ``min_coverage`` of their region stay. ``templates`` has, for each region, the
    earliest mosaic that covers ``template_coverage`` of it.
    """
    grids = region_ops.grid_spec(regions, template_res, template_res).select("region", "xmin", "ymax", "res", "width", "height")
    tiles = scene_ops.tile_priority(regions)
    named = scene_ops.add_tile_and_zone(scene_ops.add_mosaic_key(scenes.select("name", "acquired"))).withColumn("zone", F.col("zone").cast("int"))
    listed = materialise(scene_ops.scenes_per_region(named, tiles).select(*MOSAIC, F.col("name").alias("tile"), "zone", "rank", "acquired"), "tiles")
    cells = px.withColumnRenamed("name", "tile").join(listed.select(*MOSAIC, "tile"), "tile")
    found = mosaic.mosaic_two_zone(cells, listed.join(grids, "region"), res, Grid.of_columns(), MOSAIC, size, one_zone="nearest")
    found = materialise(found, "mosaics")
    areas = scene_ops.coverage_fraction(scene_ops.coverage_area(found, MOSAIC, template_res**2), regions)
    covered = materialise(areas.join(listed.groupBy(*MOSAIC).agg(F.min("acquired").alias("acquired")), MOSAIC), "coverage")
    kept = scene_ops.filter_coverage(covered, cfg.min_coverage).select(*MOSAIC)
    templates = scene_ops.pick_template(covered.withColumnRenamed("mosaic_key", "scene"), cfg.template_coverage).withColumnRenamed("scene", "mosaic_key")
    lineage = scene_ops.mosaic_lineage(named, tiles).join(kept, MOSAIC, "left_semi")
    return found.join(kept, MOSAIC, "left_semi"), lineage, templates


def orbit_pairs(scenes: DataFrame, good: DataFrame, start: str, end: str) -> DataFrame:
    """Scene names and quality lists to the pair table.

    ``start`` and ``end`` are ``yyyyMMdd``; ``scenes`` holds ``region, name``, ``good`` ``region, id``.
    """
    named = pair_ops.filter_scene_dates(pair_ops.parse_scene_names(scenes), start, end)
    orbits = pair_ops.filter_orbit_dates(named, start, end).drop("name")
    iso = [f"{s[:4]}-{s[4:6]}-{s[6:]}" for s in (start, end)]
    dated = pair_ops.filter_pair_dates(pair_ops.parse_pair_dates(good), *iso)
    return pair_ops.orbit_pair_label(pair_ops.pair_temporal(pair_ops.join_pair_orbits(dated, orbits)))


def _epochs(pairs: DataFrame, cfg) -> DataFrame:
    return pair_ops.split_dem_epoch(pairs, cfg.dem_switch, cfg.dem_date) if cfg.dem_switch else pairs


def _masked(px_wide: DataFrame, field_mask, keep_only_one=False) -> DataFrame:
    """Companion masks of single fields, where there are any."""
    return px_wide if field_mask is None else mask_ops.apply_field_mask(px_wide, field_mask, ["dx", "dy"], keep_only_one)


def offset_fields(px_wide: DataFrame, pairs: DataFrame, width: int, height: int, cfg=Settings(), field_mask: DataFrame | None = None):
    """A priori field, reference direction and offsets: (a_priori, flow, offsets).

    ``field_mask`` holds the fields' companion masks, applied before any median. The a priori field is one
    value per region and cell and feeds three later steps; the offsets, one
    vector per orbit pair and cell, are read by every pass over the pixels. Both are written once.
    """
    px_wide, pairs = _masked(px_wide, field_mask), _epochs(pairs, cfg)
    long = offsets.to_long(offsets.add_magnitude(px_wide))
    a_priori = materialise(offsets.a_priori_field(long, pairs, width, height), "a-priori")
    table = materialise(offsets.orbit_pair_offset(px_wide, pairs, a_priori, cfg.min_fields), "offsets")
    return a_priori, offsets.flow_reference(a_priori), table


def correct_fields(
    px_wide: DataFrame, pairs: DataFrame, offset_table: DataFrame, masks: DataFrame, flow: DataFrame, res: float, cfg=Settings(),
    field_mask: DataFrame | None = None, src: Grid | None = None, dst: Grid | None = None,
):
    """Correct, measure error on rock, filter by direction and coverage: (pixels, documents).

    Errors are taken before the direction filter, coverage after it. ``masks`` carries ice and ocean,
    ``pairs`` the scene columns and the region's bounds.

    With ``src`` and ``dst`` fields are brought onto the region's grid first, by cubic resampling;
    ``field_mask`` is applied after that, on the region's grid.

    The corrected pixels are written once; the statistics, a row per field, and the output are read from
    there.
    """
    flags = mask_ops.rock_mask(masks)
    if src is not None and dst is not None:
        px_wide = resample.resample_cubic(px_wide, src, dst, FIELD, ("dx", "dy"))
    px_wide, marked = _masked(px_wide, field_mask), _epochs(pairs, cfg)
    corrected = correction.apply_offset(correction.join_offsets(px_wide, marked, offset_table))
    ready = materialise(correction.join_flow_reference(mask_ops.join_masks(corrected, flags), flow), "corrected")
    stats = materialise(
        correction.covered_fields(correction.field_statistics(ready, masks), cfg.min_ice_share), "field-statistics"
    )
    filtered = correction.flow_filter(ready, cfg.max_angle).join(stats.select(*FIELD), FIELD, "left_semi")
    px = offsets.add_magnitude(filtered).select(
        *FIELD, "iy", "ix", F.col("dx").alias("vx"), F.col("dy").alias("vy"), F.col("dmag").alias("vv")
    )
    named = pairs.join(stats, FIELD).withColumn(
        "id", pair_ops.sentinel_field_id(F.col("region"), F.col("datetime_1"), F.col("datetime_2"))
    )
    return px, documents.build_field_document(named, res)


def cube_sentinel(px: DataFrame, docs: DataFrame):
    """Corrected fields to a typed, indexed cube: (pixels, fields)."""
    text = docs.select("region", "field_id", F.to_json("document").alias("value"))
    meta = documents.scan_field_metadata(text).withColumn(
        "id", pair_ops.cube_field_id(F.col("region"), F.col("scene_1_datetime"), F.col("scene_2_datetime"), F.lit("S2"))
    )
    indexed = cube.attach_attributes(cube.narrow_types(cube.cube_index(meta), schemas.CUBE_FIELDS))
    pixels = px.select(*FIELD, "iy", "ix", "vx", "vy").join(indexed.select(*FIELD, "index"), FIELD)
    return cube.narrow_types(pixels, schemas.CUBE_PIXELS), indexed


def cube_landsat(
    px_wide: DataFrame, good: DataFrame, metas: DataFrame, masks: DataFrame, src: Grid, dst: Grid, start: str, end: str,
    field_mask: DataFrame | None = None,
):
    """Landsat fields to a typed, indexed cube: (pixels, fields). Of a field with a companion mask only cells marked 1 count.

    ``good`` holds ``region, field_id, id`` with two 14-digit stamps in the id, ``metas`` the two scene
    ids per field as ``region, field_id, ids``.
    """
    scene = [F.get("ids", F.lit(n)) for n in (0, 1)]
    parsed = metas.select(*FIELD, *names.landsat_id_columns(scene[0], "1"), *names.landsat_id_columns(scene[1], "2"))
    dated = pair_ops.filter_pair_dates(pair_ops.parse_landsat_dates(good), start, end)
    fields = pair_ops.pair_temporal_landsat(pair_ops.drop_aster_pairs(dated.join(parsed, FIELD)))
    valid = correction.landsat_valid(_masked(px_wide, field_mask, keep_only_one=True)).join(fields.select(*FIELD), FIELD, "left_semi")
    placed = resample.resample_bilinear(valid, src, dst, FIELD, ("dx", "dy"))
    flags = mask_ops.rock_mask(masks)
    errors = correction.rock_error_landsat(mask_ops.join_masks(placed, flags))
    share = correction.ice_share_landsat(masks)
    a, b = F.col("date1"), F.col("date2")
    meta = fields.join(errors, FIELD).join(share, "region").select(
        *FIELD, pair_ops.cube_field_id(F.col("region"), a, b, F.lit("L8")).alias("id"), a.alias("scene_1_datetime"),
        b.alias("scene_2_datetime"), F.col("baseline").alias("baseline_days"), F.col("midpoint").alias("midpoint_datetime"),
        F.col("satellite1").alias("scene_1_satellite"), F.col("satellite2").alias("scene_2_satellite"),
        F.col("path_row1").alias("scene_1_orbit"), F.col("path_row2").alias("scene_2_orbit"),
        F.col("baseline1").alias("scene_1_processing_version"), F.col("baseline2").alias("scene_2_processing_version"),
        "percent_ice_area_notnull", F.col("mag_rmse").alias("error_mag_rmse"),
        *[F.col(c).alias(f"error_{c}") for c in correction.ERROR_COLUMNS[1:]],
    )
    # A row per field; stored, so that numbering does not run the pixels again.
    meta = materialise(meta, "landsat-fields")
    indexed = cube.attach_attributes(cube.narrow_types(cube.cube_index(meta), schemas.CUBE_FIELDS))
    pixels = placed.withColumnsRenamed({"dx": "vx", "dy": "vy"}).join(indexed.select(*FIELD, "index"), FIELD)
    return cube.narrow_types(pixels, schemas.CUBE_PIXELS), indexed


def delivery(s2: DataFrame | None, l8: DataFrame | None, public_names: DataFrame, full_year: bool = False) -> DataFrame:
    """Fields of both sensors and of all epochs, numbered per public id and year.

    Pixels follow by joining on the fields' keys; ``sinks.sink_cube`` writes both.
    """
    named = region_ops.join_public_id(cube.union_sensors(s2, l8), public_names)
    return cube.cube_index(cube.split_years(named, full_year), by_year=True, group=("public_id",))
