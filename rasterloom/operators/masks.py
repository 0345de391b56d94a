"""Ice, ocean and rock masks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.operators.spatial import join_boxes

CELL = ["region", "iy", "ix"]


def rock_mask(masks: DataFrame) -> DataFrame:
    """Rock is what is neither ice nor ocean."""
    return masks.withColumn("is_rock", ~F.col("is_ice") & ~F.col("is_ocean"))


def join_masks(px: DataFrame, masks: DataFrame) -> DataFrame:
    return px.join(masks, CELL, "left")


def apply_field_mask(px: DataFrame, mask: DataFrame, columns, keep_only_one=False) -> DataFrame:
    """Null where a field's companion mask is 0 (or, for Landsat, not 1).

    ``mask`` holds ``region, field_id, iy, ix, mask`` for the fields that have one; fields without a
    mask stay as they are.
    """
    joined = px.join(mask, ["region", "field_id", "iy", "ix"], "left")
    drop = F.col("mask") != 1 if keep_only_one else F.col("mask") == 0
    hidden = F.coalesce(drop, F.lit(False))
    return joined.withColumns({c: F.when(~hidden, F.col(c)) for c in columns}).drop("mask")


def join_extent_intersects(tiles: DataFrame, regions: DataFrame, finest: float | None = None) -> DataFrame:
    """Mask tiles and the regions whose box they touch."""
    return join_boxes(tiles, regions, finest).select("tile", "region")


def merge_mask_tiles(tile_cells: DataFrame, tiles: DataFrame, regions: DataFrame, res: float, finest: float | None = None) -> DataFrame:
    """Masks on each region's grid from the tiles that touch it; on overlap the later tile wins.

    ``tile_cells`` holds ``tile, x, y`` (cell centres) and the flags.
    """
    boxes = regions.select("region", F.col("xmin").alias("rx0"), F.col("ymin").alias("ry0"),
                           F.col("xmax").alias("rx1"), F.col("ymax").alias("ry1"))
    wanted = join_extent_intersects(tiles, regions, finest).join(boxes, "region")
    # Cells may come from a small table that unfolds them, which Spark would take for small itself and broadcast.
    inside = tile_cells.hint("merge").join(wanted, "tile").where(
        (F.col("x") >= F.col("rx0")) & (F.col("x") < F.col("rx1")) & (F.col("y") > F.col("ry0")) & (F.col("y") <= F.col("ry1"))
    )
    placed = inside.select(
        "region", F.floor((F.col("ry1") - F.col("y")) / res).cast("int").alias("iy"),
        F.floor((F.col("x") - F.col("rx0")) / res).cast("int").alias("ix"), "tile", "is_ice", "is_ocean",
    )
    return placed.groupBy(*CELL).agg(
        F.max_by("is_ice", "tile").alias("is_ice"), F.max_by("is_ocean", "tile").alias("is_ocean")
    )
