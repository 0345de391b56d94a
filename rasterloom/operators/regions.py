"""Region tables: readiness, selection, geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions.grid import ceil_to


def check_crs(regions: DataFrame, expected: str = "EPSG:3413") -> DataFrame:
    """Fail on the first region in another coordinate system."""
    message = F.concat(F.lit(f"expected {expected}, found "), F.coalesce("crs", F.lit("none")))
    ok = F.col("crs").eqNullSafe(F.lit(expected))
    return regions.withColumn("crs", F.when(ok, F.col("crs")).otherwise(F.raise_error(message)))


def scan_aoi_regions(regions: DataFrame, expected: str = "EPSG:3413") -> DataFrame:
    return check_crs(regions, expected).orderBy("region")


def order_regions(regions: DataFrame, start: int = 0, end: int | None = None) -> DataFrame:
    """Regions by name, positions ``start`` up to (not including) ``end``."""
    ordered = regions.orderBy("region").offset(start)
    return ordered if end is None else ordered.limit(max(end - start, 0))


def filter_regions(regions, min_area=None, max_area=None, names=None, ignore=None, start=0, end=None) -> DataFrame:
    """Area bounds (upper one excluded), then the slice, then the name list, then the ignore list.

    A name list replaces the selection made by area and slice.
    """
    chosen = regions
    if names:
        chosen = chosen.where(F.col("region").isin(list(names)))
    else:
        if min_area:
            chosen = chosen.where(F.col("area_km2") >= min_area)
        if max_area:
            chosen = chosen.where(F.col("area_km2") < max_area)
        if start or end is not None:
            chosen = order_regions(chosen, start, end)
    if ignore:
        chosen = chosen.where(~F.col("region").isin(list(ignore)))
    return chosen.orderBy("region")


def filter_ready_regions(regions: DataFrame, listing: DataFrame):
    """Regions with clipped scenes, and the listed ones without any.

    ``listing`` holds ``region, n_clipped``: one row per region folder.
    """
    named = listing.where(F.col("region").rlike(r"^\d{3}_"))
    ready = regions.join(named.where("n_clipped > 0").select("region"), "region", "left_semi")
    excluded = named.where("n_clipped = 0").select("region")
    return ready, excluded


def join_public_id(df: DataFrame, names: DataFrame) -> DataFrame:
    """Attach the public name; ``names`` holds ``internal_processing_ID, ID``."""
    public = names.select(F.col("internal_processing_ID").alias("region"), F.col("ID").alias("public_id"))
    return df.join(public, "region")


def grid_spec(regions: DataFrame, res_x: float, res_y: float) -> DataFrame:
    """Columns, rows and affine terms of every region's grid; both axes must share the cell size."""
    same = F.round(F.lit(res_x), 2) == F.round(F.lit(res_y), 2)
    res = F.when(same, F.round(F.lit(res_x), 2)).otherwise(F.raise_error(F.lit("cell size differs between the axes")))
    width, height = F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")
    sized = regions.withColumn("res", res)
    return sized.withColumns({
        "width": (width / F.col("res")).cast("int"), "height": (height / F.col("res")).cast("int"),
    }).withColumns({
        "scale_x": width / F.col("width"), "scale_y": -(height / F.col("height")),
        "origin_x": F.col("xmin"), "origin_y": F.col("ymax"),
    })


def snap_roi_300(boxes: DataFrame, step: float = 300.0) -> DataFrame:
    """Keep the top-left corner, round width and height up to whole steps."""
    width, height = F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")
    return boxes.withColumns({
        "xmax": F.col("xmin") + ceil_to(width, step), "ymin": F.col("ymax") - ceil_to(height, step),
    })


def snap_template(cells: DataFrame, regions: DataFrame, res: float) -> DataFrame:
    """Truncate cell centres to whole metres, then shift the grid onto the region's lower-left corner.

    ``cells`` holds ``region, x, y``. One row per region travels to the cells.
    """
    whole = cells.withColumns({"x": F.col("x").cast("bigint").cast("double"), "y": F.col("y").cast("bigint").cast("double")})
    corner = whole.groupBy("region").agg((F.min("x") - res / 2).alias("_left"), (F.min("y") - res / 2).alias("_bottom"))
    shift = corner.join(regions.select("region", "xmin", "ymin"), "region").select(
        "region", (F.col("xmin") - F.col("_left")).alias("_dx"), (F.col("ymin") - F.col("_bottom")).alias("_dy")
    )
    return whole.join(shift, "region").withColumns(
        {"x": F.col("x") + F.col("_dx"), "y": F.col("y") + F.col("_dy")}
    ).drop("_dx", "_dy")


def template_grid(regions: DataFrame, res: float) -> DataFrame:
    """Every cell of every region's grid with its centre. Rows are spread before they are widened."""
    sized = grid_spec(regions, res, res).select("region", "xmin", "ymax", "res", "width", "height")
    rows = sized.withColumn("iy", F.explode(F.sequence(F.lit(0), F.col("height") - 1)))
    cells = rows.repartition("region", "iy").withColumn("ix", F.explode(F.sequence(F.lit(0), F.col("width") - 1)))
    return cells.select(
        "region", "iy", "ix",
        (F.col("xmin") + (F.col("ix") + 0.5) * F.col("res")).alias("x"),
        (F.col("ymax") - (F.col("iy") + 0.5) * F.col("res")).alias("y"),
    )
