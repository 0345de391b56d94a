"""Whole-raster properties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGEST_PIECES = 4
PIECE_DIGITS = 7


def content_digest(px: DataFrame, keys, value: str) -> DataFrame:
    """Digest of a raster's cells that combines before the shuffle.

    Every cell is hashed with its position and the 28-bit pieces of the hashes are summed, so no task
    ever holds a raster. Equal rasters give equal digests, whatever the row order.
    """
    hashed = px.withColumn("_h", F.md5(F.concat_ws(":", "iy", "ix", F.coalesce(F.col(value).cast("string"), F.lit("~")))))
    pieces = [
        F.sum(F.conv(F.substring("_h", 1 + i * PIECE_DIGITS, PIECE_DIGITS), 16, 10).cast("bigint")).cast("string")
        for i in range(DIGEST_PIECES)
    ]
    return hashed.groupBy(*keys).agg(F.md5(F.concat_ws("-", *pieces)).alias("digest"))


def shape_uniformity(px: DataFrame, stack_keys, raster_keys) -> DataFrame:
    """Do all rasters of a stack share one shape?"""
    shapes = px.groupBy(*stack_keys, *raster_keys).agg(F.max("iy").alias("h"), F.max("ix").alias("w"))
    same = (F.min("h") == F.max("h")) & (F.min("w") == F.max("w"))
    return shapes.groupBy(*stack_keys).agg(same.alias("uniform"), F.count("*").alias("n_rasters"))
