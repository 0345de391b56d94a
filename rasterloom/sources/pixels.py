"""Pixel tables from chunked arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions.vector import nodata_to_null


def scan_pixels(chunks: DataFrame, width: int, height: int, nodata, values="values") -> DataFrame:
    """One row per cell from rows holding a chunk's cells in row order.

    ``chunks`` carries ``chunk_y``, ``chunk_x`` and the array; all other columns are kept. Listed
    nodata values become null. Narrow: no shuffle.
    """
    rest = [c for c in chunks.columns if c not in ("chunk_y", "chunk_x", values)]
    at = chunks.select("*", F.posexplode(values).alias("pos", "raw"))
    return at.select(
        *rest,
        (F.col("chunk_y") * height + F.floor(F.col("pos") / width)).cast("int").alias("iy"),
        (F.col("chunk_x") * width + F.col("pos") % width).cast("int").alias("ix"),
        nodata_to_null(F.col("raw"), nodata).alias("value"),
    )


def scan_vector_pixels(chunks: DataFrame, width: int, height: int, nodata, components) -> DataFrame:
    """The wide form: rows that hold one array per component, exploded together."""
    rest = [c for c in chunks.columns if c not in ("chunk_y", "chunk_x", *components)]
    at = chunks.select("*", F.posexplode(F.arrays_zip(*components)).alias("pos", "raw"))
    return at.select(
        *rest,
        (F.col("chunk_y") * height + F.floor(F.col("pos") / width)).cast("int").alias("iy"),
        (F.col("chunk_x") * width + F.col("pos") % width).cast("int").alias("ix"),
        *[nodata_to_null(F.col(f"raw.{c}"), nodata).alias(c) for c in components],
    )


def to_chunks(px: DataFrame, keys, width: int, height: int, value="value") -> DataFrame:
    """The storage form: cells of one chunk gathered in row order, missing ones as null."""
    pos = (F.col("iy") % height) * width + F.col("ix") % width
    # A chunk has width x height cells at most, so the list is bounded.
    cells = F.sort_array(F.collect_list(F.struct(pos.alias("pos"), F.col(value).alias("v"))))
    grouped = px.groupBy(
        *keys, F.floor(F.col("iy") / height).alias("chunk_y"), F.floor(F.col("ix") / width).alias("chunk_x")
    ).agg(cells.alias("cells"))
    return grouped.select(*keys, "chunk_y", "chunk_x", F.col("cells.v").alias("values"))
