"""3x3 median over a pixel table.

Cells travel to their chunk once; only cells on a chunk border travel twice or more (the halo). The
filter then runs chunk by chunk on dense arrays of bounded size, so neither the shuffle nor a task
grows with the nine-fold neighbourhood.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 64
# Cells a task holds as one dense block.
CELLS_AT_ONCE = 1 << 20


def _chunks_of(cell, size):
    """Chunks that need this row (or column): its own, and a neighbour's across a border."""
    own = F.floor(cell / size)
    return F.array_distinct(F.array(own, F.floor((cell - 1) / size), F.floor((cell + 1) / size)))


def _median_of_nine(nine):
    """Median of each row's nine values without NaN; NaN where nothing is left."""
    ordered = np.sort(nine, axis=1)
    n = np.count_nonzero(~np.isnan(ordered), axis=1)
    row = np.arange(len(ordered))
    return 0.5 * ordered[row, np.maximum(n - 1, 0) // 2] + 0.5 * ordered[row, np.minimum(n // 2, 8)]


def _filter_chunks(chunks: pd.DataFrame, width, height, size):
    """Filter a few chunks at once: row number in ``chunks``, iy, ix and median of every cell they own."""
    lengths = chunks.v.str.len().to_numpy()
    at = np.repeat(np.arange(len(chunks)), lengths)
    top, left = chunks.cy.to_numpy() * size, chunks.cx.to_numpy() * size
    rows, cols = np.minimum(size, height - top), np.minimum(size, width - left)
    ys, xs, values = (np.concatenate(chunks[c].to_numpy()) for c in ("iy", "ix", "v"))
    y, x = ys - top[at] + 1, xs - left[at] + 1

    dense = np.full((len(chunks), rows.max() + 2, cols.max() + 2), np.nan)
    dense[at, y, x] = values
    # The grid's edges repeat the outermost cell; elsewhere the halo holds the neighbour.
    first, last = top == 0, top + rows == height
    dense[first, 0] = dense[first, 1]
    dense[last, rows[last] + 1] = dense[last, rows[last]]
    first, last = left == 0, left + cols == width
    dense[first, :, 0] = dense[first, :, 1]
    dense[last, :, cols[last] + 1] = dense[last, :, cols[last]]

    own = (y >= 1) & (y <= rows[at]) & (x >= 1) & (x <= cols[at])
    at, y, x, values = at[own], y[own], x[own], values[own]
    nine = np.stack([dense[at, y + dy, x + dx] for dy in (-1, 0, 1) for dx in (-1, 0, 1)], axis=1)
    return at, ys[own], xs[own], np.where(np.isnan(values), np.nan, _median_of_nine(nine))


def box_median_3x3(px: DataFrame, keys, width: int, height: int, value="value", size=CHUNK) -> DataFrame:
    """Replace each value by the median of its 3x3 neighbourhood.

    Null neighbours are ignored, a null centre stays null, and the grid's edge cells are repeated
    outwards. ``keys`` tells rasters apart; the grid is ``width`` x ``height``.
    """
    keys = list(keys)
    placed = (
        px.select(*keys, "iy", "ix", F.col(value).cast("double").alias("v"))
        .withColumn("cy", F.explode(_chunks_of(F.col("iy"), size)))
        .withColumn("cx", F.explode(_chunks_of(F.col("ix"), size)))
        .where(
            (F.col("cy") >= 0) & (F.col("cx") >= 0)
            & (F.col("cy") * size < height) & (F.col("cx") * size < width)
        )
    )
    chunks = placed.groupBy(*keys, "cy", "cx").agg(
        F.collect_list(F.struct("iy", "ix", F.coalesce("v", F.lit(float("nan"))).alias("v"))).alias("cells")
    ).select(*keys, "cy", "cx", "cells.iy", "cells.ix", "cells.v")

    step = max(1, CELLS_AT_ONCE // (size + 2) ** 2)

    def run(batches):
        for batch in batches:
            for start in range(0, len(batch), step):
                part = batch.iloc[start:start + step]
                at, ys, xs, medians = _filter_chunks(part, width, height, size)
                out = {k: part[k].to_numpy()[at] for k in keys}
                yield pd.DataFrame({**out, "iy": ys, "ix": xs, value: medians})

    types = dict(chunks.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in keys] + ["iy int", "ix int", f"`{value}` double"])
    # Arrow hands NaN back as NaN; the pixel table knows only null.
    return chunks.mapInPandas(run, schema).withColumn(value, F.when(~F.isnan(value), F.col(value)))
