"""Rasters as dense blocks in Arrow batches.

A block is a row: the raster's keys, its place in the raster's grid of blocks and one array of cells, row
by row, for each value. Operators that look at neighbours cut each block once along the windows that
other blocks need, so what is shuffled is the blocks and a rim of a few cells around them; cells become
rows in the last step, if at all. A window of a raster is bounded by the block size, whatever the raster's.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions.vector import nodata_to_null

BLOCK = 64
# Cells a task holds in dense form at a time.
CELLS_AT_ONCE = 1 << 20


def cleaned(blocks: DataFrame, nodata, values) -> DataFrame:
    """Listed nodata values become null inside the arrays."""
    return blocks.withColumns({v: F.transform(v, lambda x: nodata_to_null(x.cast("double"), nodata)) for v in values})


def scan_blocks(blocks: DataFrame, keys, values, bh: int, bw: int, height: int, width: int) -> DataFrame:
    """One row per cell of the raster. Narrow: no shuffle."""
    at = blocks.select(*keys, "by", "bx", F.posexplode(F.arrays_zip(*values)).alias("pos", "cell"))
    placed = at.select(
        *keys, (F.col("by") * bh + F.floor(F.col("pos") / bw)).cast("int").alias("iy"),
        (F.col("bx") * bw + F.col("pos") % bw).cast("int").alias("ix"), *[F.col(f"cell.{v}").alias(v) for v in values],
    )
    return placed.where((F.col("iy") < height) & (F.col("ix") < width))


def _densify(bh, bw, keys, values):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = batch.column("cells")
            row = np.repeat(np.arange(batch.num_rows), np.diff(cells.offsets.to_numpy()))
            inner = cells.flatten()
            pos = inner.field("pos").to_numpy()
            high = np.zeros(batch.num_rows, int)
            np.maximum.at(high, row, pos // bw + 1)
            out = []
            for v in values:
                block = np.full((batch.num_rows, bh * bw), np.nan)
                block[row, pos] = inner.field(v).cast(pa.float64()).to_numpy(zero_copy_only=False)
                out.append(lists([b[:h * bw] for b, h in zip(block, high)]))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), batch.column("by"), batch.column("bx"), *out], [*keys, "by", "bx", *values])
    return run


def gather_blocks(px: DataFrame, keys, values, bh: int = BLOCK, bw: int = BLOCK) -> DataFrame:
    """Blocks from a row per cell: one shuffle, each cell once. Cells without a row are null."""
    keys = list(keys)
    pos = ((F.col("iy") % bh) * bw + F.col("ix") % bw).cast("int")
    grouped = px.groupBy(*keys, F.floor(F.col("iy") / bh).cast("int").alias("by"), F.floor(F.col("ix") / bw).cast("int").alias("bx")).agg(
        F.collect_list(F.struct(pos.alias("pos"), *values)).alias("cells"))
    return grouped.mapInArrow(_densify(bh, bw, keys, values), ddl(grouped, keys, ", ".join(["by int, bx int", *(f"`{v}` array<double>" for v in values)])))


def floats(column):
    """Values of an Arrow list column end to end, null as NaN, and the lists' bounds."""
    at = column.offsets.to_numpy()
    flat = column.values.slice(at[0], at[-1] - at[0]) if len(column) else column.values.slice(0, 0)
    return flat.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float, copy=False), at - at[0]


def lists(rows):
    """Arrays as an Arrow list column of doubles, NaN as null."""
    flat = np.concatenate([r.ravel() for r in rows]) if rows else np.zeros(0)
    bounds = np.append(0, np.cumsum([r.size for r in rows])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat, pa.float64(), mask=np.isnan(flat)))


def ddl(df: DataFrame, keys, rest: str) -> str:
    types = dict(df.dtypes)
    return ", ".join([f"`{k}` {types[k]}" for k in keys] + [rest])


def ranges(low, high, first, last):
    """Windows ``[low, high)``, both rising, that meet ``[first, last)``: the first one and the one after the last."""
    return int(np.searchsorted(high, first, "right")), int(np.searchsorted(low, last, "left"))


def halo(n: int, size: int, rim: int):
    """Windows of blocks of ``size`` along an axis of ``n`` cells, with a rim that ends at the edge."""
    start = np.arange(0, n, size)
    return np.maximum(start - rim, 0), np.minimum(start + size + rim, n)


def _cut(rows, cols, bh, bw, keys, values):
    """Blocks to the parts that windows need: keys, window (by, bx), first row and column, width, values."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            arrays = [floats(batch.column(v)) for v in values]
            bound = arrays[0][1]
            by, bx = batch.column("by").to_numpy(), batch.column("bx").to_numpy()
            place, parts = [], [[] for _ in values]
            for i in range(batch.num_rows):
                y, x, h = by[i] * bh, bx[i] * bw, -(-(bound[i + 1] - bound[i]) // bw)
                blocks = []
                for flat, at in arrays:
                    block = np.full(h * bw, np.nan)
                    block[:at[i + 1] - at[i]] = flat[at[i]:at[i + 1]]
                    blocks.append(block.reshape(h, bw))
                for wy in range(*ranges(*rows, y, y + h)):
                    for wx in range(*ranges(*cols, x, x + bw)):
                        top, low = max(rows[0][wy] - y, 0), min(rows[1][wy] - y, h)
                        left, right = max(cols[0][wx] - x, 0), min(cols[1][wx] - x, bw)
                        if top < low and left < right:
                            place.append((i, wy, wx, y + top, x + left, right - left))
                            for out, block in zip(parts, blocks):
                                out.append(block[top:low, left:right])
            if place:
                i, *numbers = np.array(place).T
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).take(pa.array(i)) for k in keys), *(pa.array(n.astype(np.int32)) for n in numbers), *map(lists, parts)],
                    [*keys, "by", "bx", "y0", "x0", "w", *values])
    return run


def windows(blocks: DataFrame, keys, values, bh: int, bw: int, rows, cols) -> DataFrame:
    """Every window of a raster with the parts of blocks that lie in it: keys, by, bx, parts.

    ``rows`` and ``cols`` are the windows' bounds along either axis (see ``halo``). One shuffle, of blocks and rims.
    A window meets a bounded number of blocks, so its list of parts is bounded.
    """
    keys, numbers = list(keys), ["y0", "x0", "w"]
    part = ddl(blocks, keys, ", ".join(["by int, bx int, y0 int, x0 int, w int", *(f"`{v}` array<double>" for v in values)]))
    cut = blocks.select(*keys, "by", "bx", *values).mapInArrow(_cut(rows, cols, bh, bw, keys, values), part)
    return cut.groupBy(*keys, "by", "bx").agg(F.collect_list(F.struct(*numbers, *values)).alias("parts"))


def whole(blocks: DataFrame, keys, values, bw: int) -> DataFrame:
    """The same form where a raster is one block: nothing travels."""
    part = F.struct(F.lit(0).alias("y0"), F.lit(0).alias("x0"), F.lit(bw).alias("w"), *values)
    return blocks.select(*keys, F.lit(0).alias("by"), F.lit(0).alias("bx"), F.array(part).alias("parts"))


def neighbourhoods(blocks, keys, values, bh, bw, height, width, rim) -> DataFrame:
    """Blocks with a rim of their neighbours' cells."""
    if height <= bh and width <= bw:
        return whole(blocks, keys, values, bw)
    return windows(blocks, keys, values, bh, bw, halo(height, bh, rim), halo(width, bw, rim))


def dense(batch, values, y_bounds, x_bounds):
    """Windows of a batch as arrays (values, rows of the batch, y, x), all of the largest window's shape.

    ``y_bounds`` and ``x_bounds``: first and last bound of each row's window. Cells that no part covers are NaN.
    """
    (y0, y1), (x0, x1) = y_bounds, x_bounds
    out = np.full((len(values), batch.num_rows, int((y1 - y0).max()), int((x1 - x0).max())), np.nan)
    parts = batch.column("parts")
    of = np.repeat(np.arange(batch.num_rows), np.diff(parts.offsets.to_numpy()))
    inner = parts.flatten()
    top, left, wide = (inner.field(c).to_numpy() for c in ("y0", "x0", "w"))
    for k, v in enumerate(values):
        flat, at = floats(inner.field(v))
        size = np.diff(at)
        part = np.repeat(np.arange(len(inner)), size)
        pos = np.arange(len(flat)) - np.repeat(at[:-1], size)
        row = of[part]
        y, x = top[part] + pos // wide[part] - y0[row], left[part] + pos % wide[part] - x0[row]
        inside = (y >= 0) & (x >= 0) & (y < (y1 - y0)[row]) & (x < (x1 - x0)[row])
        out[k, row[inside], y[inside], x[inside]] = flat[inside]
    return out


def map_windows(found: DataFrame, keys, values, out_values, rows, cols, cells: int, kernel: Callable) -> DataFrame:
    """Run ``kernel(dense windows, by, bx) -> for each out value a list of arrays`` over windows; gives blocks.

    ``cells`` is the size of a window: as many are taken at once as stay within ``CELLS_AT_ONCE``.
    """
    keys = list(keys)
    step = max(1, CELLS_AT_ONCE // max(1, cells * len(values)))

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                by, bx = part.column("by").to_numpy(), part.column("bx").to_numpy()
                made = kernel(dense(part, values, (rows[0][by], rows[1][by]), (cols[0][bx], cols[1][bx])), by, bx)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in keys), part.column("by"), part.column("bx"), *map(lists, made)],
                    [*keys, "by", "bx", *out_values])

    schema = ddl(found, keys, ", ".join(["by int, bx int", *(f"`{v}` array<double>" for v in out_values)]))
    return found.select(*keys, "by", "bx", "parts").mapInArrow(run, schema)


def median_of(stack, axis=-1):
    """Median along an axis, NaN left out; NaN where nothing is left."""
    ordered = np.sort(stack, axis=axis)  # NaN last
    n = np.count_nonzero(~np.isnan(ordered), axis=axis, keepdims=True)
    low = np.take_along_axis(ordered, np.maximum(n - 1, 0) // 2, axis)
    high = np.take_along_axis(ordered, np.minimum(n // 2, ordered.shape[axis] - 1), axis)
    return (0.5 * low + 0.5 * high).squeeze(axis)


def median_blocks_3x3(blocks: DataFrame, keys, values, bh: int, bw: int, height: int, width: int) -> DataFrame:
    """Blocks whose cells are the median of their 3x3 neighbourhood.

    Null neighbours are ignored, a null centre stays null, and the raster's edge cells are repeated
    outwards.
    """
    rows, cols = halo(height, bh, 1), halo(width, bw, 1)

    def kernel(window, by, bx):
        out = [[] for _ in values]
        for shape in sorted({(int(a), int(b)) for a, b in zip(by, bx)}):
            mine = np.flatnonzero((by == shape[0]) & (bx == shape[1]))
            (y0, y1), (x0, x1) = ((r[0][i], r[1][i]) for r, i in zip((rows, cols), shape))
            top, left = shape[0] * bh, shape[1] * bw
            h, w = min(bh, height - top), min(bw, width - left)
            part = window[:, mine, :y1 - y0, :x1 - x0]
            part = np.pad(part, ((0, 0), (0, 0), (int(top == y0), int(top + h == y1)), (int(left == x0), int(left + w == x1))), mode="edge")
            nine = np.stack([part[:, :, y:y + h, x:x + w] for y in range(3) for x in range(3)], axis=-1)
            centre = part[:, :, 1:1 + h, 1:1 + w]
            made = np.full((*centre.shape[:3], bw), np.nan)
            made[..., :w] = np.where(np.isnan(centre), np.nan, median_of(nine))
            for k in range(len(values)):
                out[k] += [(i, made[k, j]) for j, i in enumerate(mine)]
        return [[a for _, a in sorted(found, key=lambda x: x[0])] for found in out]

    return map_windows(neighbourhoods(blocks, keys, values, bh, bw, height, width, 1), keys, values, values, rows, cols, 9 * (bh + 2) * (bw + 2), kernel)


def median_stack(blocks: DataFrame, keys, values, bh: int, bw: int, largest: int, at_once: int = 1 << 23) -> DataFrame:
    """Per cell, the median over all blocks of a stack: those with the same keys and place. Nulls are ignored.

    ``largest`` is the most blocks a stack has. Stacks are cut into strips of cells such that a strip of
    the largest one has at most about ``at_once`` values; a strip of a single cell is the least. Selection runs
    along the stack in one array, and no group holds more than a strip.
    """
    keys = list(keys)
    strip = max(1, min(bh * bw, at_once // max(1, largest * len(values))))
    types = ", ".join(f"`{v}` array<double>" for v in values)
    cells = F.greatest(F.lit(1), *[F.coalesce(F.size(v), F.lit(0)) for v in values])
    starts = F.explode(F.sequence(F.lit(0), cells - 1, F.lit(strip)))
    cut = blocks.select(*keys, "by", "bx", *values, starts.alias("at")).select(
        *keys, "by", "bx", "at", *[F.slice(v, F.col("at") + 1, strip).alias(v) for v in values])

    def run(key, table):
        out = []
        for v in values:
            column = table.column(v).combine_chunks()
            flat, at = floats(column)
            size = np.diff(at)
            stack = np.full((len(size), size.max()), np.nan)
            stack[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(at[:-1], size)] = flat
            out.append(lists([median_of(stack, axis=0)]))
        return pa.table([*(pa.array([k.as_py()], k.type) for k in key), *out], [*keys, "by", "bx", "at", *values])

    strips = cut.groupBy(*keys, "by", "bx", "at").applyInArrow(run, ddl(blocks, keys, f"by int, bx int, at int, {types}"))
    # A block's strips, back in order: at most as many as it has cells.
    joined = strips.groupBy(*keys, "by", "bx").agg(F.sort_array(F.collect_list(F.struct("at", *values))).alias("strips"))
    return joined.select(*keys, "by", "bx", *[F.flatten(F.col(f"strips.{v}")).alias(v) for v in values])
