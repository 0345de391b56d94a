"""Resampling and clipping.

Bilinear and cubic resampling work on blocks of the target grid: a source cell travels once, and once
more for each further block within the kernel's reach, whatever the kernel's size. Inside a block the
kernel is separable, so both axes are matrix products. Nearest neighbour needs no shuffle at all: each
target lies in exactly one source cell.

A grid's members may be numbers or columns; with columns every row can have a grid of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.functions.grid import Grid
from rasterloom.functions.kernels import ARRAY_KERNELS
from rasterloom.operators import blocks as block_ops
from rasterloom.sources.pixels import scan_pixels

MIN_WEIGHT = 1e-6
# A kernel that is not widened skips source cells when targets are larger than this times the source's cells.
COARSEST = 1.2


def _targets(df, cell, name, first, last, limit):
    """Explode to target positions ``first..last`` inside the grid."""
    lo, hi = F.greatest(first, F.lit(0)), F.least(last, F.lit(limit) - 1)
    spread = df.withColumns({"_lo": lo.cast("int"), "_hi": hi.cast("int")}).where("_lo <= _hi")
    return spread.withColumn(name, F.explode(F.sequence("_lo", "_hi"))).drop("_lo", "_hi")


def _nearest_range(cell, shift, src, dst):
    def edge(c):
        return F.ceil((c * src.res - shift) / dst.res - 0.5)

    return edge(cell), edge(cell + 1) - 1


def resample_nearest(px: DataFrame, src: Grid, dst: Grid) -> DataFrame:
    """Every target cell takes the source cell that holds its centre. All other columns stay."""
    y = _nearest_range(F.col("iy"), src.ymax - dst.ymax, src, dst)
    x = _nearest_range(F.col("ix"), dst.xmin - src.xmin, src, dst)
    placed = _targets(_targets(px, "iy", "_ty", *y, dst.height), "ix", "_tx", *x, dst.width)
    return placed.drop("iy", "ix").withColumnsRenamed({"_ty": "iy", "_tx": "ix"})


def _widening(src_res, dst_res, widen):
    """Factor of the kernel's width: 1, or with ``widen`` the ratio of the cells where targets are larger."""
    if not widen:
        return 1.0
    ratio = dst_res / src_res
    return F.greatest(ratio, F.lit(1.0)) if isinstance(ratio, Column) else max(ratio, 1.0)


def _refuse(src_res, dst_res):
    raise ValueError(f"cells of {src_res} cannot be resampled to cells of {dst_res} without widen=True")


def _axis_weights(shift, src_res, dst_res, first, targets, low, cells, method, widen):
    """Weights of source cells ``low..`` for targets ``first..`` along an axis, and whether they are within reach."""
    kernel, support = ARRAY_KERNELS[method]
    centre = (shift + (first + np.arange(targets) + 0.5) * dst_res) / src_res - 0.5
    distance = (centre[:, None] - (low + np.arange(cells))[None, :]) / _widening(src_res, dst_res, widen)
    return kernel(distance), np.abs(distance) < support


def _weighted_mean(cells, wy, wx):
    """Weighted mean of the cells that are not NaN; NaN where too little weight is left."""
    valid = ~np.isnan(cells)
    total = wy @ np.where(valid, cells, 0.0) @ wx.T
    weight = wy @ valid.astype(float) @ wx.T
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(weight > MIN_WEIGHT, total / weight, np.nan)


def _resample_cells(keys, values, method, size, widen):
    """Blocks with lists of the source cells in reach to a row per target cell in reach of a row of the source."""
    def run(batches):
        for batch in batches:
            grids = np.array(batch.column("grid").to_pylist(), float).reshape(batch.num_rows, 8)
            by, bx = batch.column("by").to_numpy(), batch.column("bx").to_numpy()
            bounds = batch.column("cells").offsets.to_numpy()
            inner = batch.column("cells").flatten()
            ys, xs = inner.field("iy").to_numpy(), inner.field("ix").to_numpy()
            raw = [inner.field(v).cast(pa.float64()).to_numpy(zero_copy_only=False) for v in values]
            bounds = bounds - bounds[0]
            alike = {}
            for i in range(batch.num_rows):
                alike.setdefault((by[i], bx[i], *grids[i]), []).append(i)
            row, iy, ix, made = [], [], [], [[] for _ in values]
            for (cy, cx, sx, sy, sr, dx, dy, dr, width, height), rows in alike.items():
                if dr > COARSEST * sr and not widen:
                    _refuse(sr, dr)
                top, left = int(cy) * size, int(cx) * size
                h, w = min(size, int(height) - top), min(size, int(width) - left)
                inside = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in rows])
                low_y, low_x = ys[inside].min(), xs[inside].min()
                n_y, n_x = int(ys[inside].max() - low_y) + 1, int(xs[inside].max() - low_x) + 1
                (wy, near_y), (wx, near_x) = (
                    _axis_weights(sy - dy, sr, dr, top, h, low_y, n_y, method, widen), _axis_weights(dx - sx, sr, dr, left, w, low_x, n_x, method, widen))
                step = max(1, block_ops.CELLS_AT_ONCE // (n_y * n_x))
                for start in range(0, len(rows), step):
                    some = rows[start:start + step]
                    at = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in some])
                    own = np.repeat(np.arange(len(some)), [bounds[i + 1] - bounds[i] for i in some])
                    there = np.zeros((len(some), n_y, n_x))
                    there[own, ys[at] - low_y, xs[at] - low_x] = 1
                    k, y, x = np.nonzero(near_y.astype(float) @ there @ near_x.astype(float).T > 0.5)
                    row.append(np.array(some)[k])
                    iy.append(y + top)
                    ix.append(x + left)
                    for out, v in zip(made, raw):
                        cells = np.full((len(some), n_y, n_x), np.nan)
                        cells[own, ys[at] - low_y, xs[at] - low_x] = v[at]
                        out.append(_weighted_mean(cells, wy, wx)[k, y, x])
            if row:
                place = pa.array(np.concatenate(row))
                flat = [np.concatenate(v) for v in made]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).take(place) for k in keys), *(pa.array(np.concatenate(x).astype(np.int32)) for x in (iy, ix)),
                     *(pa.array(v, mask=np.isnan(v)) for v in flat)], [*keys, "iy", "ix", *values])
    return run


def resample_weighted(px: DataFrame, src: Grid, dst: Grid, method: str, keys, values=("value",), size=block_ops.BLOCK, widen=False) -> DataFrame:
    """Kernel-weighted mean of the non-null source cells around every target centre.

    Cells coarser than the source's by more than a fifth are refused, for numbers here and for columns when
    the job meets them, unless ``widen`` lets the kernel cover the target's whole cell. A target gets a
    row if a row of the source is in reach.
    """
    keys, values = list(keys), list(values)
    if not widen and all(isinstance(g.res, (int, float)) for g in (src, dst)) and dst.res > COARSEST * src.res:
        _refuse(src.res, dst.res)
    reach = ARRAY_KERNELS[method][1] * _widening(src.res, dst.res, widen)
    placed = px
    for axis, block, shift, limit in (("iy", "by", src.ymax - dst.ymax, dst.height), ("ix", "bx", dst.xmin - src.xmin, dst.width)):
        def position(edge, shift=shift):
            return ((edge + 0.5) * src.res - shift) / dst.res - 0.5

        first = F.greatest(F.floor(position(F.col(axis) - reach)) + 1, F.lit(0))
        last = F.least(F.ceil(position(F.col(axis) + reach)) - 1, F.lit(limit) - 1)
        spread = placed.withColumns({"_lo": first.cast("int"), "_hi": last.cast("int")}).where("_lo <= _hi")
        placed = spread.withColumn(block, F.explode(F.sequence(F.floor(F.col("_lo") / size), F.floor(F.col("_hi") / size)))).drop("_lo", "_hi")
    members = (src.xmin, src.ymax, src.res, dst.xmin, dst.ymax, dst.res, dst.width, dst.height)
    grid = F.array(*[(m if isinstance(m, Column) else F.lit(m)).cast("double") for m in members])
    found = placed.groupBy(*keys, F.col("by").cast("int").alias("by"), F.col("bx").cast("int").alias("bx")).agg(
        F.first(grid).alias("grid"), F.collect_list(F.struct("iy", "ix", *values)).alias("cells"))
    schema = block_ops.ddl(found, keys, ", ".join(["iy int, ix int", *(f"`{v}` double" for v in values)]))
    return found.mapInArrow(_resample_cells(keys, values, method, size, widen), schema)


def _source_windows(shift, src_res, dst_res, targets, size, cells, reach):
    """Source cells in reach of each block of targets along an axis."""
    first = np.arange(0, targets, size)
    last = np.minimum(first + size, targets) - 1
    low, high = (((shift + (t + 0.5) * dst_res) / src_res - 0.5) for t in (first, last))
    return tuple(np.clip(x, 0, cells).astype(int) for x in (np.floor(low - reach) + 1, np.ceil(high + reach)))


def resample_blocks(blocks: DataFrame, src: Grid, dst: Grid, method: str, keys, bh: int, bw: int, values=("value",), size=block_ops.BLOCK, widen=False):
    """The same from blocks to blocks: (blocks, their rows, their columns).

    ``blocks`` holds ``bh`` x ``bw`` cells a row. Every cell of the target grid is in the result, null where nothing is in reach.
    """
    values = list(values)
    if not widen and dst.res > COARSEST * src.res:
        _refuse(src.res, dst.res)
    oh, ow = min(size, dst.height), min(size, dst.width)
    reach = ARRAY_KERNELS[method][1] * _widening(src.res, dst.res, widen)
    shift_y, shift_x = src.ymax - dst.ymax, dst.xmin - src.xmin
    rows = _source_windows(shift_y, src.res, dst.res, dst.height, oh, src.height, reach)
    cols = _source_windows(shift_x, src.res, dst.res, dst.width, ow, src.width, reach)

    def kernel(window, by, bx):
        out = [[None] * len(by) for _ in values]
        for y, x in sorted({(int(a), int(b)) for a, b in zip(by, bx)}):
            mine = np.flatnonzero((by == y) & (bx == x))
            n_y, n_x = int(rows[1][y] - rows[0][y]), int(cols[1][x] - cols[0][x])
            h, w = min(oh, dst.height - y * oh), min(ow, dst.width - x * ow)
            wy = _axis_weights(shift_y, src.res, dst.res, y * oh, h, rows[0][y], n_y, method, widen)[0]
            wx = _axis_weights(shift_x, src.res, dst.res, x * ow, w, cols[0][x], n_x, method, widen)[0]
            for k in range(len(values)):
                made = np.full((len(mine), h, ow), np.nan)
                made[:, :, :w] = _weighted_mean(window[k, mine, :n_y, :n_x], wy, wx)
                for i, block in zip(mine, made):
                    out[k][i] = block
        return out

    one = src.height <= bh and src.width <= bw and dst.height <= oh and dst.width <= ow
    found = block_ops.whole(blocks, keys, values, bw) if one else block_ops.windows(blocks, keys, values, bh, bw, rows, cols)
    cells = int(max(rows[1] - rows[0], default=1) * max(cols[1] - cols[0], default=1))
    return block_ops.map_windows(found, keys, values, values, rows, cols, cells, kernel), oh, ow


def nearest_blocks(blocks: DataFrame, src: Grid, dst: Grid, keys, bh: int, bw: int, values=("value",), size=block_ops.BLOCK):
    """``resample_nearest`` from blocks to blocks: (blocks, their rows, their columns). Targets outside the source are null."""
    values = list(values)
    oh, ow = min(size, dst.height), min(size, dst.width)

    def axis(shift, targets, step, cells):
        """The source cell of each target, and the bounds of those that each block takes from."""
        cell = np.floor(((np.arange(targets) + 0.5) * dst.res + shift) / src.res).astype(int)
        first = np.arange(0, targets, step)
        bounds = cell[first], cell[np.minimum(first + step, targets) - 1] + 1
        return cell, tuple(np.clip(b, 0, cells) for b in bounds)

    (cell_y, rows), (cell_x, cols) = axis(src.ymax - dst.ymax, dst.height, oh, src.height), axis(dst.xmin - src.xmin, dst.width, ow, src.width)

    def kernel(window, by, bx):
        out = [[None] * len(by) for _ in values]
        for y, x in sorted({(int(a), int(b)) for a, b in zip(by, bx)}):
            mine = np.flatnonzero((by == y) & (bx == x))
            iy, ix = cell_y[y * oh:(y + 1) * oh], cell_x[x * ow:(x + 1) * ow]
            in_y, in_x = (iy >= rows[0][y]) & (iy < rows[1][y]), (ix >= cols[0][x]) & (ix < cols[1][x])
            for k in range(len(values)):
                made = np.full((len(mine), len(iy), ow), np.nan)
                if in_y.any() and in_x.any():
                    part = window[k][mine[:, None, None], (iy[in_y] - rows[0][y])[None, :, None], (ix[in_x] - cols[0][x])[None, None, :]]
                    made[np.ix_(range(len(mine)), np.flatnonzero(in_y), np.flatnonzero(in_x))] = part
                for i, block in zip(mine, made):
                    out[k][i] = block
        return out

    one = src.height <= bh and src.width <= bw and dst.height <= oh and dst.width <= ow
    found = block_ops.whole(blocks, keys, values, bw) if one else block_ops.windows(blocks, keys, values, bh, bw, rows, cols)
    cells = int(max(rows[1] - rows[0], default=1) * max(cols[1] - cols[0], default=1))
    return block_ops.map_windows(found, keys, values, values, rows, cols, cells, kernel), oh, ow


def resample_bilinear(px, src, dst, keys, values=("value",), widen=False):
    return resample_weighted(px, src, dst, "bilinear", keys, values, widen=widen)


def resample_cubic(px, src, dst, keys, values=("value",), widen=False):
    return resample_weighted(px, src, dst, "cubic", keys, values, widen=widen)


def _index_range(grid: Grid, bounds):
    """Rows and columns whose centre lies inside the bounds."""
    xmin, ymin, xmax, ymax = bounds

    def inside(lo, hi, res):
        first = -int(-(lo / res - 0.5) // 1)
        last = int((hi / res - 0.5) // 1)
        return first, last

    return inside(grid.ymax - ymax, grid.ymax - ymin, grid.res), inside(xmin - grid.xmin, xmax - grid.xmin, grid.res)


def clip_to_bounds(px: DataFrame, grid: Grid, bounds) -> DataFrame:
    """Cells inside ``(xmin, ymin, xmax, ymax)``: a plain range on ``iy, ix``. Stored chunks are pruned by ``clip_chunks``."""
    (y0, y1), (x0, x1) = _index_range(grid, bounds)
    return px.where(F.col("iy").between(y0, y1) & F.col("ix").between(x0, x1))


def prune_chunks(chunks: DataFrame, grid: Grid, bounds, width: int, height: int) -> DataFrame:
    """The same for stored chunks: only those that meet the bounds are read."""
    (y0, y1), (x0, x1) = _index_range(grid, bounds)
    return chunks.where(
        F.col("chunk_y").between(y0 // height, y1 // height) & F.col("chunk_x").between(x0 // width, x1 // width)
    )


def clip_chunks(chunks: DataFrame, grid: Grid, bounds, width: int, height: int, nodata=()) -> DataFrame:
    """Cells inside the bounds, from stored chunks of ``width`` x ``height`` cells. The chunk range reaches the scan."""
    return clip_to_bounds(scan_pixels(prune_chunks(chunks, grid, bounds, width, height), width, height, nodata), grid, bounds)
