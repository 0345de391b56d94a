"""Mosaics of overlapping tiles."""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.functions.grid import Grid
from rasterloom.functions.kernels import ARRAY_KERNELS, array_cubic
from rasterloom.functions.projection import Arrays, polar_from_utm, utm_from_polar
from rasterloom.operators import blocks as block_ops
from rasterloom.operators.resample import MIN_WEIGHT, resample_nearest

SUPPORT = ARRAY_KERNELS["cubic"][1]


def mosaic_first_valid(px: DataFrame, keys=("mosaic_key",), order=("rank",), value="value") -> DataFrame:
    """Per cell, the first valid value in tile order. Combines before the shuffle."""
    first = F.min_by(value, F.when(F.col(value).isNotNull(), F.struct(*order)))
    return px.groupBy(*keys, "iy", "ix").agg(first.alias(value))


def first_valid_blocks(blocks: DataFrame, keys=("mosaic_key",), order=("rank",), value="value") -> DataFrame:
    """The same on blocks: the first valid value of each cell in tile order, over whole arrays.

    A mosaic's block has at most one array for each tile of its list.
    """
    stack = F.sort_array(F.collect_list(F.struct(*order, value)))
    grouped = blocks.groupBy(*keys, "by", "bx").agg(stack.alias("_stack"))
    layers = F.transform("_stack", lambda s: s[value])
    merged = F.aggregate(F.slice(layers, 2, F.size(layers)), F.get(layers, F.lit(0)), lambda done, x: F.zip_with(done, x, lambda a, b: F.coalesce(a, b)))
    return grouped.select(*keys, "by", "bx", merged.alias(value))


def zone_ranks(tiles: DataFrame, keys=("mosaic_key",)) -> DataFrame:
    """0 for tiles in the zone of the mosaic's first tile, 1 for the others. ``tiles`` is one row per tile."""
    first = tiles.groupBy(*keys).agg(F.min_by("zone", "rank").alias("_first"))
    return tiles.join(first, list(keys)).withColumn(
        "zone_rank", F.when(F.col("zone") == F.col("_first"), 0).otherwise(1)
    ).drop("_first")


def tile_blocks(px: DataFrame, keys, res: float, size=block_ops.BLOCK) -> DataFrame:
    """Cells of tiles, given by their centres, as blocks of the tile's own grid: one shuffle, each cell once.

    A block holds the centre of its upper left cell, its width and, row by row, the values; ``there`` tells
    cells without a row from cells without a value.
    """
    step, keys = res * size, list(keys)
    cells = px.groupBy(*keys, F.floor(F.col("x") / step).alias("_cx"), F.floor(F.col("y") / step).alias("_cy")).agg(
        F.collect_list(F.struct("x", "y", "value")).alias("cells"))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            bounds = batch.column("cells").offsets.to_numpy()
            inner = batch.column("cells").flatten()
            xs, ys = (inner.field(c).to_numpy() for c in ("x", "y"))
            raw = inner.field("value").cast(pa.float64()).to_numpy(zero_copy_only=False)
            places, values, there = [], [], []
            for low, high in zip(bounds[:-1] - bounds[0], bounds[1:] - bounds[0]):
                x, y = xs[low:high], ys[low:high]
                left, top = x.min(), y.max()
                col, row = np.rint((x - left) / res).astype(int), np.rint((top - y) / res).astype(int)
                grid, mask = np.full((row.max() + 1, col.max() + 1), np.nan), np.zeros((row.max() + 1, col.max() + 1))
                grid[row, col], mask[row, col] = raw[low:high], 1
                places.append((left, top, grid.shape[1]))
                values.append(grid)
                there.append(mask)
            left, top, wide = zip(*places)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), pa.array(left), pa.array(top), pa.array(wide, pa.int32()), block_ops.lists(values),
                 block_ops.lists(there).cast(pa.list_(pa.int8()))], [*keys, "left", "top", "w", "value", "there"])

    schema = block_ops.ddl(cells, keys, "left double, top double, w int, value array<double>, there array<tinyint>")
    return cells.select(*keys, "cells").mapInArrow(run, schema)


class Outlines:
    """Which cells of a tile the blocks of a polar grid need, and which blocks a tile may touch.

    Outlines are projected at a few points an edge; what the edges bend between them is far below the
    margin of a cell.
    """

    POINTS = 17

    def __init__(self, res, size):
        self.res, self.size = res, size
        self.box = functools.lru_cache(1 << 14)(self._box)
        self.centres = functools.lru_cache(1 << 8)(self._centres)

    def _edge(self, x0, y0, x1, y1):
        t = np.linspace(0, 1, self.POINTS)
        x, y = x0 + t * (x1 - x0), y0 + t * (y1 - y0)
        return np.concatenate([x, x, 0 * t + x0, 0 * t + x1]), np.concatenate([0 * t + y0, 0 * t + y1, y, y])

    def blocks(self, grid, zone, x0, y0, x1, y1):
        """Rows and columns of the grid's blocks that a box in the zone may touch."""
        xmin, ymax, res, width, height = grid
        x, y = polar_from_utm(*self._edge(x0, y0, x1, y1), zone, Arrays)
        step = res * self.size

        def span(low, high, cells):
            return range(max(int((low - res) // step), 0), min(int((high + res) // step), -(-int(cells) // self.size) - 1) + 1)

        return span(ymax - y.max(), ymax - y.min(), height), span(x.min() - xmin, x.max() - xmin, width)

    def _box(self, grid, zone, by, bx):
        """Bounds in the zone of what a block's cells take from, with the kernel's reach."""
        xmin, ymax, res, width, height = grid
        x0, x1 = xmin + bx * self.size * res, xmin + min((bx + 1) * self.size, width) * res
        y1, y0 = ymax - by * self.size * res, ymax - min((by + 1) * self.size, height) * res
        x, y = utm_from_polar(*self._edge(x0, y0, x1, y1), zone, Arrays)
        margin = (SUPPORT + 1) * self.res
        return x.min() - margin, y.min() - margin, x.max() + margin, y.max() + margin

    def _centres(self, grid, zone, by, bx):
        """Where the centres of a block's cells lie in the zone."""
        xmin, ymax, res, width, height = grid
        iy = np.arange(by * self.size, min((by + 1) * self.size, int(height)))
        ix = np.arange(bx * self.size, min((bx + 1) * self.size, int(width)))
        x, y = np.meshgrid(xmin + (ix + 0.5) * res, ymax - (iy + 0.5) * res)
        return utm_from_polar(x, y, zone, Arrays)


def _needed(res, size, keys):
    """Blocks of tiles to the parts of them that blocks of the polar grid need."""
    def run(batches):
        outlines = Outlines(res, size)
        for batch in batches:
            grids, zones = batch.column("grid").to_pylist(), batch.column("zone").to_pylist()
            lefts, tops, wides = (batch.column(c).to_numpy() for c in ("left", "top", "w"))
            (flat, bounds), (there, _) = block_ops.floats(batch.column("value")), block_ops.floats(batch.column("there"))
            place, values, masks = [], [], []
            for i in range(batch.num_rows):
                grid, zone, left, top, w = tuple(grids[i]), zones[i], lefts[i], tops[i], wides[i]
                cells = slice(bounds[i], bounds[i + 1])
                value, mask = flat[cells].reshape(-1, w), there[cells].reshape(-1, w)
                h, reach = len(value), (SUPPORT + 1) * res
                rows, cols = outlines.blocks(grid, zone, left - reach, top - h * res - reach, left + w * res + reach, top + reach)
                for by in rows:
                    for bx in cols:
                        x0, y0, x1, y1 = outlines.box(grid, zone, by, bx)
                        c0, c1 = max(math.ceil((x0 - left) / res), 0), min(math.floor((x1 - left) / res) + 1, w)
                        r0, r1 = max(math.ceil((top - y1) / res), 0), min(math.floor((top - y0) / res) + 1, h)
                        if c0 < c1 and r0 < r1:
                            place.append((i, by, bx, left + c0 * res, top - r0 * res, c1 - c0))
                            values.append(value[r0:r1, c0:c1])
                            masks.append(mask[r0:r1, c0:c1])
            if place:
                i, by, bx, left, top, w = zip(*place)
                kept = [batch.column(c).take(pa.array(i)) for c in (*keys, "tile", "zone", "zone_rank", "rank", "nearest", "grid")]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(by, pa.int32()), pa.array(bx, pa.int32()), pa.array(left), pa.array(top), pa.array(w, pa.int32()),
                     block_ops.lists(values), block_ops.lists(masks).cast(pa.list_(pa.int8()))],
                    [*keys, "tile", "zone", "zone_rank", "rank", "nearest", "grid", "by", "bx", "left", "top", "w", "value", "there"])
    return run


def _sampled(parts, res, x, y, nearest=False):
    """Values at points of a tile: (point numbers, values) for those in a cell that has a row; NaN where that cell has no value.

    By the cubic kernel, or with ``nearest`` the cell's own.
    """
    left, top = min(p[0] for p in parts), max(p[1] for p in parts)
    at = [(round((p[0] - left) / res), round((top - p[1]) / res), p[2], p[3]) for p in parts]
    w, h = max(c + v.shape[1] for c, _, v, _ in at), max(r + v.shape[0] for _, r, v, _ in at)
    # Two cells of nothing around, so that every kernel lies inside.
    grid, there = np.full((h + 4, w + 4), np.nan), np.zeros((h + 4, w + 4), bool)
    for c, r, v, m in at:
        grid[r + 2:r + 2 + v.shape[0], c + 2:c + 2 + v.shape[1]] = v
        there[r + 2:r + 2 + v.shape[0], c + 2:c + 2 + v.shape[1]] = m > 0
    col, row = (x.ravel() - left) / res + 2, (top - y.ravel()) / res + 2
    inside = np.flatnonzero((col >= 1.5) & (col <= w + 1.5) & (row >= 1.5) & (row <= h + 1.5))
    col, row = col[inside], row[inside]
    own, has = np.zeros(len(inside), bool), np.zeros(len(inside), bool)
    for c in (np.floor(col + 0.5), np.ceil(col - 0.5)):  # a point between two cells lies in both
        for r in (np.floor(row + 0.5), np.ceil(row - 0.5)):
            spot = r.astype(int), c.astype(int)
            own |= there[spot]
            has |= ~np.isnan(grid[spot])
    inside, col, row, has = inside[own], col[own], row[own], has[own]
    if nearest:
        return inside, grid[np.floor(row + 0.5).astype(int), np.floor(col + 0.5).astype(int)]
    total, weight = np.zeros(len(inside)), np.zeros(len(inside))
    first_c, first_r = np.floor(col).astype(int), np.floor(row).astype(int)
    for dr in (-1, 0, 1, 2):
        wr = array_cubic(row - (first_r + dr))
        for dc in (-1, 0, 1, 2):
            v = grid[np.clip(first_r + dr, 0, h + 3), np.clip(first_c + dc, 0, w + 3)]
            k = np.where(np.isnan(v), 0.0, wr * array_cubic(col - (first_c + dc)))
            total += k * np.nan_to_num(v)
            weight += k
    with np.errstate(divide="ignore", invalid="ignore"):
        return inside, np.where(has & (weight > MIN_WEIGHT), total / weight, np.nan)


def _merged(res, size, keys):
    """Parts, sorted by mosaic, block and tile order, to a row per cell: tile by tile, first valid value."""
    def run(batches):
        outlines = Outlines(res, size)
        block = tile = None
        parts, value, seen, key_row = [], None, None, None

        def add_tile():
            if parts:
                grid, by, bx = block[-1], block[-3], block[-2]
                points, found = _sampled(parts, res, *outlines.centres(grid, tile[0], by, bx), tile[-1])
                seen[points] = True
                value[points] = np.where(np.isnan(value[points]), found, value[points])
                parts.clear()

        def cells():
            xmin, ymax, cell, width, height = block[-1]
            at = np.flatnonzero(seen)
            wide = min(size, int(width) - block[-2] * size)
            row = pa.array(np.zeros(len(at), np.int64))
            v = value[at]
            return pa.RecordBatch.from_arrays(
                [*(k.take(row) for k in key_row), pa.array((block[-3] * size + at // wide).astype(np.int32)),
                 pa.array((block[-2] * size + at % wide).astype(np.int32)), pa.array(v, mask=np.isnan(v))], [*keys, "iy", "ix", "value"])

        for batch in batches:
            names = list(zip(*(batch.column(k).to_pylist() for k in keys), *(batch.column(c).to_pylist() for c in ("by", "bx")), map(tuple, batch.column("grid").to_pylist())))
            tiles = list(zip(*(batch.column(c).to_pylist() for c in ("zone", "zone_rank", "rank", "tile", "nearest"))))
            lefts, tops, wides = (batch.column(c).to_numpy() for c in ("left", "top", "w"))
            (flat, bounds), (there, _) = block_ops.floats(batch.column("value")), block_ops.floats(batch.column("there"))
            for i in range(batch.num_rows):
                if names[i] != block:
                    if block is not None:
                        add_tile()
                        yield cells()
                    block, tile = names[i], tiles[i]
                    key_row = [batch.column(k).slice(i, 1) for k in keys]
                    n = outlines.centres(block[-1], tile[0], block[-3], block[-2])[0].size
                    value, seen = np.full(n, np.nan), np.zeros(n, bool)
                elif tiles[i] != tile:
                    add_tile()
                    tile = tiles[i]
                part = slice(bounds[i], bounds[i + 1])
                parts.append((lefts[i], tops[i], flat[part].reshape(-1, wides[i]), there[part].reshape(-1, wides[i])))
        if block is not None:
            add_tile()
            yield cells()
    return run


def grid_array(grid: Grid):
    """A grid's members, numbers or columns, in one array column."""
    return F.array(*[(m if isinstance(m, Column) else F.lit(m)).cast("double") for m in (grid.xmin, grid.ymax, grid.res, grid.width, grid.height)])


def mosaic_two_zone(px: DataFrame, tiles: DataFrame, res: float, dst: Grid, keys=("mosaic_key",), size=block_ops.BLOCK, one_zone="cubic") -> DataFrame:
    """Tiles of the first zone win over those of the other zone, then the tile order counts.

    ``px`` holds ``mosaic_key, tile, x, y, value`` with cells of ``res``, ``tiles`` ``mosaic_key, tile, zone,
    rank``. Tiles are brought onto the polar grid one by one, cubically, so each keeps its own edge. ``dst``
    may be made of columns of ``tiles``, one grid for each mosaic. With ``one_zone="nearest"`` mosaics whose tiles
    all lie in one zone take their nearest cells instead.

    Cells travel to blocks of their tile once. Each block of the target then gets the parts of tiles, of either
    zone, that lie under its outline in that zone, with the kernel's reach around. There every target
    centre is projected once a zone and looked up in the tile's cells, so neither zone's cells are spread, and every
    target whose centre lies in a tile's cell has a row: a turned grid leaves no holes. The tiles of a block come one
    after the other; a task holds one of them and the block.
    """
    keys = list(keys)
    ranked = zone_ranks(tiles, keys)
    zones = ranked.groupBy(*keys).agg((F.lit(one_zone == "nearest") & (F.max("zone_rank") == 0)).alias("nearest"))
    ranked = ranked.join(zones, keys).select(*keys, "tile", "zone", "zone_rank", "rank", "nearest", grid_array(dst).alias("grid"))
    placed = tile_blocks(px.select(*keys, "tile", "x", "y", "value"), [*keys, "tile"], res, size).join(ranked, [*keys, "tile"])
    types = dict(placed.dtypes)
    part = block_ops.ddl(placed, [*keys, "tile", "zone", "zone_rank", "rank", "nearest"],
                         "grid array<double>, by int, bx int, left double, top double, w int, value array<double>, there array<tinyint>")
    order = ["by", "bx", "zone_rank", "rank", "tile", "zone"]
    parts = placed.mapInArrow(_needed(res, size, keys), part).repartition(*keys, "by", "bx").sortWithinPartitions(*keys, *order)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "iy int, ix int, value double"])
    return parts.mapInArrow(_merged(res, size, keys), schema)


def mosaic_match_template(mosaic: DataFrame, src: Grid, template: Grid) -> DataFrame:
    """Mosaic cells on the template's grid."""
    return resample_nearest(mosaic, src, template)
