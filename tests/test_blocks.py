"""Rasters as blocks: rims, stacks, resampling and mosaics against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.functions.grid import Grid
from rasterloom.functions.kernels import ARRAY_KERNELS
from rasterloom.operators import blocks, resample

H, W = 11, 9


def raster(seed, height=H, width=W):
    rng = np.random.default_rng(seed)
    grid = rng.normal(size=(height, width))
    grid[rng.random(grid.shape) < 0.2] = np.nan
    return grid


def cells(spark, grids):
    rows = [(f, y, x, None if np.isnan(v) else float(v)) for f, g in grids.items() for (y, x), v in np.ndenumerate(g)]
    return spark.createDataFrame(rows, "f int, iy int, ix int, value double").repartition(3)


def as_grids(df, height, width):
    out = {}
    for r in df.collect():
        grid = out.setdefault(r.f, np.full((height, width), np.nan))
        grid[r.iy, r.ix] = np.nan if r.value is None else r.value
    return out


def median_3x3(grid):
    padded = np.pad(grid, 1, mode="edge")
    out = np.full(grid.shape, np.nan)
    for y, x in np.argwhere(~np.isnan(grid)):
        out[y, x] = np.nanmedian(padded[y:y + 3, x:x + 3])
    return out


@pytest.mark.parametrize("bh, bw", [(3, 4), (4, 3), (64, 64), (11, 9)])
def test_median_of_blocks(spark, bh, bw):
    grids = {f: raster(f) for f in (1, 2)}
    found = blocks.gather_blocks(cells(spark, grids), ["f"], ["value"], bh, bw)
    made = blocks.scan_blocks(blocks.median_blocks_3x3(found, ["f"], ["value"], bh, bw, H, W), ["f"], ["value"], bh, bw, H, W)
    assert made.count() == 2 * H * W
    for f, grid in as_grids(made, H, W).items():
        np.testing.assert_array_equal(grid, median_3x3(grids[f]))


def test_blocks_and_cells_are_one(spark):
    grids = {f: raster(f) for f in (1, 2, 3)}
    found = blocks.gather_blocks(cells(spark, grids), ["f"], ["value"], 4, 4)
    assert found.count() == 3 * 9
    for f, grid in as_grids(blocks.scan_blocks(found, ["f"], ["value"], 4, 4, H, W), H, W).items():
        np.testing.assert_array_equal(grid, grids[f])


@pytest.mark.parametrize("at_once", [1, 40, 1 << 20])
def test_median_of_a_stack_in_strips(spark, at_once):
    stacks = {f: raster(f) for f in range(7)}
    found = blocks.gather_blocks(cells(spark, stacks), ["f"], ["value"], 4, 5)
    made = blocks.median_stack(found.withColumn("f", F.lit(0)), ["f"], ["value"], 4, 5, 7, at_once=at_once)
    got = as_grids(blocks.scan_blocks(made, ["f"], ["value"], 4, 5, H, W), H, W)[0]
    with np.errstate(all="ignore"):
        np.testing.assert_array_equal(got, np.nanmedian(np.stack(list(stacks.values())), axis=0))


def test_rims_are_all_that_travels_twice(spark):
    found = blocks.gather_blocks(cells(spark, {1: raster(1, 64, 64)}), ["f"], ["value"], 16, 16)
    rows = blocks.halo(64, 16, 2)
    made = blocks.windows(found, ["f"], ["value"], 16, 16, rows, rows)
    sent = made.select(F.explode("parts").alias("p")).agg(F.sum(F.size("p.value"))).first()[0]
    assert sent == sum((high - low) for low, high in zip(*rows)) ** 2
    assert made.count() == 16


def plain_resampled(grid, src, dst, method, widen):
    """Weights of every source cell for every target, as the formula has them."""
    kernel, support = ARRAY_KERNELS[method]
    factor = max(dst.res / src.res, 1.0) if widen else 1.0
    out, near = np.full((dst.height, dst.width), np.nan), np.zeros((dst.height, dst.width), bool)
    for y in range(dst.height):
        for x in range(dst.width):
            cy = (src.ymax - dst.ymax + (y + 0.5) * dst.res) / src.res - 0.5
            cx = (dst.xmin - src.xmin + (x + 0.5) * dst.res) / src.res - 0.5
            total = weight = 0.0
            for (iy, ix), v in np.ndenumerate(grid):
                if abs(cy - iy) / factor < support and abs(cx - ix) / factor < support:
                    near[y, x] = True
                    if not np.isnan(v):
                        w = float(kernel((cy - iy) / factor) * kernel((cx - ix) / factor))
                        total, weight = total + w * v, weight + w
            if weight > 1e-6:
                out[y, x] = total / weight
    return out, near


GRIDS = [
    (Grid(37.0, 1061.0, 100.0, 8, 12), False), (Grid(-450.0, 1300.0, 60.0, 31, 23), False),
    (Grid(0.0, 1100.0, 250.0, 4, 5), True), (Grid(5000.0, 9000.0, 100.0, 3, 3), False),
]


@pytest.mark.parametrize("method", ["bilinear", "cubic"])
@pytest.mark.parametrize("dst, widen", GRIDS)
def test_resampling(spark, method, dst, widen):
    src = Grid(0.0, 1100.0, 100.0, W, H)
    grids = {f: raster(f) for f in (1, 2)}
    px = cells(spark, grids)
    made = resample.resample_weighted(px, src, dst, method, ["f"], size=5, widen=widen)
    found, bh, bw = resample.resample_blocks(blocks.gather_blocks(px, ["f"], ["value"], 4, 4), src, dst, method, ["f"], 4, 4, size=5, widen=widen)
    stored = as_grids(blocks.scan_blocks(found, ["f"], ["value"], bh, bw, dst.height, dst.width), dst.height, dst.width)
    rows = {(r.f, r.iy, r.ix): r.value for r in made.collect()}
    for f, grid in grids.items():
        want, near = plain_resampled(grid, src, dst, method, widen)
        assert {k[1:] for k in rows if k[0] == f} == {tuple(int(i) for i in p) for p in np.argwhere(near)}
        got = np.full(want.shape, np.nan)
        for (g, y, x), v in rows.items():
            if g == f and v is not None:
                got[y, x] = v
        np.testing.assert_allclose(got, want, rtol=1e-9, atol=1e-9)
        np.testing.assert_allclose(stored.get(f, np.full(want.shape, np.nan)), want, rtol=1e-9, atol=1e-9)


def test_grids_of_rows(spark):
    """Every raster has a target grid of its own; a coarse one is refused when it is met."""
    src = Grid(0.0, 1100.0, 100.0, W, H)
    grids = {1: raster(1), 2: raster(2)}
    own = {1: Grid(37.0, 1061.0, 100.0, 8, 12), 2: Grid(-450.0, 1300.0, 60.0, 31, 23)}
    table = spark.createDataFrame([(f, g.xmin, g.ymax, g.res, g.width, g.height) for f, g in own.items()],
                                  "f int, xmin double, ymax double, res double, width int, height int")
    made = {(r.f, r.iy, r.ix): r.value for r in resample.resample_cubic(cells(spark, grids).join(table, "f"), src, Grid.of_columns(), ["f"]).collect()}
    for f, g in own.items():
        want, near = plain_resampled(grids[f], src, g, "cubic", False)
        for y, x in np.argwhere(near):
            v = made[f, y, x]
            assert (v is None and np.isnan(want[y, x])) or v == pytest.approx(want[y, x])
    with pytest.raises(Exception, match="widen"):
        resample.resample_cubic(cells(spark, grids).join(table.withColumn("res", F.lit(300.0)), "f"), src, Grid.of_columns(), ["f"]).collect()


def test_empty_tables(spark):
    none = cells(spark, {1: raster(1)}).where("f > 1")
    found = blocks.gather_blocks(none, ["f"], ["value"], 4, 4)
    assert blocks.median_blocks_3x3(found, ["f"], ["value"], 4, 4, H, W).count() == 0
    assert blocks.median_stack(found, ["f"], ["value"], 4, 4, 0).count() == 0
    assert resample.resample_blocks(found, Grid(0.0, 1100.0, 100.0, W, H), GRIDS[0][0], "cubic", ["f"], 4, 4)[0].count() == 0
