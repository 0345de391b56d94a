"""Mosaics on the regions' polar grids from tiles of one and of two zones, against every cell looked up by itself."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.functions.grid import Grid
from rasterloom.functions.projection import Arrays, polar_from_utm, utm_from_polar
from rasterloom.operators import mosaic, resample
from rasterloom.operators.blocks import gather_blocks, scan_blocks
from rasterloom.plans import chains

RES, SIDE, TOP = 2000.0, 30, 7776000.0
LEFT = {22: 612000.0, 23: 384000.0}
NAME = "S2A_MSIL2A_2020010{}T101010_N0214_R083_T{}"
TILES = {22: "22VFP", 23: "23VKL"}


def tile_cells(zone, day, value):
    """Centres and values of a tile; one corner has no rows, one cell no value."""
    name = NAME.format(day, TILES[zone])
    return [(name, LEFT[zone] + (c + 0.5) * RES, TOP - (r + 0.5) * RES, None if (r, c) == (12, 12) else value(r, c))
            for r in range(SIDE) for c in range(SIDE) if r + c > 4]


def looked_up(zone, x, y):
    """Row and column of the tile's cell that holds a point, if it has a row."""
    ux, uy = utm_from_polar(np.float64(x), np.float64(y), zone, Arrays)
    r, c = int(np.floor((TOP - uy) / RES)), int(np.floor((ux - LEFT[zone]) / RES))
    return (r, c) if 0 <= r < SIDE and 0 <= c < SIDE and r + c > 4 else None


@pytest.mark.parametrize("size", [8, 64])
def test_regions_of_one_and_two_zones(spark, size):
    ramp = lambda r, c: float(100 * r + c + 1)
    px = spark.createDataFrame(tile_cells(22, 1, lambda r, c: 5.0) + tile_cells(23, 1, lambda r, c: 7.0) + tile_cells(22, 2, ramp),
                               "name string, x double, y double, value double").repartition(4)
    edge = [polar_from_utm(np.float64(LEFT[z] + i * SIDE * RES), np.float64(TOP - j * SIDE * RES), z, Arrays) for z in LEFT for i in (0, 1) for j in (0, 1)]
    x0, y0 = (float(min(p[k] for p in edge)) - 3000 for k in (0, 1))
    x1, y1 = (float(max(p[k] for p in edge)) + 3000 for k in (0, 1))
    regions = spark.createDataFrame([("both", x0, y0, x1, y1, 4000.0, "22VFP,23VKL"), ("one", x0 + 11.0, y0, x1, y1, 3000.0, "22VFP")],
                                    "region string, xmin double, ymin double, xmax double, ymax double, area_km2 double, utm_grid string")
    scenes = px.select("name").distinct().withColumn("acquired", F.substring(F.get(F.split("name", "_"), F.lit(2)), 1, 8))
    found, lineage, templates = chains.mosaic_regions(px, scenes, regions, RES, RES, size=size)
    got = {(r.region, r.mosaic_key[18:19], r.iy, r.ix): r.value for r in found.collect()}

    want = {}
    for region, left in (("both", x0), ("one", x0 + 11.0)):
        width, height = int((x1 - left) / RES), int((y1 - y0) / RES)
        for iy in range(height):
            for ix in range(width):
                x, y = left + (ix + 0.5) * RES, y1 - (iy + 0.5) * RES
                a, b = looked_up(22, x, y), looked_up(23, x, y)
                blank = (12, 12)
                if a is not None:
                    want[region, "2", iy, ix] = None if a == blank else ramp(*a)
                    want[region, "1", iy, ix] = None if a == blank else 5.0
                if region == "both" and b is not None and want.get((region, "1", iy, ix)) is None:
                    want[region, "1", iy, ix] = None if b == blank else 7.0
    assert set(got) == set(want)
    for k, v in want.items():
        assert (got[k] is None) == (v is None) and (v is None or got[k] == pytest.approx(v, abs=1e-9)), k
    assert {7.0, 5.0} <= {v for k, v in got.items() if k[:2] == ("both", "1")}
    assert {(r.region, r.mosaic_key[18:19]): r.sources.count(",") for r in lineage.collect()} == {("both", "1"): 1, ("both", "2"): 0, ("one", "1"): 0, ("one", "2"): 0}
    # The earliest mosaic that covers the region: for "both" only that of two tiles does.
    assert {r.region: r.mosaic_key[18:19] for r in templates.collect()} == {"both": "1", "one": "1"}


def test_first_valid_on_blocks_is_that_on_cells(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rank, y, x, None if rng.random() < 0.5 else float(rng.normal())) for k in (1, 2) for rank in range(3) for y in range(9) for x in range(7)]
    px = spark.createDataFrame(rows, "mosaic_key int, rank int, iy int, ix int, value double")
    blocks = gather_blocks(px, ["mosaic_key", "rank"], ["value"], 4, 4)
    a = scan_blocks(mosaic.first_valid_blocks(blocks), ["mosaic_key"], ["value"], 4, 4, 9, 7)
    b = mosaic.mosaic_first_valid(px)
    key = lambda df: {(r.mosaic_key, r.iy, r.ix): r.value for r in df.collect()}
    assert key(a) == key(b)


@pytest.mark.parametrize("dst", [Grid(30.0, 870.0, 70.0, 9, 11), Grid(-250.0, 1150.0, 130.0, 9, 12), Grid(5000.0, 9000.0, 100.0, 2, 2)])
def test_nearest_on_blocks_is_that_on_cells(spark, dst):
    src = Grid(0.0, 900.0, 100.0, 7, 9)
    px = spark.createDataFrame([(1, y, x, float(10 * y + x)) for y in range(9) for x in range(7)], "f int, iy int, ix int, value double")
    made, bh, bw = resample.nearest_blocks(gather_blocks(px, ["f"], ["value"], 4, 4), src, dst, ["f"], 4, 4, size=5)
    a = {(r.iy, r.ix): r.value for r in scan_blocks(made, ["f"], ["value"], bh, bw, dst.height, dst.width).collect() if r.value is not None}
    assert a == {(r.iy, r.ix): r.value for r in resample.resample_nearest(px, src, dst).collect()}
