"""Footprints from degrees, and the selections that use them."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.functions.projection import Arrays, polar_from_lonlat
from rasterloom.operators import footprints
from rasterloom.plans import chains

SCHEMA = "scene int, coordinates array<array<array<double>>>"
SQUARE = [[-50.0, 70.0], [-48.0, 70.0], [-48.0, 71.0], [-50.0, 71.0], [-50.0, 70.0]]


def plain_ring(ring, parts):
    points = []
    for (ax, ay), (bx, by) in zip(ring[:-1], ring[1:]):
        turn = (bx - ax + 180) % 360 - 180
        points += [(ax + turn * k / parts, ay + (by - ay) * k / parts) for k in range(parts)]
    return np.array([polar_from_lonlat(np.float64(x), np.float64(y), Arrays) for x, y in points])


@pytest.mark.parametrize("parts", [1, 8])
def test_rings(spark, parts):
    over = [[179.0, 75.0], [-179.0, 75.0], [-179.0, 76.0], [179.0, 76.0], [179.0, 75.0]]  # across the date line
    rows = [(1, [SQUARE]), (2, [over, SQUARE]), (3, None), (4, []), (5, [[[0.0, 80.0], [1.0, 80.0]]])]
    found = {r.scene: r for r in footprints.project_footprints(spark.createDataFrame(rows, SCHEMA), parts=parts).collect()}
    for scene, ring in ((1, SQUARE), (2, over)):
        want = plain_ring(ring, parts)
        got = np.array([(p.x, p.y) for p in found[scene].ring])
        np.testing.assert_allclose(got, want, atol=1e-6)
        r = found[scene]
        assert np.allclose([r.x0, r.y0, r.x1, r.y1], [*want.min(axis=0), *want.max(axis=0)], atol=1e-6)
        assert math.dist((r.x0, r.y0), (r.x1, r.y1)) < 300_000
    assert all(found[i].ring is None and found[i].x0 is None for i in (3, 4, 5))


def test_selection_starts_from_coordinates(spark):
    x, y = map(float, polar_from_lonlat(np.float64(-49.0), np.float64(70.5), Arrays))
    regions = spark.createDataFrame([("in", x - 5000, y - 5000, x + 5000, y + 5000), ("half", x - 5000, y + 40000, x + 5000, y + 80000), ("out", 0.0, 0.0, 1.0, 1.0)],
                                    "region string, xmin double, ymin double, xmax double, ymax double")
    item = ("LANDSAT_8", ["OLI"], "2020-05-06T07:08:09Z", "SC1", "item", [SQUARE])
    catalog = spark.createDataFrame([item, (*item[:3], "SC2", "none", None), ("LANDSAT_2", *item[1:])],
                                    "platform string, instruments array<string>, datetime string, scene_id string, id string, coordinates array<array<array<double>>>")
    done = spark.createDataFrame([], "subset_id string")
    found = {r.region: r for r in chains.scene_selection_from_coordinates(catalog, regions, done).collect()}
    assert found["in"].frac == pytest.approx(1.0) and found["in"].subset_id == "20200506070809_SC1_item_ortho"
    assert "out" not in found and len(found) <= 2
    stored = spark.createDataFrame([("20200506070809_X",)], "subset_id string")
    assert chains.scene_selection_from_coordinates(catalog, regions, stored).count() == 0


def test_tile_selection(spark):
    name = "S2{}_MSIL2A_202001{:02d}T101010_N0214_R083_T{}".format
    rows = [name("A", 1, "22VFP"), name("A", 1, "22VFP"), name("A", 1, "24WWU"), name("A", 2, "22VFP"), name("B", 9, "22VFP"), name("A", 1, "99XXX")]
    scenes = spark.createDataFrame([(n,) for n in rows], "name string")
    regions = spark.createDataFrame([("r", "22VFP,24WWU"), ("q", "24WWU")], "region string, utm_grid string")
    done = spark.createDataFrame([("r", name("A", 2, "")[:37])], "region string, mosaic_key string")
    found = chains.tile_scene_selection(scenes, regions, done, "20200101", "20200105").select("region", "mosaic_key", "n_scenes", F.day("acquired").alias("day")).collect()
    key = name("A", 1, "")[:37]
    assert sorted(tuple(r) for r in found) == [("q", key, 1, 1), ("r", key, 2, 1)]
