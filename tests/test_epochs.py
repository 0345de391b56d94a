"""The elevation-model epoch as a key, companion masks and alignment in the composed jobs, pruned chunks."""

import pytest
from pyspark.sql import functions as F

from rasterloom.functions.grid import Grid
from rasterloom.operators import masks as mask_ops, resample
from rasterloom.plans import chains, fixtures as fx

D = "/root/testdata/sf0.001"
SWITCH = "2020-01-11"
BOUNDS = {"xmin": 0.0, "ymin": 0.0, "xmax": 400.0, "ymax": 800.0}


@pytest.fixture(scope="module")
def inputs(spark):
    pairs = fx.field_times(spark, D).withColumns({k: F.lit(v) for k, v in BOUNDS.items()})
    return fx.px_wide(spark, D), pairs, fx.masks(spark, D)


def run(px, pairs, masks, cfg, **more):
    _, flow, table = chains.offset_fields(px, pairs, fx.WIDTH, fx.HEIGHT, cfg, **more)
    out, docs = chains.correct_fields(px, pairs, table, masks, flow, 100.0, cfg, **more)
    keep = ["region", "field_id", "iy", "ix", "vx", "vy"]
    return table, {tuple(r) for r in out.select(*keep).collect()}, {(r.region, r.field_id) for r in docs.collect()}


def test_a_period_across_the_switch_equals_two_runs(inputs):
    px, pairs, masks = inputs
    table, pixels, fields = run(px, pairs, masks, chains.Settings(dem_switch=SWITCH))
    assert {r.epoch for r in table.select("epoch").distinct().collect()} == {"pre", "post"}
    parts = [pairs.where(F.col("datetime_1").cast("date") < F.lit(SWITCH).cast("date")), pairs.where(F.col("datetime_1").cast("date") >= F.lit(SWITCH).cast("date"))]
    apart = [run(px, p, masks, chains.Settings()) for p in parts]
    assert pixels == apart[0][1] | apart[1][1] and fields == apart[0][2] | apart[1][2]
    assert all(a[1] for a in apart)
    assert pixels != run(px, pairs, masks, chains.Settings())[1]


def test_companion_masks_act_before_medians_and_correction(inputs):
    px, pairs, masks = inputs
    hidden = px.where("field_id % 3 = 0").select("region", "field_id", "iy", "ix", ((F.col("iy") + F.col("ix")) % 2).alias("mask"))
    with_mask = run(px, pairs, masks, chains.Settings(), field_mask=hidden)
    before = run(mask_ops.apply_field_mask(px, hidden, ["dx", "dy"]), pairs, masks, chains.Settings())
    assert with_mask[1:] == before[1:]


def test_fields_are_aligned_before_correction(inputs):
    px, pairs, masks = inputs
    src, dst = Grid(25.0, 775.0, 100.0, fx.WIDTH, fx.HEIGHT), Grid(0.0, 800.0, 100.0, fx.WIDTH, fx.HEIGHT)
    _, flow, table = chains.offset_fields(px, pairs, fx.WIDTH, fx.HEIGHT)
    a, _ = chains.correct_fields(px, pairs, table, masks, flow, 100.0, src=src, dst=dst)
    placed = resample.resample_cubic(px, src, dst, ["region", "field_id"], ("dx", "dy"))
    b, _ = chains.correct_fields(placed, pairs, table, masks, flow, 100.0)
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}


def test_coarser_grids_are_refused(inputs):
    with pytest.raises(ValueError):
        resample.resample_cubic(inputs[0], Grid(0.0, 800.0, 100.0, 4, 8), Grid(0.0, 800.0, 300.0, 2, 3), ["field_id"], ("dx",))


def test_clip_prunes_stored_chunks(spark, tmp_path):
    chunks = spark.range(100).select(
        F.floor(F.col("id") / 10).cast("int").alias("chunk_y"), (F.col("id") % 10).cast("int").alias("chunk_x"),
        F.transform(F.sequence(F.lit(0), F.lit(15)), lambda p: (p + F.col("id") * 100).cast("double")).alias("values"))
    chunks.write.parquet(str(tmp_path / "chunks"))
    stored, grid, bounds = spark.read.parquet(str(tmp_path / "chunks")), Grid(0.0, 40.0, 1.0, 40, 40), (5.2, 8.1, 17.0, 30.5)
    clipped = resample.clip_chunks(stored, grid, bounds, 4, 4, (-1.0,))
    plan = clipped._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(chunk_y,2), LessThanOrEqual(chunk_y,7" in plan
    whole = resample.clip_to_bounds(resample.scan_pixels(stored, 4, 4, (-1.0,)), grid, bounds)
    assert {tuple(r) for r in clipped.collect()} == {tuple(r) for r in whole.collect()} and clipped.count() > 0


def test_two_zone_mosaics_have_no_holes(spark):
    """A full tile, on a polar grid of equal cells that stands at an angle to it."""
    from rasterloom.functions.projection import polar_from_utm, utm_from_polar
    from rasterloom.operators import mosaic

    px = spark.range(900).select(
        F.lit("k").alias("mosaic_key"), F.lit(1).alias("tile"), (612000.0 + (F.col("id") % 30 + 0.5) * 2000).alias("x"),
        (7776000.0 - (F.floor(F.col("id") / 30) + 0.5) * 2000).alias("y"), F.lit(5.0).alias("value"))
    tiles = spark.createDataFrame([("k", 1, 22, 0)], "mosaic_key string, tile int, zone int, rank int")
    corner = px.select(*polar_from_utm(F.col("x"), F.col("y"), F.lit(22))).toDF("a", "b").agg(F.min("a"), F.max("b")).first()
    dst = Grid(corner[0] - 4000, corner[1] + 4000, 2000.0, 60, 60)
    got = {(r.iy, r.ix): r.value for r in mosaic.mosaic_two_zone(px, tiles, 2000.0, dst).collect()}
    cells = spark.range(3600).select((F.col("id") / 60).cast("int").alias("iy"), (F.col("id") % 60).cast("int").alias("ix"))
    x, y = utm_from_polar(F.lit(dst.xmin) + (F.col("ix") + 0.5) * 2000, F.lit(dst.ymax) - (F.col("iy") + 0.5) * 2000, F.lit(22))
    inside = cells.withColumns({"x": x, "y": y}).where("x > 612000 and x < 672000 and y < 7776000 and y > 7716000")
    assert set(got) == {(r.iy, r.ix) for r in inside.collect()} and all(abs(v - 5) < 1e-9 for v in got.values())
