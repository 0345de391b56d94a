"""The plans for large groups, forced on small tables and compared with brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rasterloom.functions import projection
from rasterloom.functions.grid import Grid
from rasterloom.functions.polygon import clip_to_box, ring_area
from rasterloom.operators import mosaic, offsets, quantiles, rasters, resample, spatial
from rasterloom.operators.neighbourhood import box_median_3x3
from rasterloom.operators.numbering import group_row_number
from rasterloom.sources import pixels


def skewed(spark, n=6000):
    """One group holds a third of the rows, with copies, nulls, and one value far out."""
    rng = np.random.default_rng(7)
    key = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 40, n))
    v = np.round(rng.normal(size=n), 2)
    v[::50] = np.nan
    v[1] = 1e300
    frame = pd.DataFrame({"k": key, "v": v, "w": rng.integers(0, 9, n).astype(float)})
    df = spark.createDataFrame(frame).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    more = [(99, None, None), (None, 5.0, 1.0), (None, 7.0, None), (None, None, 2.0)]
    return df.union(spark.createDataFrame(more, "k long, v double, w double"))


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.95, 1.0])
def test_quantile_by_bracket_is_exact(spark, p):
    df = skewed(spark).cache()
    columns = {"a": "v", "b": "w"}
    small = {r.k: (r.a, r.b) for r in quantiles.grouped_quantile(df, ["k"], columns, p).collect()}
    large = {r.k: (r.a, r.b) for r in quantiles.grouped_quantile(df, ["k"], columns, p, limit=0).collect()}
    assert small == large and large[99] == (None, None) and large[None][0] is not None and len(large) == 42


def test_median_does_not_depend_on_order(spark):
    df = skewed(spark)
    a = offsets.median_composite(df.select("k", F.col("v").alias("value")), ["k"], largest=1)
    b = offsets.median_composite(df.select("k", F.col("v").alias("value")).orderBy(F.desc("value")), ["k"], largest=1)
    assert a.exceptAll(b).count() == 0


def test_numbering_by_sorted_slices(spark):
    df = skewed(spark).withColumn("id", F.monotonically_increasing_id())
    small = group_row_number(df, ["k"], ["w", "id"])
    large = group_row_number(df, ["k"], ["w", "id"], limit=0)
    rows = {(r.id, r["index"]) for r in large.collect()}
    assert {(r.id, r["index"]) for r in small.collect()} == rows and len(rows) == 6004
    assert sorted(r["index"] for r in large.where("k is null").collect()) == [0, 1, 2]


def brute_median(grid):
    h, w = grid.shape
    padded = np.pad(grid, 1, mode="edge")
    out = np.full((h, w), np.nan)
    for y in range(h):
        for x in range(w):
            if not np.isnan(grid[y, x]):
                out[y, x] = np.nanmedian(padded[y:y + 3, x:x + 3])
    return out


@pytest.mark.parametrize("size", [3, 4, 64])
def test_box_median_across_chunks(spark, size):
    rng = np.random.default_rng(3)
    grids = {f: rng.normal(size=(11, 9)) for f in (1, 2)}
    for g in grids.values():
        g[rng.random(g.shape) < 0.2] = np.nan
    rows = [(f, y, x, None if np.isnan(v) else float(v)) for f, g in grids.items() for (y, x), v in np.ndenumerate(g)]
    out = box_median_3x3(spark.createDataFrame(rows, "f int, iy int, ix int, value double"), ["f"], 9, 11, size=size).toPandas()
    assert len(out) == 2 * 99
    for f, g in grids.items():
        got = np.full(g.shape, np.nan)
        part = out[out.f == f]
        got[part.iy, part.ix] = part.value.astype(float)
        np.testing.assert_array_equal(got, brute_median(g))


def test_box_median_with_missing_rows(spark):
    rows = [(1, 0, 0, 1.0), (1, 0, 2, 5.0), (1, 1, 1, 3.0)]
    out = box_median_3x3(spark.createDataFrame(rows, "f int, iy int, ix int, value double"), ["f"], 3, 2, size=2)
    # The corner is repeated outwards: (0, 0) sees itself four times and 3.0 once.
    assert {(r.iy, r.ix): r.value for r in out.collect()} == {(0, 0): 1.0, (0, 2): 5.0, (1, 1): 3.0}


def test_offset_of_fields_equal_to_their_a_priori_is_zero(spark):
    px = spark.sql("SELECT 'r' region, f.id field_id, CAST(y.id AS INT) iy, CAST(x.id AS INT) ix, CAST(y.id * 4 + x.id + 1 AS DOUBLE) dx, CAST(1 AS DOUBLE) dy "
                   "FROM range(6) f, range(3) y, range(4) x")
    pairs = spark.sql("SELECT 'r' region, id field_id, 'R1_R1' orbit_pair, 1 orbit_match, -2.0D day_sep FROM range(6)")
    a_priori = offsets.median_composite(offsets.to_long(offsets.add_magnitude(px)))
    got = offsets.orbit_pair_offset(px, pairs, a_priori).agg(F.max(F.abs("dx_offset")), F.max(F.abs("dy_offset")), F.count("*")).first()
    assert tuple(got) == (0.0, 0.0, 12)
    assert offsets.orbit_pair_offset(px, pairs, a_priori, min_fields=7).count() == 0


def test_nearest_and_linear_on_a_ramp(spark):
    src = Grid(0.0, 600.0, 100.0, 6, 6)
    rows = [(1, y, x, float(10 * y + x)) for y in range(6) for x in range(6)]
    px = spark.createDataFrame(rows, "f int, iy int, ix int, value double")
    finer = Grid(0.0, 600.0, 50.0, 12, 12)
    near = {(r.iy, r.ix): r.value for r in resample.resample_nearest(px, src, finer).collect()}
    assert len(near) == 144 and near[(11, 0)] == 50.0 and near[(2, 5)] == 12.0
    shifted = Grid(130.0, 470.0, 100.0, 3, 3)
    for method in ("bilinear", "cubic"):
        got = {(r.iy, r.ix): r.value for r in resample.resample_weighted(px, src, shifted, method, ["f"]).collect()}
        # Both kernels reproduce a plane: row + 1.3, column + 1.3.
        assert got[(0, 0)] == pytest.approx(14.3) and got[(1, 1)] == pytest.approx(25.3)


def test_resampling_skips_null_sources(spark):
    src, dst = Grid(0.0, 200.0, 100.0, 2, 2), Grid(50.0, 150.0, 100.0, 1, 1)
    px = spark.createDataFrame([(1, 0, 0, 2.0), (1, 0, 1, None), (1, 1, 0, 4.0), (1, 1, 1, None)], "f int, iy int, ix int, value double")
    assert resample.resample_bilinear(px, src, dst, ["f"]).first().value == 3.0


def test_clip_reaches_the_scan(spark, tmp_path, capsys):
    spark.sql("SELECT CAST(id % 10 AS INT) iy, CAST(id DIV 10 AS INT) ix FROM range(100)").write.parquet(str(tmp_path / "p"))
    px = spark.read.parquet(str(tmp_path / "p"))
    grid = Grid(0.0, 1000.0, 100.0, 10, 10)
    clipped = resample.clip_to_bounds(px, grid, (200.0, 300.0, 500.0, 800.0))
    assert sorted({r.ix for r in clipped.collect()}) == [2, 3, 4] and sorted({r.iy for r in clipped.collect()}) == [2, 3, 4, 5, 6]
    clipped.explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(iy,2)" in plan and "LessThanOrEqual(ix,4)" in plan


def test_chunks_round_trip(spark):
    rows = [(1, y, x, None if (y, x) == (0, 1) else float(y * 4 + x + 1)) for y in range(4) for x in range(4)]
    px = spark.createDataFrame(rows, "f int, iy int, ix int, value double")
    stored = pixels.to_chunks(px, ["f"], 2, 2)
    assert stored.count() == 4
    back = pixels.scan_pixels(stored, 2, 2, [0.0])
    assert {tuple(r) for r in back.select("f", "iy", "ix", "value").collect()} == set(rows)


def test_mosaic_covers_the_union_of_valid_cells(spark):
    px = spark.createDataFrame([("m", 0, 0, 0, None), ("m", 1, 0, 0, 5.0), ("m", 0, 0, 1, 3.0), ("m", 1, 0, 1, 9.0), ("m", 1, 0, 2, None)],
                               "mosaic_key string, rank int, iy int, ix int, value double")
    assert {r.ix: r.value for r in mosaic.mosaic_first_valid(px).collect()} == {0: 5.0, 1: 3.0, 2: None}


def test_digest_ignores_order_and_sees_position(spark):
    a = spark.createDataFrame([(1, 0, 0, 5), (1, 0, 1, 6), (2, 0, 1, 6), (2, 0, 0, 5), (3, 0, 0, 6), (3, 0, 1, 5)], "r int, iy int, ix int, v int")
    got = {r.r: r.digest for r in rasters.content_digest(a, ["r"], "v").collect()}
    assert got[1] == got[2] != got[3]


def polygon(points):
    return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points])


@pytest.mark.parametrize("points,box,want", [
    ([(0, -2), (2, 0), (0, 2), (-2, 0)], (0, 0, 3, 3), 2.0),  # a quarter of a diamond
    ([(0, -2), (2, 0), (0, 2), (-2, 0)], (-1, -1, 1, 1), 4.0),
    ([(0, 0), (4, 0), (0, 4)], (10, 10, 12, 12), 0.0),
    ([(0, 0), (0, 4), (4, 0)], (-1, -1, 9, 9), 8.0),  # other turning sense
])
def test_convex_clip(spark, points, box, want):
    area = ring_area(clip_to_box(polygon(points), *[F.lit(float(b)) for b in box]))
    assert spark.range(1).select(area).first()[0] == pytest.approx(want)


def test_binned_join_reports_each_pair_once(spark):
    rng = np.random.default_rng(1)
    a = [(i, *map(float, (x, y, x + w, y + h))) for i, (x, y, w, h) in enumerate(rng.integers(-50, 50, (80, 4)) % [100, 100, 40, 40])]
    b = [(i, *map(float, (x, y, x + w, y + h))) for i, (x, y, w, h) in enumerate(rng.integers(-50, 50, (60, 4)) % [100, 100, 40, 40])]
    left = spark.createDataFrame(a, "a int, x0 double, y0 double, x1 double, y1 double")
    right = spark.createDataFrame(b, "b int, xmin double, ymin double, xmax double, ymax double")
    got = sorted((r.a, r.b) for r in spatial.join_boxes(left, right, 10.0).collect())
    want = sorted((p[0], q[0]) for p in a for q in b if p[1] <= q[3] and p[3] >= q[1] and p[2] <= q[4] and p[4] >= q[2])
    assert got == want


def test_projections_round_trip_below_a_millimetre(spark):
    pts = spark.sql("SELECT 500000D + (id % 20 - 10) * 30000 x, 6600000D + (id DIV 20) * 120000 y, 20 + id % 7 zone FROM range(240)")
    px, py = projection.polar_from_utm(F.col("x"), F.col("y"), F.col("zone"))
    back = pts.withColumns({"px": px, "py": py})
    ux, uy = projection.utm_from_polar(F.col("px"), F.col("py"), F.col("zone"))
    worst = back.select(F.max(F.abs(ux - F.col("x"))), F.max(F.abs(uy - F.col("y")))).first()
    assert max(worst) < 1e-3


def test_projections_keep_known_lengths(spark):
    one = spark.range(1)
    # The pole is the origin, and the standard parallel keeps its length.
    x, y = projection.polar_from_lonlat(F.lit(-45.0), F.lit(90.0))
    assert one.select(F.hypot(x, y)).first()[0] == pytest.approx(0.0, abs=1e-6)
    x, _ = projection.polar_from_lonlat(F.lit(-44.999), F.lit(70.0))
    phi = np.radians(70)
    parallel = np.radians(0.001) * projection.A * np.cos(phi) / np.sqrt(1 - projection.E2 * np.sin(phi) ** 2)
    assert one.select(x).first()[0] == pytest.approx(parallel, rel=1e-8)
    # The central meridian of a zone is a meridian arc times the zone's scale.
    _, north = projection.utm_from_lonlat(F.lit(-51.0), F.lit(70.0), F.lit(22))
    t = np.linspace(0, phi, 200001)
    curve = projection.A * (1 - projection.E2) / (1 - projection.E2 * np.sin(t) ** 2) ** 1.5
    assert one.select(north).first()[0] == pytest.approx(0.9996 * np.trapezoid(curve, t), abs=1e-2)


def test_each_region_may_have_its_own_template(spark):
    px = spark.createDataFrame([("a", 0, 0, 1.0), ("a", 0, 1, 2.0), ("b", 0, 0, 3.0), ("b", 0, 1, 4.0)], "region string, iy int, ix int, value double")
    own = spark.createDataFrame([("a", 0.0, 100.0, 50.0, 2, 2), ("b", 100.0, 100.0, 100.0, 1, 1)],
                                "region string, xmin double, ymax double, res double, width int, height int")
    got = resample.resample_nearest(px.join(own, "region"), Grid(0.0, 100.0, 100.0, 2, 1), Grid.of_columns())
    assert sorted((r.region, r.iy, r.ix, r.value) for r in got.collect()) == [
        ("a", 0, 0, 1.0), ("a", 0, 1, 1.0), ("a", 1, 0, 1.0), ("a", 1, 1, 1.0), ("b", 0, 0, 4.0)]
