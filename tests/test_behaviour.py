"""Hand-computed cases for behaviour that is easy to get wrong."""

import math

import pytest
from pyspark.sql import functions as F

from rasterloom import schemas
from rasterloom.functions import names, temporal, vector
from rasterloom.operators import correction, cube, documents, pairs, quality, regions, scenes
from rasterloom.sources import catalog


def one(spark, **columns):
    row = spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()
    return row[0] if len(columns) == 1 else row


@pytest.mark.parametrize("dx,dy,want", [
    (1.0, 1.0, 45.0), (-1.0, 1.0, 135.0), (-1.0, -1.0, -135.0), (1.0, -1.0, -45.0), (-1.0, 0.0, 180.0),
    (0.0, 1.0, -90.0), (0.0, -1.0, 90.0), (0.0, 0.0, None),
])
def test_flow_direction(spark, dx, dy, want):
    got = one(spark, a=vector.flow_direction(F.lit(dx), F.lit(dy)))
    assert got is None if want is None else got == pytest.approx(want)


def test_flow_direction_takes_the_side_of_the_uncorrected_component(spark):
    assert one(spark, a=vector.flow_direction(F.lit(1.0), F.lit(1.0), side=F.lit(-2.0))) == pytest.approx(-135.0)


def test_atan2_form_agrees_off_the_vertical(spark):
    both = one(spark, a=vector.flow_direction(F.lit(-2.0), F.lit(0.5)), b=vector.flow_direction_atan2(F.lit(-2.0), F.lit(0.5)))
    assert both[0] == pytest.approx(both[1])


def test_angular_difference_folds(spark):
    assert one(spark, a=vector.angular_difference(F.lit(170.0), F.lit(-170.0))) == 20.0


def test_correction_by_zero_days_is_null(spark):
    assert one(spark, a=vector.corrected(F.lit(1.0), F.lit(2.0), F.lit(0.0))) is None


def test_nodata_and_nan_become_null(spark):
    df = spark.createDataFrame([(0.0,), (-9999.0,), (float("nan"),), (2.5,), (None,)], "v double")
    got = [r[0] for r in df.select(vector.nodata_to_null(F.col("v"), [0.0, -9999.0])).collect()]
    assert got == [None, None, None, 2.5, None]


def test_scene_name(spark):
    name = "S2B_MSIL2A_20200716T162839_N0214_R083_T22VFP_20200716T190000"
    row = spark.createDataFrame([(name,)], "name string").select(*names.scene_name_columns(F.col("name"))).first()
    assert tuple(row) == ("S2B", "20200716T162839", "20200716T16", "083", "0214")
    key, tile, zone = one(spark, k=names.mosaic_key(F.lit(name)), t=names.tile_of(F.lit(name)), z=names.zone_of(F.lit(name)))
    assert (key, tile, zone) == ("S2B_MSIL2A_20200716T162839_N0214_R083", "22VFP", "22")


def test_pair_dates_need_lone_hour_stamps(spark):
    df = spark.createDataFrame([("vmap_S2A_20200101T00_S2B_20200111T12_x",), ("vmap_20200101T000102_20200111T12",)], "id string")
    a, b = pairs.parse_pair_dates(df).select("datehr1", "datehr2").collect()
    assert tuple(a) == ("20200101T00", "20200111T12")
    assert tuple(b) == ("20200111T12", None)


@pytest.mark.parametrize("name,want", [
    ("20200101000000_LC80080112020001LGN00_LC08_L1TP_008011_20200101_20200114_01_T1_ortho", ("LC08", "008011", "C01_T1_L1TP")),
    ("20200101000000_AST_L1T_0000", ("AST", "AST", "AST")),
    ("20200101000000_LC80080112020001LGN00_ortho", ("LC08", "008011", "Pre Collection-1")),
])
def test_landsat_ids(spark, name, want):
    row = spark.createDataFrame([(name,)], "name string").select(*names.landsat_id_columns(F.col("name"))).first()
    assert tuple(row) == want


def test_orbit_label_uses_integers(spark):
    df = spark.createDataFrame([("083", "083"), ("008", "127")], "orbit1 string, orbit2 string")
    got = [tuple(r) for r in pairs.orbit_pair_label(df).select("orbit_pair", "orbit_match").collect()]
    assert got == [("R83_R83", 1), ("R8_R127", 0)]


def test_signs_of_day_sep(spark):
    df = spark.sql("SELECT TIMESTAMP '2020-01-01' a, TIMESTAMP '2020-01-11 12:00:00' b")
    s2 = pairs.pair_temporal(df, "a", "b", "a").first()
    l8 = pairs.pair_temporal_landsat(df, "a", "b").first()
    assert (s2.day_sep, s2.baseline, s2.halfbaseline, l8.day_sep) == (-10.5, 10.5, 5.25, 10.5)
    assert str(s2.midpoint) == "2020-01-06 06:00:00"


def test_last_orbit_of_an_hour_wins(spark):
    df = spark.createDataFrame([
        ("r", "20200101T000102", "20200101T00", "S2A", "001", "0214"), ("r", "20200101T005959", "20200101T00", "S2A", "002", "0214"),
        ("r", "20200101T005959", "20200101T00", "S2B", "003", "0300")],
        "region string, datetime string, datehour string, satellite string, orbits string, processing_baselines string")
    assert [r.orbits for r in pairs.dedupe_last_per_hour(df).collect()] == ["003"]


def test_date_filters_treat_the_end_day_differently(spark):
    df = spark.createDataFrame([("20240731T101010",), ("20240730T101010",), ("20240101T101010",)], "datetime string")
    assert pairs.filter_orbit_dates(df, "20240101", "20240731").count() == 2
    assert pairs.filter_scene_dates(df, "20240101", "20240731").count() == 1


def test_season_steps_by_month(spark):
    def flag(a, b):
        return one(spark, f=temporal.season_flag(F.to_date(F.lit(a)), F.to_date(F.lit(b))))

    assert flag("2020-01-31", "2020-05-30") is False  # the step to 31 May lies beyond the end
    assert flag("2020-01-15", "2020-05-15") is True
    assert flag("2020-10-01", "2021-04-30") is False
    assert flag("2020-06-01", "2020-05-01") is False


def test_year_ends_at_midnight_unless_told_otherwise(spark):
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP '2020-12-31 00:00:00'), (TIMESTAMP '2020-12-31 06:00:00') t(midpoint_datetime)")
    assert cube.split_years(df).count() == 1
    assert cube.split_years(df, full_year=True).count() == 2


def test_errors_before_filter_coverage_after_it(spark):
    # Cell 0: ice flowing the wrong way, cell 1: ice along the reference, cell 2: rock.
    px = spark.createDataFrame([
        ("r", 1, 0, 0, -1.0, 0.0, -1.0, True, False, 0.0, -2.0), ("r", 1, 0, 1, 1.0, 0.0, 1.0, True, False, 0.0, -2.0),
        ("r", 1, 0, 2, -3.0, 4.0, -3.0, False, True, 0.0, -2.0)],
        "region string, field_id int, iy int, ix int, dx double, dy double, dx_raw double, is_ice boolean, is_rock boolean, flow_ref double, day_sep double")
    masks = px.select("region", "iy", "ix", "is_ice")
    stats = correction.field_statistics(px, masks).first()
    assert (stats.mag_rmse, stats.dx_mean, stats.dx_displacement_mean) == (5.0, -3.0, 6.0)
    assert (stats.valid_ice_cells, stats.ice_cells, stats.percent_ice_area_notnull) == (1, 2, 50.0)
    left = {r.ix: (r.dx, r.dy) for r in correction.flow_filter(px).collect()}
    assert left == {0: (None, None), 1: (1.0, 0.0), 2: (-3.0, 4.0)}


def test_all_null_rock_gives_null_statistics(spark):
    px = spark.createDataFrame([("r", 1, None, None, True)], "region string, field_id int, dx double, dy double, is_rock boolean")
    assert correction.rock_error_velocity(px).first().mag_rmse is None


def test_landsat_zero_statistics_are_missing(spark):
    px = spark.createDataFrame([("r", 1, 0.0, 1.0, True)], "region string, field_id int, dx double, dy double, is_rock boolean")
    row = correction.rock_error_landsat(px).first()
    assert (row.dx_mean, row.dx_sd, row.dy_mean) == (None, None, 1.0)


def test_landsat_validity_tests_x_only(spark):
    px = spark.createDataFrame([(0.0, 1.0), (2.0, 0.0)], "dx double, dy double")
    assert [tuple(r) for r in correction.landsat_valid(px).collect()] == [(None, None), (2.0, 0.0)]


def test_two_scenes_of_one_second_count_as_one(spark):
    new = spark.createDataFrame([("r", "20200101000000_A"), ("r", "20200101000001_B"), ("q", "20200101000000_A")], "region string, subset_id string")
    done = spark.createDataFrame([("r", "20200101000000_C")], "region string, subset_id string")
    assert {tuple(r) for r in scenes.anti_new_scenes(new, done).collect()} == {("r", "20200101000001_B"), ("q", "20200101000000_A")}


def test_platforms_match_exactly(spark):
    df = spark.createDataFrame([("LANDSAT_1", ["MSS"]), ("LANDSAT_5", ["MSS"]), ("LANDSAT_5", ["TM"]), ("LANDSAT_9", ["OLI"]), ("LANDSAT_10", ["OLI"])],
                               "platform string, instruments array<string>")
    assert [r.platform for r in catalog.filter_platforms(df).collect()] == ["LANDSAT_5", "LANDSAT_9"]


def test_wrong_crs_stops_the_job(spark):
    df = spark.createDataFrame([("a", "EPSG:4326")], "region string, crs string")
    with pytest.raises(Exception, match="expected EPSG:3413"):
        regions.scan_aoi_regions(df).collect()


def test_unequal_cell_sizes_stop_the_job(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0, 300.0, 300.0)], "region string, xmin double, ymin double, xmax double, ymax double")
    assert regions.grid_spec(df, 100.001, 99.999).first().width == 3
    with pytest.raises(Exception, match="differs between the axes"):
        regions.grid_spec(df, 100.0, 101.0).collect()


def test_region_names_override_area_and_slice(spark):
    df = spark.createDataFrame([("001_a", 1.0), ("002_b", 5.0), ("003_c", 9.0)], "region string, area_km2 double")
    got = [r.region for r in regions.filter_regions(df, min_area=8, names=["001_a", "002_b"], ignore=["002_b"]).collect()]
    assert got == ["001_a"]
    assert [r.region for r in regions.filter_regions(df, max_area=9).collect()] == ["001_a", "002_b"]


def test_one_sensor_is_enough_and_none_is_not(spark):
    df = spark.createDataFrame([("a",)], "id string")
    assert cube.union_sensors(None, df).count() == 1
    with pytest.raises(ValueError):
        cube.union_sensors(None, None)


def test_attributes_survive_storage(spark, tmp_path):
    df = cube.attach_attributes(spark.createDataFrame([(1.0,)], "vx double"))
    df.write.parquet(str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).schema["vx"].metadata["units"] == "metres per day"


def test_documents_round_half_even_and_come_back(spark):
    stats = {c: 0.125 for c in (*correction.ERROR_COLUMNS, *correction.DISPLACEMENT_COLUMNS)}
    row = {"region": "r", "field_id": 1, "id": "S2_r", "source_product": "P", "satellite1": "S2A", "satellite2": "S2B", "baseline": 10.375,
           "orbit1": "083", "orbit2": "008", "processingbaseline1": "0214", "processingbaseline2": "0300", "percent_ice_area_notnull": 50.0,
           "xmin": 0.0, "ymin": 0.0, "xmax": 1.0, "ymax": 1.0, **stats}
    df = spark.createDataFrame([row]).withColumns({c: F.expr("TIMESTAMP '2020-01-01 10:20:30'") for c in ("datetime_1", "datetime_2", "midpoint")})
    back = documents.scan_field_metadata(documents.to_json_documents(documents.build_field_document(df, 100.0))).first()
    assert (back.error_dx_mean, back.baseline_days, back.scene_1_orbit) == (0.12, 10.38, 83)
    assert str(back.midpoint_datetime) == "2020-01-01 10:20:30"


def test_narrowing_truncates_days(spark):
    df = spark.createDataFrame([(10.9, 0.1)], "baseline_days double, error_dx_sd double")
    narrow = cube.narrow_types(df, schemas.CUBE_FIELDS)
    assert dict(narrow.dtypes) == {"baseline_days": "bigint", "error_dx_sd": "float"}
    assert narrow.first().baseline_days == 10


@pytest.mark.parametrize("verdicts,status", [
    (["matched", "skipped"], 0), (["matched", "unavailable"], 2), (["mismatched", "unavailable"], 1), (["skipped"], 2), ([], 2),
])
def test_tally_status(spark, verdicts, status):
    df = spark.createDataFrame([(v,) for v in verdicts], "verdict string")
    assert quality.qa_tally(df).first().status == status


def test_comparison_treats_null_as_equal(spark):
    a = spark.createDataFrame([(1, None), (2, 1.0), (3, 1.0)], "k int, v double")
    b = spark.createDataFrame([(1, None), (2, 2.0), (4, 1.0)], "k int, v double")
    got = {r.k: r.state for r in quality.compare_full_outer(a, b, ["k"], ["v"]).collect()}
    assert got == {2: "changed", 3: "only_candidate", 4: "only_baseline"}


def test_spec_reports_missing_wrong_and_forbidden(spark):
    rows = [(1, v, r, e) for v, r, k, e in quality.rule_rows({"epsg": "3413"}) if k == "exact"] + [(1, "", n, "x") for n in quality.FREE_ATTRIBUTES]
    units = spark.createDataFrame([(1,)], "unit int")
    schema = "unit int, variable string, rule string, value string"
    assert quality.qa_validate_spec(spark.createDataFrame(rows, schema), units, ["unit"], {"epsg": "3413"}).count() == 0
    bad = [r for r in rows if r[1] != "crs"] + [(1, "scene_1_datetime", "_FillValue", "NaN")]
    bad = [(u, v, r, "4" if (v, r) == ("vx", "complevel") else e) for u, v, r, e in bad]
    issues = {(r.variable, r.rule, r.issue) for r in quality.qa_validate_spec(spark.createDataFrame(bad, schema), units, ["unit"], {"epsg": "3413"}).collect()}
    assert issues == {("crs", "", "missing variable"), ("scene_1_datetime", "_FillValue", "must be absent"), ("vx", "complevel", "got 4")}


def test_structure_of_both_sensors(spark):
    s2 = spark.createDataFrame([("001_a", "clipped"), ("001_a", "metadata"), ("_reference", "x")], "region string, part string")
    assert {tuple(r) for r in quality.qa_output_structure(s2, "sentinel2").collect()} == {("001_a", "template", True), ("001_a", "download", False)}
    l8 = spark.createDataFrame([("001_a", "x")], "region string, part string")
    assert [tuple(r) for r in quality.qa_output_structure(l8, "landsat").collect()] == [("", "_reference", True)]


def test_epoch_grouping_equals_two_runs(spark):
    df = spark.sql("SELECT id % 5 AS k, date_add(DATE '1998-01-01', CAST(id AS INT)) AS date1, CAST(id AS DOUBLE) AS v FROM range(400)")
    both = pairs.split_dem_epoch(df, "1998-08-23")
    together = {(r.epoch, r.k): r.m for r in both.groupBy("epoch", "k").agg(F.median("v").alias("m")).collect()}
    for epoch, part in (("pre", df.where("date1 < DATE '1998-08-23'")), ("post", df.where("date1 >= DATE '1998-08-23'"))):
        for r in part.groupBy("k").agg(F.median("v").alias("m")).collect():
            assert together[(epoch, r.k)] == r.m
    assert not math.isnan(sum(together.values()))
