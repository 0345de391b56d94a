"""Only years whose content changed are delivered again."""

from pyspark.sql import functions as F

from rasterloom.sources import sinks


def cube(spark, shift=0, years=(2019, 2020, 2021)):
    fields = spark.createDataFrame([("P1", y, i, f"id{y}-{i}") for y in years for i in range(3)], "public_id string, year int, index bigint, id string")
    pixels = spark.createDataFrame([("P1", y, i, r, c, float(i + r + c) + (shift if y == 2020 else 0)) for y in years for i in range(3) for r in range(4) for c in range(3)],
                                   "public_id string, year int, index bigint, iy int, ix int, vx double")
    return pixels.repartition(3), fields.repartition(2)


def files(path):
    return {p.relative_to(path): p.stat().st_mtime_ns for p in path.glob("*/public_id=*/year=*/*.parquet")}


def test_a_year_is_written_again_only_if_it_changed(spark, tmp_path):
    path = str(tmp_path / "cube")
    assert sorted(r.year for r in sinks.deliver_cube(*cube(spark), path).collect()) == [2019, 2020, 2021]
    first = files(tmp_path / "cube")
    assert sinks.deliver_cube(*cube(spark), path).count() == 0 and files(tmp_path / "cube") == first
    # Rows in another order, in other partitions, are the same content.
    pixels, fields = cube(spark)
    assert sinks.deliver_cube(pixels.orderBy(F.desc("iy")).coalesce(1), fields.select("id", "index", "year", "public_id"), path).count() == 0
    pixels, fields = cube(spark, shift=5, years=(2019, 2020, 2021, 2022))
    assert sorted(r.year for r in sinks.deliver_cube(pixels, fields, path).collect()) == [2020, 2022]
    now = files(tmp_path / "cube")
    assert {k: v for k, v in now.items() if "year=2020" not in str(k) and "year=2022" not in str(k)} == {k: v for k, v in first.items() if "year=2020" not in str(k)}
    got = spark.read.parquet(f"{path}/pixels").select("public_id", "year", "index", "iy", "ix", "vx")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, pixels.collect()))


def test_a_job_that_dies_delivers_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "cube")
    monkeypatch.setattr(sinks.time, "time_ns", lambda: 1 / 0)
    try:
        sinks.deliver_cube(*cube(spark), path)
    except ZeroDivisionError:
        pass
    monkeypatch.undo()
    assert sinks.deliver_cube(*cube(spark), path).count() == 3
    assert spark.read.parquet(f"{path}/pixels").count() == 3 * 36


def test_nothing_to_deliver(spark, tmp_path):
    pixels, fields = cube(spark)
    assert sinks.deliver_cube(pixels.limit(0), fields.limit(0), str(tmp_path / "cube")).count() == 0
    # Fields without pixels are delivered too.
    assert sinks.deliver_cube(pixels.limit(0), fields, str(tmp_path / "cube")).count() == 3
