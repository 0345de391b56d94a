"""Intermediates are made once for the files they come from."""

from pyspark.sql import functions as F

from rasterloom.sources.store import files_digest, intermediate


def test_a_second_call_reads_and_a_changed_input_builds(spark, tmp_path):
    data, root, calls = str(tmp_path / "data"), str(tmp_path / "store"), []
    spark.range(100).repartition(3).write.parquet(data)

    def total(**parameters):
        def build():
            calls.append(parameters)
            return spark.read.parquet(data).agg(F.sum("id").alias("total"))

        return intermediate(spark, "total", [spark.read.parquet(data)], parameters, build, root).first().total

    assert total(k=1) == total(k=1) == 4950 and len(calls) == 1
    assert total(k=2) == 4950 and len(calls) == 2
    spark.range(100, 101).write.mode("append").parquet(data)
    assert total(k=1) == 5050 and len(calls) == 3
    assert total(k=1) == 5050 and len(calls) == 3


def test_half_written_tables_do_not_count(spark, tmp_path):
    data, root = str(tmp_path / "data"), str(tmp_path / "store")
    spark.range(10).write.parquet(data)
    make = lambda: intermediate(spark, "rows", [spark.read.parquet(data)], {}, lambda: spark.read.parquet(data), root)
    assert make().count() == 10
    place = next((tmp_path / "store").iterdir())
    (place / "_SUCCESS").unlink()  # a job died while it wrote here
    for part in list(place.glob("part-*"))[1:]:
        part.unlink()
    assert make().count() == 10


def test_digest_follows_the_files(spark, tmp_path):
    for name in ("a", "b"):
        spark.range(5).coalesce(1).write.parquet(str(tmp_path / name))
    a, b = (files_digest(spark.read.parquet(str(tmp_path / n))) for n in "ab")
    assert a != b and a == files_digest(spark.read.parquet(str(tmp_path / "a")))
    assert files_digest(spark.read.parquet(str(tmp_path / "a")).where("id < 0")).startswith("(0, ")
