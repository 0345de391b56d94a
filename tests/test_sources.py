"""Readers, sinks and the stream on real folders."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from rasterloom import schemas
from rasterloom.session import scratch_dir
from rasterloom.sources import sinks, text
from rasterloom.streaming import new_scenes


def test_good_lists_skip_empty_files(spark, tmp_path):
    (tmp_path / "list_good_2020.txt").write_text("pair_a\t0.1\t0.2\npair_b\t0.3\t0.4\n")
    (tmp_path / "list_good_2021.txt").write_text("")
    (tmp_path / "list_bad_2020.txt").write_text("pair_c\t0\t0\n")
    got = text.read_good_lists(spark, f"{tmp_path}/list_good_20??.txt", "/vel")
    assert sorted(tuple(r) for r in got.collect()) == [("pair_a", "/vel/pair_a"), ("pair_b", "/vel/pair_b")]


def test_meta_texts_keep_the_order_of_lines(spark, tmp_path):
    (tmp_path / "a_meta.txt").write_text("Title\nImage 1=/x/zz.tif\nnoise Image\nImage 2=/x/aa.tif\n")
    got = text.scan_pair_meta_text(text.read_meta_texts(spark, f"{tmp_path}/*meta.txt"))
    assert got.first().ids == ["zz.tif", "aa.tif"]


def test_listing_reads_names_only(spark, tmp_path):
    for region, part, name in (("001_a", "clipped", "S2A_x.tif"), ("001_a", "clipped", "L8_x.tif"), ("001_a", "template", "S2A_y.tif"),
                               ("_reference", "clipped", "S2A_z.tif"), ("002_b", "clipped", "S2B_x.tif")):
        folder = tmp_path / region / part
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(b"0")
    listing = text.read_listing(spark, str(tmp_path))
    assert listing.columns == ["path"]
    found = sorted((r.region, r.name) for r in text.scan_scene_listing(listing).collect())
    assert found == [("001_a", "S2A_x"), ("002_b", "S2B_x")]
    assert [r.region for r in text.scan_regions_present(listing, f"file:{tmp_path}").collect()] == ["001_a", "002_b"]


def test_a_large_region_is_written_by_many_tasks(spark, tmp_path):
    df = spark.range(2000).select(F.when(F.col("id") < 1900, "big").otherwise("small").alias("region"), "id")
    out = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")  # what a task's share is
    try:
        sinks.sink_by_region(df.repartition(8), out)
        sinks.sink_by_region(df.where("region = 'small'"), out)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = spark.read.parquet(out)
    assert back.count() == 2000
    assert back.where("region = 'big'").select(F.input_file_name()).distinct().count() > 1


def test_failures_add_up_by_run_and_keep_the_rest(spark, tmp_path):
    units = spark.createDataFrame([("a", None), ("b", "broken")], "unit string, error string")
    good, failed = sinks.split_failures(units)
    out = str(tmp_path / "f")
    for run in ("1", "2", "2"):  # a retry of the second
        sinks.sink_failures(failed, out, run)
    assert [r.unit for r in good.collect()] == ["a"] and spark.read.parquet(out).count() == 2


def session_with(master, **conf):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: conf.get(k, d)), sparkContext=SimpleNamespace(master=master))


def test_scratch_follows_the_cluster_setting():
    named = session_with("yarn", **{"spark.checkpoint.dir": "/shared/folder/"})
    assert scratch_dir(named, "x").startswith("/shared/folder/x-")
    with pytest.raises(ValueError):
        scratch_dir(session_with("yarn"), "x")


NAME = "S2A_MSIL2A_202001{:02d}T101010_N0214_R083_T22VFP"


def run(spark, tmp_path, **options):
    scenes = new_scenes.read_landing(spark, str(tmp_path / "in"), schemas.struct({"region": schemas.S, "name": schemas.S}), **options)
    job = new_scenes.stream_new_scenes(scenes, str(tmp_path / "table"), str(tmp_path / "cp"))
    job.awaitTermination()
    return spark.read.parquet(str(tmp_path / "table"))


def land(spark, tmp_path, days, region="r"):
    rows = [(region, NAME.format(day)) for day in days]
    spark.createDataFrame(rows, "region string, name string").write.mode("append").parquet(str(tmp_path / "in"))


def test_stream_appends_only_new_scenes(spark, tmp_path):
    land(spark, tmp_path, [1, 2, 2])
    assert run(spark, tmp_path).count() == 2
    land(spark, tmp_path, [2, 3])
    land(spark, tmp_path, [2], region="q")
    table = run(spark, tmp_path)
    assert sorted((r.region, r.stamp) for r in table.collect()) == [
        ("q", "20200102101010"), ("r", "20200101101010"), ("r", "20200102101010"), ("r", "20200103101010")]


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    land(spark, tmp_path, [1, 2])
    run(spark, tmp_path)
    # Without the last commit the batch runs again.
    (tmp_path / "cp" / "commits" / "0").unlink()
    crc = tmp_path / "cp" / "commits" / ".0.crc"
    if crc.exists():
        crc.unlink()
    assert run(spark, tmp_path).count() == 2


@pytest.mark.parametrize("name", ["vx", "vy"])
def test_cube_schema_is_narrow(name):
    assert schemas.CUBE_PIXELS[name].dataType.typeName() == "float"


def test_stream_keeps_all_scenes_of_a_second_whatever_the_batches(spark, tmp_path):
    land(spark, tmp_path, [1])
    assert run(spark, tmp_path).count() == 1
    # The same second as a stored scene, and two new scenes of one second, each in a file of its own.
    for orbit, day in (("R077", 1), ("R077", 5), ("R078", 5), ("R078", 5)):
        name = NAME.format(day).replace("R083", orbit)
        spark.createDataFrame([("r", name)], "region string, name string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    found = run(spark, tmp_path, files_per_batch=1).collect()
    assert sorted((r.stamp[:8], r.orbits) for r in found) == [("20200101", "083"), ("20200105", "077"), ("20200105", "078")]
    assert len({(r.job, r.batch) for r in found}) == 3


def landed_seconds(spark, folder, orbits):
    """Scenes of one second, each in a file of its own."""
    for orbit in orbits:
        name = NAME.format(5).replace("R083", orbit)
        spark.createDataFrame([("r", name)], "region string, name string").coalesce(1).write.mode("append").parquet(str(folder / "in"))


def start(spark, folder, fail=None):
    scenes = new_scenes.read_landing(spark, str(folder / "in"), schemas.struct({"region": schemas.S, "name": schemas.S}), files_per_batch=1)
    if fail:
        scenes = scenes.withColumn("name", F.when(F.contains("name", F.lit(fail)), F.raise_error(F.lit("broken off"))).otherwise(F.col("name")))
    return new_scenes.stream_new_scenes(scenes, str(folder / "table"), str(folder / "cp"))


def stored_scenes(spark, folder):
    return sorted((r.region, r.name) for r in new_scenes.read_scenes(spark, str(folder / "table")).collect())


@pytest.mark.parametrize("stop", [False, True])
def test_a_broken_run_ends_like_an_unbroken_one(spark, tmp_path, stop):
    orbits = ["R071", "R072", "R073", "R074"]
    for name in ("whole", "broken"):
        (tmp_path / name).mkdir()
        landed_seconds(spark, tmp_path / name, orbits)
    start(spark, tmp_path / "whole").awaitTermination()
    job = start(spark, tmp_path / "broken", fail="R073")
    with pytest.raises(Exception, match="broken off"):
        job.awaitTermination()
    assert 1 <= len(stored_scenes(spark, tmp_path / "broken")) < 4
    again = start(spark, tmp_path / "broken")
    assert again.run == job.run
    again.awaitTermination()
    assert stored_scenes(spark, tmp_path / "broken") == stored_scenes(spark, tmp_path / "whole") and len(stored_scenes(spark, tmp_path / "whole")) == 4
    # That run is over: what comes now is another one's, and the second is known.
    landed_seconds(spark, tmp_path / "broken", ["R075"])
    last = start(spark, tmp_path / "broken")
    if stop:
        last.stop()
        assert start(spark, tmp_path / "broken").run == last.run != job.run
    else:
        last.awaitTermination()
        assert len(stored_scenes(spark, tmp_path / "broken")) == 4 and last.run != job.run


def test_compaction(spark, tmp_path):
    for day in (1, 2):
        for orbit in ("R071", "R072", "R073"):
            spark.createDataFrame([("r", NAME.format(day).replace("R083", orbit))], "region string, name string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    start(spark, tmp_path).awaitTermination()
    before, table, cp = stored_scenes(spark, tmp_path), str(tmp_path / "table"), str(tmp_path / "cp")
    folders = lambda: sorted(str(p.parent.name) for p in (tmp_path / "table").glob("day=2020*/*/*"))
    assert len(before) == 6 and len(folders()) == 6
    # What a job that died before its record has left does not count.
    half = new_scenes.read_scenes(spark, table).where("day = '20200101'").withColumn("job", F.lit("compacted-0"))
    half.write.mode("append").partitionBy("day", "job", "batch").parquet(table)
    assert stored_scenes(spark, tmp_path) == before
    assert new_scenes.compact(spark, table, cp, most=3) == 0
    assert new_scenes.compact(spark, table, cp, most=2) == 2
    assert stored_scenes(spark, tmp_path) == before
    assert len([f for f in folders() if f != "job=compacted-0"]) == 2
    # Known scenes stay known, new ones come in, and a second compaction takes the first one's folders along.
    landed_seconds(spark, tmp_path, ["R079"])
    spark.createDataFrame([("r", NAME.format(1).replace("R083", "R071"))], "region string, name string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    start(spark, tmp_path).awaitTermination()
    assert len(stored_scenes(spark, tmp_path)) == 7
    assert new_scenes.compact(spark, table, cp, most=0) == 3
    assert len(stored_scenes(spark, tmp_path)) == 7


def test_open_runs_are_not_compacted(spark, tmp_path):
    landed_seconds(spark, tmp_path, ["R071", "R072", "R073"])
    with pytest.raises(Exception, match="broken off"):
        start(spark, tmp_path, fail="R073").awaitTermination()
    assert new_scenes.compact(spark, str(tmp_path / "table"), str(tmp_path / "cp"), most=0) == 0
