"""What tables must not grow by: regions that share a tile list, broadcasts of exploded rows, files of a stream."""

import re

from pyspark.sql import functions as F

from rasterloom.functions.grid import Grid
from rasterloom.operators import masks, quality, scenes
from rasterloom.plans import chains
from rasterloom.streaming import new_scenes

NAME = "S2A_MSIL2A_20240105T1200{:02d}_N0200_R001_T{}"


def tiled_regions(spark, lists):
    return spark.createDataFrame([(f"{i:03d}_R", g, 0.001) for i, g in enumerate(lists)], "region string, utm_grid string, area_km2 double")


def test_mosaics_are_merged_and_stored_once_a_tile_list(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(chains, "materialise", lambda df, name: stored.append(df.cache()) or stored[-1])
    regions = tiled_regions(spark, ["22VFP,24WWU"] * 6 + ["24WWU,22VFP"] + ["26XMR"])
    scenes = [(NAME.format(s, t), t) for s in range(5) for t in ("22VFP", "24WWU", "24WWV")]
    value = [(n, t, 0, 0, [None if t == "22VFP" and k == 0 else float(len(t) + k + (t == "24WWU") * 10) for k in range(4)]) for n, t in scenes]
    blocks = spark.createDataFrame(value, "name string, tile string, by int, bx int, value array<double>")
    grid = Grid(0.0, 200.0, 100.0, 2, 2)
    pixels, lineage = chains.mosaic_clip_blocks(blocks, spark.createDataFrame(scenes, "name string, tile string"), regions, grid, grid, 2, 2, 1e4)
    # Five keys and two lists of the same tiles: ten mosaics, for whatever number of regions.
    assert stored[0].count() == 10
    got = {(r.region, r.mosaic_key[-24:], r.iy, r.ix): (r.value, r.sources) for r in pixels.collect()}
    assert len(got) == 7 * 5 * 4 and lineage.count() == 7 * 5
    # The first tile's cell is null, so the second tile's shows; in the region with the other order the second tile is in front.
    for region, cells, tiles in (("000_R", [15.0, 6.0, 7.0, 8.0], ["22VFP", "24WWU"]), ("005_R", [15.0, 6.0, 7.0, 8.0], ["22VFP", "24WWU"]),
                                 ("006_R", [15.0, 16.0, 17.0, 18.0], ["24WWU", "22VFP"])):
        key = NAME.format(3, "")[:37][-24:]
        sources = ",".join(NAME.format(3, t) + "_B08.tif" for t in tiles)
        assert [got[region, key, k // 2, k % 2] for k in range(4)] == [(c, sources) for c in cells]
    plan = pixels._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("posexplode") < plan.index("Join"), "cells are made after the last join"


def joins_on(df, key):
    """The joins of the plan on a key, as Spark names them."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return {word for line in lines for word in line.split() if word.endswith("Join") and f"{word} [{key}#" in line}


def test_cells_of_mask_tiles_are_never_broadcast(spark):
    # Few tiles in storage, which unfold to any number of cells.
    tiles = spark.range(40).select(F.col("id").alias("tile"), (F.col("id") * 100.0).alias("x0"), F.lit(0.0).alias("y0"), (F.col("id") * 100.0 + 300).alias("x1"), F.lit(300.0).alias("y1"))
    cells = tiles.select("tile", "x0", F.explode(F.sequence(F.lit(0), F.lit(8))).alias("k")).select(
        "tile", (F.col("x0") + F.col("k") % 3 * 100 + 50).alias("x"), (F.floor(F.col("k") / 3) * 100.0 + 50).alias("y"),
        (F.col("tile") % 3 == 0).alias("is_ice"), (F.col("k") == 4).alias("is_ocean"))
    regions = spark.createDataFrame([("a", 0.0, 0.0, 1000.0, 300.0), ("b", 900.0, 100.0, 2000.0, 200.0)], "region string, xmin double, ymin double, xmax double, ymax double")
    merged = masks.merge_mask_tiles(cells, tiles, regions, 100.0)
    assert joins_on(merged, "tile") == {"SortMergeJoin"}
    got = {(r.region, r.iy, r.ix): (r.is_ice, r.is_ocean) for r in merged.collect()}
    # The latest of the three tiles over a cell wins: the one that begins there.
    assert got == {(r, iy, ix): ((ix + shift) % 3 == 0, False) for r, shift, h, w in (("a", 0, 3, 10), ("b", 9, 1, 11)) for iy in range(h) for ix in range(w)}


def test_spec_entries_are_never_broadcast_and_issues_are_those_of_the_joins(spark):
    attributes = {"epsg": "3413", "title": "t"}
    rules = spark.createDataFrame(quality.rule_rows(attributes), "variable string, rule string, kind string, expected string")
    units = spark.range(60).select((F.col("id") % 50).alias("unit")).union(spark.createDataFrame([(None,)], "unit long"))
    # Entries unfold from a small table; units 50 to 59 are not asked for, unit 7 has no entries, some entries are twice, null or of no rule.
    listed = F.array(*[F.struct(F.lit(v).alias("variable"), F.lit(r).alias("rule"), F.lit(e).cast("string").alias("expected"))
                       for v, r, _, e in quality.rule_rows(attributes)])
    pick = F.pmod(F.xxhash64("unit", "variable", "rule"), F.lit(40))
    entries = spark.range(60).select(F.col("id").alias("unit"), F.inline(listed)).where((F.col("unit") != 7) & (pick != 3) & ~((F.col("variable") == "crs") & (F.col("unit") % 9 == 4)))
    value = F.when(pick == 5, "odd").when(pick == 6, None).otherwise(F.coalesce("expected", F.when(F.col("unit") % 2 == 0, "x")))
    entries = entries.select("unit", "variable", "rule", value.alias("value"))
    more = spark.createDataFrame([(1, "vx", "dtype", None), (1, "vx", "dtype", "int8"), (2, "vx", None, "z"), (3, "extra", "dtype", "z"), (None, "vx", "dtype", "z"), (1, "", "epsg", None)],
                                 "unit long, variable string, rule string, value string")
    observed = entries.union(entries.where("unit < 5")).union(more)
    found = quality.qa_validate_spec(observed, units, ["unit"], attributes)
    sizes = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "BroadcastHashJoin" in line]
    assert sizes and all("[variable#" in line for line in sizes), "only the rules may be broadcast"

    joined = units.crossJoin(rules).join(observed.select("unit", "variable").distinct().withColumn("known", F.lit(True)), ["unit", "variable"], "left").join(
        observed, ["unit", "variable", "rule"], "left")
    whole = (F.col("variable") != "") & F.col("known").isNull()
    issue = F.when(whole, "missing variable").when((F.col("kind") == "absent") & F.col("value").isNotNull(), "must be absent").when(
        (F.col("kind") != "absent") & F.col("value").isNull(), "missing").when((F.col("kind") == "exact") & (F.col("value") != F.col("expected")), F.concat(F.lit("got "), "value"))
    expected = joined.select("unit", "variable", F.when(whole, "").otherwise(F.col("rule")).alias("rule"), issue.alias("issue")).where("issue IS NOT NULL").distinct()
    a, b = sorted(map(str, found.collect())), sorted(map(str, expected.collect()))
    assert a == b and {i.issue.split()[0] for i in expected.collect()} == {"missing", "must", "got"}


def test_rows_of_one_landed_file_are_spread_over_tasks(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/landing")
    seen = []
    rows = new_scenes.read_landing(spark, f"{tmp_path}/landing", "id long", files_per_batch=1)
    rows.writeStream.foreachBatch(lambda batch, _: seen.append(sorted(r[1] for r in batch.groupBy(F.spark_partition_id()).count().collect()))).option(
        "checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 1 and sum(seen[0]) == 1000 and len(seen[0]) > 1


def test_lineage_is_made_once_a_tile_list(spark):
    listed = scenes.tile_priority(tiled_regions(spark, ["22VFP,24WWU"] * 6 + ["24WWU,22VFP"]))
    rows = [(NAME.format(s, t), t) for s in range(5) for t in ("22VFP", "24WWU")] * 2
    named = spark.createDataFrame(rows, "name string, tile string")
    assert scenes.list_lineage(named, scenes.tile_lists(listed)[1]).count() == 10
    whole = scenes.mosaic_lineage(named, listed)
    got = {(r.region, r.mosaic_key): (r.sources, r.n_sources) for r in whole.collect()}
    order = lambda region: ("24WWU", "22VFP") if region == "006_R" else ("22VFP", "24WWU")
    assert got == {(f"{i:03d}_R", NAME.format(s, "")[:37]): (",".join(NAME.format(s, t) + "_B08.tif" for t in order(f"{i:03d}_R")), 2) for i in range(7) for s in range(5)}


def test_funnel_tells_keys_apart_once_a_tile_list(spark):
    listed = scenes.tile_priority(tiled_regions(spark, ["22VFP,24WWU"] * 3 + ["24WWU,22VFP", "24WWV", "26XMR"]))
    listed = listed.union(listed.where("region = '002_R'"))  # a region that is given twice counts its scenes twice
    # Five keys on two tiles, one image of them twice; the third tile has three keys of its own.
    rows = [(NAME.format(s, t), t) for s in range(5) for t in ("22VFP", "24WWU")] + [(NAME.format(0, "22VFP"), "22VFP")]
    rows += [(NAME.format(s, "24WWV"), "24WWV") for s in (3, 8, 9)]
    named = spark.createDataFrame(rows, "name string, tile string")
    found = scenes.funnel_counts(named, listed, named.where("name LIKE '%T120003%' OR name LIKE '%T120004%'"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(list#" in plan and not re.search(r"hashpartitioning\(region#\d+, mosaic_key#", plan)
    got = {r.region: (r.n_in_tile, r.n_unique, r.n_remaining) for r in found.collect()}
    assert got == {"000_R": (11, 5, 3), "001_R": (11, 5, 3), "002_R": (22, 5, 3), "003_R": (11, 5, 3), "004_R": (3, 3, 2)}


def test_tile_selection_groups_scenes_once_a_tile_list(spark):
    regions = tiled_regions(spark, ["22VFP,24WWU"] * 3 + ["24WWU,22VFP", "26XMR"])
    rows = [(NAME.format(s, t),) for s in range(5) for t in ("22VFP", "24WWU")] * 2
    # What one region has stored is still to be made for the others, those with its tile list too.
    done = spark.createDataFrame([("001_R", NAME.format(4, "")[:37])], "region string, mosaic_key string")
    found = chains.tile_scene_selection(spark.createDataFrame(rows, "name string"), regions, done, "20240101", "20240131")
    aggregates = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Aggregate(" in line and "mosaic_key#" in line]
    assert any("keys=[list#" in line or "key=[list#" in line for line in aggregates) and not any("[region#" in line for line in aggregates)
    got = {(r.region, r.mosaic_key): r.n_scenes for r in found.collect()}
    assert got == {(f"{i:03d}_R", NAME.format(s, "")[:37]): 2 for i in range(4) for s in range(5) if (i, s) != (1, 4)}
