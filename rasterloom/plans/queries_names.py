"""Queries on names, dates, pairs and scene tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rasterloom.functions import names, temporal
from rasterloom.operators import pairs as pair_ops, regions as region_ops, scenes as scene_ops
from rasterloom.plans import fixtures as fx
from rasterloom.plans.registry import query
from rasterloom.sources import sinks, text
from rasterloom.session import scratch_dir

FMT = "yyyy-MM-dd HH:mm:ss"
START, END = "20240105", "20240120"


def show(ts):
    """Times travel to the check as text."""
    return F.date_format(ts, FMT)


def orbits(spark, d):
    return fx.orbits(spark, d)


def dated_pairs(spark, d):
    return pair_ops.parse_pair_dates(fx.pairs(spark, d))


def known_orbits(spark, d):
    return fx.orbits(spark, d).select("region", "datetime", "datehour", "satellite", "orbits", "processing_baselines")


def pair_table(spark, d):
    joined = pair_ops.join_pair_orbits(dated_pairs(spark, d), known_orbits(spark, d))
    return pair_ops.orbit_pair_label(pair_ops.pair_temporal(joined))


@query("parse_scene_name", "SELECT name, satellite, datetime, datehour, orbits, processing_baselines FROM scene_cols", ["scene_cols"])
def _(spark, d):
    return pair_ops.parse_scene_names(fx.scenes(spark, d).select("name"))


@query("mosaic_key", "SELECT name, left(name, 37) AS mosaic_key FROM scenes", ["scenes"])
def _(spark, d):
    return scene_ops.add_mosaic_key(fx.scenes(spark, d).select("name"))


@query("tile_and_zone", "SELECT name, tile, left(tile, 2) AS zone FROM scenes", ["scenes"])
def _(spark, d):
    return scene_ops.add_tile_and_zone(fx.scenes(spark, d).select("name"))


@query("tile_priority", "SELECT region, tile, CAST(rank AS INTEGER) AS rank FROM tiles", ["tiles"])
def _(spark, d):
    return scene_ops.tile_priority(fx.regions(spark, d))


@query("parse_pair_dates", """
    SELECT id, dh1 AS datehr1, dh2 AS datehr2, strftime(date_trunc('hour', ts1), '%Y-%m-%d %H:%M:%S') AS date1,
           strftime(date_trunc('hour', ts2), '%Y-%m-%d %H:%M:%S') AS date2 FROM pairs""", ["pairs"])
def _(spark, d):
    return dated_pairs(spark, d).select("id", "datehr1", "datehr2", show("date1").alias("date1"), show("date2").alias("date2"))


def landsat_pairs(spark, d):
    p = fx.pairs(spark, d)
    stamp = "yyyyMMddHHmmss"
    return p.select("region", F.concat_ws("_", F.lit("L8"), F.date_format("ts1", stamp), F.date_format("ts2", stamp)).alias("id"))


@query("parse_landsat_dates", """
    SELECT 'L8_' || strftime(ts1, '%Y%m%d%H%M%S') || '_' || strftime(ts2, '%Y%m%d%H%M%S') AS id,
           strftime(ts1, '%Y-%m-%d %H:%M:%S') AS date1, strftime(ts2, '%Y-%m-%d %H:%M:%S') AS date2 FROM pairs""", ["pairs"])
def _(spark, d):
    return pair_ops.parse_landsat_dates(landsat_pairs(spark, d)).select("id", show("date1").alias("date1"), show("date2").alias("date2"))


# Three generations of ids, by event type.
LANDSAT_ID_SQL = """
    SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN
             '20200101000000_LC8' || lpad(CAST(user_id AS VARCHAR), 6, '0') || '2020001LGN00_LC08_L1TP_'
             || lpad(CAST(user_id AS VARCHAR), 6, '0') || '_20200101_20200114_0' || (1 + user_id % 2) || '_T' || (1 + user_id % 2) || '_ortho'
           WHEN event_type = 'error' THEN '20200101000000_AST_' || event_id
           ELSE '20200101000000_LC' || (7 + user_id % 2) || lpad(CAST(user_id AS VARCHAR), 6, '0') || '2020001LGN00_ortho' END AS name
    FROM events"""


def landsat_ids(spark, d):
    user, path_row = F.col("user_id"), F.lpad(F.col("user_id").cast("string"), 6, "0")
    tier = (1 + user % 2).cast("string")
    kind = F.col("event_type")
    current = F.concat(F.lit("20200101000000_LC8"), path_row, F.lit("2020001LGN00_LC08_L1TP_"), path_row,
                       F.lit("_20200101_20200114_0"), tier, F.lit("_T"), tier, F.lit("_ortho"))
    aster = F.concat(F.lit("20200101000000_AST_"), F.col("event_id").cast("string"))
    early = F.concat(F.lit("20200101000000_LC"), (7 + user % 2).cast("string"), path_row, F.lit("2020001LGN00_ortho"))
    return fx.table(spark, d, "events").select(
        "event_id", F.when(kind.isin("view", "click"), current).when(kind == "error", aster).otherwise(early).alias("name"))


PARSED_ID_SQL = f"""
    SELECT event_id, CASE WHEN length(name) > 80 THEN substr(name, 38, 4) WHEN substr(name, 16, 3) = 'AST' THEN 'AST'
                     ELSE 'LC0' || substr(name, 18, 1) END AS satellite,
           CASE WHEN length(name) > 80 THEN substr(name, 48, 6) WHEN substr(name, 16, 3) = 'AST' THEN 'AST' ELSE substr(name, 19, 6) END AS path_row,
           CASE WHEN length(name) > 80 THEN 'C' || substr(name, 73, 2) || '_' || substr(name, 76, 2) || '_' || substr(name, 43, 4)
                WHEN substr(name, 16, 3) = 'AST' THEN 'AST' ELSE 'Pre Collection-1' END AS baseline
    FROM ({LANDSAT_ID_SQL})"""


@query("parse_landsat_id", PARSED_ID_SQL)
def _(spark, d):
    return landsat_ids(spark, d).select("event_id", *names.landsat_id_columns(F.col("name")))


@query("drop_aster_pairs", f"""
    WITH ids AS ({PARSED_ID_SQL})
    SELECT a.event_id, a.satellite AS satellite1, b.satellite AS satellite2
    FROM ids a JOIN ids b ON b.event_id = a.event_id + 97 WHERE a.satellite <> 'AST' AND b.satellite <> 'AST'""")
def _(spark, d):
    ids = landsat_ids(spark, d)
    first = ids.select("event_id", *names.landsat_id_columns(F.col("name"), "1"))
    second = ids.select((F.col("event_id") - 97).alias("event_id"), *names.landsat_id_columns(F.col("name"), "2"))
    return pair_ops.drop_aster_pairs(first.join(second, "event_id")).select("event_id", "satellite1", "satellite2")


TEMPORAL_SQL = """
    SELECT event_id, (epoch_us({a}) - epoch_us({b})) / 86400000000.0 AS day_sep, CAST(year(ts1) AS INTEGER) AS year,
           CAST((epoch_us(ts1) + epoch_us(ts2)) // 2 AS BIGINT) AS midpoint_us,
           (epoch_us(ts2) - epoch_us(ts1)) / 86400000000.0 AS baseline{more} FROM pairs"""
HALF = """,
           (epoch_us(ts2) - (epoch_us(ts1) + epoch_us(ts2)) // 2) / 86400000000.0 AS halfbaseline"""


@query("pair_temporal", TEMPORAL_SQL.format(a="ts1", b="ts2", more=HALF), ["pairs"])
def _(spark, d):
    timed = pair_ops.pair_temporal(fx.pairs(spark, d), "ts1", "ts2", "ts1")
    return timed.select("event_id", "day_sep", "year", F.unix_micros("midpoint").alias("midpoint_us"), "baseline", "halfbaseline")


@query("pair_temporal_landsat", TEMPORAL_SQL.format(a="ts2", b="ts1", more=""), ["pairs"])
def _(spark, d):
    timed = pair_ops.pair_temporal_landsat(fx.pairs(spark, d), "ts1", "ts2")
    return timed.select("event_id", "day_sep", "year", F.unix_micros("midpoint").alias("midpoint_us"), "baseline")


@query("field_ids", """
    SELECT event_id, 'S2_' || region || '_' || dt1 || '_' || dt2 AS s2_id, region || '_' || dt1 || '_' || dt2 || '_S2' AS cube_s2_id,
           region || '_' || dt1 || '_' || dt2 || '_L8' AS cube_l8_id FROM pairs""", ["pairs"])
def _(spark, d):
    r, a, b = F.col("region"), F.col("ts1"), F.col("ts2")
    return fx.pairs(spark, d).select(
        "event_id", pair_ops.sentinel_field_id(r, a, b).alias("s2_id"),
        *[pair_ops.cube_field_id(r, a, b, F.lit(s)).alias(f"cube_{s.lower()}_id") for s in ("S2", "L8")])


@query("season_flag", """
    SELECT l_orderkey, l_linenumber, list_bool_or(list_transform(range(0, 1 + 12 * (year(d2) - year(d1)) + month(d2) - month(d1)
             - CASE WHEN d1 + to_months(CAST(12 * (year(d2) - year(d1)) + month(d2) - month(d1) AS INTEGER)) > d2 THEN 1 ELSE 0 END),
             lambda k: month(d1 + to_months(CAST(k AS INTEGER))) BETWEEN 5 AND 9)) AS in_season
    FROM (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS d1,
                 CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) * 3 AS d2 FROM lineitem)""")
def _(spark, d):
    line = fx.table(spark, d, "lineitem").withColumn("d1", F.col("l_shipdate").cast("date"))
    line = line.withColumn("d2", F.date_add("d1", F.col("l_quantity").cast("int") * 3))
    return line.select("l_orderkey", "l_linenumber", temporal.season_flag(F.col("d1"), F.col("d2")).alias("in_season"))


@query("filter_scene_dates", f"""
    SELECT name, datetime FROM scene_cols WHERE left(datetime, 8) > '{START}' AND left(datetime, 8) < '{END}'""", ["scene_cols"])
def _(spark, d):
    return pair_ops.filter_scene_dates(orbits(spark, d), START, END).select("name", "datetime")


@query("filter_orbit_dates", f"SELECT name, datetime FROM scene_cols WHERE datetime >= '{START}' AND datetime <= '{END}'", ["scene_cols"])
def _(spark, d):
    return pair_ops.filter_orbit_dates(orbits(spark, d), START, END).select("name", "datetime")


@query("filter_pair_dates", """
    SELECT event_id, id FROM pairs WHERE date_trunc('hour', ts1) >= TIMESTAMP '2024-01-05' AND date_trunc('hour', ts2) <= TIMESTAMP '2024-01-20'""", ["pairs"])
def _(spark, d):
    return pair_ops.filter_pair_dates(dated_pairs(spark, d), "2024-01-05", "2024-01-20").select("event_id", "id")


@query("filter_pair_years", """
    SELECT field_id FROM cube WHERE year(scene_1_datetime) BETWEEN 1996 AND 1999 AND year(scene_2_datetime) BETWEEN 1996 AND 1999""", ["cube"])
def _(spark, d):
    return pair_ops.filter_pair_years(fx.cube(spark, d), 1996, 1999, "scene_1_datetime", "scene_2_datetime").select("field_id")


@query("order_scenes", "SELECT name FROM scenes", ["scenes"])
def _(spark, d):
    return scene_ops.order_scenes(fx.scenes(spark, d).select("name"))


@query("distinct_keys", "SELECT DISTINCT left(name, 37) AS mosaic_key, left(tile, 2) AS zone, CAST(year(ts) AS INTEGER) AS year FROM scenes", ["scenes"])
def _(spark, d):
    keyed = scene_ops.add_tile_and_zone(scene_ops.add_mosaic_key(fx.scenes(spark, d))).withColumn("year", F.year("ts"))
    return scene_ops.distinct_keys(keyed, "mosaic_key", "zone", "year")


@query("dedupe_last_per_hour", """
    SELECT region, datehour, datetime, satellite, orbits, processing_baselines FROM orbit_hours""", ["orbit_hours"])
def _(spark, d):
    return pair_ops.dedupe_last_per_hour(known_orbits(spark, d))


JOINED_SQL = """
    SELECT p.region, p.event_id, p.id, a.datetime AS datetime_1, b.datetime AS datetime_2, a.orbits AS orbit1, b.orbits AS orbit2,
           a.processing_baselines AS processingbaseline1, b.processing_baselines AS processingbaseline2, a.ts AS t1, b.ts AS t2
    FROM pairs p JOIN orbit_hours a ON a.region = p.region AND a.datehour = p.dh1
    JOIN orbit_hours b ON b.region = p.region AND b.datehour = p.dh2"""


@query("join_pair_orbits", f"SELECT * EXCLUDE (region, t1, t2) FROM ({JOINED_SQL})", ["pairs", "orbit_hours"])
def _(spark, d):
    joined = pair_ops.join_pair_orbits(dated_pairs(spark, d), known_orbits(spark, d))
    stamp = "yyyyMMdd'T'HHmmss"
    return joined.select(
        "event_id", "id", *[F.date_format(c, stamp).alias(c) for c in ("datetime_1", "datetime_2")],
        "orbit1", "orbit2", "processingbaseline1", "processingbaseline2")


PAIR_TABLE_SQL = f"""
    SELECT id, (epoch_us(s1) - epoch_us(s2)) / 86400000000.0 AS day_sep, CAST(2024 AS INTEGER) AS year,
           (epoch_us(s2) - epoch_us(s1)) / 86400000000.0 AS baseline, orbit1, orbit2, processingbaseline1, processingbaseline2,
           'R' || CAST(orbit1 AS INTEGER) || '_R' || CAST(orbit2 AS INTEGER) AS orbit_pair,
           CASE WHEN orbit1 = orbit2 THEN 1 ELSE 0 END AS orbit_match, region
    FROM (SELECT *, date_trunc('second', t1) AS s1, date_trunc('second', t2) AS s2 FROM ({JOINED_SQL}))"""
PAIR_COLUMNS = ("id", "day_sep", "year", "baseline", "orbit1", "orbit2", "processingbaseline1",
                "processingbaseline2", "orbit_pair", "orbit_match", "region")


@query("sink_pair_table", PAIR_TABLE_SQL, ["pairs", "orbit_hours"])
def _(spark, d):
    out = scratch_dir(spark, "pair-table")
    sinks.sink_by_region(pair_table(spark, d), out)
    return spark.read.parquet(out).select(*PAIR_COLUMNS)


@query("sink_orbit_table", "SELECT region, datetime, datehour, satellite, orbits, processing_baselines FROM scene_cols", ["scene_cols"])
def _(spark, d):
    out = scratch_dir(spark, "orbit-table")
    sinks.sink_by_region(known_orbits(spark, d), out, order=["datetime"])
    return spark.read.parquet(out).select("region", "datetime", "datehour", "satellite", "orbits", "processing_baselines")


@query("filter_tiles", """
    SELECT s.event_id, s.name FROM scenes s WHERE s.tile IN (SELECT tile FROM tiles JOIN reg USING (region) WHERE area_km2 < 300)""", ["scenes", "tiles"])
def _(spark, d):
    small = fx.regions(spark, d).where("area_km2 < 300")
    return scene_ops.filter_tiles(fx.scenes(spark, d), scene_ops.tile_priority(small), ["tile"]).select("event_id", "name")


@query("shared_tiles", """
    SELECT tile, name, n_regions FROM (SELECT DISTINCT tile, name FROM scenes)
    JOIN (SELECT tile, count(DISTINCT region) AS n_regions FROM tiles GROUP BY ALL) USING (tile)""", ["scenes", "tiles"])
def _(spark, d):
    return scene_ops.shared_tiles(fx.scenes(spark, d), scene_ops.tile_priority(fx.regions(spark, d)))


LINEAGE_SQL = """
    SELECT region, mosaic_key, string_agg(name || '_B08.tif', ',' ORDER BY rank, name) AS sources, count(*) AS n_sources
    FROM (SELECT DISTINCT t.region, left(s.name, 37) AS mosaic_key, t.rank, s.name FROM scenes s JOIN tiles t ON t.tile = s.tile)
    GROUP BY ALL"""


@query("mosaic_lineage", LINEAGE_SQL, ["scenes", "tiles"])
def _(spark, d):
    return scene_ops.mosaic_lineage(fx.scenes(spark, d), scene_ops.tile_priority(fx.regions(spark, d)))


@query("sink_lineage", f"SELECT region, mosaic_key, sources FROM ({LINEAGE_SQL})", ["scenes", "tiles"])
def _(spark, d):
    out = scratch_dir(spark, "lineage")
    lineage = scene_ops.mosaic_lineage(fx.scenes(spark, d), scene_ops.tile_priority(fx.regions(spark, d)))
    sinks.sink_lineage(lineage, out)
    return spark.read.parquet(out).select("region", "mosaic_key", "sources")


@query("skip_processed", """
    SELECT event_id, name FROM scenes WHERE left(name, 37) NOT IN (SELECT left(name, 37) FROM scenes WHERE is_done)""", ["scenes"])
def _(spark, d):
    todo = scene_ops.add_mosaic_key(fx.scenes(spark, d))
    return scene_ops.skip_processed(todo, scene_ops.add_mosaic_key(fx.done(spark, d))).select("event_id", "name")


@query("difference_processed", """
    SELECT left(name, 37) AS mosaic_key FROM scenes EXCEPT SELECT left(name, 37) FROM scenes WHERE is_done""", ["scenes"])
def _(spark, d):
    keys = scene_ops.add_mosaic_key(fx.scenes(spark, d)).select("mosaic_key")
    return scene_ops.difference_processed(keys, scene_ops.add_mosaic_key(fx.done(spark, d)).select("mosaic_key"))


@query("funnel_counts", """
    SELECT region, CAST(sum(n) AS BIGINT) AS n_in_tile, count(*) AS n_unique, count(*) FILTER (NOT fin) AS n_remaining
    FROM (SELECT t.region, left(s.name, 37) AS k, count(*) AS n,
                 left(s.name, 37) IN (SELECT left(name, 37) FROM scenes WHERE is_done) AS fin
          FROM scenes s JOIN tiles t ON t.tile = s.tile GROUP BY ALL) GROUP BY ALL""", ["scenes", "tiles"])
def _(spark, d):
    return scene_ops.funnel_counts(fx.scenes(spark, d), scene_ops.tile_priority(fx.regions(spark, d)), fx.done(spark, d))


# A folder tree with one folder per region, some of them helpers and some still empty.
LISTING_SQL = """
    SELECT '/data/out/' || CASE WHEN event_type = 'error' AND value > 90 THEN '_reference'
             WHEN event_type = 'error' AND value > 60 THEN 'slurm_jobs'
             ELSE lpad(CAST(user_id % 30 AS VARCHAR), 3, '0') || '_NATION_' || (user_id % 30) END
           || CASE WHEN event_type = 'view' THEN '/metadata/' ELSE '/clipped/' END || name || '.tif' AS path
    FROM (SELECT e.event_type, e.value, e.user_id, s.name FROM events e JOIN scenes s ON s.event_id = e.event_id)"""


def listing(spark, d):
    kind, user = F.col("event_type"), F.col("user_id") % 30
    folder = (
        F.when((kind == "error") & (F.col("value") > 90), "_reference")
        .when((kind == "error") & (F.col("value") > 60), "slurm_jobs")
        .otherwise(F.concat(F.lpad(user.cast("string"), 3, "0"), F.lit("_NATION_"), user.cast("string")))
    )
    level = F.when(kind == "view", "/metadata/").otherwise("/clipped/")
    events = fx.table(spark, d, "events").select("event_id", F.concat(F.lit("/data/out/"), folder, level).alias("head"))
    joined = events.join(fx.scenes(spark, d).select("event_id", "name"), "event_id")
    return joined.select(F.concat("head", "name", F.lit(".tif")).alias("path"))


@query("scan_scene_listing", f"""
    SELECT split_part(path, '/', 4) AS region, replace(split_part(path, '/', 6), '.tif', '') AS name
    FROM ({LISTING_SQL}) WHERE path LIKE '%/clipped/%'""", ["scenes"])
def _(spark, d):
    return text.scan_scene_listing(listing(spark, d))


@query("scan_regions_present", f"""
    SELECT DISTINCT split_part(path, '/', 4) AS region FROM ({LISTING_SQL})
    WHERE split_part(path, '/', 4) NOT LIKE '\\_%' ESCAPE '\\' AND split_part(path, '/', 4) <> 'slurm_jobs'""", ["scenes"])
def _(spark, d):
    return text.scan_regions_present(listing(spark, d), "/data/out")


READY_SQL = f"""
    WITH folders AS (SELECT split_part(path, '/', 4) AS region, count(*) FILTER (path LIKE '%/clipped/%') AS n_clipped
                     FROM ({LISTING_SQL}) GROUP BY ALL)
    SELECT region, 'ready' AS state FROM reg WHERE region IN (SELECT region FROM folders WHERE n_clipped > 0)
    UNION ALL SELECT region, 'excluded' FROM folders WHERE n_clipped = 0 AND regexp_matches(region, '^[0-9]{{3}}_')"""


@query("filter_ready_regions", READY_SQL, ["scenes", "reg"])
def _(spark, d):
    folders = listing(spark, d).groupBy(F.get(F.split("path", "/"), F.lit(3)).alias("region")).agg(
        F.count_if(F.contains("path", F.lit("/clipped/"))).alias("n_clipped"))
    ready, excluded = region_ops.filter_ready_regions(fx.regions(spark, d), folders)
    return ready.select("region", F.lit("ready").alias("state")).union(
        excluded.select("region", F.lit("excluded").alias("state")))


@query("scan_good_lists", """
    SELECT 'pair_' || o_orderkey AS id, '/vel/pair_' || o_orderkey AS dir FROM orders WHERE o_orderstatus = 'F'""")
def _(spark, d):
    row = F.concat_ws("\t", F.concat(F.lit("pair_"), F.col("o_orderkey").cast("string")),
                      F.col("o_totalprice").cast("string"), F.lit("0.5"))
    # Orders that are not finished stand for blank lines.
    lines = fx.table(spark, d, "orders").select(F.when(F.col("o_orderstatus") == "F", row).otherwise("").alias("line"))
    return text.parse_good_lines(lines, "/vel")


@query("scan_pair_meta_text", """
    SELECT doc_id, string_agg(regexp_extract(line, '([^/]*)$', 1), ',' ORDER BY pos) AS ids
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
         LATERAL (SELECT 'Image' || pos || '=/scenes/' || md5(raw) || '.tif' AS line)
    WHERE length(raw) >= 40 GROUP BY ALL""")
def _(spark, d):
    # Long lines of each document become image lines, short ones stay noise.
    lines = F.transform(F.split("text", "\n"), lambda s, i: F.when(
        F.length(s) >= 40, F.concat(F.lit("Image"), (i + 1).cast("string"), F.lit("=/scenes/"), F.md5(s), F.lit(".tif"))
    ).otherwise(F.concat(F.lit("#"), s)))
    files = fx.table(spark, d, "documents").select("doc_id", F.array_join(lines, "\n").alias("text"))
    parsed = text.scan_pair_meta_text(files).where(F.size("ids") > 0)
    return parsed.select("doc_id", F.array_join("ids", ",").alias("ids"))
