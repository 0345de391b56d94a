"""Input tables of the operators, derived from the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rasterloom.functions import names
from rasterloom.operators.blocks import cleaned
from rasterloom.operators.pairs import orbit_pair_label
from rasterloom.sources.pixels import scan_pixels, scan_vector_pixels

# Grid of a velocity field: 8 rows of 4 cells, dx in the first half of the vector, dy in the second.
WIDTH, HEIGHT = 4, 8
HALF = WIDTH * HEIGHT
NODATA = (0.0, -9999.0)


# Declared columns of the given tables, so that no read has to look into a file first.
TABLES = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, "
              "o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
                "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
}


def table(spark, d, name):
    """A given table."""
    return spark.read.schema(TABLES[name]).parquet(f"{d}/{name}.parquet")


def _site(field_id):
    return F.concat(F.lit("00"), (field_id % 4).cast("string"), F.lit("_Site"))


def fields(spark, d):
    """One row per velocity field: orbits and time between its scenes."""
    v, label = F.col("vec_id"), F.col("label")
    second = F.when(v % 50 == 7, (label + 5) % 10).when(v % 2 == 0, label).otherwise((label + 1) % 10)
    e = table(spark, d, "embeddings").select(
        v.alias("field_id"), _site(v).alias("region"), label.cast("int").alias("orbit1"),
        second.cast("int").alias("orbit2"), (-(1 + v % 10)).cast("double").alias("day_sep"),
    )
    return orbit_pair_label(e)


def field_times(spark, d):
    """The pair table behind the fields: scene times, orbits, versions."""
    v = F.col("field_id")
    start = F.unix_micros(F.lit("2020-01-01 00:00:00").cast("timestamp")) + v * 3_600_000_000
    days = (1 + v % 10) * 86_400_000_000
    return fields(spark, d).select(
        "*", F.timestamp_micros(start).alias("datetime_1"), F.timestamp_micros(start + days).alias("datetime_2"),
        F.timestamp_micros((start + days / 2).cast("bigint")).alias("midpoint"), (-F.col("day_sep")).alias("baseline"),
        F.when(v % 3 == 0, "S2A").otherwise("S2B").alias("satellite1"),
        F.when(v % 5 == 0, "S2A").otherwise("S2B").alias("satellite2"), F.lit("MSIL2A").alias("source_product"),
        F.concat(F.lit("02"), F.lpad((v % 15).cast("string"), 2, "0")).alias("processingbaseline1"),
        F.lit("0214").alias("processingbaseline2"),
    )


def _raw(spark, d):
    cells = F.transform(
        "embedding",
        lambda x: F.when(F.abs(x) < 0.004, F.lit(-9999.0)).otherwise(F.round(x.cast("double") * 10, 6)),
    )
    return table(spark, d, "embeddings").select(
        _site(F.col("vec_id")).alias("region"), F.col("vec_id").alias("field_id"), cells.alias("cells")
    )


def chunks(spark, d):
    """Storage form: one array per field and component, nodata still coded."""
    halves = F.array(
        F.struct(F.lit("dx").alias("component"), F.slice("cells", 1, HALF).alias("values")),
        F.struct(F.lit("dy").alias("component"), F.slice("cells", HALF + 1, HALF).alias("values")),
    )
    return _raw(spark, d).select("region", "field_id", F.inline(halves)).withColumns(
        {"chunk_y": F.lit(0), "chunk_x": F.lit(0)}
    )


def blocks(spark, d):
    """The same without codes for nodata, as one block per field and component."""
    return cleaned(chunks(spark, d), NODATA, ["values"]).withColumnsRenamed({"chunk_y": "by", "chunk_x": "bx", "values": "value"})


def field_blocks(spark, d):
    """One block per field with both components."""
    raw = _raw(spark, d).select(
        "region", "field_id", F.lit(0).alias("by"), F.lit(0).alias("bx"), F.slice("cells", 1, HALF).alias("dx"), F.slice("cells", HALF + 1, HALF).alias("dy"))
    return cleaned(raw, NODATA, ["dx", "dy"])


def px(spark, d):
    return scan_pixels(chunks(spark, d), WIDTH, HEIGHT, NODATA)


def px_wide(spark, d):
    wide = _raw(spark, d).select(
        "region", "field_id", F.slice("cells", 1, HALF).alias("dx"),
        F.slice("cells", HALF + 1, HALF).alias("dy"), F.lit(0).alias("chunk_y"), F.lit(0).alias("chunk_x"),
    )
    return scan_vector_pixels(wide, WIDTH, HEIGHT, NODATA, ["dx", "dy"])


def masks(spark, d):
    """Ice and ocean flags of every region's cells."""
    grid = (
        fields(spark, d).select("region").distinct()
        .select("region", F.explode(F.sequence(F.lit(0), F.lit(HEIGHT - 1))).alias("iy"))
        .select("region", "iy", F.explode(F.sequence(F.lit(0), F.lit(WIDTH - 1))).alias("ix"))
    )
    return grid.select(
        "region", "iy", "ix",
        ((F.col("iy") + F.col("ix")) % 3 != 0).alias("is_ice"),
        ((F.col("ix") == 0) & (F.col("iy") < 2)).alias("is_ocean"),
    )


def scenes(spark, d):
    return name_scenes(table(spark, d, "events"))


def name_scenes(events):
    """Scene names from events, which may be a stream."""
    user = F.col("user_id")
    tile = (
        F.when(F.col("event_type") == "view", "22VFP").when(F.col("event_type") == "click", "24WWU")
        .when(F.col("event_type") == "error", "24WWV").when(F.col("event_type") == "signup", "26XMR")
        .otherwise("25WDS")
    )
    name = F.concat(
        F.lit("S2"), F.when(user % 2 == 0, "A").otherwise("B"), F.lit("_MSIL2A_"),
        F.date_format("ts", "yyyyMMdd'T'HHmmss"), F.lit("_N0"), (200 + user % 5).cast("string"),
        F.lit("_R"), F.lpad((1 + user % 143).cast("string"), 3, "0"), F.lit("_T"), tile,
    )
    return events.select(
        "event_id", "ts", tile.alias("tile"), name.alias("name"),
        ((F.col("event_type") == "purchase") | (F.col("value") < 10)).alias("is_done"),
    )


def done(spark, d):
    return scenes(spark, d).where("is_done")


def orbits(spark, d):
    s = scenes(spark, d)
    return s.select(F.col("tile").alias("region"), "event_id", "ts", "name",
                    *names.scene_name_columns(F.col("name")))


def pairs(spark, d):
    """Scene n with scene n + 97."""
    s = orbits(spark, d)
    second = s.select(
        (F.col("event_id") - 97).alias("event_id"), F.col("ts").alias("ts2"), F.col("name").alias("scene2"),
        F.col("satellite").alias("sat2"), F.col("datehour").alias("dh2"),
    )
    return s.join(second, "event_id").select(
        "region", "event_id", F.col("ts").alias("ts1"), "ts2", F.col("name").alias("scene1"), "scene2",
        F.concat_ws("_", F.lit("vmap"), "satellite", F.lit("MSIL2A"), "datehour",
                    "sat2", F.lit("MSIL2A"), "dh2").alias("id"),
    )


def regions(spark, d):
    k = F.col("n_nationkey")
    row = F.floor(k / 5)
    tiles = F.when(k % 3 == 0, "22VFP,24WWU").when(k % 3 == 1, "24WWV").otherwise("26XMR,25WDS")
    return table(spark, d, "nation").select(
        F.concat_ws("_", F.lpad(k.cast("string"), 3, "0"), "n_name").alias("region"), k.alias("k"),
        (100.0 * (k + 1)).alias("area_km2"), ((k % 5) * 3000.0).alias("xmin"), (row * 3000.0).alias("ymin"),
        ((k % 5) * 3000.0 + 3000.0 + 300.0 * (k % 4)).alias("xmax"), (row * 3000.0 + 3000.0).alias("ymax"),
        tiles.alias("utm_grid"), F.lit("EPSG:3413").alias("crs"),
    )


def footprints(spark, d):
    c = F.col("c_custkey")
    x0, y0 = (c % 50) * 300.0 - 600.0, (F.floor(c / 50) % 50) * 300.0 - 600.0
    return table(spark, d, "customer").select(
        c.alias("scene_no"), x0.alias("x0"), y0.alias("y0"),
        (x0 + 1500.0 + (c % 7) * 300.0).alias("x1"), (y0 + 1500.0).alias("y1"),
    )


def catalog(spark, d):
    i = F.col("event_id")
    platform = F.lit("LANDSAT_2")
    for rest, number in enumerate((1, 3, 4, 5, 7, 8, 9)):
        platform = F.when(i % 8 == rest, f"LANDSAT_{number}").otherwise(platform)
    return table(spark, d, "events").select(
        "event_id", "ts", "user_id", "value",
        F.get_json_object("props", "$.k").cast("double").alias("cloud_cover"), platform.alias("platform"),
        F.when(i % 3 == 0, "MSS").otherwise("TM").alias("instrument"),
        F.lpad(F.col("user_id").cast("string"), 6, "0").alias("path_row"),
        F.concat(F.lit("SC"), i.cast("string")).alias("scene_id"),
        F.concat(F.lit("item-"), i.cast("string")).alias("id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("datetime"),
    )


def polygons(spark, d):
    """Footprints in degrees as a catalogue has them: closed rings around the regions of ``polar_regions``."""
    c = F.col("c_custkey")
    lon, lat = -50.0 + (c % 40) * 0.25, 66.0 + (F.floor(c / 40) % 40) * 0.1
    corner = lambda x, y: F.array(lon + x, lat + y)
    ring = F.array(corner(0.0, 0.0), corner(2.5, 0.2), corner(2.7, 1.1), corner(-0.2, 0.9), corner(0.0, 0.0))
    return table(spark, d, "customer").select(c.alias("scene_no"), F.array(ring).alias("coordinates"))


def polar_regions(spark, d):
    """Regions of 60 to 84 km on the polar grid."""
    k = F.col("k")
    x, y = -250000.0 + (k % 5) * 100000.0, -2650000.0 + F.floor(k / 5) * 100000.0
    size = 60000.0 + 6000.0 * (k % 5)
    return regions(spark, d).withColumns({"xmin": x, "ymin": y, "xmax": x + size, "ymax": y + size})


def stack(spark, d):
    """Large stack: one row per field and cell observation."""
    key = F.col("l_orderkey")
    return table(spark, d, "lineitem").select(
        key.alias("field_id"), (F.col("l_suppkey") % 10).cast("int").alias("iy"),
        (F.col("l_partkey") % 20).cast("int").alias("ix"),
        F.round(F.col("l_discount") * 10 - 0.5, 6).alias("dx"), F.round(F.col("l_tax") * 10 - 0.4, 6).alias("dy"),
        F.col("l_shipdate").cast("date").alias("shipdate"), F.col("l_shipdate").alias("ship_ts"),
        F.concat(F.lpad((key % 25).cast("string"), 3, "0"), F.lit("_NATION_"), (key % 25).cast("string")).alias("region"),
    )


def cube(spark, d):
    """Fields of two sensors before delivery."""
    c = F.col("o_custkey") % 25
    start = F.col("o_orderdate").cast("timestamp")
    hours = 12 + F.col("o_custkey") % 480
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("field_id"),
        F.concat(F.lpad(c.cast("string"), 3, "0"), F.lit("_NATION_"), c.cast("string")).alias("region"),
        start.alias("scene_1_datetime"),
        F.timestamp_micros(F.unix_micros(start) + hours * 3_600_000_000).alias("scene_2_datetime"),
        F.when(F.col("o_orderstatus") == "F", "S2").otherwise("L8").alias("sensor"),
        F.col("o_totalprice").alias("score"),
    )


def baseline(spark, d):
    return px(spark, d).select("region", "field_id", "component", "iy", "ix", "value")


def candidate(spark, d):
    """The baseline with strong fields shifted by one and the weakest ones missing."""
    raw = _raw(spark, d)
    valid = F.filter("cells", lambda x: x != -9999.0)
    state = raw.select("field_id", F.array_max(valid).alias("m"), F.array_min(valid).alias("n"))
    return baseline(spark, d).join(state, "field_id").where("n > -4.4").select(
        "region", "field_id", "component", "iy", "ix",
        F.when(F.col("m") > 4.0, F.col("value") + 1).otherwise(F.col("value")).alias("value"),
    )
