"""Queries on delivery checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from rasterloom.operators import quality
from rasterloom.plans import fixtures as fx
from rasterloom.plans.queries_pixels import imagery
from rasterloom.plans.registry import query

CELL = ["component", "iy", "ix"]
OUTER_SQL = """
    SELECT coalesce(c.region, b.region) AS region, coalesce(c.field_id, b.field_id) AS field_id, coalesce(c.component, b.component) AS component,
           coalesce(c.iy, b.iy) AS iy, coalesce(c.ix, b.ix) AS ix, c.value AS cand_value, b.value AS base_value,
           CASE WHEN c.field_id IS NULL THEN 'only_baseline' WHEN b.field_id IS NULL THEN 'only_candidate'
                WHEN c.value IS NOT DISTINCT FROM b.value THEN 'same' ELSE 'changed' END AS state
    FROM cand c FULL JOIN base b ON b.field_id = c.field_id AND b.component = c.component AND b.iy = c.iy AND b.ix = c.ix"""
VERDICT_SQL = f"""
    SELECT *, CASE WHEN n_missing = n_cells THEN 'skipped' WHEN n_extra = n_cells THEN 'unavailable'
                   WHEN n_extra + n_missing + n_changed > 0 THEN 'mismatched' ELSE 'matched' END AS verdict
    FROM (SELECT region, field_id, count(*) FILTER (state = 'only_candidate') AS n_extra, count(*) FILTER (state = 'only_baseline') AS n_missing,
                 count(*) FILTER (state = 'changed') AS n_changed, count(*) AS n_cells FROM ({OUTER_SQL}) GROUP BY ALL)"""


@query("compare_full_outer", f"SELECT * FROM ({OUTER_SQL}) WHERE state <> 'same'", ["cand", "base"])
def _(spark, d):
    return quality.compare_full_outer(fx.candidate(spark, d), fx.baseline(spark, d), ["region", "field_id", *CELL], ["value"])


def verdicts(spark, d):
    return quality.qa_compare_pixels(fx.candidate(spark, d), fx.baseline(spark, d), ["region", "field_id"], CELL, ["value"])


@query("qa_compare_pixels", VERDICT_SQL, ["cand", "base"])
def _(spark, d):
    return verdicts(spark, d)


@query("qa_tally", f"""
    SELECT *, CAST(CASE WHEN mismatched > 0 THEN 1 WHEN unavailable > 0 OR matched = 0 THEN 2 ELSE 0 END AS INTEGER) AS status
    FROM (SELECT count(*) FILTER (verdict = 'matched') AS matched, count(*) FILTER (verdict = 'skipped') AS skipped,
                 count(*) FILTER (verdict = 'unavailable') AS unavailable, count(*) FILTER (verdict = 'mismatched') AS mismatched
          FROM ({VERDICT_SQL}))""", ["cand", "base"])
def _(spark, d):
    return quality.qa_tally(verdicts(spark, d))


@query("qa_compare_structure", """
    WITH a AS (SELECT region, max(iy) + 1 AS cand_y, max(ix) + 1 AS cand_x, count(DISTINCT field_id) AS cand_index FROM cand GROUP BY ALL),
    b AS (SELECT region, max(iy) + 1 AS base_y, max(ix) + 1 AS base_x, count(DISTINCT field_id) AS base_index FROM base GROUP BY ALL)
    SELECT a.*, b.* EXCLUDE (region), cand_y = base_y AND cand_x = base_x AS same_shape,
           round_even(cand_index * 1.0 / base_index * 100, 1) AS index_percent
    FROM a JOIN b ON b.region = a.region""", ["cand", "base"])
def _(spark, d):
    return quality.qa_compare_structure(fx.candidate(spark, d), fx.baseline(spark, d), ["region"], "field_id")


# One delivered file per customer, described by the rules' own rows with departures by segment and balance.
ATTRIBUTES = {"epsg": "3413", "Conventions": "CF-1.7", "coordinate_unit": "m"}


def _literal(v):
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


RULES_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"({_literal(v)}, {_literal(r)}, {_literal(k)}, {_literal(e)})" for v, r, k, e in quality.rule_rows(ATTRIBUTES)
) + ") AS rules(variable, rule, kind, expected)"
OBSERVED_SQL = f"""
    SELECT c_custkey AS unit, variable, rule,
           CASE WHEN rule = 'complevel' AND variable IN ('vx', 'vy') AND c_mktsegment = 'BUILDING' THEN '4'
                WHEN rule = '_FillValue' AND kind = 'absent' THEN 'NaN'
                WHEN kind = 'present' THEN 'text ' || c_custkey
                WHEN rule = 'epsg' AND c_acctbal > 9000 THEN '4326' ELSE expected END AS value
    FROM customer, ({RULES_SQL})
    WHERE NOT (variable = 'crs' AND c_acctbal < 0) AND NOT (kind = 'absent' AND c_mktsegment <> 'MACHINERY')
      AND NOT (rule = 'creation_date' AND c_acctbal > 9500)"""


def customers(spark, d):
    return fx.table(spark, d, "customer").select(F.col("c_custkey").alias("unit"), "c_acctbal", "c_mktsegment")


def observed(spark, d):
    rules = F.array(*[
        F.struct(F.lit(v).alias("variable"), F.lit(r).alias("rule"), F.lit(k).alias("kind"), F.lit(e).cast("string").alias("expected"))
        for v, r, k, e in quality.rule_rows(ATTRIBUTES)
    ])
    rule, variable, kind = F.col("rule"), F.col("variable"), F.col("kind")
    rows = customers(spark, d).select("*", F.inline(rules)).where(
        ~((variable == "crs") & (F.col("c_acctbal") < 0)) & ~((kind == "absent") & (F.col("c_mktsegment") != "MACHINERY"))
        & ~((rule == "creation_date") & (F.col("c_acctbal") > 9500)))
    value = (
        F.when((rule == "complevel") & variable.isin("vx", "vy") & (F.col("c_mktsegment") == "BUILDING"), "4")
        .when((rule == "_FillValue") & (kind == "absent"), "NaN")
        .when(kind == "present", F.concat(F.lit("text "), F.col("unit").cast("string")))
        .when((rule == "epsg") & (F.col("c_acctbal") > 9000), "4326").otherwise(F.col("expected"))
    )
    return rows.select("unit", "variable", "rule", value.alias("value"))


# The baseline describes every file without departures.
BASE_RULES_SQL = f"""SELECT c_custkey AS unit, variable, rule, CASE WHEN kind = 'present' THEN 'text ' || c_custkey ELSE expected END AS value
    FROM customer, ({RULES_SQL}) WHERE kind <> 'absent' AND NOT (variable = 'id' AND c_acctbal > 9800)"""


def expected_rules(spark, d):
    rules = F.array(*[
        F.struct(F.lit(v).alias("variable"), F.lit(r).alias("rule"), F.lit(k).alias("kind"), F.lit(e).cast("string").alias("expected"))
        for v, r, k, e in quality.rule_rows(ATTRIBUTES) if k != "absent"
    ])
    rows = customers(spark, d).select("*", F.inline(rules)).where(~((F.col("variable") == "id") & (F.col("c_acctbal") > 9800)))
    value = F.when(F.col("kind") == "present", F.concat(F.lit("text "), F.col("unit").cast("string"))).otherwise(F.col("expected"))
    return rows.select("unit", "variable", "rule", value.alias("value"))


@query("qa_compare_schema", f"""
    WITH c AS (SELECT * FROM ({OBSERVED_SQL}) WHERE NOT (variable = '' AND rule IN ('creation_date', 'data_acknowledgement'))),
    b AS (SELECT * FROM ({BASE_RULES_SQL}) WHERE NOT (variable = '' AND rule IN ('creation_date', 'data_acknowledgement')))
    SELECT coalesce(c.unit, b.unit) AS unit, coalesce(c.variable, b.variable) AS variable, coalesce(c.rule, b.rule) AS rule,
           c.value AS cand_value, b.value AS base_value,
           CASE WHEN c.unit IS NULL THEN 'only_baseline' WHEN b.unit IS NULL THEN 'only_candidate' ELSE 'changed' END AS state
    FROM c FULL JOIN b ON b.unit = c.unit AND b.variable = c.variable AND b.rule = c.rule
    WHERE c.value IS DISTINCT FROM b.value OR c.unit IS NULL OR b.unit IS NULL""")
def _(spark, d):
    return quality.qa_compare_schema(observed(spark, d), expected_rules(spark, d), ["unit"])


@query("schema_difference", f"""
    WITH c AS (SELECT DISTINCT unit, variable FROM ({OBSERVED_SQL})), b AS (SELECT DISTINCT unit, variable FROM ({BASE_RULES_SQL}))
    SELECT u.unit, coalesce((SELECT string_agg(variable, ',' ORDER BY variable) FROM c WHERE c.unit = u.unit AND NOT EXISTS
               (SELECT 1 FROM b WHERE b.unit = c.unit AND b.variable = c.variable)), '') AS only_candidate,
           coalesce((SELECT string_agg(variable, ',' ORDER BY variable) FROM b WHERE b.unit = u.unit AND NOT EXISTS
               (SELECT 1 FROM c WHERE c.unit = b.unit AND c.variable = b.variable)), '') AS only_baseline
    FROM (SELECT c_custkey AS unit FROM customer) u""")
def _(spark, d):
    return quality.schema_difference(observed(spark, d), expected_rules(spark, d), ["unit"])


@query("qa_validate_spec", f"""
    WITH o AS ({OBSERVED_SQL}), known AS (SELECT DISTINCT unit, variable FROM o),
    j AS (SELECT c.c_custkey AS unit, r.*, k.unit IS NOT NULL AS known, o.value
          FROM customer c CROSS JOIN ({RULES_SQL}) r
          LEFT JOIN known k ON k.unit = c.c_custkey AND k.variable = r.variable
          LEFT JOIN o ON o.unit = c.c_custkey AND o.variable = r.variable AND o.rule = r.rule)
    SELECT DISTINCT unit, variable, CASE WHEN variable <> '' AND NOT known THEN '' ELSE rule END AS rule, issue FROM (
      SELECT *, CASE WHEN variable <> '' AND NOT known THEN 'missing variable' WHEN kind = 'absent' AND value IS NOT NULL THEN 'must be absent'
                     WHEN kind <> 'absent' AND value IS NULL THEN 'missing' WHEN kind = 'exact' AND value <> expected THEN 'got ' || value END AS issue
      FROM j) WHERE issue IS NOT NULL""")
def _(spark, d):
    return quality.qa_validate_spec(observed(spark, d), customers(spark, d).select("unit"), ["unit"], ATTRIBUTES)


# Rasters: one per field and component; some blank, some constant, some written twice.
def rasters(spark, d):
    px = imagery(spark, d)
    f = F.col("field_id") * 2 + (F.col("component") == "dy").cast("int")
    v = F.when(f % 31 == 3, 0).when(f % 31 == 5, 7).when(f % 31 == 9, F.col("iy") * 10 + F.col("ix")).otherwise(F.col("v"))
    return px.select("region", f.alias("raster"), "iy", "ix", v.alias("value"))


RASTER_SQL = """
    SELECT region, raster, iy, ix, CASE raster % 31 WHEN 3 THEN 0 WHEN 5 THEN 7 WHEN 9 THEN iy * 10 + ix
           ELSE CAST(floor(abs(coalesce(value, 0)) * 1000) AS INTEGER) END AS v
    FROM (SELECT *, field_id * 2 + CASE component WHEN 'dy' THEN 1 ELSE 0 END AS raster FROM px)"""


@query("qa_raster_sanity", f"""
    WITH r AS ({RASTER_SQL}),
    s AS (SELECT region, raster, min(v) AS lo, max(v) AS hi, count(*) FILTER (v <> 0) AS valid,
                 string_agg(iy || ':' || ix || ':' || v, ',' ORDER BY iy, ix) AS body FROM r GROUP BY ALL),
    k AS (SELECT *, min(raster) OVER (PARTITION BY region, body) AS first FROM s)
    SELECT region, raster, concat_ws('; ', CASE WHEN raster % 23 = 1 THEN 'res 15.0' END, CASE WHEN raster % 29 = 2 THEN 'dtype float32' END,
             CASE WHEN valid = 0 THEN 'entirely nodata' WHEN lo = hi THEN 'constant ' || lo END,
             CASE WHEN raster <> first THEN 'same as ' || first END) AS problems FROM k""", ["px"])
def _(spark, d):
    f = F.col("raster")
    meta = fx.fields(spark, d).withColumn("raster", F.explode(F.array(F.col("field_id") * 2, F.col("field_id") * 2 + 1))).select(
        "region", f.alias("raster"), F.lit("EPSG:3413").alias("crs"), F.when(f % 23 == 1, 15.0).otherwise(10.0).alias("res"),
        F.when(f % 29 == 2, "float32").otherwise("uint16").alias("dtype"), F.lit(0).alias("nodata"), F.lit(1).alias("bands"))
    return quality.qa_raster_sanity(rasters(spark, d), meta, quality.RASTER_RULES["sentinel2"])


@query("qa_output_structure", """
    WITH l AS (SELECT DISTINCT lpad(CAST(user_id AS VARCHAR), 4, '0') || '_' || CAST(floor(value) AS INTEGER) AS region, CASE event_type WHEN 'view' THEN 'clipped' WHEN 'click' THEN 'metadata'
                      WHEN 'signup' THEN 'template' WHEN 'purchase' THEN 'download' ELSE 'logs' END AS part FROM events)
    SELECT r.region, p.part, p.required FROM (SELECT DISTINCT region FROM l) r,
           (VALUES ('clipped', true), ('metadata', true), ('template', true), ('download', false)) p(part, required)
    WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.region = r.region AND l.part = p.part)""")
def _(spark, d):
    kind = F.col("event_type")
    part = (F.when(kind == "view", "clipped").when(kind == "click", "metadata").when(kind == "signup", "template")
            .when(kind == "purchase", "download").otherwise("logs"))
    folder = F.concat_ws("_", F.lpad(F.col("user_id").cast("string"), 4, "0"), F.floor("value").cast("string"))
    listing = fx.table(spark, d, "events").select(folder.alias("region"), part.alias("part"))
    return quality.qa_output_structure(listing, "sentinel2")


FILES_SQL = """
    SELECT lpad(CAST(o_custkey AS VARCHAR), 6, '0') || '_Site' || (o_custkey % 7) || '_' || year(o_orderdate) || '_v01.' || (o_orderkey % 3) || '.nc' AS file,
           CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus FROM orders"""


@query("qa_match_by_unit", f"""
    WITH f AS ({FILES_SQL}), c AS (SELECT DISTINCT file, year FROM f WHERE o_orderstatus = 'O'), b AS (SELECT DISTINCT file, year FROM f WHERE o_orderstatus <> 'O'),
    k AS (SELECT split_part(file, '_', 1) || '_' || split_part(file, '_', 2) AS unit, year, max(file) AS base_file FROM b GROUP BY ALL)
    SELECT split_part(c.file, '_', 1) || '_' || split_part(c.file, '_', 2) AS unit, c.year, c.file AS cand_file, k.base_file
    FROM c LEFT JOIN k ON k.unit = split_part(c.file, '_', 1) || '_' || split_part(c.file, '_', 2) AND k.year = c.year""")
def _(spark, d):
    c = F.col("o_custkey")
    file = F.concat(F.lpad(c.cast("string"), 6, "0"), F.lit("_Site"), (c % 7).cast("string"), F.lit("_"), F.year("o_orderdate").cast("string"),
                    F.lit("_v01."), (F.col("o_orderkey") % 3).cast("string"), F.lit(".nc"))
    files = fx.table(spark, d, "orders").select(file.alias("file"), F.year("o_orderdate").alias("year"), "o_orderstatus")
    candidate = files.where("o_orderstatus = 'O'").select("file", "year").distinct()
    return quality.qa_match_by_unit(candidate, files.where("o_orderstatus <> 'O'").select("file", "year"), ["year"])
