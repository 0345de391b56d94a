"""Checks of a delivery: against a baseline, against a specification, against invariants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import names
from rasterloom.operators.rasters import content_digest

SKIPPED_ATTRIBUTES = ("creation_date", "data_acknowledgement")
PASSED, FAILED, UNCHECKED = 0, 1, 2

# Encodings a delivered variable must have. None: the entry must be absent.
_PACKED = {"zlib": "True", "complevel": "5", "shuffle": "True"}
_EPOCH = {"zlib": "False", "units": "seconds since 1970-01-01", "calendar": "proleptic_gregorian"}
_FLOAT = {"dtype": "float32", **_PACKED, "_FillValue": "NaN"}
_TEXT = {"dtype": "S1", **_PACKED}
_AXIS = {"dtype": "float64", "zlib": "False", "_FillValue": "NaN"}
VARIABLE_RULES = {
    **{v: _FLOAT for v in (
        "vx", "vy", "percent_ice_area_notnull", "error_mag_rmse", "error_dx_mean", "error_dx_sd",
        "error_dy_mean", "error_dy_sd")},
    **{v: {"dtype": "int64", **_EPOCH, "_FillValue": None} for v in ("scene_1_datetime", "scene_2_datetime")},
    "midpoint_datetime": {"dtype": "float64", **_EPOCH, "_FillValue": "NaN"},
    "baseline_days": {"dtype": "int64", **_PACKED, "units": "days"},
    **{v: _TEXT for v in (
        "id", "scene_1_satellite", "scene_2_satellite", "scene_1_orbit", "scene_2_orbit",
        "scene_1_processing_version", "scene_2_processing_version")},
    "crs": _AXIS,
    "index": {"dtype": "int64", "zlib": "False"},
    "x": _AXIS,
    "y": _AXIS,
}
# Attributes that only have to be there.
FREE_ATTRIBUTES = ("glacier_id", "data_acknowledgement", "creation_date")
# What a clipped raster must be.
RASTER_RULES = {
    "sentinel2": {"crs": "EPSG:3413", "res": 10.0, "dtype": "uint16", "nodata": 0, "bands": 1},
    "landsat": {"crs": "EPSG:3413", "res": 15.0, "dtype": "uint16", "nodata": 0, "bands": 1},
}
# Fixed values: (sensor, level, part, required).
STRUCTURE_RULES = (
    ("sentinel2", "region", "clipped", True),
    ("sentinel2", "region", "metadata", True),
    ("sentinel2", "region", "template", True),
    ("sentinel2", "region", "download", False),
    ("landsat", "sensor", "_reference", True),
)


def rule_rows(attributes=None):
    """The specification as rows ``variable, rule, kind, expected``; dataset attributes have variable ''."""
    rows = [
        (v, rule, "absent" if expected is None else "exact", expected)
        for v, rules in VARIABLE_RULES.items() for rule, expected in rules.items()
    ]
    rows += [("", name, "exact", value) for name, value in (attributes or {}).items()]
    return rows + [("", name, "present", None) for name in FREE_ATTRIBUTES]


def compare_full_outer(candidate: DataFrame, baseline: DataFrame, keys, values) -> DataFrame:
    """Rows that differ, null-safe: missing in the candidate, missing in the baseline, or changed."""
    return _outer(candidate, baseline, keys, values).where("state <> 'same'")


def _outer(candidate, baseline, keys, values):
    a = candidate.select(*keys, *[F.col(v).alias(f"cand_{v}") for v in values], F.lit(True).alias("_a"))
    b = baseline.select(*keys, *[F.col(v).alias(f"base_{v}") for v in values], F.lit(True).alias("_b"))
    same = F.lit(True)
    for v in values:
        same = same & F.col(f"cand_{v}").eqNullSafe(F.col(f"base_{v}"))
    state = (
        F.when(F.col("_a").isNull(), "only_baseline").when(F.col("_b").isNull(), "only_candidate")
        .when(same, "same").otherwise("changed")
    )
    return a.join(b, list(keys), "full_outer").withColumn("state", state).drop("_a", "_b")


def qa_compare_pixels(candidate: DataFrame, baseline: DataFrame, unit, keys, values) -> DataFrame:
    """Per unit of the candidate or baseline: differing cells, and a verdict."""
    counted = _outer(candidate, baseline, [*unit, *keys], values).groupBy(*unit).agg(
        F.count_if(F.col("state") == "only_candidate").alias("n_extra"),
        F.count_if(F.col("state") == "only_baseline").alias("n_missing"),
        F.count_if(F.col("state") == "changed").alias("n_changed"),
        F.count("*").alias("n_cells"),
    )
    verdict = (
        F.when(F.col("n_missing") == F.col("n_cells"), "skipped").when(F.col("n_extra") == F.col("n_cells"), "unavailable")
        .when(F.col("n_extra") + F.col("n_missing") + F.col("n_changed") > 0, "mismatched").otherwise("matched")
    )
    return counted.withColumn("verdict", verdict)


def qa_compare_structure(candidate: DataFrame, baseline: DataFrame, unit, member) -> DataFrame:
    """Per unit: do the grids have one size, and how many fields are there compared with the baseline?"""
    def shape(df, prefix):
        # One row per field first, so that counting fields needs no set of them in one task.
        per_field = df.groupBy(*unit, member).agg(F.max("iy").alias("h"), F.max("ix").alias("w"))
        return per_field.groupBy(*unit).agg(
            (F.max("h") + 1).alias(f"{prefix}_y"), (F.max("w") + 1).alias(f"{prefix}_x"), F.count("*").alias(f"{prefix}_index")
        )

    both = shape(candidate, "cand").join(shape(baseline, "base"), list(unit))
    same = (F.col("cand_y") == F.col("base_y")) & (F.col("cand_x") == F.col("base_x"))
    return both.withColumns({
        "same_shape": same, "index_percent": F.bround(F.col("cand_index") / F.col("base_index") * 100, 1),
    })


def schema_difference(candidate: DataFrame, baseline: DataFrame, unit) -> DataFrame:
    """Variables only one side has, comma-joined. A unit has a few dozen variables."""
    a = candidate.groupBy(*unit).agg(F.collect_set("variable").alias("_a"))
    b = baseline.groupBy(*unit).agg(F.collect_set("variable").alias("_b"))
    return a.join(b, list(unit)).select(
        *unit,
        F.array_join(F.sort_array(F.array_except("_a", "_b")), ",").alias("only_candidate"),
        F.array_join(F.sort_array(F.array_except("_b", "_a")), ",").alias("only_baseline"),
    )


def qa_compare_schema(candidate: DataFrame, baseline: DataFrame, unit, skip=SKIPPED_ATTRIBUTES) -> DataFrame:
    """Encodings and attributes that differ, from tables ``unit, variable, rule, value``."""
    def kept(df):
        return df.where(~((F.col("variable") == "") & F.col("rule").isin(*skip)))

    return compare_full_outer(kept(candidate), kept(baseline), [*unit, "variable", "rule"], ["value"])


BITS = 62


def _bits(number, words):
    """Set of the numbers of a group as bits of whole numbers. Combines before the shuffle."""
    shifted = F.call_function("shiftleft", F.lit(1).cast("bigint"), (number % BITS).cast("int"))
    return F.array(*[F.coalesce(F.bit_or(F.when(F.floor(number / BITS) == w, shifted)), F.lit(0).cast("bigint")) for w in range(words)])


def _has(bits, number):
    return F.getbit(F.get(bits, F.floor(number / BITS).cast("int")), (number % BITS).cast("int")) == 1


def qa_validate_spec(observed: DataFrame, units: DataFrame, unit, attributes=None) -> DataFrame:
    """Departures from the specification as ``unit, variable, rule, issue``.

    The rules are a fixed list. An observed entry is held against its own rule where it stands; what a unit lacks follows
    from the set of rules and variables seen in it, a few numbers a unit. So neither the entries nor the
    expected rules are shuffled or joined, whatever a plan takes their size for. A variable that is missing
    altogether gives one issue.
    """
    unit = list(unit)
    specified = rule_rows(attributes)
    variables = sorted({v for v, *_ in specified if v})
    rules = F.array(*[
        F.struct(F.lit(v).alias("variable"), F.lit(r).alias("rule"), F.lit(k).alias("kind"), F.lit(e).cast("string").alias("expected"),
                 F.lit(i).alias("number"), F.lit(variables.index(v) if v else None).cast("int").alias("of"))
        for i, (v, r, k, e) in enumerate(specified)
    ])
    # One small row unfolded: small for the planner too, so the entries stay where they are.
    table = observed.sparkSession.range(0, 1, 1, 1).select(F.inline(rules)).drop("of")
    seen = observed.dropna(subset=unit).join(table, ["variable", "rule"], "left")
    value = F.col("value")
    issue = (
        F.when((F.col("kind") == "absent") & value.isNotNull(), "must be absent")
        .when((F.col("kind") != "absent") & value.isNull(), "missing")
        .when((F.col("kind") == "exact") & (value != F.col("expected")), F.concat(F.lit("got "), value))
    )
    wrong = seen.select(*unit, "variable", "rule", issue.alias("issue")).where("issue IS NOT NULL")

    known = F.array_position(F.array(*map(F.lit, variables)), F.col("variable")) - 1
    sides = seen.select(*unit, "number", known.alias("of"), F.lit(False).alias("asked")).unionByName(
        units.select(*unit, F.lit(None).cast("int").alias("number"), F.lit(None).cast("bigint").alias("of"), F.lit(True).alias("asked")))
    sets = sides.groupBy(*unit).agg(
        F.bool_or("asked").alias("asked"), _bits(F.col("number"), len(specified) // BITS + 1).alias("numbers"),
        _bits(F.col("of"), len(variables) // BITS + 1).alias("known")).where("asked")

    def lacks(r):
        return F.when(r["of"].isNotNull() & ~_has(F.col("known"), r["of"]), "missing variable").when(
            (r["kind"] != "absent") & ~_has(F.col("numbers"), r["number"]), "missing")

    # Most units lack nothing, which shows by the numbers as a whole.
    needed = [i for i, (_, _, kind, _) in enumerate(specified) if kind != "absent"]
    sound = F.lit(True)
    for column, numbers, words in (("numbers", needed, len(specified) // BITS + 1), ("known", range(len(variables)), len(variables) // BITS + 1)):
        for w in range(words):
            mask = sum(1 << i % BITS for i in numbers if i // BITS == w)
            sound &= F.get(column, F.lit(w)).bitwiseAND(F.lit(mask).cast("bigint")) == mask
    found = F.filter(
        F.transform(rules, lambda r: F.struct(r["variable"].alias("variable"), r["rule"].alias("rule"), lacks(r).alias("issue"))), lambda x: x["issue"].isNotNull())
    named = F.transform(found, lambda x: F.struct(
        x["variable"].alias("variable"), F.when(x["issue"] == "missing", x["rule"]).otherwise("").alias("rule"), x["issue"].alias("issue")))
    lacking = sets.where(~sound).select(*unit, F.inline(F.array_distinct(named)))
    # Units are asked for as often as they like, and entries may be repeated. Neither side is known to be small.
    wrong = wrong.distinct().hint("merge").join(units.select(*unit), unit, "left_semi")
    return wrong.unionByName(lacking)


def qa_raster_sanity(px: DataFrame, meta: DataFrame, expect: dict, keys=("region", "raster"), value="value") -> DataFrame:
    """Per raster, the problems found, joined by '; ' (empty: sound).

    ``px`` holds whole-number cells, ``meta`` one row per raster with crs, res, dtype, nodata, bands.
    """
    region, raster = keys
    stats = px.groupBy(*keys).agg(
        F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count_if(F.col(value) != expect["nodata"]).alias("_valid")
    ).join(content_digest(px, keys, value), list(keys))
    first = stats.groupBy(region, "digest").agg(F.min(raster).alias("_first"), F.count("*").alias("_copies"))
    joined = meta.join(stats, list(keys)).join(first, [region, "digest"])
    problems = F.array_compact(F.array(
        *[F.when(~F.col(k).eqNullSafe(F.lit(v)), F.concat(F.lit(f"{k} "), F.coalesce(F.col(k).cast("string"), F.lit("none"))))
          for k, v in expect.items()],
        F.when(F.col("_valid") == 0, F.lit("entirely nodata"))
        .when(F.col("_lo") == F.col("_hi"), F.concat(F.lit("constant "), F.col("_lo").cast("string"))),
        F.when((F.col("_copies") > 1) & (F.col(raster) != F.col("_first")), F.concat(F.lit("same as "), F.col("_first").cast("string"))),
    ))
    return joined.select(*keys, F.array_join(problems, "; ").alias("problems"))


def qa_output_structure(listing: DataFrame, sensor: str, rules=STRUCTURE_RULES) -> DataFrame:
    """Missing parts: ``region, part, required``. ``listing`` holds ``region, part``; helpers start with '_'."""
    helper = F.startswith("region", F.lit("_"))
    wanted = F.array(*[
        F.struct(F.lit(p).alias("part"), F.lit(r).alias("required")) for s, level, p, r in rules if s == sensor and level == "region"
    ]) if any(s == sensor and level == "region" for s, level, _, _ in rules) else None
    top = [(p, r) for s, level, p, r in rules if s == sensor and level == "sensor"]
    missing = None
    if wanted is not None:
        regions = listing.where(~helper).select("region").distinct()
        missing = regions.select("region", F.inline(wanted)).join(
            listing.select("region", "part").distinct(), ["region", "part"], "left_anti"
        ).select("region", "part", "required")
    if top:
        spark = listing.sparkSession
        expected = spark.createDataFrame([("", p, r) for p, r in top], "region string, part string, required boolean")
        found = listing.where(helper).select(F.col("region").alias("part")).distinct()
        absent = expected.join(found, "part", "left_anti").select("region", "part", "required")
        missing = absent if missing is None else missing.unionByName(absent)
    return missing


def qa_tally(results: DataFrame, verdict="verdict") -> DataFrame:
    """One row of counts and a status. A mismatch outranks what could not be checked."""
    def n(state):
        return F.count_if(F.col(verdict) == state)

    counts = results.agg(
        n("matched").alias("matched"), n("skipped").alias("skipped"), n("unavailable").alias("unavailable"),
        n("mismatched").alias("mismatched"),
    )
    status = (
        F.when(F.col("mismatched") > 0, FAILED).when((F.col("unavailable") > 0) | (F.col("matched") == 0), UNCHECKED).otherwise(PASSED)
    )
    return counts.withColumn("status", status)


def qa_match_by_unit(candidate: DataFrame, baseline: DataFrame, extra=()) -> DataFrame:
    """Candidate files with the baseline file of the same unit (and year, if given); the last name wins."""
    def unit(df):
        return df.withColumn("unit", names.unit_of(F.col("file")))

    known = unit(baseline).groupBy("unit", *extra).agg(F.max("file").alias("base_file"))
    return unit(candidate).withColumnRenamed("file", "cand_file").join(known, ["unit", *extra], "left")
