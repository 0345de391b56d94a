"""Scene pairs: dates, orbits, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import names, temporal

MIN_FIELDS = 5


def parse_scene_names(scenes: DataFrame, name="name") -> DataFrame:
    return scenes.select("*", *names.scene_name_columns(F.col(name)))


def parse_pair_dates(pairs: DataFrame, id="id") -> DataFrame:
    """First and second lone date-hour stamp of the id, as text and as time."""
    stamps = pairs.withColumns({f"datehr{n}": names.nth_match(F.col(id), names.LONE_DATEHOUR, n - 1) for n in (1, 2)})
    return stamps.withColumns({f"date{n}": names.datehour_to_timestamp(F.col(f"datehr{n}")) for n in (1, 2)})


def parse_landsat_dates(pairs: DataFrame, id="id") -> DataFrame:
    return pairs.withColumns(
        {f"date{n}": names.stamp_to_timestamp(names.nth_match(F.col(id), names.LONG_STAMP, n - 1)) for n in (1, 2)}
    )


def pair_temporal(pairs: DataFrame, first="datetime_1", second="datetime_2", year_of="date1") -> DataFrame:
    """Times of a Sentinel pair. ``day_sep`` is first minus second, hence negative."""
    a, b = F.col(first), F.col(second)
    return pairs.withColumns({
        "day_sep": temporal.days_between(b, a),
        "year": F.year(year_of),
        "midpoint": temporal.midpoint(a, b),
        "baseline": temporal.days_between(a, b),
    }).withColumn("halfbaseline", temporal.days_between(F.col("midpoint"), b))


def pair_temporal_landsat(pairs: DataFrame, first="date1", second="date2") -> DataFrame:
    """Times of a Landsat pair. ``day_sep`` is second minus first, hence positive."""
    a, b = F.col(first), F.col(second)
    return pairs.withColumns({
        "day_sep": temporal.days_between(a, b),
        "year": F.year(a),
        "midpoint": temporal.midpoint(a, b),
        "baseline": temporal.days_between(a, b),
    })


def orbit_pair_label(pairs: DataFrame, first="orbit1", second="orbit2") -> DataFrame:
    """``R<first>_R<second>`` and whether both scenes share the orbit.

    Orbits enter the label as integers: ``083`` becomes ``R83``.
    """
    a, b = F.col(first).cast("int"), F.col(second).cast("int")
    return pairs.withColumns({
        "orbit_pair": F.concat(F.lit("R"), a.cast("string"), F.lit("_R"), b.cast("string")),
        "orbit_match": F.when(a == b, 1).otherwise(0),
    })


def dedupe_last_per_hour(orbits: DataFrame) -> DataFrame:
    """One scene per region and hour: the last by time, then by satellite."""
    rest = [c for c in orbits.columns if c not in ("region", "datehour")]
    order = F.struct("datetime", "satellite", "orbits", "processing_baselines")
    return orbits.groupBy("region", "datehour").agg(
        F.max_by(F.struct(*rest), order).alias("last")
    ).select("region", "datehour", "last.*")


def join_pair_orbits(pairs: DataFrame, orbits: DataFrame) -> DataFrame:
    """Attach time, orbit and baseline of both scenes; pairs lacking either are dropped.

    ``orbits`` holds at most one row per region and hour after the dedupe, so pairs never multiply, and
    Spark broadcasts it while it is small or else splits hot hours in a shuffled join.
    """
    known = dedupe_last_per_hour(orbits).select(
        "region", "datehour", names.datetime_to_timestamp(F.col("datetime")).alias("datetime"),
        "orbits", "processing_baselines",
    )
    for n in (1, 2):
        side = known.toDF("region", f"datehr{n}", f"datetime_{n}", f"orbit{n}", f"processingbaseline{n}")
        pairs = pairs.join(side, ["region", f"datehr{n}"])
    return pairs


def filter_orbit_dates(orbits: DataFrame, start: str, end: str) -> DataFrame:
    """Text comparison of the stamp with ``yyyyMMdd`` bounds; the end day itself drops out."""
    return orbits.where((F.col("datetime") >= start) & (F.col("datetime") <= end))


def filter_scene_dates(scenes: DataFrame, start: str, end: str) -> DataFrame:
    """Days strictly between ``yyyyMMdd`` bounds."""
    day = F.substring("datetime", 1, 8)
    return scenes.where((day > start) & (day < end))


def filter_pair_dates(pairs: DataFrame, start: str, end: str) -> DataFrame:
    """First date from ``start`` on, second date up to midnight of ``end``."""
    return pairs.where(
        (F.col("date1") >= F.lit(start).cast("timestamp")) & (F.col("date2") <= F.lit(end).cast("timestamp"))
    )


def filter_pair_years(pairs: DataFrame, first: int, last: int, a="date1", b="date2") -> DataFrame:
    return pairs.where(F.year(a).between(first, last) & F.year(b).between(first, last))


def drop_aster_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.where((F.col("satellite1") != "AST") & (F.col("satellite2") != "AST"))


def orbit_pair_counts(pairs: DataFrame, keys=("region", "orbit_pair")) -> DataFrame:
    return pairs.groupBy(*keys).agg(F.count("*").alias("n_fields"))


def min_samples(pairs: DataFrame, n: int = MIN_FIELDS, keys=("region", "orbit_pair")) -> DataFrame:
    """Orbit pairs with enough fields to estimate an offset."""
    return orbit_pair_counts(pairs, keys).where(F.col("n_fields") >= n)


def split_dem_epoch(pairs: DataFrame, switch_date: str, date="date1") -> DataFrame:
    """Mark which elevation model a row belongs to; the mark joins every grouping key."""
    before = F.col(date).cast("date") < F.lit(switch_date).cast("date")
    return pairs.withColumn("epoch", F.when(before, "pre").otherwise("post"))


def sentinel_field_id(region, t1, t2):
    """Name of a corrected field."""
    return F.concat_ws("_", F.lit("S2"), region, _stamp(t1), _stamp(t2))


def cube_field_id(region, t1, t2, sensor):
    """Name of a field in the cube."""
    return F.concat_ws("_", region, _stamp(t1), _stamp(t2), sensor)


def _stamp(ts):
    return F.date_format(ts, "yyyyMMdd'T'HHmmss")
