"""Correct fields, measure their error on rock, filter by flow direction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import vector
from rasterloom.operators.offsets import area

FIELD = ["region", "field_id"]
MAX_ANGLE = 20.0
MIN_ICE_SHARE = 0.01
ERROR_COLUMNS = ("mag_rmse", "dx_mean", "dx_sd", "dy_mean", "dy_sd")
DISPLACEMENT_COLUMNS = (
    "mag_displacement_rmse", "dx_displacement_mean", "dx_displacement_sd",
    "dy_displacement_mean", "dy_displacement_sd",
)


def join_offsets(px_wide: DataFrame, pairs: DataFrame, offsets: DataFrame) -> DataFrame:
    """Attach the orbit pair's offset, of the field's epoch if there are epochs; fields of pairs without one are dropped."""
    keys = [*area(pairs), "orbit_pair"]
    known = pairs.select(*keys, "field_id", "day_sep")
    return px_wide.join(known, FIELD).join(offsets, [*keys, "iy", "ix"])


def apply_offset(px_wide: DataFrame) -> DataFrame:
    """Corrected components; the uncorrected x component stays as ``dx_raw``."""
    step = F.col("day_sep")
    return px_wide.withColumn("dx_raw", F.col("dx")).withColumns({
        "dx": vector.corrected(F.col("dx"), F.col("dx_offset"), step),
        "dy": vector.corrected(F.col("dy"), F.col("dy_offset"), step),
    }).drop("dx_offset", "dy_offset")


def _error_aggregates(dx, dy, labels, when=None):
    """Root mean square of the speed, mean and population deviation of the components."""
    pick = (lambda c: c) if when is None else (lambda c: F.when(when, c))
    rmse, dx_mean, dx_sd, dy_mean, dy_sd = labels
    return [
        F.sqrt(F.avg(pick(dx * dx + dy * dy))).alias(rmse),
        F.avg(pick(dx)).alias(dx_mean), F.stddev_pop(pick(dx)).alias(dx_sd),
        F.avg(pick(dy)).alias(dy_mean), F.stddev_pop(pick(dy)).alias(dy_sd),
    ]


def rock_error_velocity(px_masked: DataFrame) -> DataFrame:
    """Error of every field over rock. All-null rock gives null."""
    return px_masked.groupBy(*FIELD).agg(
        *_error_aggregates(F.col("dx"), F.col("dy"), ERROR_COLUMNS, F.col("is_rock"))
    )


def rock_error_displacement(px_masked: DataFrame) -> DataFrame:
    """The same, times the time between scenes."""
    dx, dy = F.col("dx") * F.col("day_sep"), F.col("dy") * F.col("day_sep")
    return px_masked.groupBy(*FIELD).agg(*_error_aggregates(dx, dy, DISPLACEMENT_COLUMNS, F.col("is_rock")))


def rock_error_landsat(px_masked: DataFrame) -> DataFrame:
    """The velocity error with results of exactly zero taken as missing."""
    stats = rock_error_velocity(px_masked)
    return stats.withColumns({c: vector.zero_to_null(F.col(c)) for c in ERROR_COLUMNS})


def ice_share_landsat(masks: DataFrame) -> DataFrame:
    """Ice cells over all cells, in percent: what the Landsat branch reports as coverage."""
    share = F.sum(F.col("is_ice").cast("double")) / F.count("*") * 100
    return masks.groupBy("region").agg(F.bround(share, 2).alias("percent_ice_area_notnull"))


def landsat_valid(px_wide: DataFrame) -> DataFrame:
    """Both components null where the x component is no measurement."""
    valid = ~F.col("dx").isin(0.0, -9999.0)
    return px_wide.withColumns({"dy": F.when(valid, F.col("dy")), "dx": F.when(valid, F.col("dx"))})


def join_flow_reference(px_wide: DataFrame, flow: DataFrame) -> DataFrame:
    return px_wide.join(flow, [*area(flow), "iy", "ix"], "left")


def flow_filter(px: DataFrame, max_angle: float = MAX_ANGLE) -> DataFrame:
    """Null on ice where the direction departs from the reference; rock stays.

    Needs ``dx, dy, dx_raw, is_ice, flow_ref``. The half-plane follows the uncorrected component. A
    cell without x component loses its y component too.
    """
    angle = vector.flow_direction(F.col("dx"), F.col("dy"), side=F.col("dx_raw"))
    astray = vector.angular_difference(F.col("flow_ref"), angle) > max_angle
    keep = ~F.coalesce(F.col("is_ice") & astray, F.lit(False)) & F.col("dx").isNotNull()
    return px.withColumn("_keep", keep).withColumns(
        {c: F.when(F.col("_keep"), F.col(c)) for c in ("dx", "dy")}
    ).drop("_keep")


def _with_share(counts, masks):
    """Share of the region's ice cells, counted on the mask itself, that hold a value."""
    ice = masks.groupBy("region").agg(F.count_if("is_ice").alias("ice_cells"))
    share = F.try_divide(F.col("valid_ice_cells").cast("double"), F.col("ice_cells").cast("double"))
    return counts.join(ice, "region").withColumn("ice_share", share).withColumn(
        "percent_ice_area_notnull", F.bround(share * 100, 2)
    )


def ice_coverage(px_masked: DataFrame, masks: DataFrame) -> DataFrame:
    """Valid ice cells over ice cells, in percent."""
    valid = F.count_if(F.col("is_ice") & F.col("dx").isNotNull()).alias("valid_ice_cells")
    return _with_share(px_masked.groupBy(*FIELD).agg(valid), masks)


def covered_fields(coverage: DataFrame, threshold: float = MIN_ICE_SHARE) -> DataFrame:
    return coverage.where((F.col("valid_ice_cells") > 0) & (F.col("ice_share") >= threshold))


def filter_ice_coverage(px: DataFrame, coverage: DataFrame, threshold: float = MIN_ICE_SHARE) -> DataFrame:
    """Drop fields with hardly any valid ice."""
    return px.join(covered_fields(coverage, threshold).select(*FIELD), FIELD, "left_semi")


def field_statistics(px: DataFrame, masks: DataFrame) -> DataFrame:
    """Errors before the flow filter and coverage after it, in one aggregate.

    Needs the columns of ``flow_filter`` plus ``is_rock`` and ``day_sep``. Both states of the field sit
    in the same row, so one exchange serves both.
    """
    filtered = flow_filter(px.withColumns({"_dx": F.col("dx"), "_dy": F.col("dy")}))
    dx, dy, step, rock = F.col("_dx"), F.col("_dy"), F.col("day_sep"), F.col("is_rock")
    stats = filtered.groupBy(*FIELD).agg(
        *_error_aggregates(dx, dy, ERROR_COLUMNS, rock),
        *_error_aggregates(dx * step, dy * step, DISPLACEMENT_COLUMNS, rock),
        F.count_if(F.col("is_ice") & F.col("dx").isNotNull()).alias("valid_ice_cells"),
    )
    return _with_share(stats, masks)
