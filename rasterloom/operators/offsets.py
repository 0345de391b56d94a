"""A priori field from repeat-track fields, and the offset of every orbit pair from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import vector
from rasterloom.operators import blocks as block_ops
from rasterloom.operators.pairs import MIN_FIELDS, min_samples
from rasterloom.operators.quantiles import grouped_quantile, largest_group

CELL = ["region", "iy", "ix"]
COMPONENTS = ("dmag", "dx", "dy")


def area(df: DataFrame) -> list:
    """What is estimated apart: the region and, where rows carry one, the elevation-model epoch."""
    return ["region", "epoch"] if "epoch" in df.columns else ["region"]


def median_composite(px: DataFrame, keys=("region", "component", "iy", "ix"), largest=None) -> DataFrame:
    """Per-cell median over all fields, nulls ignored.

    A cell holds one value per field, so the number of fields per region bounds every group. It is
    counted from two columns unless the caller passes it.
    """
    if largest is None:
        largest = largest_group(px, ["region"], "field_id")
    return grouped_quantile(px, keys, {"value": "value"}, largest=largest)


def add_magnitude(px_wide: DataFrame) -> DataFrame:
    return px_wide.withColumn("dmag", vector.magnitude(F.col("dx"), F.col("dy")))


def to_long(px_wide: DataFrame, components=("dmag", "dx", "dy")) -> DataFrame:
    """Wide to long inside the partition."""
    rest = [c for c in px_wide.columns if c not in components]
    rows = F.array(*[F.struct(F.lit(c).alias("component"), F.col(c).alias("value")) for c in components])
    return px_wide.select(*rest, F.inline(rows))


def to_wide(px: DataFrame, keys, components=("dx", "dy"), value="value", suffix="") -> DataFrame:
    """Long to wide; one value per key and component, so ``max`` only picks it."""
    return px.groupBy(*keys).agg(
        *[F.max(F.when(F.col("component") == c, F.col(value))).alias(f"{c}{suffix}") for c in components]
    )


def _filtered_median(rasters: DataFrame, keys, values, largest: int, bh: int, bw: int, height: int, width: int) -> DataFrame:
    smooth = block_ops.median_blocks_3x3(rasters, [*keys, "field_id"], values, bh, bw, height, width)
    composite = block_ops.median_stack(smooth, keys, values, bh, bw, largest)
    return block_ops.median_blocks_3x3(composite, keys, values, bh, bw, height, width)


def repeat_tracks(pairs: DataFrame):
    """The fields that count for the a priori field, and the most of them that one area has."""
    keys = area(pairs)
    repeat = pairs.where("orbit_match = 1").select(*keys, "field_id")
    return repeat, largest_group(repeat, keys, "field_id")


def a_priori_blocks(blocks: DataFrame, pairs: DataFrame, bh: int, bw: int, height: int, width: int) -> DataFrame:
    """Median of the repeat-track fields per cell, 3x3-filtered before and after: from blocks to blocks of dmag, dx, dy.

    ``blocks`` holds ``region, field_id, by, bx`` and the arrays dx and dy of ``bh`` x ``bw`` cells. Speed is the
    median of speeds, not the speed of the medians. Pairs with an ``epoch`` give one field per epoch. Arrays
    stay arrays throughout; what is shuffled are blocks, for the rims and for the stacks.
    """
    repeat, largest = repeat_tracks(pairs)
    rasters = blocks.join(repeat, ["region", "field_id"]).withColumn("dmag", F.zip_with("dx", "dy", vector.magnitude))
    return _filtered_median(rasters, area(pairs), COMPONENTS, largest, bh, bw, height, width)


def a_priori_field(px: DataFrame, pairs: DataFrame, width: int, height: int, size: int = block_ops.BLOCK) -> DataFrame:
    """The same from a row per cell and component (dx, dy, dmag) to rows again."""
    repeat, largest = repeat_tracks(pairs)
    keys, bh, bw = [*area(pairs), "component"], min(size, height), min(size, width)
    rasters = block_ops.gather_blocks(px.join(repeat, ["region", "field_id"]), [*keys, "field_id"], ["value"], bh, bw)
    found = _filtered_median(rasters, keys, ["value"], largest, bh, bw, height, width)
    return block_ops.scan_blocks(found, keys, ["value"], bh, bw, height, width)


def flow_reference(a_priori: DataFrame) -> DataFrame:
    """Reference direction per cell from the a priori components."""
    keys = [*area(a_priori), "iy", "ix"]
    wide = to_wide(a_priori, keys)
    return wide.select(*keys, vector.flow_direction(F.col("dx"), F.col("dy")).alias("flow_ref"))


def join_a_priori(px: DataFrame, a_priori: DataFrame) -> DataFrame:
    """Difference of every value from the a priori field (a priori minus value)."""
    reference = a_priori.withColumnRenamed("value", "median")
    return px.join(reference, [*area(a_priori), "component", "iy", "ix"]).withColumn("diff", F.col("median") - F.col("value"))


def to_displacement(px: DataFrame, pairs: DataFrame, columns=("value",)) -> DataFrame:
    """Velocity times the time between the scenes."""
    times = pairs.select("region", "field_id", "day_sep")
    return px.join(times, ["region", "field_id"]).withColumns({c: F.col(c) * F.col("day_sep") for c in columns})


def orbit_pair_offset(
    px_wide: DataFrame, pairs: DataFrame, a_priori: DataFrame, min_fields: int = MIN_FIELDS
) -> DataFrame:
    """Per cell, the median displacement offset of every orbit pair with enough fields.

    Both components travel in one row. The fields of an orbit pair bound each group, and they are
    counted on the pair table, before any pixel is read. Pairs with an ``epoch`` are counted, compared
    and averaged within it.
    """
    keys = [*area(pairs), "orbit_pair"]
    enough = min_samples(pairs, min_fields, keys)
    used = pairs.join(enough, keys).select(*keys, "field_id", "day_sep")
    largest = enough.agg(F.max("n_fields")).first()[0] or 0
    cell = [*area(pairs), "iy", "ix"]
    reference = to_wide(a_priori, cell, suffix="_ref")
    moved = px_wide.join(used, ["region", "field_id"]).join(reference, cell).select(
        *keys, "iy", "ix",
        *[((F.col(f"{c}_ref") - F.col(c)) * F.col("day_sep")).alias(c) for c in ("dx", "dy")],
    )
    return grouped_quantile(
        moved, [*keys, "iy", "ix"], {"dx_offset": "dx", "dy_offset": "dy"}, largest=largest
    )


def offset_magnitude(offsets: DataFrame) -> DataFrame:
    return offsets.select(
        *area(offsets), "orbit_pair", "iy", "ix",
        vector.magnitude(F.col("dx_offset"), F.col("dy_offset")).alias("offset_mag"),
    )


def speed_p95_ceil10(a_priori: DataFrame, largest=None) -> DataFrame:
    """95th percentile of the a priori speed per region, up to the next ten."""
    speed = a_priori.where("component = 'dmag'")
    keys = area(a_priori)
    top = grouped_quantile(speed, keys, {"p95": "value"}, p=0.95, largest=largest)
    return top.select(*keys, "p95", (F.ceil(F.col("p95") / 10) * 10.0).cast("double").alias("vmax"))
