"""Datacubes: stacking, indexing, unions, years, types, attributes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import temporal
from rasterloom.operators.numbering import group_row_number
from rasterloom.operators.offsets import to_wide

ORDER = ("scene_1_datetime", "scene_2_datetime", "id")

# Attributes of the cube's variables.
_PER_DAY = "metres per day"
_ORBIT = (
    "Sentinel-2: Relative Orbit number. e.g. '125' = Relative Orbit R125. "
    "Landsat 8: Path/Row in format PPPRRR e.g. '008011' = Path 008, Row 011."
)
VARIABLE_ATTRIBUTES = {
    "vx": {"long_name": "x component of ice velocity", "standard_name": "land_ice_x_velocity", "units": _PER_DAY},
    "vy": {"long_name": "y component of ice velocity", "standard_name": "land_ice_y_velocity", "units": _PER_DAY},
    "id": {"long_name": "velocity field ID in format {glacier ID}_{datetime1}_{datetime2}_{satellite}"},
    "scene_1_datetime": {"long_name": "scene 1 acquisition time"},
    "scene_2_datetime": {"long_name": "scene 2 acquisition time"},
    "baseline_days": {"long_name": "temporal baseline between scene 1 and scene 2", "units": "days"},
    "midpoint_datetime": {"long_name": "midpoint between scene 1 and scene 2 acquisition time"},
    "scene_1_satellite": {"long_name": "scene 1 source satellite"},
    "scene_2_satellite": {"long_name": "scene 2 source satellite"},
    "scene_1_orbit": {"long_name": "scene 1 orbital information", "comment": _ORBIT},
    "scene_2_orbit": {"long_name": "scene 2 orbital information", "comment": _ORBIT},
    "scene_1_processing_version": {"long_name": "scene 1 processing version"},
    "scene_2_processing_version": {"long_name": "scene 2 processing version"},
    "percent_ice_area_notnull": {
        "units": "percent", "long_name": "percentage of ice mask region containing valid data"},
    "error_mag_rmse": {"long_name": "root mean square of off-ice velocity magnitude", "units": _PER_DAY},
    "error_dx_mean": {"long_name": "mean of off-ice velocity in x direction", "units": _PER_DAY},
    "error_dx_sd": {"long_name": "standard deviation of off-ice velocity in x direction", "units": _PER_DAY},
    "error_dy_mean": {"long_name": "mean of off-ice velocity in y direction", "units": _PER_DAY},
    "error_dy_sd": {"long_name": "standard deviation of off-ice velocity in y direction", "units": _PER_DAY},
}
# Dataset attributes that do not name a project or people; callers add theirs.
DATASET_ATTRIBUTES = {
    "data": "ice surface velocity",
    "units": "m d^{-1}",
    "source": "Landsat-8 and Sentinel-2 optical imagery",
    "projection": "WGS 84 / NSDIC Sea Ice Polar Stereographic North",
    "epsg": "3413",
    "coordinate_unit": "m",
    "spatial_resolution": "100 m",
    "Conventions": "CF-1.7",
}


def stack_field_components(px: DataFrame, fields: DataFrame, keys=("region", "field_id")):
    """Cube rows from component rasters and the typed metadata: (pixels, fields).

    Only fields with metadata enter. Pixels keep ``field_id``; the index comes with ``cube_index``.
    """
    known = fields.select(*keys)
    wide = to_wide(px.join(known, list(keys), "left_semi"), [*keys, "iy", "ix"])
    return wide.withColumnsRenamed({"dx": "vx", "dy": "vy"}), fields


def cube_index(fields: DataFrame, by_year: bool = False, group=("region",), **limits) -> DataFrame:
    """Number fields from 0 by the times of their scenes, per region or per region and year."""
    keys = [*group, "year"] if by_year else list(group)
    return group_row_number(fields.drop("index"), keys, ORDER, "index", **limits)


def union_sensors(*cubes: DataFrame | None) -> DataFrame:
    """Stack the cubes at hand. A missing sensor is tolerated, none at all is an error."""
    present = [c for c in cubes if c is not None]
    if not present:
        raise ValueError("no sensor delivered a cube")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def union_dem_epochs(pre: DataFrame | None, post: DataFrame | None, group=("region", "year")) -> DataFrame:
    """Cubes made before and after the elevation model's switch, numbered anew."""
    return cube_index(union_sensors(pre, post), group=group)


def split_years(fields: DataFrame, full_year: bool = False) -> DataFrame:
    """Year of the midpoint.

    The year ends at midnight of 31 December unless ``full_year``: midpoints later that day drop out.
    """
    dated = fields.withColumn("year", F.year("midpoint_datetime"))
    if full_year:
        return dated
    return dated.where(F.col("midpoint_datetime") <= F.make_timestamp(
        F.col("year"), F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0)))


def narrow_types(df: DataFrame, schema) -> DataFrame:
    """Cast to the declared columns; others stay in front as keys."""
    declared = set(schema.fieldNames())
    keys = [F.col(c) for c in df.columns if c not in declared]
    return df.select(*keys, *[F.col(f.name).cast(f.dataType) for f in schema.fields if f.name in df.columns])


def encode_times(fields: DataFrame) -> DataFrame:
    """Epoch seconds: whole for the scenes, fractional for the midpoint."""
    return fields.withColumns({
        "scene_1_datetime": temporal.epoch_seconds(F.col("scene_1_datetime")),
        "scene_2_datetime": temporal.epoch_seconds(F.col("scene_2_datetime")),
        "midpoint_datetime": temporal.epoch_seconds_double(F.col("midpoint_datetime")),
    })


def date_span(fields: DataFrame, keys=("region",)) -> DataFrame:
    """First and last midpoint day and year."""
    return fields.groupBy(*keys).agg(
        F.min("midpoint_datetime").cast("date").alias("date_min"), F.max("midpoint_datetime").cast("date").alias("date_max")
    ).withColumns({"year_min": F.year("date_min"), "year_max": F.year("date_max")})


def attach_attributes(df: DataFrame, attributes=VARIABLE_ATTRIBUTES) -> DataFrame:
    """Put variable attributes into the columns' metadata, which Parquet keeps."""
    for name, values in attributes.items():
        if name in df.columns:
            df = df.withMetadata(name, values)
    return df


def dataset_attributes(fields: DataFrame, attributes=None, created=None, id_column="region", glacier_id=None) -> DataFrame:
    """Dataset attributes per region as ``region, name, value``.

    The acknowledgement names the span of years; ``created`` defaults to now.
    """
    constants = {**DATASET_ATTRIBUTES, **(attributes or {})}
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss") if created is None else F.lit(created)
    spans = date_span(fields, (id_column,))
    credit = F.format_string("Contains modified Copernicus Sentinel data [%d to %d].", "year_min", "year_max")
    values = [
        *[F.struct(F.lit(k).alias("name"), F.lit(v).alias("value")) for k, v in constants.items()],
        F.struct(F.lit("glacier_id").alias("name"), F.col(glacier_id or id_column).alias("value")),
        F.struct(F.lit("data_acknowledgement").alias("name"), credit.alias("value")),
        F.struct(F.lit("creation_date").alias("name"), stamp.alias("value")),
    ]
    return spans.select(id_column, F.inline(F.array(*values)))
