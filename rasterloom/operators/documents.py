"""The metadata document of a field, written as nested JSON and read back as columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom import schemas
from rasterloom.operators.correction import DISPLACEMENT_COLUMNS, ERROR_COLUMNS

TIME_FORMAT = "yyyy-MM-dd 'T'HH:mm:ss"  # Fixed value, blank included.

# Flat column -> path in the document.
DOCUMENT_COLUMNS = {
    "id": "field_info.id",
    "scene_1_datetime": "field_info.scene_1_datetime",
    "scene_2_datetime": "field_info.scene_2_datetime",
    "baseline_days": "field_info.baseline_days",
    "midpoint_datetime": "field_info.midpoint_datetime",
    "scene_1_satellite": "field_info.scene_1_satellite",
    "scene_2_satellite": "field_info.scene_2_satellite",
    "scene_1_orbit": "field_info.scene_1_orbit",
    "scene_2_orbit": "field_info.scene_2_orbit",
    "scene_1_processing_version": "field_info.scene_1_processing_baseline",
    "scene_2_processing_version": "field_info.scene_2_processing_baseline",
    "percent_ice_area_notnull": "field_info.percent_ice_area_notnull",
    "error_mag_rmse": "error_units_velocity.mag_rmse",
    "error_dx_mean": "error_units_velocity.dx_mean",
    "error_dx_sd": "error_units_velocity.dx_sd",
    "error_dy_mean": "error_units_velocity.dy_mean",
    "error_dy_sd": "error_units_velocity.dy_sd",
}


def _two_digits(c):
    return F.bround(c, 2).alias(c)


def build_field_document(fields: DataFrame, res: float, project_info=None) -> DataFrame:
    """One nested document per field, numbers rounded half-even to two digits.

    ``fields`` holds the pair's columns, the error statistics and the region's bounds.
    """
    def time(c):
        return F.date_format(c, TIME_FORMAT)

    info = F.struct(
        F.col("id"), F.col("region").alias("region_id"), F.lit("ice surface velocity").alias("data"),
        F.lit("m d^{-1}").alias("units"), F.col("source_product"), F.col("satellite1").alias("scene_1_satellite"),
        F.col("satellite2").alias("scene_2_satellite"), time("datetime_1").alias("scene_1_datetime"),
        time("datetime_2").alias("scene_2_datetime"), time("midpoint").alias("midpoint_datetime"),
        F.bround("baseline", 2).alias("baseline_days"), F.col("orbit1").cast("int").alias("scene_1_orbit"),
        F.col("orbit2").cast("int").alias("scene_2_orbit"),
        F.col("processingbaseline1").alias("scene_1_processing_baseline"),
        F.col("processingbaseline2").alias("scene_2_processing_baseline"), F.col("percent_ice_area_notnull"),
    )
    credit = F.concat(F.lit("Contains modified Copernicus Sentinel data ["), F.year("midpoint").cast("string"), F.lit("]."))
    project = [F.lit(x) for kv in (project_info or {}).items() for x in kv]
    document = F.struct(
        info.alias("field_info"),
        F.struct(*[_two_digits(c) for c in ERROR_COLUMNS]).alias("error_units_velocity"),
        F.struct(*[_two_digits(c) for c in DISPLACEMENT_COLUMNS]).alias("error_units_displacement"),
        F.struct(
            F.lit("3413").alias("epsg"), F.lit("m").alias("coordinate_unit"), F.lit(float(res)).alias("x_resolution"),
            F.lit(float(res)).alias("y_resolution"), F.struct("xmin", "ymin", "xmax", "ymax").alias("extent"),
        ).alias("geospatial_info"),
        F.create_map(*project, F.lit("data_acknowledgement"), credit).alias("project_info"),
    )
    return fields.select("region", "field_id", document.alias("document"))


def to_json_documents(documents: DataFrame) -> DataFrame:
    return documents.select("region", F.to_json("document").alias("value"))


def scan_field_metadata(documents: DataFrame, column="value") -> DataFrame:
    """Typed columns of every JSON document."""
    parsed = documents.withColumn("_d", F.from_json(column, schemas.FIELD_DOCUMENT)).drop(column)
    times = ("scene_1_datetime", "scene_2_datetime", "midpoint_datetime")
    flat = parsed.select(
        *[c for c in parsed.columns if c != "_d"], *[F.col(f"_d.{p}").alias(c) for c, p in DOCUMENT_COLUMNS.items()]
    )
    return flat.withColumns({c: F.try_to_timestamp(c, F.lit(TIME_FORMAT)) for c in times})
