"""Declared schemas. No source infers its columns."""

from pyspark.sql import types as T

S, D, F32, I, L, B = T.StringType(), T.DoubleType(), T.FloatType(), T.IntegerType(), T.LongType(), T.BooleanType()
TS = T.TimestampType()


def struct(fields):
    """Schema from name -> type."""
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def same(names, data_type):
    return dict.fromkeys(names, data_type)


GOOD_LIST = struct({"id": S, "filter_ratio_1": D, "filter_ratio_2": D})

# Property names of a public catalogue. A nested item as a search saves it; the links sit under the band's asset.
_HREF = struct({"href": S})
_ASSET = struct({"href": S, "alternate": struct({"s3": _HREF})})
CATALOG_ITEM = struct({
    "id": S,
    "bbox": T.ArrayType(D),
    "collection": S,
    "geometry": struct({"type": S, "coordinates": T.ArrayType(T.ArrayType(T.ArrayType(D)))}),
    "properties": struct({
        "datetime": S, "eo:cloud_cover": D, "view:sun_azimuth": D, "view:sun_elevation": D, "platform": S,
        "instruments": T.ArrayType(S), "view:off_nadir": D, "landsat:cloud_cover_land": D,
        **same(("landsat:wrs_type", "landsat:wrs_path", "landsat:wrs_row", "landsat:scene_id",
                "landsat:collection_category", "landsat:collection_number", "landsat:correction", "proj:code"), S),
        "proj:shape": T.ArrayType(I), "proj:transform": T.ArrayType(D), "created": S, "updated": S,
    }),
    "assets": struct({"nir08": _ASSET, "pan": _ASSET}),
})

ASSET_ITEM = struct({
    "id": S, "properties": struct({"datetime": S, "s2:product_uri": S}), "assets": T.MapType(S, _HREF),
})

# Names in the delivered metadata documents.
FIELD_DOCUMENT = struct({
    "field_info": struct({
        **same(("id", "region_id", "data", "units", "source_product", "scene_1_satellite", "scene_2_satellite",
                "scene_1_datetime", "scene_2_datetime", "midpoint_datetime"), S),
        "baseline_days": D, "scene_1_orbit": I, "scene_2_orbit": I,
        "scene_1_processing_baseline": S, "scene_2_processing_baseline": S, "percent_ice_area_notnull": D,
    }),
    "error_units_velocity": struct(same(("mag_rmse", "dx_mean", "dx_sd", "dy_mean", "dy_sd"), D)),
    "error_units_displacement": struct(same(
        ("mag_displacement_rmse", "dx_displacement_mean", "dx_displacement_sd", "dy_displacement_mean",
         "dy_displacement_sd"), D)),
    "geospatial_info": struct({
        "epsg": S, "coordinate_unit": S, "x_resolution": D, "y_resolution": D,
        "extent": struct(same(("xmin", "ymin", "xmax", "ymax"), D)),
    }),
    "project_info": T.MapType(S, S),
})

# Delivered cube: one row per field ...
CUBE_FIELDS = struct({
    "index": L, "id": S, "scene_1_datetime": TS, "scene_2_datetime": TS, "baseline_days": L, "midpoint_datetime": TS,
    **same(("scene_1_satellite", "scene_2_satellite", "scene_1_orbit", "scene_2_orbit",
            "scene_1_processing_version", "scene_2_processing_version"), S),
    **same(("percent_ice_area_notnull", "error_mag_rmse", "error_dx_mean", "error_dx_sd", "error_dy_mean",
            "error_dy_sd"), F32),
})
# ... and one row per field and cell.
CUBE_PIXELS = struct({"index": L, "iy": I, "ix": I, "vx": F32, "vy": F32})
