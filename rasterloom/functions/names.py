"""Column expressions on scene, pair and file names."""

from pyspark.sql import functions as F

# The stamps inside names, and the widths of their parts.
DATETIME = r"(\d{8}\D\d{6})"
DATEHOUR = r"(\d{8}\D\d{2})"
LONE_DATEHOUR = r"(?<!\d)(\d{8}\D\d{2})(?!\d)"
LONG_STAMP = r"(\d{14})"
MOSAIC_KEY_LENGTH = 37
STAMP_LENGTH = 14


def scene_name_columns(name):
    """Satellite, datetime, datehour, orbit and processing baseline of a scene name."""
    return [
        F.substring(name, 1, 3).alias("satellite"),
        F.regexp_extract(name, DATETIME, 1).alias("datetime"),
        F.regexp_extract(name, DATEHOUR, 1).alias("datehour"),
        F.regexp_extract(name, "_R(.{3})", 1).alias("orbits"),
        F.regexp_extract(name, "_N(.{4})", 1).alias("processing_baselines"),
    ]


def nth_match(text, pattern, n):
    """n-th match (from 0), null when there are fewer."""
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(n))


def datehour_to_timestamp(stamp):
    return F.try_to_timestamp(F.regexp_replace(stamp, r"\D", ""), F.lit("yyyyMMddHH"))


def stamp_to_timestamp(stamp):
    return F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss"))


def datetime_to_timestamp(text):
    return F.try_to_timestamp(F.regexp_replace(text, r"\D", ""), F.lit("yyyyMMddHHmmss"))


def landsat_id_columns(name, suffix=""):
    """Satellite, path/row and processing version, over three generations of ids.

    Ids beyond 80 characters carry the current layout, ``AST`` at 16-18 marks another instrument,
    and everything else is the pre-collection layout.
    """
    # Positions in the ids of the three generations.
    long_id = F.length(name) > 80
    aster = F.substring(name, 16, 3) == "AST"
    satellite = (
        F.when(long_id, F.substring(name, 38, 4))
        .when(aster, F.lit("AST"))
        .otherwise(F.concat(F.lit("LC0"), F.substring(name, 18, 1)))
    )
    path_row = (
        F.when(long_id, F.substring(name, 48, 6))
        .when(aster, F.lit("AST"))
        .otherwise(F.substring(name, 19, 6))
    )
    version = (
        F.when(
            long_id,
            F.concat(
                F.lit("C"),
                F.concat_ws(
                    "_",
                    F.substring(name, 73, 2),
                    F.substring(name, 76, 2),
                    F.substring(name, 43, 4),
                ),
            ),
        )
        .when(aster, F.lit("AST"))
        .otherwise(F.lit("Pre Collection-1"))
    )
    return [
        satellite.alias(f"satellite{suffix}"),
        path_row.alias(f"path_row{suffix}"),
        version.alias(f"baseline{suffix}"),
    ]


def subset_id(acquired, scene_id, item_id):
    return F.concat_ws("_", F.date_format(acquired, "yyyyMMddHHmmss"), scene_id, item_id, F.lit("ortho"))


def mosaic_key(name):
    """Satellite, time, baseline and orbit: what all tiles of one overpass share."""
    return F.substring(name, 1, MOSAIC_KEY_LENGTH)


def tile_of(name):
    """Tile id: the sixth part of the name without its leading letter."""
    return F.substring(F.get(F.split(name, "_"), F.lit(5)), 2, 5)


def zone_of(name):
    return F.substring(tile_of(name), 1, 2)


def base_name(path):
    return F.element_at(F.split(path, "/"), -1)


def unit_of(file_name):
    """``NNN_Name`` prefix of a delivered file."""
    return F.regexp_extract(file_name, r"^([^_]*_[^_.]*)", 1)
