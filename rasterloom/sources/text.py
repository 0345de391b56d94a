"""Text sources: quality lists, product meta files, folder listings, saved catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom import schemas
from rasterloom.functions import names

JOB_FOLDER = "slurm_jobs"  # Fixed value: the scheduler's folder among the region folders.


def read_good_lists(spark: SparkSession, glob: str, root: str) -> DataFrame:
    """Union of tab-separated quality lists. Empty files add no rows."""
    lists = spark.read.schema(schemas.GOOD_LIST).csv(glob, sep="\t")
    return good_list_rows(lists, root)


def good_list_rows(lists: DataFrame, root: str) -> DataFrame:
    """Id and folder of every listed field."""
    return lists.where(F.col("id").isNotNull()).select("id", F.concat(F.lit(f"{root}/"), "id").alias("dir"))


def parse_good_lines(lines: DataFrame, root: str, line="line") -> DataFrame:
    """The same from raw text lines; blank ones are skipped."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.GOOD_LIST)
    row = F.from_csv(F.col(line), columns, {"sep": "\t"})
    filled = lines.where(F.length(F.trim(line)) > 0)
    return good_list_rows(filled.select(row.alias("r")).select("r.*"), root)


def read_meta_texts(spark: SparkSession, glob: str) -> DataFrame:
    """Meta files whole, one row per file."""
    return spark.read.text(glob, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("text"))


def scan_pair_meta_text(files: DataFrame, marker: str = "Image") -> DataFrame:
    """Base names of the paths on lines that start with the marker, in file order.

    A meta file arrives as one row, so its lines never shuffle.
    """
    lines = F.filter(F.split("text", "\n"), lambda s: F.startswith(s, F.lit(marker)))
    ids = F.transform(lines, lambda s: names.base_name(F.substring_index(s, "=", -1)))
    return files.withColumn("ids", ids)


def read_listing(spark: SparkSession, root: str, glob: str = "*.tif") -> DataFrame:
    """Paths of files below a folder. Only the path is selected, so no content is read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return reader.load(root).select("path")


def scan_scene_listing(listing: DataFrame) -> DataFrame:
    """Region folder and scene name of clipped rasters: ``.../<region>/clipped/<name>.tif``."""
    parts = F.split("path", "/")
    kept = listing.where(F.col("path").rlike(r"/clipped/S2[^/]*\.tif$"))
    return kept.select(
        F.element_at(parts, -3).alias("region"), F.regexp_extract("path", r"([^/]+)\.tif$", 1).alias("name")
    )


def scan_regions_present(listing: DataFrame, root: str) -> DataFrame:
    """Region folders right below ``root``; helper folders are left out."""
    below = F.regexp_extract("path", "^" + root.rstrip("/") + "/([^/]+)/", 1)
    named = listing.select(below.alias("region")).where(
        (F.col("region") != "") & ~F.startswith("region", F.lit("_")) & (F.col("region") != JOB_FOLDER)
    )
    return named.distinct().orderBy("region")
