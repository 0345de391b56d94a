"""Sinks. Each writes Parquet (or JSON lines) that a later job reads back by its declared columns."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rasterloom.session import scratch_dir


def _rebalanced(df: DataFrame, *keys) -> DataFrame:
    """Rows of one key together, as far as a task's fair share allows: Spark cuts large keys by measured size and joins small ones."""
    return df.hint("rebalance", *[F.col(k) for k in keys])


def _overwrite(df: DataFrame, *keys):
    """Replaces the folders that the rows belong to, and leaves all others alone."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys)


def sink_by_region(df: DataFrame, path: str, order=()) -> None:
    """One folder per region, with as many files as its size asks for.

    Files are sorted; across the files of a region the order is that of ``order`` only within each.
    """
    _overwrite(_rebalanced(df, "region").sortWithinPartitions("region", *order), "region").parquet(path)


def sink_catalog_results(catalog: DataFrame, path: str) -> None:
    """Filtered search results per region."""
    sink_by_region(catalog, path)


def sink_lineage(lineage: DataFrame, path: str) -> None:
    """Per-region manifest in order of acquisition. An empty input writes an empty table."""
    sink_by_region(lineage.withColumn("acquired", F.get(F.split("mosaic_key", "_"), F.lit(2))), path, order=["acquired"])


def sink_field_metadata(documents: DataFrame, path: str, keys=("region",)) -> None:
    """One JSON document per field, as JSON lines."""
    _overwrite(_rebalanced(documents, *keys), *keys).text(path)


def sink_cube(pixels: DataFrame, fields: DataFrame, path: str, rows_per_slice: int = 64, fields_per_slice: int = 1024) -> None:
    """Cube by public id and year: ``<path>/pixels`` and ``<path>/fields``.

    Pixels are cut by blocks of grid rows and of fields, so a dominant region or year spreads over many
    tasks, and readers can skip files by ``iy`` and ``index``. Inside a file rows follow the field index
    and the cell, which packs well.
    """
    where = ["public_id", "year"]
    blocks = {"_rows": F.floor(F.col("iy") / rows_per_slice), "_fields": F.floor(F.col("index") / fields_per_slice)}
    _write_cube(pixels.withColumns(blocks).repartition(*where, *blocks).drop(*blocks), where, ["index", "iy", "ix"], f"{path}/pixels")
    # A field is one row, so a slice of fields may be larger.
    block = F.floor(F.col("index") / (fields_per_slice * 1024))
    _write_cube(fields.withColumn("_fields", block).repartition(*where, "_fields").drop("_fields"), where, ["index"], f"{path}/fields")


def year_digests(pixels: DataFrame, fields: DataFrame, where=("public_id", "year")) -> DataFrame:
    """Content of each year: rows of pixels and fields and sums of their hashes in two lanes, in no order. Combined before the shuffle."""
    def summed(df, name):
        lane = lambda seed: F.sum(F.xxhash64(F.lit(seed), *sorted(set(df.columns) - set(where))).cast("decimal(38,0)")).cast("string")
        return df.groupBy(*where).agg(F.concat_ws(":", F.count(F.lit(1)), lane(1), lane(2)).alias(name))

    # A year may lack pixels, but has fields.
    return summed(fields, "_fields").join(summed(pixels, "_pixels"), list(where), "left").select(
        *where, F.concat_ws("/", "_fields", F.coalesce("_pixels", F.lit("none"))).alias("digest"))


def deliver_cube(pixels: DataFrame, fields: DataFrame, path: str, **slices) -> DataFrame:
    """``sink_cube`` of the years whose content has changed since they were last delivered; returns them.

    ``<path>/digests`` holds the digest of each delivered year, a file for each delivery; the latest counts. It is written
    after the years themselves, so a job that dies in between delivers them again. Both tables should be stored:
    they are read for the digests and again for what has changed.
    """
    spark, where = pixels.sparkSession, ["public_id", "year"]
    now = year_digests(pixels, fields)
    columns = T.StructType([*(fields.schema[c] for c in where), T.StructField("digest", T.StringType()), T.StructField("delivered", T.LongType())])
    spark.createDataFrame([], columns).write.mode("ignore").parquet(f"{path}/digests")
    known = spark.read.schema(columns).parquet(f"{path}/digests").groupBy(*where).agg(F.max_by("digest", "delivered").alias("old"))
    target = scratch_dir(spark, "changed-years")
    now.join(known, where, "left").where(~F.col("digest").eqNullSafe(F.col("old"))).select(*where, "digest").write.parquet(target)
    changed = spark.read.parquet(target)  # a row a year
    if not changed.isEmpty():
        sink_cube(pixels.join(changed.select(*where), where, "left_semi"), fields.join(changed.select(*where), where, "left_semi"), path, **slices)
        changed.withColumn("delivered", F.lit(time.time_ns())).coalesce(1).write.mode("append").parquet(f"{path}/digests")
    return changed


def _write_cube(df, where, order, path):
    """Years that are not delivered again stay as they are."""
    _overwrite(df.sortWithinPartitions(*where, *order), *where).option("compression", "zstd").parquet(path)


def split_failures(units: DataFrame, error="error"):
    """Good units and a failure table ``unit, error``: one bad unit never stops the rest."""
    good = units.where(F.col(error).isNull()).drop(error)
    return good, units.where(F.col(error).isNotNull())


def sink_failures(failures: DataFrame, path: str, run: str) -> None:
    """Add a run's failures to the table. A retry of the run replaces its own rows."""
    failures.write.mode("overwrite").parquet(f"{path}/run={run}")
