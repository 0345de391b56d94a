"""Positions inside groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.operators.joins import null_safe_join
from rasterloom.session import scratch_dir

# Most rows of one group that a single task may sort.
MAX_SORTED_ROWS = 5_000_000


def group_row_number(df: DataFrame, group, order, out="index", limit=MAX_SORTED_ROWS) -> DataFrame:
    """0-based position of each row within its group by ``order``, which should leave no ties.

    A window sorts a whole group in one task, so it serves only while the largest group is small enough
    (one number to the driver). Beyond, the table is sorted over all tasks and each slice is told how
    many rows of its groups come before it. Both plans give the same rows; null groups are groups.
    """
    group, order = list(group), list(order)
    largest = df.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
    if largest <= limit:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - F.lit(1).cast("bigint"))
    return _by_sorted_slices(df, group, order, out)


def _by_sorted_slices(df, group, order, out):
    spark = df.sparkSession
    path = scratch_dir(spark, "sorted")
    # Partition number in the upper bits, position in the lower 33. Written once: slice limits come from
    # sampling, and a second run after a lost executor must not see other limits.
    df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order).withColumn(
        "_at", F.monotonically_increasing_id()
    ).write.parquet(path)
    placed = spark.read.parquet(path).withColumns({
        "_slice": F.shiftright("_at", 33), "_pos": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)),
    })
    before = Window.partitionBy(*group).orderBy("_slice")
    starts = placed.groupBy(*group, "_slice").agg(F.count("*").alias("_n"), F.min("_pos").alias("_first"))
    shifts = starts.select(*group, "_slice", (F.sum("_n").over(before) - F.col("_n") - F.col("_first")).alias("_shift"))
    return null_safe_join(placed, shifts, [*group, "_slice"]).withColumn(out, F.col("_pos") + F.col("_shift")).drop(
        "_at", "_slice", "_pos", "_shift"
    )
