"""Exact quantiles per group, safe for groups of any size.

Spark's own ``percentile`` keeps every distinct value of a group in one buffer. That is the fastest
plan while groups are small, and the wrong one once a group outgrows an executor. ``grouped_quantile``
therefore looks at the size of the largest group first (one number to the driver) and takes one of two
physical plans, which give the same rows, for null keys too:

* small groups: one shuffle, built-in ``percentile``;
* large groups: a sketch brackets the wanted rank; what lies below is counted, equal values inside are
  counted together, and only the distinct values inside are ranked. The bracket follows ranks, not
  values, so outliers do not widen it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.operators.joins import null_safe_join

# Most values a group may hold for the in-memory plan: some 50 MB of buffer.
MAX_BUFFERED_VALUES = 1_000_000
# The bracket's half width and the sketch's accuracy, as shares of a group; the width allows for the sketch's error.
BRACKET, SKETCH = 0.002, 10_000


def largest_group(df: DataFrame, group, member) -> int:
    """Members in the largest group. One row reaches the driver."""
    sizes = df.select(*group, member).distinct().groupBy(*group).count()
    return sizes.agg(F.max("count")).first()[0] or 0


def grouped_quantile(
    df: DataFrame, keys, columns: dict, p=0.5, largest=None, limit=MAX_BUFFERED_VALUES
) -> DataFrame:
    """Exact interpolated quantile ``p`` per ``keys``, nulls ignored.

    ``columns`` maps output names to value columns. ``largest`` is an upper bound of the values per
    group; when the caller knows none it is counted.
    """
    if largest is None:
        largest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if largest <= limit:
        return df.groupBy(*keys).agg(*[F.percentile(c, F.lit(p)).alias(o) for o, c in columns.items()])
    return _by_bracket(df, list(keys), columns, p)


def _by_bracket(df, keys, columns, p):
    names = list(columns)
    long = df.select(
        *keys,
        F.explode(F.array(*[F.struct(F.lit(i).alias("series"), F.col(columns[o]).cast("double").alias("v"))
                            for i, o in enumerate(names)])).alias("s"),
    ).select(*keys, "s.series", "s.v")
    group = [*keys, "series"]
    values = long.where(F.col("v").isNotNull())

    # Sketches of bounded size, combined before the shuffle, bracket the wanted ranks.
    near = [max(0.0, p - BRACKET), min(1.0, p + BRACKET)]
    span = values.groupBy(*group).agg(F.percentile_approx("v", near, SKETCH).alias("span"), F.count("*").alias("n"))
    lo, hi = F.get("span", F.lit(0)), F.get("span", F.lit(1))
    # Equal values inside are one row, and so is all that lies below and all that lies above. In a small
    # group the wanted ranks may be the last value below or the first one above.
    side = F.when(F.col("v") < lo, -1).when(F.col("v") > hi, 1).otherwise(0)
    counted = (
        null_safe_join(values, span, group)
        .groupBy(*group, "n", side.alias("side"), F.when(F.col("v").between(lo, hi), F.col("v")).alias("inside"))
        .agg(F.count("*").alias("m"), F.min("v").alias("least"), F.max("v").alias("most"))
    )
    upto = Window.partitionBy(*group).orderBy("side", "inside")
    rank = p * (F.col("n") - 1)
    ranked = counted.withColumns({
        "start": F.sum("m").over(upto) - F.col("m"), "first": F.floor(rank), "last": F.ceil(rank),
    })

    def at(wanted):
        first_of, last_of = F.col(wanted) == F.col("start"), F.col(wanted) == F.col("start") + F.col("m") - 1
        inside = (F.col("side") == 0) & _covers(wanted, "start", "m")
        return F.max(F.when(inside | ((F.col("side") == 1) & first_of), F.col("least")).when((F.col("side") == -1) & last_of, F.col("most")))

    picked = ranked.groupBy(*group, "n", "first", "last").agg(at("first").alias("a"), at("last").alias("b"))
    value = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(
        (F.col("last") - rank) * F.col("a") + (rank - F.col("first")) * F.col("b")
    )
    answers = picked.select(*group, value.alias("q")).groupBy(*keys).agg(
        *[F.max(F.when(F.col("series") == i, F.col("q"))).alias(o) for i, o in enumerate(names)]
    )
    # Groups without any value stay in the result, with nulls.
    return null_safe_join(long.select(*keys).distinct(), answers, keys, "left")


def _covers(rank, start, count):
    return (F.col(start) <= F.col(rank)) & (F.col(rank) < F.col(start) + F.col(count))
