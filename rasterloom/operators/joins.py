"""Joins on keys that may be null."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys, how="inner") -> DataFrame:
    """Join on ``keys``; a null key meets a null key, as in a group by."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(right, on, how).drop(*[f"_right_{k}" for k in keys])
