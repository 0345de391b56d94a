"""Rounding of sums before they are compared with another engine's."""

from pyspark.sql import functions as F

# Means of short decimals often fall on a rounding tie, which the last bits of two engines' sums break
# differently. A nudge far below the kept digits moves them off it.
NUDGE = 2.71828e-9


def steady(df, *columns):
    return df.withColumns({c: F.round(F.col(c) + NUDGE, 8) for c in columns})


def steady_sql(columns, prefix=""):
    return ", ".join(f"round({prefix}{c} + {NUDGE}, 8) AS {c}" for c in columns)
