"""Column expressions on times. All assume the session zone UTC."""

from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def micros(ts):
    return F.unix_micros(ts.cast("timestamp"))


def days_between(start, end):
    """``end - start`` in fractional days."""
    return (micros(end) - micros(start)) / F.lit(float(MICROS_PER_DAY))


def midpoint(start, end):
    return F.timestamp_micros(micros(start) + F.floor((micros(end) - micros(start)) / F.lit(2)))


def season_flag(start, end, first_month=5, last_month=9):
    """Does a month stepped from ``start`` to ``end`` lie in the season?

    Steps keep the start's day, so the month of ``end`` counts only when that day is reached.
    """
    months = F.sequence(start.cast("date"), F.greatest(start, end).cast("date"), F.expr("interval 1 month"))
    return F.when(end >= start, F.exists(months, lambda d: F.month(d).between(first_month, last_month))).otherwise(
        F.lit(False)
    )


def epoch_seconds(ts):
    """Whole seconds, for scene times."""
    return F.unix_seconds(ts.cast("timestamp"))


def epoch_seconds_double(ts):
    """Seconds with fraction, for midpoints."""
    return micros(ts) / F.lit(1e6)
