"""Column expressions on vector components."""

from pyspark.sql import functions as F


def magnitude(x, y):
    return F.sqrt(x * x + y * y)


def flow_direction(dx, dy, side=None):
    """Degrees anticlockwise from the x axis, in (-180, 180].

    The half-plane follows the sign of ``side`` (``dx`` unless given: the correction picks it by the
    uncorrected component). A vertical vector counts as lying left of the axis, so (0, 1) gives -90.
    """
    side = dx if side is None else side
    base = (
        F.when(dx != 0, F.degrees(F.atan(F.try_divide(dy, dx))))
        .when((dx == 0) & (dy > 0), F.lit(90.0))
        .when((dx == 0) & (dy < 0), F.lit(-90.0))
    )
    turned = F.when(side > 0, base).otherwise(base + 180.0)
    return F.when(turned > 180, turned - 360.0).otherwise(turned)


def flow_direction_atan2(dx, dy):
    """The usual quadrant-aware angle; differs from ``flow_direction`` only for dx = 0."""
    return F.when((dx != 0) | (dy != 0), F.degrees(F.atan2(dy, dx)))


def angular_difference(a, b):
    """Smaller angle between two directions, in [0, 180]."""
    d = F.abs(a - b)
    return F.when(d > 180, 360.0 - d).otherwise(d)


def corrected(value, offset, day_sep):
    """Velocity plus displacement offset over time; null where the time is zero."""
    return value + F.try_divide(offset, day_sep)


def nodata_to_null(value, nodata):
    """Null where the value is listed as nodata, or is NaN."""
    return F.when(~(value.isin(*nodata) | F.isnan(value)), value)


def zero_to_null(value):
    return F.nullif(value, F.lit(0.0))
