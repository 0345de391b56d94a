"""Box and footprint joins without a nested loop.

Boxes are indexed on a grid of many levels, each with bins twice as wide as the last. A box lies on the
level whose bins are just wider than itself, so it meets at most four of them; it is listed there and on
the coarser levels that the other side uses. Two boxes meet on the level of the larger one, so the join is
an equi-join on the bin, which Spark can shuffle and split, and no size has to be known
beforehand. A pair that shares several bins is reported in one bin only: the one holding the
lower-left corner of the two boxes' intersection. No ``distinct`` is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions.polygon import clip_to_box, ring_area

BOX = ("xmin", "ymin", "xmax", "ymax")
# Bins are no finer than this unless told otherwise; points have no size of their own.
FINEST = 2.0 ** -20


def _level(box, finest):
    """The level of a box: two to its power is the width of its bins."""
    x0, y0, x1, y1 = map(F.col, box)
    return F.ceil(F.log2(F.greatest(x1 - x0, y1 - y0, F.lit(float(finest))))).cast("int")


def _levels(df, box, finest):
    """Levels in use: a few dozen at most, as each has twice the width of the one below."""
    return [r[0] for r in df.select(_level(box, finest).alias("level")).where("level is not null").distinct().collect()]


def _bins(df, box, finest, others, name):
    """A row for each bin of each level on which a box may meet one of the other side: at most four a level."""
    own = df.withColumn(name, _level(box, finest))
    coarser = F.filter(F.array(*map(F.lit, others)).cast("array<int>"), lambda x: x > F.col(name))
    own = own.withColumn("_level", F.explode(F.concat(F.array(F.col(name)), coarser)))
    x0, y0, x1, y1 = (F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("_level"))) for c in box)
    return own.withColumn("_bx", F.explode(F.sequence(x0, x1))).withColumn("_by", F.explode(F.sequence(y0, y1)))


def join_boxes(left: DataFrame, right: DataFrame, finest: float | None = None, left_box=("x0", "y0", "x1", "y1"), right_box=BOX) -> DataFrame:
    """Pairs whose boxes meet; touching counts. Boxes with a null bound meet nothing.

    ``finest``: the least width of a bin, where many tiny boxes would use more levels than it is worth.
    """
    a, b, finest = left_box, right_box, finest or FINEST
    levels = [sorted(set(_levels(df, box, finest))) for df, box in ((left, a), (right, b))]
    size = F.pow(F.lit(2.0), F.col("_level"))
    owner_x = F.floor(F.greatest(F.col(a[0]), F.col(b[0])) / size)
    owner_y = F.floor(F.greatest(F.col(a[1]), F.col(b[1])) / size)
    meet = (
        (F.col(a[0]) <= F.col(b[2])) & (F.col(a[2]) >= F.col(b[0]))
        & (F.col(a[1]) <= F.col(b[3])) & (F.col(a[3]) >= F.col(b[1]))
    )
    return (
        _bins(left, a, finest, levels[1], "_la").join(_bins(right, b, finest, levels[0], "_lb"), ["_level", "_bx", "_by"])
        .where(meet & (F.col("_level") == F.greatest("_la", "_lb")) & (F.col("_bx") == owner_x) & (F.col("_by") == owner_y))
        .drop("_level", "_bx", "_by", "_la", "_lb")
    )


def join_footprint_overlap(scenes: DataFrame, regions: DataFrame, finest: float | None = None, ring="ring") -> DataFrame:
    """Share of each region that a convex footprint covers.

    ``scenes`` carries the footprint's ring and its bounding box ``x0, y0, x1, y1``: the box meets the
    region's box first, the exact clip runs on the survivors.
    """
    met = join_boxes(scenes, regions, finest)
    xmin, ymin, xmax, ymax = (F.col(c) for c in BOX)
    area = ring_area(clip_to_box(F.col(ring), xmin, ymin, xmax, ymax))
    # As a generated column the clip runs once per pair: a filter on it cannot be merged into the clip.
    return met.withColumn("frac", F.explode(F.array(area / ((xmax - xmin) * (ymax - ymin)))))


def filter_intersect_fraction(overlaps: DataFrame, threshold: float = 0.05) -> DataFrame:
    return overlaps.where(F.col("frac") > threshold)
