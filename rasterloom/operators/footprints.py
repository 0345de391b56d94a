"""Footprints of scenes on the polar grid, from the coordinates of a catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import projection

#: Parts of a footprint's edge; a straight edge in degrees is bent on the polar grid.
PARTS = 8


def _point(x, y):
    return F.struct(x.alias("x"), y.alias("y"))


def densified(ring, parts=PARTS):
    """A closed ring of [longitude, latitude] as open ring of points, each edge in ``parts`` equal parts.

    Edges that cross the date line take the short way round.
    """
    n = F.greatest(F.size(ring) - 1, F.lit(0))

    def edge(p, q):
        turn = q[0] - p[0]
        turn = F.when(turn > 180, turn - 360).when(turn < -180, turn + 360).otherwise(turn)
        return F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda k: _point(p[0] + turn * k / parts, p[1] + (q[1] - p[1]) * k / parts))

    return F.flatten(F.zip_with(F.slice(ring, 1, n), F.slice(ring, 2, n), edge))


def project_footprints(catalog: DataFrame, coordinates="coordinates", parts=PARTS) -> DataFrame:
    """Adds the outer ring on the polar grid, ``ring``, and its bounding box ``x0, y0, x1, y1``.

    ``coordinates`` is a polygon's list of closed rings, the outer one first. Every point is projected once: the ring
    is a generated column, so neither the box nor a later clip projects it again. Scenes without
    coordinates, or with fewer than four points, have no ring and no box.
    """
    outer = F.get(coordinates, F.lit(0))

    def projected(p):
        return _point(*projection.polar_from_lonlat(p["x"], p["y"]))

    ring = F.when(F.size(outer) >= 4, F.transform(densified(outer, parts), projected))
    placed = catalog.withColumn("ring", F.explode(F.array(ring)))
    bounds = {"x0": F.array_min("ring.x"), "y0": F.array_min("ring.y"), "x1": F.array_max("ring.x"), "y1": F.array_max("ring.y")}
    return placed.withColumns(bounds)
