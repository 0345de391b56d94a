"""Area of a convex footprint inside a box, as array expressions.

A ring is ``ARRAY<STRUCT<x, y>>`` without the closing point, in either turning sense.
"""

from pyspark.sql import functions as F


def _half_plane(a, b, c):
    return F.struct(a.alias("a"), b.alias("b"), c.alias("c"))


def _box_planes(xmin, ymin, xmax, ymax):
    """The four half-planes ``a*x + b*y + c >= 0`` whose intersection is the box."""
    one, none = F.lit(1.0), F.lit(0.0)
    return F.array(
        _half_plane(one, none, -xmin),
        _half_plane(-one, none, xmax),
        _half_plane(none, one, -ymin),
        _half_plane(none, -one, ymax),
    )


def _clip(ring, plane):
    """Keep the part of the ring inside one half-plane."""

    def height(p):
        return plane["a"] * p["x"] + plane["b"] * p["y"] + plane["c"]

    # Every corner with its height, so that an edge looks heights up instead of computing them again.
    measured = F.transform(ring, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), height(p).alias("h")))

    def edge(p, q):
        s = p["h"] / (p["h"] - q["h"])
        cut = _point(p["x"] + s * (q["x"] - p["x"]), p["y"] + s * (q["y"] - p["y"]))
        kept = _point(q["x"], q["y"])
        return (
            F.when((p["h"] >= 0) & (q["h"] >= 0), F.array(kept))
            .when(p["h"] >= 0, F.array(cut))
            .when(q["h"] >= 0, F.array(cut, kept))
            .otherwise(F.filter(F.array(kept), lambda _: F.lit(False)))
        )

    return F.flatten(_bind(measured, lambda m: F.zip_with(m, _rotated(m), edge)))


def _point(x, y):
    return F.struct(x.alias("x"), y.alias("y"))


def _rotated(ring):
    """Every point's successor."""
    return F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))


def _bind(value, use):
    """Evaluate an array expression once and hand it to ``use``, which may refer to it often."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def clip_to_box(ring, xmin, ymin, xmax, ymax):
    return F.reduce(_box_planes(xmin, ymin, xmax, ymax), ring, _clip)


def ring_area(ring):
    """Shoelace formula; an empty ring has no area."""
    def cross(p, q):
        return p["x"] * q["y"] - q["x"] * p["y"]

    crosses = _bind(ring, lambda r: F.zip_with(r, _rotated(r), cross))
    return F.abs(F.reduce(crosses, F.lit(0.0), lambda total, c: total + c)) / 2.0


def box_ring(xmin, ymin, xmax, ymax):
    x0, y0, x1, y1 = (c.cast("double") for c in (xmin, ymin, xmax, ymax))
    return F.array(_point(x0, y0), _point(x1, y0), _point(x1, y1), _point(x0, y1))
