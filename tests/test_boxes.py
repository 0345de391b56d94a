"""The box index against every pair."""

import random

import pytest

from rasterloom.operators import spatial


@pytest.mark.parametrize("finest", [None, 50.0])
def test_boxes_of_all_sizes(spark, finest):
    r = random.Random(7)

    def boxes(n, first):
        rows = []
        for i in range(n):
            x, y = r.uniform(-1000, 1000), r.uniform(-1000, 1000)
            w, h = (10 ** r.uniform(-2, 3.2) for _ in range(2))
            rows.append((first + i, x, y, x + w, y + h))
        # Points, boxes that touch in a corner or an edge, whole numbers on bin edges, and nothing known.
        rows += [(first + n, 0.0, 0.0, 0.0, 0.0), (first + n + 1, 0.0, 0.0, 64.0, 64.0), (first + n + 2, 64.0, 64.0, 128.0, 128.0),
                 (first + n + 3, -64.0, 0.0, 0.0, 64.0), (first + n + 4, None, 0.0, 1.0, 1.0), (first + n, 0.0, 0.0, 0.0, 0.0)]
        return rows

    a, b = boxes(120, 0), boxes(90, 1000)
    left = spark.createDataFrame(a, "a int, x0 double, y0 double, x1 double, y1 double")
    right = spark.createDataFrame(b, "b int, xmin double, ymin double, xmax double, ymax double")
    want = sorted((p[0], q[0]) for p in a for q in b
                  if None not in p and None not in q and p[1] <= q[3] and p[3] >= q[1] and p[2] <= q[4] and p[4] >= q[2])
    assert sorted((x.a, x.b) for x in spatial.join_boxes(left, right, finest).collect()) == want
    assert len(want) > 200


def test_a_box_makes_four_rows_a_level(spark):
    scene = spark.createDataFrame([(1, 12_345.0, 67_890.0, 197_345.0, 252_890.0)], "a int, x0 double, y0 double, x1 double, y1 double")
    box = ("x0", "y0", "x1", "y1")
    assert spatial._bins(scene, box, spatial.FINEST, [], "_la").count() <= 4
    assert spatial._bins(scene, box, spatial.FINEST, [3, 9, 19, 25], "_la").count() <= 12


def test_nothing_meets_nothing(spark):
    none = spark.createDataFrame([], "a int, x0 double, y0 double, x1 double, y1 double")
    some = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0)], "b int, xmin double, ymin double, xmax double, ymax double")
    assert spatial.join_boxes(none, some).count() == 0
