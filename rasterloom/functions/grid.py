"""Column expressions on grids. Row 0 is the top row, column 0 the left one."""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """A north-up grid: left and top edge, cell size, columns and rows. Numbers, or columns of a table."""

    xmin: float | Column
    ymax: float | Column
    res: float | Column
    width: int | Column
    height: int | Column

    @classmethod
    def from_bounds(cls, xmin, ymin, xmax, ymax, res):
        return cls(xmin, ymax, res, int((xmax - xmin) / res), int((ymax - ymin) / res))

    @classmethod
    def of_columns(cls):
        """The grid that ``grid_spec`` put into each row."""
        return cls(F.col("xmin"), F.col("ymax"), F.col("res"), F.col("width"), F.col("height"))


def cell_to_world(iy, ix, xmin, ymax, res):
    """Coordinates of a cell's centre."""
    return xmin + (ix + 0.5) * res, ymax - (iy + 0.5) * res


def world_to_cell(x, y, xmin, ymax, res):
    """Row and column of the cell that holds a point."""
    return F.floor((ymax - y) / res).cast("int"), F.floor((x - xmin) / res).cast("int")


def ceil_to(width, step):
    """Length rounded up to a whole number of steps."""
    return F.ceil(width / step) * step
