"""The lattice all masks share, and points on it."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GridSpec:
    """width x height square cells of cell_m metres; (x0, y_top) is the upper left corner, rows count downwards."""

    width: int
    height: int
    cell_m: float = 25.0
    x0: float = 0.0
    y_top: float = 0.0
    crs: str = "EPSG:31287"

    def radius(self, metres: float) -> float:
        return float(metres) / self.cell_m

    def min_cells(self, hectares: float) -> int:
        return math.ceil(hectares * 10_000 / self.cell_m**2 - 1e-9)

    def row(self, y: Column) -> Column:
        return F.floor((F.lit(self.y_top) - y) / self.cell_m).cast("int")

    def col(self, x: Column) -> Column:
        return F.floor((x - self.x0) / self.cell_m).cast("int")

    def inside(self, row: Column, col: Column) -> Column:
        return (row >= 0) & (row < self.height) & (col >= 0) & (col < self.width)

    def window(self, minx: float, miny: float, maxx: float, maxy: float) -> GridSpec:
        """The grid cut to a box, whole cells."""
        c0, c1 = max(0, round((minx - self.x0) / self.cell_m)), min(self.width, round((maxx - self.x0) / self.cell_m))
        r0, r1 = max(0, round((self.y_top - maxy) / self.cell_m)), min(self.height, round((self.y_top - miny) / self.cell_m))
        return GridSpec(c1 - c0, r1 - r0, self.cell_m, self.x0 + c0 * self.cell_m, self.y_top - r0 * self.cell_m, self.crs)


def disc(radius: float) -> list[tuple[int, int]]:
    """(dr, half width) of the rows of a disc of offsets dr*dr + dc*dc <= radius*radius + 1e-9."""
    r2 = radius * radius + 1e-9
    return [(dr, math.isqrt(math.floor(r2 - dr * dr))) for dr in range(-math.floor(math.sqrt(r2)), math.floor(math.sqrt(r2)) + 1)]
