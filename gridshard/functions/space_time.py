"""Space-time cells and the Getis-Ord G* statistic."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GridSpec:
    """Closed bounds of the cell grid. The defaults are fixed values: the New York
    area in steps of a hundredth of a degree, and the days of a 31-day month."""

    min_x: int = -7450
    max_x: int = -7370
    min_y: int = 4050
    max_y: int = 4090
    min_z: int = 1
    max_z: int = 31
    step: float = 0.01

    @property
    def num_cells(self) -> int:
        return (
            (self.max_x - self.min_x + 1)
            * (self.max_y - self.min_y + 1)
            * (self.max_z - self.min_z + 1)
        )

    def holds(self, x: Column, y: Column, z: Column) -> Column:
        return (
            x.between(self.min_x, self.max_x)
            & y.between(self.min_y, self.max_y)
            & z.between(self.min_z, self.max_z)
        )


def cell_index(value: Column, step: float) -> Column:
    """Index of the grid step holding ``value``; null when there is none."""
    number = F.nanvl(value, F.lit(None).cast("double"))
    return F.floor(number / F.lit(step)).try_cast("int")


# Cells around a cell, itself included, by the number of grid
# faces it lies on (inside, face, edge, corner).
NEIGHBOR_COUNTS = (27, 18, 12, 8)


def neighbor_count(x: Column, y: Column, z: Column, grid: GridSpec, boundary: str = "exact") -> Column:
    """Number of grid cells around a cell.

    ``compat`` compares each axis with the bounds at shuffled places (x with
    min_x and min_y, y with min_z and max_x, z with max_y and max_z), as callers
    of the original job got them.
    """
    if boundary == "exact":
        faces = ((x, grid.min_x, grid.max_x), (y, grid.min_y, grid.max_y), (z, grid.min_z, grid.max_z))
    elif boundary == "compat":
        faces = ((x, grid.min_x, grid.min_y), (y, grid.min_z, grid.max_x), (z, grid.max_y, grid.max_z))
    else:
        raise ValueError(f"boundary must be 'exact' or 'compat', not {boundary!r}")
    on_faces = F.lit(1)
    for axis, low, high in faces:
        on_faces = on_faces + axis.isin(low, high).cast("int")
    return F.element_at(F.array(*[F.lit(n) for n in NEIGHBOR_COUNTS]), on_faces)


def getis_ord(neighbor_sum: Column, neighbors: Column, cells: int, mean: Column, std: Column) -> Column:
    """G* z-score of a cell; null when every cell of the grid counts the same."""
    k = neighbors.cast("double")
    n = F.lit(float(cells))
    deviation = neighbor_sum.cast("double") - mean * k
    spread = std * F.sqrt((n * k - k * k) / F.lit(float(cells - 1)))
    return F.try_divide(deviation, spread)
