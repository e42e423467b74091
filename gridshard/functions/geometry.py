"""Planar predicates on double columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the tolerance of the area-sum containment test.
AREA_TOLERANCE = 1e-10


def triangle_area(x1: Column, y1: Column, x2: Column, y2: Column, x3: Column, y3: Column) -> Column:
    doubled = x1 * (y2 - y3) + x2 * (y3 - y1) + x3 * (y1 - y2)
    return F.abs(doubled / F.lit(2.0))


def contains(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Point in closed rectangle; (x1, y1), (x2, y2) are any two opposite corners."""
    return x.between(F.least(x1, x2), F.greatest(x1, x2)) & y.between(F.least(y1, y2), F.greatest(y1, y2))


def contains_by_area(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Point in rectangle by comparing areas, tolerance included.

    The four triangles from the point to the sides sum to the area of the
    rectangle exactly when the point is inside. With a zero-width or zero-height
    rectangle the test also accepts points off the rectangle.
    """
    rectangle = triangle_area(x1, y2, x2, y2, x2, y1) + triangle_area(x1, y2, x1, y1, x2, y1)
    fan = (
        triangle_area(x, y, x1, y2, x2, y2)
        + triangle_area(x, y, x2, y2, x2, y1)
        + triangle_area(x, y, x2, y1, x1, y1)
        + triangle_area(x, y, x1, y1, x1, y2)
    )
    return fan - rectangle <= F.lit(AREA_TOLERANCE)


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx, dy = x2 - x1, y2 - y1
    return F.sqrt(dx * dx + dy * dy)


def within(x1: Column, y1: Column, x2: Column, y2: Column, d: float) -> Column:
    return distance(x1, y1, x2, y2) <= F.lit(float(d))


def reach(center: Column, d: float) -> Column:
    """Half-width of a box around ``center`` that no point within ``d`` can leave.

    The relative parts cover the rounding of the distance formula and of
    ``center`` plus or minus the result.
    """
    return F.lit(d * (1 + 1e-9)) + F.abs(center) * F.lit(4e-16)


# Rounding of the area sum, relative to coordinate size times rectangle side.
_AREA_ROUNDING = 4e-14


def _size(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.greatest(F.abs(x1), F.abs(x2), F.abs(y1), F.abs(y2)) + F.abs(x2 - x1)


def is_flat(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """The width cannot be told from rounding."""
    return F.abs(x2 - x1) <= F.lit(2 * _AREA_ROUNDING) * _size(x1, y1, x2, y2)


def area_slack(
    x1: Column, y1: Column, x2: Column, y2: Column, farthest: float | None = None
) -> tuple[Column, Column]:
    """How far outside a rectangle ``contains_by_area`` may still accept a point.

    A point dx, dy outside a w by h rectangle raises the area sum by h*dx + w*dy,
    so it can pass only while that stays below the tolerance plus the rounding of
    the sum. Infinity means the axis has no bound, as across an edge of length 0.

    For a flat rectangle the rounding grows with the y of the point. ``farthest``
    is a bound on its size; without one, flat rectangles have no bounds.
    """
    w, h, size = F.abs(x2 - x1), F.abs(y2 - y1), _size(x1, y1, x2, y2)
    unbounded = F.lit(math.inf)

    def slack(rounding: Column, edge: Column) -> Column:
        excess = F.lit(AREA_TOLERANCE) + F.lit(_AREA_ROUNDING) * size * rounding
        return F.coalesce(F.try_divide(F.lit(2.0) * excess, edge), unbounded)

    flat = is_flat(x1, y1, x2, y2)
    if farthest is None:
        flat_dx = flat_dy = unbounded
    else:
        flat_dx, flat_dy = (slack(F.lit(farthest) + size, edge) for edge in (h, w))
    return F.when(flat, flat_dx).otherwise(slack(h, h)), F.when(flat, flat_dy).otherwise(slack(h, w))
