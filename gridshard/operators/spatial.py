"""Spatial selections and joins over points and rectangles.

Points have double columns ``x, y``; rectangles have ``x1, y1, x2, y2`` for two
opposite corners in any order. All other columns are carried along. Coordinates
that are null, NaN or infinite match nothing.

``mode="exact"`` compares coordinates. ``mode="compat"`` compares areas with a
tolerance (see ``geometry.contains_by_area``); a rectangle that is a point then accepts
every point, so it pairs with all of them.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridshard.functions import geometry
from gridshard.functions.parsing import is_finite
from gridshard.operators import box_join as bj
from gridshard.operators.skew import skew_join

CORNERS = ("x1", "y1", "x2", "y2")


def _contains(mode: str):
    tests = {"exact": geometry.contains, "compat": geometry.contains_by_area}
    if mode not in tests:
        raise ValueError(f"mode must be 'exact' or 'compat', not {mode!r}")
    return tests[mode]


def range_select(points: DataFrame, rect: tuple[float, float, float, float], mode: str = "exact") -> DataFrame:
    """Points inside one rectangle."""
    if not all(map(math.isfinite, map(float, rect))):
        return points.where(F.lit(False))
    x, y = F.col("x"), F.col("y")
    corners = [F.lit(float(v)) for v in rect]
    inside = _contains(mode)(x, y, *corners) & is_finite(x) & is_finite(y)
    if mode == "compat":
        # Folded to constants, so that a scan can use it.
        x_low, x_high, y_low, y_high = _bounds(corners, mode)
        inside = x.between(x_low, x_high) & y.between(y_low, y_high) & inside
    return points.where(inside)


def distance_select(points: DataFrame, center: tuple[float, float], d: float) -> DataFrame:
    """Points within ``d`` of ``center``. The box around it is a filter a scan can use."""
    x, y = F.col("x"), F.col("y")
    cx, cy = (F.lit(float(v)) for v in center)
    d = float(d)
    if d < 0:
        return points.where(F.lit(False))
    box = x.between(cx - geometry.reach(cx, d), cx + geometry.reach(cx, d)) & y.between(
        cy - geometry.reach(cy, d), cy + geometry.reach(cy, d)
    )
    return points.where(box & geometry.within(x, y, cx, cy, d))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def _rect_boxes(rects: DataFrame, mode: str, farthest: float | None = None) -> DataFrame:
    corners = [F.col(c) for c in CORNERS]
    finite = reduce(lambda a, b: a & b, [is_finite(c) for c in corners])
    return bj.with_box(rects.where(finite), *_bounds(corners, mode, farthest))


def _bounds(
    corners: list[Column], mode: str, farthest: float | None = None
) -> tuple[Column, Column, Column, Column]:
    """Ranges of x and y that hold every point of the rectangle."""
    x1, y1, x2, y2 = corners
    dx, dy = (F.lit(0.0), F.lit(0.0)) if mode == "exact" else geometry.area_slack(*corners, farthest)
    return F.least(x1, x2) - dx, F.greatest(x1, x2) + dx, F.least(y1, y2) - dy, F.greatest(y1, y2) + dy


def _farthest(points: DataFrame, rects: DataFrame, mode: str) -> float | None:
    """The largest size of a y of the points, where flat rectangles make it matter."""
    if mode == "exact" or rects.where(geometry.is_flat(*[F.col(c) for c in CORNERS])).isEmpty():
        return None
    return points.where(is_finite(F.col("y"))).agg(F.max(F.abs("y"))).first()[0]


def range_join(points: DataFrame, rects: DataFrame, mode: str = "exact", strategy: str = "auto") -> DataFrame:
    """All (rectangle, point) pairs with the point inside.

    ``strategy``: ``broadcast`` or ``shuffle`` the covered cells of the
    rectangles; ``auto`` broadcasts up to ``BROADCAST_BYTES`` of them.
    """
    cover, stats, broadcast = _measured(points, rects, mode, strategy)
    return _range_pairs(points, mode, cover, stats, broadcast).select(*rects.columns, *points.columns)


def _measured(points: DataFrame, rects: DataFrame, mode: str, strategy: str, finer: int = 0):
    _contains(mode)
    bj.check_names(points, rects.drop("_rects"))
    cover, stats = bj.cover_boxes(_rect_boxes(rects, mode, _farthest(points, rects, mode)), finer)
    return cover, stats, _broadcasts(stats, strategy, finer == 0)


def _broadcasts(stats: bj.BoxStats, strategy: str, required: bool = True) -> bool:
    if strategy not in ("auto", "broadcast", "shuffle"):
        raise ValueError(f"strategy must be 'auto', 'broadcast' or 'shuffle', not {strategy!r}")
    fits = stats.cell_bytes <= bj.BROADCAST_BYTES
    if strategy == "broadcast" and required and not fits:
        raise ValueError(f"{stats.cell_bytes} bytes of cells are too many to broadcast; the limit is {bj.BROADCAST_BYTES}")
    return fits and strategy != "shuffle"


def _range_pairs(points, mode, cover, stats, broadcast, cells=None) -> DataFrame:
    predicate = _contains(mode)(F.col("x"), F.col("y"), *[F.col(c) for c in CORNERS])
    return bj.box_join(points, cover, "x", "y", predicate, stats, broadcast, list(CORNERS), cells)


def _collapsed(df: DataFrame, columns: list[str], weight: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(weight))


def _weighted_count(pairs: DataFrame, weights: Column) -> DataFrame:
    return pairs.agg(F.coalesce(F.sum(weights), F.lit(0)).cast("long").alias("n"))


def range_join_count(
    points: DataFrame, rects: DataFrame, mode: str = "exact", strategy: str = "auto"
) -> DataFrame:
    """Number of pairs of ``range_join``.

    Copies of a rectangle are counted before they meet points, and cells inside rectangles are one row
    for all of those, so that only points in cells on a border are tested. Points are shuffled once at most, on the cell.
    """
    rects = _collapsed(rects, list(CORNERS), "_rects")
    points = points.select("x", "y")
    if mode == "compat":
        # The area test may turn down points inside, by rounding, so each is tested.
        return _weighted_count(_range_pairs(points, mode, *_measured(points, rects, mode, strategy)), F.col("_rects"))
    cover, stats, broadcast = _counting_cover(points, rects, strategy)
    cells = bj.counting_cells(cover, "_rects", list(CORNERS))
    return _weighted_count(_range_pairs(points, mode, cover, stats, broadcast, cells), F.col("_rects"))


# Counting cells have a quarter of the side on each axis, as long as there are not more of them than that to shuffle.
_FINER = 2
_FINE_CELLS = 1 << 26


def _counting_cover(points: DataFrame, rects: DataFrame, strategy: str):
    """Of smaller cells fewer are on a border, so they are taken where they are few enough."""
    fine = _measured(points, rects, "exact", strategy, _FINER)
    if fine[2]:
        return fine
    few = fine[1].cells <= _FINE_CELLS
    if strategy == "shuffle" and few:
        return fine
    coarse = _measured(points, rects, "exact", strategy)
    return fine if few and not coarse[2] else coarse


def distance_join(left: DataFrame, right: DataFrame, d: float, strategy: str = "auto") -> DataFrame:
    """All pairs of a ``left`` point ``(x1, y1)`` and a ``right`` point ``(x2, y2)`` within ``d``.

    Giving the same points twice keeps each point's pair with itself. Every point
    of one side is looked up in the cells around the points of the other;
    ``auto`` broadcasts the right side, else the left side, if its cells are
    small enough, else shuffles both.
    """
    d = float(d)
    bj.check_names(left, right)
    if not d >= 0:
        return bj.no_pairs(left, right)
    side, cover, stats = _distance_side(left, right, d, strategy)
    return _distance_pairs(left, right, d, side, cover, stats).select(*left.columns, *right.columns)


def distance_join_count(left: DataFrame, right: DataFrame, d: float, strategy: str = "auto") -> DataFrame:
    """Number of pairs of ``distance_join``.

    Copies of a point on the side that is broadcast are counted before they meet the others; the
    other side, or both, are shuffled once at most, on the cell.
    """
    d = float(d)
    left, right = left.select(*_LEFT), right.select(*_RIGHT)
    if not d >= 0:
        return count_rows(bj.no_pairs(left, right))
    side, _, stats = _distance_side(left, right, d, strategy)
    weights = F.lit(1)
    if side == "left":
        left = _collapsed(left, list(_LEFT), "_copies")
        weights = F.col("_copies")
    elif side == "right":
        right = _collapsed(right, list(_RIGHT), "_copies")
        weights = F.col("_copies")
    # The measure holds for the collapsed side: fewer rows in the same cells.
    cover = _disc_boxes(left, *_LEFT, d) if side == "left" else _disc_boxes(right, *_RIGHT, d)
    return _weighted_count(_distance_pairs(left, right, d, side, cover, stats), weights)


_LEFT, _RIGHT = ("x1", "y1"), ("x2", "y2")


def _distance_side(left, right, d, strategy) -> tuple[str, DataFrame, bj.BoxStats]:
    """The side to broadcast (``left``, ``right`` or ``none``), and the covered side with its measure."""
    cover = _disc_boxes(right, *_RIGHT, d)
    stats, _ = bj.measure(cover)
    if _broadcasts(stats, strategy):
        return "right", cover, stats
    if strategy == "auto":
        left_cover = _disc_boxes(left, *_LEFT, d)
        left_stats, _ = bj.measure(left_cover)
        if _broadcasts(left_stats, strategy):
            return "left", left_cover, left_stats
    return "none", cover, stats


def _distance_pairs(left, right, d, side, cover, stats) -> DataFrame:
    if d == 0:
        return _equal_points(left, right, side)
    predicate = geometry.within(*[F.col(c) for c in (*_LEFT, *_RIGHT)], d)
    if side == "left":
        return bj.box_join(right, cover, *_RIGHT, predicate, stats, True, list(_LEFT))
    return bj.box_join(left, cover, *_LEFT, predicate, stats, side == "right", list(_RIGHT))


def _disc_boxes(points: DataFrame, x: str, y: str, d: float) -> DataFrame:
    cx, cy = F.col(x), F.col(y)
    rx, ry = geometry.reach(cx, d), geometry.reach(cy, d)
    boxed = bj.with_box(points.where(is_finite(cx) & is_finite(cy)), cx - rx, cx + rx, cy - ry, cy + ry)
    return bj.covered(boxed, bj.exponent_for(d))


def _equal_points(left: DataFrame, right: DataFrame, side: str) -> DataFrame:
    """Pairs at distance 0, as a plain equi join on the coordinates."""
    left = _keyed_points(left, *_LEFT)
    right = _keyed_points(right, *_RIGHT)
    keys = ["_i", "_j"]
    if side == "none":
        spread = [[c for c in df.columns if c not in keys] for df in (left, right)]
        return skew_join(left, right, keys, *spread).drop(*keys)
    if side == "left":
        return F.broadcast(left).join(right, keys).drop(*keys)
    return left.join(F.broadcast(right), keys).drop(*keys)


def _keyed_points(df: DataFrame, x: str, y: str) -> DataFrame:
    finite = df.where(is_finite(F.col(x)) & is_finite(F.col(y)))
    # As text, which tells doubles apart and both zeros together.
    return finite.withColumns({"_i": (F.col(x) + 0.0).cast("string"), "_j": (F.col(y) + 0.0).cast("string")})
