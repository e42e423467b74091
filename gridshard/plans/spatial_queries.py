"""The four spatial queries over point and rectangle files. Each returns its number of results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridshard.operators import spatial
from gridshard.sources.text import scan_points, scan_rectangles


def _numbers(text: str, count: int) -> tuple[float, ...]:
    numbers = tuple(float(part) for part in text.split(","))
    if len(numbers) != count:
        raise ValueError(f"expected {count} comma separated numbers, got {text!r}")
    return numbers


def _count(df: DataFrame) -> int:
    return df.first()["n"]


def run_range_query(spark: SparkSession, points: str, rectangle: str, mode: str = "exact") -> int:
    found = spatial.range_select(scan_points(spark, points), _numbers(rectangle, 4), mode)
    return _count(spatial.count_rows(found))


def run_range_join_query(spark: SparkSession, points: str, rectangles: str, mode: str = "exact") -> int:
    return _count(
        spatial.range_join_count(scan_points(spark, points), scan_rectangles(spark, rectangles), mode)
    )


def run_distance_query(spark: SparkSession, points: str, center: str, d: float) -> int:
    found = spatial.distance_select(scan_points(spark, points), _numbers(center, 2), float(d))
    return _count(spatial.count_rows(found))


def run_distance_join_query(spark: SparkSession, points1: str, points2: str, d: float) -> int:
    left = scan_points(spark, points1).select(F.col("x").alias("x1"), F.col("y").alias("y1"))
    right = scan_points(spark, points2).select(F.col("x").alias("x2"), F.col("y").alias("y2"))
    return _count(spatial.distance_join_count(left, right, float(d)))
