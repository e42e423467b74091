"""Horizontal layouts: a ``part_id`` column that names the fragment of each row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridshard.functions.ratings import range_bound, range_part
from gridshard.operators.numbering import global_row_number

LOW, HIGH = 0.0, 5.0


def _fragments(n: int) -> int:
    if n < 1:
        raise ValueError(f"a layout needs at least one fragment, not {n}")
    return n


def range_partition(
    df: DataFrame, n: int, column: str = "rating", low: float = LOW, high: float = HIGH
) -> DataFrame:
    """``df`` with the fragment of each row among ``n`` equal ranges; null outside [low, high]."""
    return df.withColumn("part_id", range_part(F.col(column), _fragments(n), low, high))


def range_bounds(spark: SparkSession, n: int, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Metadata of a range layout: ``partition_num, min_rating, max_rating``."""
    i = F.col("id")
    return spark.range(_fragments(n)).select(
        i.cast("int").alias("partition_num"),
        range_bound(i, n, low, high).alias("min_rating"),
        range_bound(i + 1, n, low, high).alias("max_rating"),
    )


def round_robin(df: DataFrame, n: int, order_by: list[str], start: int = 0) -> DataFrame:
    """``df`` with rows dealt to ``n`` fragments in ``order_by`` order, from fragment ``start`` on."""
    numbered = global_row_number(df, order_by, "_row")
    part = F.pmod(F.col("_row") - 1 + F.lit(start), F.lit(_fragments(n))).cast("int")
    return numbered.withColumn("part_id", part).drop("_row")


def round_robin_state(df: DataFrame, n: int) -> DataFrame:
    """Metadata of a round-robin layout: ``partition_num``, and ``table_next_insert`` for the next row."""
    following = F.pmod(F.count(F.lit(1)), F.lit(_fragments(n))).cast("int")
    return df.agg(following.alias("table_next_insert")).select(
        F.lit(n).alias("partition_num"), "table_next_insert"
    )


def fragment_sizes(df: DataFrame, n: int) -> DataFrame:
    """Rows of each of the ``n`` fragments, empty ones included."""
    counts = df.groupBy("part_id").agg(F.count(F.lit(1)).alias("n"))
    ids = df.sparkSession.range(_fragments(n)).select(F.col("id").cast("int").alias("part_id"))
    return ids.join(counts, "part_id", "left").select(
        "part_id", F.coalesce("n", F.lit(0)).alias("n")
    )


def rejects(df: DataFrame) -> DataFrame:
    """Rows of a range layout that belong to no fragment."""
    return df.where(F.col("part_id").isNull())
