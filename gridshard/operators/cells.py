"""Counts, statistics and G* scores of space-time cells.

Everything after ``cell_counts`` is bounded by the grid, not by the trips: at
most ``grid.num_cells`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridshard.functions import space_time as st
from gridshard.functions.space_time import GridSpec

CELL = ("x", "y", "z")


def assign_cells(
    trips: DataFrame,
    grid: GridSpec = GridSpec(),
    lon: str = "lon",
    lat: str = "lat",
    time: str = "time",
    z: str = "day_of_month",
) -> DataFrame:
    """Cell ``x, y, z`` of each trip; nulls where a trip has no usable value.

    ``z`` is the ``day_of_month`` or the ``day_of_year``; months and years fold
    onto each other.
    """
    day = {"day_of_month": F.dayofmonth, "day_of_year": F.dayofyear}[z]
    return trips.select(
        st.cell_index(F.col(lon), grid.step).alias("x"),
        st.cell_index(F.col(lat), grid.step).alias("y"),
        day(time).alias("z"),
    )


def near_grid(trips: DataFrame, grid: GridSpec = GridSpec(), lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Trips no more than one step outside the grid: a range filter a scan can use."""

    def around(name: str, low: int, high: int) -> Column:
        return F.col(name).between((low - 1) * grid.step, (high + 2) * grid.step)

    return trips.where(around(lon, grid.min_x, grid.max_x) & around(lat, grid.min_y, grid.max_y))


def bounded(cells: DataFrame, grid: GridSpec = GridSpec()) -> DataFrame:
    return cells.where(grid.holds(*[F.col(c) for c in CELL]))


def cell_counts(cells: DataFrame) -> DataFrame:
    """Points per occupied cell, as ``n``."""
    return cells.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"))


def cell_stats(counts: DataFrame, grid: GridSpec = GridSpec()) -> DataFrame:
    """One row: ``total``, ``sum_sq``, and ``mean`` and ``std`` over all cells of the grid, empty ones included.

    ``sum_sq`` is a decimal, as squares of counts outgrow 64 bits first. The variance is
    the exact difference of two such products, so nothing cancels in it.
    """
    n = F.col("n").cast("decimal(19,0)")
    cells = F.lit(float(grid.num_cells))
    total, many = F.col("total").cast("decimal(19,0)"), F.lit(grid.num_cells).cast("decimal(6,0)")
    spread = (many * F.col("sum_sq")).cast("decimal(38,0)") - (total * total).cast("decimal(38,0)")
    return (
        counts.agg(F.sum("n").alias("total"), F.sum((n * n).cast("decimal(38,0)")).alias("sum_sq"))
        .withColumn("mean", F.col("total") / cells)
        .withColumn("std", F.sqrt(spread.cast("double")) / cells)
    )


def neighbor_sums(counts: DataFrame) -> DataFrame:
    """Per occupied cell, the points in the up to 27 cells around it, as ``neighbor_sum``.

    Each cell adds its count to its neighbours, itself included; a cell that got
    no count from itself is empty and drops out, so no join is needed.
    """
    own = (F.col("_dx") == 0) & (F.col("_dy") == 0) & (F.col("_dz") == 0)
    shifted = counts.select(*CELL, "n")
    for c in CELL:
        shifted = shifted.select("*", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias(f"_d{c}"))
    return (
        shifted.groupBy(*[(F.col(c) + F.col(f"_d{c}")).alias(c) for c in CELL])
        .agg(
            F.sum("n").alias("neighbor_sum"),
            F.sum(F.when(own, F.col("n"))).alias("n"),
        )
        .where(F.col("n").isNotNull())
        .select(*CELL, "n", "neighbor_sum")
    )


def getis_ord(counts: DataFrame, grid: GridSpec = GridSpec(), boundary: str = "exact") -> DataFrame:
    """G* score of every occupied cell: ``x, y, z, n, neighbor_sum, neighbors, z_score``."""
    stats = cell_stats(counts, grid)
    neighbors = st.neighbor_count(*[F.col(c) for c in CELL], grid, boundary)
    score = st.getis_ord(
        F.col("neighbor_sum"), F.col("neighbors"), grid.num_cells, F.col("_mean"), F.col("_std")
    )
    # The two scalars come from one pass over the same counts, whose shuffle is reused.
    return (
        neighbor_sums(counts)
        .withColumns(
            {
                "neighbors": neighbors,
                "_mean": stats.select("mean").scalar(),
                "_std": stats.select("std").scalar(),
            }
        )
        .withColumn("z_score", score)
        .drop("_mean", "_std")
    )


def ranked(scores: DataFrame) -> DataFrame:
    """Cells from hottest to coldest."""
    return scores.orderBy(F.col("z_score").desc_nulls_last(), F.desc("x"), F.asc("y"), F.desc("z"))


def top_cells(scores: DataFrame, k: int = 50) -> DataFrame:
    return ranked(scores).limit(k).select(*CELL)
