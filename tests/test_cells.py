import math
import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridshard.functions import space_time as st
from gridshard.functions.space_time import GridSpec
from gridshard.operators import cells
from gridshard.plans import hot_spots


def counts_of(spark, counts):
    return spark.createDataFrame([(*c, n) for c, n in counts.items()], "x int, y int, z int, n long")


def test_grid_size():
    assert GridSpec().num_cells == 102951


@pytest.mark.parametrize(
    "cell,exact,compat",
    [
        ((-7400, 4060, 15), 27, 27),
        ((-7450, 4060, 15), 18, 18),
        ((-7370, 4060, 15), 18, 27),
        ((-7400, 4050, 15), 18, 27),
        ((-7400, 4090, 15), 18, 27),
        ((-7400, 4060, 1), 18, 27),
        ((-7450, 4060, 31), 12, 12),
        ((-7370, 4090, 31), 8, 18),
        ((-7450, 4050, 1), 8, 18),
    ],
)
def test_neighbor_counts(spark, cell, exact, compat):
    row = spark.createDataFrame([cell], "x int, y int, z int").select(
        *[st.neighbor_count(F.col("x"), F.col("y"), F.col("z"), GridSpec(), b).alias(b) for b in ("exact", "compat")]
    )
    assert tuple(row.first()) == (exact, compat)


def test_cells_of_trips(spark):
    rows = [
        (-73.985, 40.755, datetime(2009, 1, 14, 13, 4)),
        (-74.5, 40.5, datetime(2009, 12, 31, 0, 0)),
        (float("nan"), 40.5, datetime(2009, 2, 1)),
        (1e300, None, None),
    ]
    trips = spark.createDataFrame(rows, "lon double, lat double, time timestamp")
    assert [tuple(r) for r in cells.assign_cells(trips).collect()] == [
        (-7399, 4075, 14),
        (-7450, 4050, 31),
        (None, 4050, 1),
        (None, None, None),
    ]
    by_year = cells.assign_cells(trips, z="day_of_year").collect()
    assert [r.z for r in by_year] == [14, 365, 32, None]


def test_near_grid_keeps_every_bounded_cell(spark):
    grid = GridSpec()
    lon = [v / 1000 for v in range(-74520, -73680)]
    trips = spark.createDataFrame([(v, 40.7, datetime(2009, 1, 2)) for v in lon], "lon double, lat double, time timestamp")
    slow = cells.bounded(cells.assign_cells(trips, grid), grid)
    fast = cells.bounded(cells.assign_cells(cells.near_grid(trips, grid), grid), grid)
    assert fast.count() == slow.count() > 800


def brute_sums(counts):
    return {
        (x, y, z): sum(
            counts.get((x + i, y + j, z + k), 0) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)
        )
        for x, y, z in counts
    }


def test_neighbor_sums_equal_brute_force(spark):
    rng = random.Random(3)
    counts = Counter((rng.randint(0, 9), rng.randint(0, 9), rng.randint(1, 9)) for _ in range(900))
    got = {(r.x, r.y, r.z): r for r in cells.neighbor_sums(counts_of(spark, counts)).collect()}
    assert {c: r.neighbor_sum for c, r in got.items()} == brute_sums(counts)
    assert {c: r.n for c, r in got.items()} == dict(counts)


def test_scores_and_ranking_equal_brute_force(spark):
    rng = random.Random(4)
    grid = GridSpec(0, 9, 0, 9, 1, 9)
    counts = Counter((rng.randint(0, 9), rng.randint(0, 9), rng.randint(1, 9)) for _ in range(700))
    n = grid.num_cells
    mean = sum(counts.values()) / n
    std = (sum(v * v for v in counts.values()) / n - mean * mean) ** 0.5
    expected = {}
    for (x, y, z), total in brute_sums(counts).items():
        k = [27, 18, 12, 8][(x in (0, 9)) + (y in (0, 9)) + (z in (1, 9))]
        expected[x, y, z] = (total - mean * k) / (std * ((n * k - k * k) / (n - 1)) ** 0.5)
    scores = cells.getis_ord(counts_of(spark, counts), grid)
    got = {(r.x, r.y, r.z): r.z_score for r in scores.collect()}
    assert got == pytest.approx(expected)
    order = sorted(expected, key=lambda c: (-round(expected[c], 9), -c[0], c[1], -c[2]))
    assert [tuple(r) for r in cells.top_cells(scores, 20).collect()] == order[:20]


def test_equal_counts_everywhere_have_no_score(spark):
    grid = GridSpec(0, 1, 0, 1, 1, 2)
    counts = {(x, y, z): 3 for x in (0, 1) for y in (0, 1) for z in (1, 2)}
    assert [r.z_score for r in cells.getis_ord(counts_of(spark, counts), grid).collect()] == [None] * 8


def test_no_trips_give_no_cells(spark):
    trips = spark.createDataFrame([], "lon double, lat double, time timestamp")
    assert hot_spots.hot_cells(trips).collect() == []


def test_trips_are_read_once(spark, tmp_path):
    """Counts feed the sums and the statistics; the second use takes over the shuffle of the first."""
    path = str(tmp_path / "trips")
    spark.range(5000).selectExpr(
        "-74.2D + id % 50 / 100.0D AS lon", "40.6D + id % 20 / 100.0D AS lat", "timestamp_seconds(id * 7000) AS time"
    ).write.parquet(path)
    scores = cells.getis_ord(hot_spots.bounded_counts(spark.read.parquet(path)))
    scores.collect()
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
    pushed = plan.split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(lon,-74.51)" in pushed and "LessThanOrEqual(lat,40.92)" in pushed


def test_statistics_of_very_many_trips(spark):
    grid = GridSpec()
    one = cells.cell_stats(spark.createDataFrame([(0, 0, 1, 4 * 10**9)], "x int, y int, z int, n long")).first()
    assert one.sum_sq == 16 * 10**18
    assert one.std == pytest.approx(4e9 * math.sqrt((1 - 1 / grid.num_cells) / grid.num_cells))
    even = spark.range(grid.num_cells).select(F.lit(10**7).cast("long").alias("n"))
    row = cells.cell_stats(even).first()
    assert (row.total, row.sum_sq, row.mean, row.std) == (grid.num_cells * 10**7, grid.num_cells * 10**14, 1e7, 0.0)
