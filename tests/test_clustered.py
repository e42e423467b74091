import math
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridshard.operators import spatial
from gridshard.sources import clustered


def interleaved(x, y):
    return sum(((x >> b & 1) | (y >> b & 1) << 1) << 2 * b for b in range(24))


def test_places_interleave_the_bits(spark):
    rng = random.Random(1)
    rows = [(float(rng.randrange(1 << 24)), float(rng.randrange(1 << 24))) for _ in range(300)] + [(0.0, 0.0), (2.0**24, 2.0**24)]
    df = spark.createDataFrame(rows, "x double, y double")
    got = df.select("x", "y", clustered.curve_place(F.col("x"), F.col("y"), (0.0, 0.0, 2.0**24, 2.0**24)).alias("p")).collect()
    assert all(r.p == interleaved(*(min(int(v), 2**24 - 1) for v in r[:2])) for r in got)


def scattered(spark, n=60_000):
    return spark.range(n, numPartitions=6).select(
        "id", (F.rand(1) * 360 - 180).alias("x"), (F.rand(2) * 180 - 90).alias("y"), F.sha2(F.col("id").cast("string"), 256).alias("carried")
    )


def row_groups(path, box):
    """All row groups, and those whose statistics meet a box."""
    every = met = 0
    for file in path.rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            x, y = (meta.row_group(g).column(names.index(c)).statistics for c in "xy")
            every += 1
            met += x.min <= box[2] and x.max >= box[0] and y.min <= box[3] and y.max >= box[1]
    return every, met


def scanned_rows(df):
    """Rows that the scan handed on: those of the row groups it read."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        node = leaves.apply(i)
        nodes = node.executedPlan().collectLeaves() if node.nodeName() == "AdaptiveSparkPlan" else None
        found += [nodes.apply(k) for k in range(nodes.size())] if nodes else [node]
    return sum(n.metrics().apply("numOutputRows").value() for n in found)


def test_a_box_reads_a_fraction_of_the_row_groups(spark, tmp_path):
    points = scattered(spark)
    points.write.parquet(str(tmp_path / "plain"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        clustered.write_clustered(points, str(tmp_path / "clustered"), row_group_bytes=50_000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    box = (-20.0, -10.0, 5.0, 12.0)
    every, met = row_groups(tmp_path / "clustered", box)
    assert every >= 20 and met <= every / 4
    assert row_groups(tmp_path / "plain", box)[0] == row_groups(tmp_path / "plain", box)[1]
    plain = spatial.range_select(points, box)
    found = spatial.range_select(clustered.read_clustered(spark, str(tmp_path / "clustered")), box)
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty() and plain.count() > 100
    assert scanned_rows(found) < 60_000 / 3
    near = spatial.distance_select(clustered.read_clustered(spark, str(tmp_path / "clustered")), (100.0, 50.0), 8.0)
    assert near.count() == spatial.distance_select(points, (100.0, 50.0), 8.0).count() > 10
    assert scanned_rows(near) < 60_000 / 3


@pytest.mark.parametrize("rows", [[], [(None, 1.0)], [(1.0, 2.0)] * 500, [(-1.7e308, 5.0), (1.7e308, 5.0), (math.nan, 0.0), (0.0, math.inf), (0.0, -0.0)]])
def test_every_row_is_written_once(spark, tmp_path, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, x double, y double").withColumn("m", F.create_map(F.lit("a"), "id"))
    path = str(tmp_path / "points")
    for _ in range(2):
        clustered.write_clustered(df, path)
    back = clustered.read_clustered(spark, path)
    assert back.columns == df.columns
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_copies_of_a_point_are_split(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        clustered.write_clustered(spark.range(8000).selectExpr("id", "1D AS x", "2D AS y"), str(tmp_path / "points"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in (tmp_path / "points").rglob("*.parquet")]
    assert len(sizes) == 8 and max(sizes) < 2000
