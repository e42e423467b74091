"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data
and cores. Every query runs once to warm up and BENCH_RUNS times (default 3) for the
median, from building the DataFrame to the last row in a no-op sink. ``--shapes``
also times the straightforward form of the rewritten operators (see README).
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from workload import inputs, queries as wq  # noqa: E402

HEADLINE = (
    "geo_range_select", "geo_distance_select", "geo_range_join", "geo_range_join_count",
    "geo_distance_join", "geo_distance_join_count", "hot_zone_pairs", "cell_counts",
    "cell_neighbor_sums", "getis_ord_scores", "hot_cells_top50", "range_partition",
    "range_partition_sizes", "rr_partition", "dq_not_null", "dq_unique", "dq_foreign_key", "dq_check",
    "geo_range_join_shuffle", "geo_distance_join_shuffle", "geo_range_join_count_shuffle", "rr_append", "dq_schema_report",
)


def nested_range_join(spark, sf_dir):
    rects = F.broadcast(inputs.rectangles(spark, sf_dir))
    inside = F.expr("x BETWEEN x1 AND x2 AND y BETWEEN y1 AND y2")
    return inputs.points(spark, sf_dir).join(rects, inside)


def nested_distance_join(spark, sf_dir):
    near = F.expr("sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) <= 2.0D")
    return inputs.customers(spark, sf_dir).join(F.broadcast(inputs.suppliers(spark, sf_dir)), near)


def nested_neighbor_sums(spark, sf_dir):
    counts = wq.cell_counts(spark, sf_dir)
    other = counts.selectExpr("x AS x2", "y AS y2", "z AS z2", "n AS n2")
    near = F.expr("abs(x2 - x) <= 1 AND abs(y2 - y) <= 1 AND abs(z2 - z) <= 1")
    return counts.join(other, near).groupBy("x", "y", "z").agg(F.sum("n2").alias("neighbor_sum"))


def single_task_round_robin(spark, sf_dir):
    inputs.ordered_ratings(spark, sf_dir).createOrReplaceTempView("bench_ratings")
    return spark.sql(
        f"SELECT *, (row_number() OVER (ORDER BY movieid) - 1) % {wq.ROBIN_PARTS} AS part_id FROM bench_ratings"
    )


def scan_per_fragment(spark, sf_dir):
    ratings = inputs.ratings(spark, sf_dir)
    n, parts = wq.RANGE_PARTS, None
    for i in range(n):
        low, high = 5.0 * i / n, 5.0 * (i + 1) / n
        above = F.col("rating") >= low if i == 0 else F.col("rating") > low
        part = ratings.where(above & (F.col("rating") <= high)).withColumn("part_id", F.lit(i))
        parts = part if parts is None else parts.unionByName(part)
    return parts


def nested_range_count(spark, sf_dir):
    return nested_range_join(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


def nested_distance_count(spark, sf_dir):
    return nested_distance_join(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


SHAPES = {
    "geo_range_join_count": nested_range_count,
    "geo_distance_join_count": nested_distance_count,
    "geo_range_join": nested_range_join,
    "geo_distance_join": nested_distance_join,
    "cell_neighbor_sums": nested_neighbor_sums,
    "rr_partition": single_task_round_robin,
    "range_partition": scan_per_fragment,
}


def seconds(query, spark, sf_dir, runs):
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gridshard-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed = {name: seconds(wq.QUERIES[name], spark, sf_dir, runs) for name in HEADLINE}
    result = {
        "metric": "total_query_time",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    if "--shapes" in sys.argv:
        result["straightforward"] = {
            name: seconds(shape, spark, sf_dir, 1) for name, shape in SHAPES.items()
        }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
