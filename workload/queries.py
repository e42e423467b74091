"""One query per operator, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridshard.functions.parsing import TIMESTAMP_PATTERN
from gridshard.functions.space_time import GridSpec
from gridshard.operators import cells, integrity, layouts, spatial
from gridshard.plans import hot_spots, ratings_layouts, schema_check
from gridshard.sources import clustered, text
from gridshard.sources.scratch import scratch_path
from workload import inputs

GRID = GridSpec()
RECT = (10.0, 20.0, 30.0, 60.0)
# Without width: by area, it accepts the whole line through it.
FLAT_RECT = (10.0, 20.0, 10.0, 60.0)
CENTER, RADIUS = (25.0, 45.0), 10.0
JOIN_DISTANCE = 2.0
RANGE_PARTS, ROBIN_PARTS = 10, 7


# Sources and sinks: the tables are written in the text format and read back.


def _written(spark: SparkSession, lines: DataFrame, name: str, sep: str | None = None) -> str:
    path = scratch_path(spark, name)
    if sep is None:
        lines.write.text(path)
    else:
        lines.write.option("sep", sep).csv(path)
    return path


def _trip_file(spark, sf_dir) -> str:
    unused = [F.lit("0").alias(f"u{i}") for i in range(3)]
    rows = inputs.trip_texts(spark, sf_dir).select("vendor", "time", *unused, "point")
    return _written(spark, rows, "trips", ";")


def src_points(spark, sf_dir):
    return text.scan_points(spark, _written(spark, inputs.point_texts(spark, sf_dir), "points", "\t"))


def src_rects(spark, sf_dir):
    path = _written(spark, inputs.rectangle_texts(spark, sf_dir), "rectangles", "\t")
    return text.scan_rectangles(spark, path)


def src_trips(spark, sf_dir):
    trips = text.scan_trips(spark, _trip_file(spark, sf_dir))
    return trips.select(F.date_format("time", TIMESTAMP_PATTERN).alias("time"), "lon", "lat")


def src_pickups(spark, sf_dir):
    return text.scan_pickups(spark, _trip_file(spark, sf_dir))


def load_ratings(spark, sf_dir):
    lines = _written(spark, inputs.rating_lines(spark, sf_dir), "ratings.dat")
    return ratings_layouts.load_ratings(spark, lines, scratch_path(spark, "ratings"))


def src_rejects(spark, sf_dir):
    """Rows and malformed rows of each text source."""
    scan = {"points": text.scan_points, "rectangles": text.scan_rectangles, "trips": text.scan_trips, "ratings": text.scan_ratings}
    lines = inputs.dirty_texts(spark, sf_dir)
    return text.reject_counts({name: scan[name](spark, _written(spark, df, name, sep)) for name, (df, sep) in lines.items()})


def sink_csv(spark, sf_dir):
    trips = _trip_file(spark, sf_dir)
    rects = _written(spark, inputs.rectangle_texts(spark, sf_dir), "rectangles", "\t")
    requests = [("hotcellanalysis", trips), ("hotzoneanalysis", trips, rects)]
    cell_path, zone_path = hot_spots.run_analyses(spark, scratch_path(spark, "result"), requests, "gzip")
    hot = spark.read.schema("a string, b string, c string").csv(cell_path)
    pairs = text.scan_csv_texts(spark, zone_path, "a", "b").withColumn("c", F.lit(None).cast("string"))
    return hot.withColumn("result", F.lit(0)).unionByName(pairs.withColumn("result", F.lit(1)))


# Spatial selections and joins.


def geo_range_select(spark, sf_dir):
    return spatial.range_select(inputs.points(spark, sf_dir), RECT)


def geo_range_select_compat(spark, sf_dir):
    return spatial.range_select(inputs.points(spark, sf_dir), FLAT_RECT, "compat")


def _clustered_points(spark, sf_dir):
    path = scratch_path(spark, "clustered")
    clustered.write_clustered(inputs.points(spark, sf_dir), path)
    return clustered.read_clustered(spark, path)


def geo_range_select_clustered(spark, sf_dir):
    """From points on storage in curve order, of which row groups outside the rectangle are not read."""
    return spatial.range_select(_clustered_points(spark, sf_dir), RECT)


def geo_distance_select_clustered(spark, sf_dir):
    return spatial.distance_select(_clustered_points(spark, sf_dir), CENTER, RADIUS)


def geo_distance_select(spark, sf_dir):
    return spatial.distance_select(inputs.points(spark, sf_dir), CENTER, RADIUS)


def geo_range_join(spark, sf_dir):
    pairs = spatial.range_join(inputs.points(spark, sf_dir), inputs.rectangles(spark, sf_dir))
    return pairs.select("rid", "l_orderkey", "l_linenumber", "x", "y")


def geo_range_join_shuffle(spark, sf_dir):
    """The way taken when the rectangles are too many to broadcast."""
    pairs = spatial.range_join(
        inputs.points(spark, sf_dir), inputs.rectangles(spark, sf_dir), strategy="shuffle"
    )
    return pairs.select("rid", "l_orderkey", "l_linenumber", "x", "y")


def geo_range_join_compat(spark, sf_dir):
    pairs = spatial.range_join(inputs.points(spark, sf_dir), inputs.flat_rectangles(spark, sf_dir), "compat")
    return pairs.select("rid", "l_orderkey", "l_linenumber", "x", "y")


def geo_distance_join(spark, sf_dir):
    return spatial.distance_join(
        inputs.customers(spark, sf_dir), inputs.suppliers(spark, sf_dir), JOIN_DISTANCE
    )


def geo_distance_join_shuffle(spark, sf_dir):
    return spatial.distance_join(
        inputs.customers(spark, sf_dir), inputs.suppliers(spark, sf_dir), JOIN_DISTANCE, "shuffle"
    )


def geo_range_select_count(spark, sf_dir):
    return spatial.count_rows(geo_range_select(spark, sf_dir))


def geo_distance_select_count(spark, sf_dir):
    return spatial.count_rows(geo_distance_select(spark, sf_dir))


def geo_range_join_count(spark, sf_dir):
    return spatial.range_join_count(inputs.points(spark, sf_dir), inputs.rectangles(spark, sf_dir))


def geo_range_join_count_shuffle(spark, sf_dir):
    points, rects = inputs.points(spark, sf_dir), inputs.rectangles(spark, sf_dir)
    return spatial.range_join_count(points, rects, strategy="shuffle")


def geo_distance_join_count_shuffle(spark, sf_dir):
    return spatial.distance_join_count(
        inputs.customers(spark, sf_dir), inputs.suppliers(spark, sf_dir), JOIN_DISTANCE, "shuffle"
    )


def geo_distance_join_count(spark, sf_dir):
    return spatial.distance_join_count(
        inputs.customers(spark, sf_dir), inputs.suppliers(spark, sf_dir), JOIN_DISTANCE
    )


def hot_zone_pairs(spark, sf_dir):
    return hot_spots.hot_zone_pairs(inputs.pickups(spark, sf_dir), inputs.zones(spark, sf_dir))


# Space-time cells.


def cell_assign(spark, sf_dir):
    return cells.assign_cells(inputs.trips(spark, sf_dir), GRID)


def cell_assign_doy(spark, sf_dir):
    return cells.assign_cells(inputs.trips(spark, sf_dir), GRID, z="day_of_year")


def cell_bounded(spark, sf_dir):
    return cells.bounded(cell_assign(spark, sf_dir), GRID)


def cell_counts(spark, sf_dir):
    return hot_spots.bounded_counts(inputs.trips(spark, sf_dir), GRID)


def cell_stats(spark, sf_dir):
    stats = cells.cell_stats(cell_counts(spark, sf_dir), GRID)
    # Null if it doesn't fit; the operator's own column does not overflow.
    stats = stats.withColumn("sum_sq", F.col("sum_sq").try_cast("bigint"))
    return stats.withColumns({"mean": F.round("mean", 9), "std": F.round("std", 9)})


def cell_neighbor_sums(spark, sf_dir):
    return cells.neighbor_sums(cell_counts(spark, sf_dir))


def _scores(spark, sf_dir, boundary):
    scores = cells.getis_ord(cell_counts(spark, sf_dir), GRID, boundary)
    return scores.withColumn("z_score", F.round("z_score", 6))


def getis_ord_scores(spark, sf_dir):
    return _scores(spark, sf_dir, "exact")


def getis_ord_scores_compat(spark, sf_dir):
    return _scores(spark, sf_dir, "compat")


def hot_cells_ranked(spark, sf_dir):
    return hot_spots.hot_cells(inputs.trips(spark, sf_dir), GRID)


def hot_cells_top50(spark, sf_dir):
    return hot_cells_ranked(spark, sf_dir).limit(50)


# Layouts.


def range_partition(spark, sf_dir):
    return layouts.range_partition(inputs.ratings(spark, sf_dir), RANGE_PARTS)


def range_partition_sizes(spark, sf_dir):
    return layouts.fragment_sizes(range_partition(spark, sf_dir), RANGE_PARTS)


def range_partition_bounds(spark, sf_dir):
    bounds = layouts.range_bounds(spark, RANGE_PARTS)
    sizes = range_partition_sizes(spark, sf_dir).withColumnRenamed("part_id", "partition_num")
    return bounds.join(sizes, "partition_num")


def range_append(spark, sf_dir):
    layout = scratch_path(spark, "range_layout")
    ratings_layouts.partition_by_range(inputs.ratings(spark, sf_dir), layout, RANGE_PARTS)
    ratings_layouts.append_by_range(inputs.rating_batch(spark, sf_dir), layout)
    return ratings_layouts.fragments(spark, layout)


def range_append_repeated(spark, sf_dir):
    """An append that is run again is there once; a batch of another id is another one."""
    layout = scratch_path(spark, "range_layout")
    ratings_layouts.partition_by_range(inputs.ratings(spark, sf_dir), layout, RANGE_PARTS)
    for batch_id in ("1", "2", "1", "2"):
        ratings_layouts.append_by_range(inputs.rating_batch(spark, sf_dir), layout, batch_id)
    return ratings_layouts.fragments(spark, layout)


def rr_partition(spark, sf_dir):
    return layouts.round_robin(inputs.ordered_ratings(spark, sf_dir), ROBIN_PARTS, ["movieid"])


def rr_partition_sizes(spark, sf_dir):
    return layouts.fragment_sizes(rr_partition(spark, sf_dir), ROBIN_PARTS)


def rr_state(spark, sf_dir):
    return layouts.round_robin_state(inputs.ordered_ratings(spark, sf_dir), ROBIN_PARTS)


def rr_append(spark, sf_dir):
    layout = scratch_path(spark, "robin_layout")
    order = ["movieid"]
    ratings_layouts.partition_round_robin(inputs.ordered_ratings(spark, sf_dir), layout, ROBIN_PARTS, order)
    ratings_layouts.append_round_robin(inputs.ordered_batch(spark, sf_dir), layout, order)
    return ratings_layouts.fragments(spark, layout)


def rr_append_repeated(spark, sf_dir):
    """The fragment sizes and the next fragment after appends of which one is run again."""
    layout, order = scratch_path(spark, "robin_layout"), ["movieid"]
    ratings_layouts.partition_round_robin(inputs.ordered_ratings(spark, sf_dir), layout, ROBIN_PARTS, order)
    for batch_id in ("1", "1"):
        ratings_layouts.append_round_robin(inputs.ordered_batch(spark, sf_dir), layout, order, batch_id)
    state = ratings_layouts.metadata(spark, layout)
    sizes = ratings_layouts.fragment_sizes(spark, layout, ROBIN_PARTS)
    return sizes.withColumns({c: state.select(c).scalar() for c in state.columns})


# Integrity rules.


def dq_not_null(spark, sf_dir):
    documents = inputs.table(spark, sf_dir, "documents").join(
        inputs.table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    return integrity.not_null(documents, ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"])


def dq_unique(spark, sf_dir):
    return integrity.unique(inputs.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_foreign_key(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders")
    return integrity.foreign_key(orders, "o_custkey", inputs.table(spark, sf_dir, "supplier"), "s_suppkey")


def dq_check(spark, sf_dir):
    customers = inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return integrity.check(customers, F.col("c_acctbal").between(0, 5000))


def dq_schema_report(spark, sf_dir):
    return schema_check.check_schema(inputs.schema_tables(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        src_points, src_rects, src_trips, src_pickups, src_rejects, load_ratings, sink_csv,
        geo_range_select, geo_range_select_compat, geo_distance_select,
        geo_range_select_clustered, geo_distance_select_clustered,
        geo_range_join, geo_range_join_shuffle, geo_range_join_compat,
        geo_distance_join, geo_distance_join_shuffle,
        geo_range_select_count, geo_distance_select_count,
        geo_range_join_count, geo_distance_join_count, hot_zone_pairs,
        geo_range_join_count_shuffle, geo_distance_join_count_shuffle,
        cell_assign, cell_assign_doy, cell_bounded, cell_counts, cell_stats,
        cell_neighbor_sums, getis_ord_scores, getis_ord_scores_compat,
        hot_cells_ranked, hot_cells_top50,
        range_partition, range_partition_sizes, range_partition_bounds, range_append, range_append_repeated,
        rr_partition, rr_partition_sizes, rr_state, rr_append, rr_append_repeated,
        dq_not_null, dq_unique, dq_foreign_key, dq_check, dq_schema_report,
    )
}
