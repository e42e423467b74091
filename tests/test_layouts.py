import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridshard.operators import layouts, numbering
from gridshard.plans import ratings_layouts
from gridshard.sources import batches

RATINGS = "userid int, movieid int, rating double"


def ratings_of(spark, values):
    return spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], RATINGS)


def parts(df):
    return [r.part_id for r in df.orderBy("movieid").collect()]


def test_range_parts_at_the_edges(spark):
    values = [0.0, 1.0, 1.1, 2.0, 5.0, -0.3, 5.5, None, float("nan"), 1e300, -1e300]
    df = ratings_of(spark, values)
    assert parts(layouts.range_partition(df, 5)) == [0, 0, 1, 1, 4] + [None] * 6
    assert parts(layouts.range_partition(df, 1)) == [0] * 5 + [None] * 6
    assert layouts.rejects(layouts.range_partition(df, 5)).count() == 6
    with pytest.raises(ValueError):
        layouts.range_partition(df, 0)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 9, 11, 50, 96, 200])
def test_range_parts_agree_with_the_bounds(spark, n):
    """Every value lies in the interval the metadata gives for its fragment."""
    df = ratings_of(spark, [i / 100 for i in range(501)] + [5.0 * i / n for i in range(n + 1)])
    placed = layouts.range_partition(df, n)
    bounds = layouts.range_bounds(spark, n)
    assert bounds.count() == n and bounds.agg(F.max("max_rating")).first()[0] == 5.0
    joined = placed.join(bounds, placed.part_id == bounds.partition_num)
    fits = (F.col("rating") <= F.col("max_rating")) & (
        (F.col("rating") > F.col("min_rating")) | ((F.col("part_id") == 0) & (F.col("rating") >= F.col("min_rating")))
    )
    assert joined.where(fits).count() == df.count()


def test_half_stars_as_floats(spark):
    df = ratings_of(spark, [i / 2 for i in range(11)]).withColumn("rating", F.col("rating").cast("float"))
    assert parts(layouts.range_partition(df, 5)) == [0, 0, 0, 1, 1, 2, 2, 3, 3, 4, 4]


def test_round_robin_deals_in_order(spark):
    df = ratings_of(spark, [1.0] * 7).orderBy(F.rand(1))
    assert parts(layouts.round_robin(df, 3, ["movieid"])) == [0, 1, 2, 0, 1, 2, 0]
    assert layouts.round_robin_state(df, 3).first().asDict() == {"partition_num": 3, "table_next_insert": 1}
    assert parts(layouts.round_robin(df.limit(2), 3, ["movieid"], start=1))[:2] == [1, 2]
    sizes = layouts.fragment_sizes(layouts.round_robin(df, 10, ["movieid"]), 10)
    assert {r.part_id: r.n for r in sizes.collect()} == {i: int(i < 7) for i in range(10)}


@pytest.mark.parametrize(
    "order_by", [["u"], ["k"], ["t", "k"], ["s"], ["d", "u"], ["same"]], ids=lambda o: "-".join(o)
)
@pytest.mark.parametrize("rows", [0, 1, 10, 20_000])
def test_row_numbers(spark, order_by, rows, monkeypatch):
    """Unique, tied, null, text and constant keys; a third of the rows are copies of one."""
    monkeypatch.setattr(numbering, "_ROWS_PER_BUCKET", 500)
    i = F.col("i")
    df = spark.range(rows).selectExpr("if(id % 3 = 0, 7, id) AS i").select(
        F.xxhash64(i).alias("u"),
        i.alias("k"),
        F.when(i % 5 > 0, F.timestamp_micros(i * 1_000_003)).alias("t"),
        F.concat(F.lit('"a\\'), i % 40).alias("s"),
        (i / 7).alias("d"),
        F.lit(1).alias("same"),
    )
    numbered = numbering.global_row_number(df, order_by)
    got = numbered.orderBy("row_num").collect()
    assert [r.row_num for r in got] == list(range(1, rows + 1))
    keys = [tuple((r[c] is not None, r[c]) for c in order_by) for r in got]
    assert all(a <= b for a, b in zip(keys, keys[1:]))
    assert Counter(tuple(r)[:-1] for r in got) == Counter(tuple(r) for r in df.collect())


def test_row_numbers_equal_a_plain_window(spark):
    df = spark.range(50_000).select(F.xxhash64("id").alias("k"), "id")
    df.createOrReplaceTempView("to_number")
    plain = spark.sql("SELECT id, row_number() OVER (ORDER BY k) AS row_num FROM to_number")
    ours = numbering.global_row_number(df, ["k"]).select("id", "row_num")
    assert ours.exceptAll(plain.withColumn("row_num", F.col("row_num").cast("long"))).isEmpty()


def test_row_numbers_split_a_hot_value(spark, monkeypatch):
    """No bucket comes near the third of the rows that share one key, copies or not."""
    monkeypatch.setattr(numbering, "_ROWS_PER_BUCKET", 1000)
    for extra in (F.col("id"), F.lit(0)):
        df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), extra.alias("v"))
        tagged = numbering._tag(df, ["k"], numbering._bounds(df, ["k"]))
        hot = F.pmod("_bucket", F.lit(2)) == 1
        assert tagged.where(~hot).groupBy("_bucket", "_sub").count().agg(F.max("count")).first()[0] < 9_000
        # What reaches a window task of the hot value are distinct rows.
        distinct = tagged.where(hot).distinct().groupBy("_bucket", "_sub").count()
        assert distinct.agg(F.max("count")).first()[0] < 9_000


def test_long_runs_of_copies_are_expanded_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(numbering, "_ROWS_PER_CHUNK", 100)
    monkeypatch.setattr(numbering, "_ROWS_PER_BUCKET", 10)
    df = spark.range(1000).select(F.when(F.col("id") < 950, 5).otherwise(F.col("id")).alias("k"))
    got = numbering.global_row_number(df, ["k"]).orderBy("row_num").collect()
    assert [r.row_num for r in got] == list(range(1, 1001))
    assert [r.k for r in got] == [5] * 950 + list(range(950, 1000))


def test_row_numbers_over_two_levels_of_buckets(spark, monkeypatch):
    """More buckets than constants in a plan: bounds within a bucket come from a table."""
    monkeypatch.setattr(numbering, "_ROWS_PER_BUCKET", 100)
    monkeypatch.setattr(numbering, "_FIRST_LEVEL", 8)
    i = F.col("i")
    df = spark.range(20_000).selectExpr("if(id % 3 = 0, 7, id * 37 % 20011) AS i").select(
        i, F.when(i % 5 > 0, (i / 100).cast("int")).alias("k"), F.concat(F.lit("s"), i).alias("s"), F.lit(1).alias("same")
    )
    for order_by in (["i"], ["k", "s"], ["s"], ["same"]):
        got = numbering.global_row_number(df, order_by).orderBy("row_num").collect()
        assert [r.row_num for r in got] == list(range(1, 20_001))
        keys = [tuple((r[c] is not None, r[c]) for c in order_by) for r in got]
        assert all(a <= b for a, b in zip(keys, keys[1:]))
        assert Counter(tuple(r)[:-1] for r in got) == Counter(tuple(r) for r in df.collect())
    tagged = numbering._tag(df, ["s"], numbering._bounds(df, ["s"]))
    sizes = tagged.where(F.pmod("_bucket", F.lit(2)) == 0).groupBy("_bucket", "_sub").count()
    assert sizes.count() > 60 and sizes.agg(F.max("count")).first()[0] < 600


@pytest.mark.parametrize("most", [256 << 20, 1000])
def test_rows_find_their_second_bucket_where_they_are(spark, monkeypatch, most):
    """No rows are shuffled for the bounds of the second level, in one piece or in several."""
    monkeypatch.setattr(numbering, "_ROWS_PER_BUCKET", 50)
    monkeypatch.setattr(numbering, "_FIRST_LEVEL", 8)
    monkeypatch.setattr(numbering, "_BROADCAST_BYTES", most)
    df = spark.range(20_000).select(F.sha1(F.col("id").cast("string")).alias("s"), "id")
    bounds = numbering._bounds(df, ["s"])
    assert (len(bounds.pieces) > 1) == (most == 1000)
    assert bounds.pieces[0][0] < 0 and all(a[1] + 1 == b[0] for a, b in zip(bounds.pieces, bounds.pieces[1:]))
    tagged = numbering._tag(df, ["s"], bounds)
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    got = numbering.global_row_number(df, ["s"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning(_bucket" in line]
    assert moved and all("_sub" in line for line in moved)
    rows = got.orderBy("row_num").collect()
    assert [r.row_num for r in rows] == list(range(1, 20_001)) and all(a.s < b.s for a, b in zip(rows, rows[1:]))


def test_row_numbers_by_nested_keys_are_refused(spark):
    df = spark.range(5).selectExpr("struct(id AS a) AS s", "array(id) AS l")
    for key in ("s", "l"):
        with pytest.raises(ValueError, match="plain columns"):
            numbering.global_row_number(df, [key])


def test_row_numbers_with_a_map_column(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.create_map(F.lit("a"), F.col("id") % 7).alias("m"))
    got = numbering.global_row_number(df, ["k"]).orderBy("row_num").collect()
    assert [r.row_num for r in got] == list(range(1, 101))
    assert Counter((r.k, r.m["a"]) for r in got) == Counter((r.k, r.m["a"]) for r in df.collect())


def test_numbering_uses_one_task_only_for_bucket_counts(spark):
    df = spark.range(10_000).select(F.xxhash64("id").alias("k"), "id")
    plan = numbering.global_row_number(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1
    single = plan[plan.index("SinglePartition"):]
    assert single.split("\n")[1].strip(" :+-").startswith("HashAggregate")


def test_range_layout_on_storage(spark, tmp_path):
    layout = str(tmp_path / "range")
    ratings_layouts.partition_by_range(ratings_of(spark, [0.0, 1.0, 1.1, 5.0, 9.9]), layout, 5)
    ratings_layouts.append_by_range(spark.createDataFrame([(2, 10, 4.9), (2, 11, 0.5), (2, 12, -1.0)], RATINGS), layout)
    stored = ratings_layouts.fragments(spark, layout)
    assert stored.columns == ["userid", "movieid", "rating", "part_id"]
    assert Counter(r.part_id for r in stored.collect()) == {0: 3, 1: 1, 4: 2, None: 2}
    assert [(r.partition_num, r.min_rating) for r in ratings_layouts.metadata(spark, layout).orderBy("partition_num").collect()] == [
        (i, float(i)) for i in range(5)
    ]
    sizes = ratings_layouts.fragment_sizes(spark, layout, 5).orderBy("part_id").collect()
    assert [r.n for r in sizes] == [3, 1, 0, 0, 2]
    one = stored.where("part_id = 4")._jdf.queryExecution().executedPlan().toString()
    assert "part_id" in one.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_round_robin_layout_on_storage(spark, tmp_path):
    layout = str(tmp_path / "robin")
    ratings_layouts.partition_round_robin(ratings_of(spark, [1.0] * 7), layout, 3, ["movieid"])
    assert ratings_layouts.metadata(spark, layout).first().table_next_insert == 1
    batch = spark.createDataFrame([(2, 100, 1.0), (2, 101, 1.0)], RATINGS)
    ratings_layouts.append_round_robin(batch, layout, ["movieid"])
    assert parts(ratings_layouts.fragments(spark, layout)) == [0, 1, 2, 0, 1, 2, 0, 1, 2]
    assert ratings_layouts.metadata(spark, layout).first().table_next_insert == 0


@pytest.mark.parametrize("n", [5, 16, 17, 50])
def test_fragments_are_gathered_before_writing(spark, tmp_path, n):
    layout = str(tmp_path / "many")
    ratings_layouts.partition_by_range(ratings_of(spark, [i / 100 for i in range(501)]).repartition(40), layout, n)
    files = [p for p in (tmp_path / "many" / "data").rglob("*.parquet")]
    assert n <= len(files) <= 2 * n
    assert ratings_layouts.fragments(spark, layout).count() == 501


def test_writing_fragments_needs_adaptive_execution(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(ValueError, match="adaptive"):
            ratings_layouts.partition_by_range(ratings_of(spark, [1.0]), str(tmp_path / "layout"), 2)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


class Killed(Exception):
    pass


def robin(spark, tmp_path):
    layout = str(tmp_path / "robin")
    ratings_layouts.partition_round_robin(ratings_of(spark, [1.0] * 7), layout, 3, ["movieid"])
    return layout, spark.createDataFrame([(2, 100 + i, 1.0) for i in range(5)], RATINGS)


@pytest.mark.parametrize("moment", ["before data", "before the commit", "after the commit"])
@pytest.mark.parametrize("kind", ["range", "round_robin"])
def test_an_append_that_died_can_be_repeated(spark, tmp_path, monkeypatch, kind, moment):
    if kind == "range":
        layout = str(tmp_path / "range")
        ratings_layouts.partition_by_range(ratings_of(spark, [0.0, 1.1, 5.0, 9.9]), layout, 5)
        batch = ratings_of(spark, [0.1, 2.5, 7.0])

        def append():
            ratings_layouts.append_by_range(batch, layout, "day 1")
    else:
        layout, batch = robin(spark, tmp_path)

        def append():
            ratings_layouts.append_round_robin(batch, layout, ["movieid"], "day 1")

    def state():
        return Counter(map(tuple, ratings_layouts.fragments(spark, layout).collect())), ratings_layouts.metadata(spark, layout).collect()

    commit, write = batches._commit, batches.write_fragments

    def dies(*args):
        if moment == "after the commit":
            commit(*args)
        raise Killed

    before = state()
    with monkeypatch.context() as m, pytest.raises(Killed):
        m.setattr(*((batches, "write_fragments", dies) if moment == "before data" else (batches, "_commit", dies)))
        append()
    if moment != "after the commit":
        assert state() == before
    assert batches.write_fragments is write
    append()
    after = state()
    append()
    assert state() == after
    assert after[0].total() == before[0].total() + batch.count()
    batches.remove_unread(spark, layout)
    assert state() == after


def test_a_process_killed_between_data_and_commit(spark, tmp_path):
    layout, batch = robin(spark, tmp_path)
    batch.write.parquet(str(tmp_path / "batch"))
    script = f"""
import os
from pyspark.sql import SparkSession
from gridshard.plans import ratings_layouts
from gridshard.sources import batches
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
batches._commit = lambda *args: os._exit(9)
ratings_layouts.append_round_robin(spark.read.parquet({str(tmp_path / "batch")!r}), {layout!r}, ["movieid"], "b")
"""
    done = subprocess.run([sys.executable, "-c", script], cwd=Path(__file__).resolve().parent.parent, capture_output=True, timeout=300)
    assert done.returncode == 9
    assert len(list((tmp_path / "robin" / "data").iterdir())) == 2
    assert ratings_layouts.fragments(spark, layout).count() == 7
    ratings_layouts.append_round_robin(batch, layout, ["movieid"], "b")
    assert parts(ratings_layouts.fragments(spark, layout)) == [i % 3 for i in range(12)]
    batches.remove_unread(spark, layout)
    assert len(list((tmp_path / "robin" / "data").iterdir())) == 2
    assert ratings_layouts.fragments(spark, layout).count() == 12


def test_of_two_batches_dealt_at_once_one_fails(spark, tmp_path):
    layout, batch = robin(spark, tmp_path)
    known = batches.committed(spark, layout)
    dealt = layouts.round_robin(batch, 3, ["movieid"], 1)
    batches.add_batch(dealt, layout, "one", known)
    with pytest.raises(batches.CommitConflict):
        batches.add_batch(dealt, layout, "two", known)
    assert [b.batch_id for b in batches.committed(spark, layout)][1:] == ["one"]
    ratings_layouts.append_round_robin(batch.selectExpr("userid", "movieid + 50 AS movieid", "rating"), layout, ["movieid"], "two")
    assert parts(ratings_layouts.fragments(spark, layout)) == [i % 3 for i in range(17)]


def test_partitioning_again_replaces_all_batches(spark, tmp_path):
    layout, batch = robin(spark, tmp_path)
    ratings_layouts.append_round_robin(batch, layout, ["movieid"], "b")
    with pytest.raises(ValueError, match="round_robin"):
        ratings_layouts.append_by_range(batch, layout)
    ratings_layouts.partition_by_range(ratings_of(spark, [0.5, 4.5]), layout, 2)
    assert parts(ratings_layouts.fragments(spark, layout)) == [0, 1]
    assert ratings_layouts.metadata(spark, layout).count() == 2
    batches.remove_unread(spark, layout)
    assert len(list((tmp_path / "robin" / "data").iterdir())) == 1
    assert parts(ratings_layouts.fragments(spark, layout)) == [0, 1]


def test_empty_batches_and_batches_of_other_types(spark, tmp_path):
    layout = str(tmp_path / "range")
    with pytest.raises(ValueError, match="not a layout"):
        ratings_layouts.append_by_range(ratings_of(spark, [1.0]), layout)
    ratings_layouts.partition_by_range(ratings_of(spark, []), layout, 2)
    assert ratings_layouts.fragments(spark, layout).columns == ["userid", "movieid", "rating", "part_id"]
    assert ratings_layouts.fragments(spark, layout).count() == 0
    ratings_layouts.append_by_range(ratings_of(spark, []), layout, "nothing")
    ratings_layouts.append_by_range(ratings_of(spark, [1.0]).selectExpr("bigint(movieid) AS movieid", "bigint(1) AS userid", "float(rating) AS rating"), layout)
    assert [tuple(r) for r in ratings_layouts.fragments(spark, layout).collect()] == [(1, 0, 1.0, 0)]
    with pytest.raises(ValueError, match="columns"):
        ratings_layouts.append_by_range(ratings_of(spark, [1.0]).withColumn("more", F.lit(1)), layout)
    assert [b.rows for b in batches.committed(spark, layout)] == [0, 0, 1]
