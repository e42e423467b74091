import csv
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridshard.operators import integrity
from gridshard.plans import hot_spots, ratings_layouts, schema_check, spatial_queries
from gridshard.sources import scratch, sinks, text
from gridshard.sources.schemas import RATINGS_SCHEMA, TableSpec
from gridshard.sources.sinks import write_csv_results


def write(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture
def files(tmp_path):
    return {
        "points": write(tmp_path / "points", ["1,1\tnote", "2,1", "3.5,1e0", "1", "a,b", ",2", "0.5,1.5,9"]),
        "rects": write(tmp_path / "rects", ["0,0,2,2", "2,2,0,0", "1,1", "5,5,6,x"]),
        "trips": write(
            tmp_path / "trips",
            [
                "CMT;2009-01-14 13:04:00;a;b;c;(-73.985,40.755);x",
                "CMT;2009-01-14 12:30:00.250;a;b;c;(-73.985,40.755)",
                "CMT;2009-02-30 01:00:00;a;b;c;(-73.985,40.755)",
                "CMT;2009-03-15 00:00:00;a;b;c;(-73.975,40.755)",
                "CMT;soon;a;b;c;nowhere",
                "CMT;2009-03-15 00:00:00",
            ],
        ),
        "zones": write(tmp_path / "zones", ["-74,40.7,-73.98,40.8", "-73.98,40.7,-73.9,40.8"]),
    }


def test_points_and_rects(spark, files):
    points = text.scan_points(spark, files["points"])
    assert [(r.point, r.x, r.y) for r in points.collect()] == [
        ("1,1", 1.0, 1.0),
        ("2,1", 2.0, 1.0),
        ("3.5,1e0", 3.5, 1.0),
        ("1", 1.0, None),
        ("a,b", None, None),
        (",2", None, 2.0),
        ("0.5,1.5,9", 0.5, 1.5),
    ]
    assert text.unparsed(points).count() == 3
    rects = text.scan_rectangles(spark, files["rects"])
    assert text.unparsed(rects).count() == 2
    assert tuple(rects.first())[1:] == (0.0, 0.0, 2.0, 2.0)


def test_trips(spark, files):
    trips = text.scan_trips(spark, files["trips"])
    assert [r.time for r in trips.collect()] == [
        datetime(2009, 1, 14, 13, 4),
        datetime(2009, 1, 14, 12, 30),
        None,
        datetime(2009, 3, 15),
        None,
        datetime(2009, 3, 15),
    ]
    assert text.unparsed(trips).count() == 3
    pickups = text.scan_pickups(spark, files["trips"])
    assert [r.point for r in pickups.collect()] == ["-73.985,40.755"] * 3 + ["-73.975,40.755", "nowhere", None]


def test_text_is_parsed_below_the_filters(spark, files):
    found = text.scan_points(spark, files["points"]).where("x > 1 AND x < 3 AND y = 1")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("substring_index") <= 2


def test_spatial_queries_over_files(spark, files):
    assert spatial_queries.run_range_query(spark, files["points"], "0,0,2,2") == 3
    assert spatial_queries.run_range_join_query(spark, files["points"], files["rects"]) == 6
    assert spatial_queries.run_distance_query(spark, files["points"], "1,1", 1) == 3
    assert spatial_queries.run_distance_join_query(spark, files["points"], files["points"], 1) == 8
    with pytest.raises(ValueError):
        spatial_queries.run_range_query(spark, files["points"], "0,0,2")


def read_csv(path):
    rows = []
    for part in sorted(path.glob("part-*")):
        with open(part) as lines:
            rows += [tuple(r) for r in csv.reader(lines)]
    return rows


def test_named_analyses(spark, files, tmp_path):
    prefix = str(tmp_path / "out")
    hot_spots.run_analyses(
        spark, prefix, [("HotCellAnalysis", files["trips"]), ("hotzoneanalysis", files["trips"], files["zones"])]
    )
    assert read_csv(tmp_path / "out0") == [("-7398", "4075", "15"), ("-7399", "4075", "14")]
    assert sorted(read_csv(tmp_path / "out1")) == [
        ("-73.98,40.7,-73.9,40.8", "-73.975,40.755"),
        *[("-74,40.7,-73.98,40.8", "-73.985,40.755")] * 3,
    ]
    for bad in ([("coldcellanalysis", "x")], [("hotzoneanalysis", "x")], [("hotcellanalysis",)]):
        with pytest.raises(ValueError):
            hot_spots.run_analyses(spark, prefix, bad)


def test_load_ratings_replaces_the_table(spark, tmp_path):
    table = str(tmp_path / "table")
    first = write(tmp_path / "a.dat", ["1::10::4.5::978300760", "2::20::x::978300760", "3::30::5::978300760"])
    second = write(tmp_path / "b.dat", ["9::90::0.5::1"])
    loaded = ratings_layouts.load_ratings(spark, first, table)
    assert [f.dataType.simpleString() for f in loaded.schema] == ["int", "int", "float"]
    assert sorted(tuple(r) for r in loaded.where("rating IS NOT NULL").collect()) == [(1, 10, 4.5), (3, 30, 5.0)]
    assert text.unparsed(loaded).count() == 1
    assert [tuple(r) for r in ratings_layouts.load_ratings(spark, second, table).collect()] == [(9, 90, 0.5)]


def test_scratch_is_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = (scratch.scratch_path(spark, "t") for _ in range(2))
    assert one.startswith(base) and two.startswith(base) and one != two


def test_integrity_rules(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, None), (None, 9.0), (None, 9.0), (3, -1.0)], "k int, v double")
    nulls = {r.column_name: r.nulls for r in integrity.not_null(df, ["k", "v"]).collect()}
    assert nulls == {"k": 2, "v": 1}
    assert [tuple(r) for r in integrity.unique(df, ["k"]).collect()] == [(1, 2)]
    assert integrity.unique(df, ["k", "v"]).count() == 0
    parent = spark.createDataFrame([(1,), (1,), (None,)], "pk int")
    orphans = integrity.foreign_key(df, "k", parent, "pk").collect()
    assert sorted(tuple(r) for r in orphans) == [(2, 1), (3, 1)]
    bad = integrity.check(df, (F.col("v") >= 0) & (F.col("v") <= 5))
    assert sorted(r.v for r in bad.collect()) == [-1.0, 9.0, 9.0]


def test_schema_report(spark):
    rows = {
        "users": [(1, "ann"), (2, None), (2, "bob")],
        "movies": [(10, "m")],
        "taginfo": [(5, "t")],
        "genres": [(7, "g")],
        "ratings": [(1, 10, Decimal("5.5"), 1), (3, 10, Decimal("4.0"), 1), (3, 10, Decimal("4.0"), None)],
        "tags": [(1, 11, 5, None)],
        "hasagenre": [(10, 7), (10, 8)],
    }
    tables = {name: spark.createDataFrame(rows[name], spec.schema) for name, spec in RATINGS_SCHEMA.items()}
    report = {(r.table_name, r.rule, r.subject): r.violations for r in schema_check.check_schema(tables).collect()}
    assert len(report) == 31
    assert {k: v for k, v in report.items() if v} == {
        ("users", "not null", "name"): 1,
        ("users", "unique", "userid"): 2,
        ("ratings", "not null", "timestamp"): 1,
        ("ratings", "unique", "userid, movieid, rating"): 2,
        ("ratings", "foreign key", "userid -> users.userid"): 2,
        ("ratings", "check", "rating >= 0 AND rating <= 5"): 1,
        ("tags", "foreign key", "movieid -> movies.movieid"): 1,
        ("hasagenre", "foreign key", "genreid -> genres.genreid"): 1,
    }


def test_schema_report_reads_each_table_once_for_its_rules(spark, tmp_path):
    tables = {}
    for name, spec in RATINGS_SCHEMA.items():
        path = str(tmp_path / name)
        spark.createDataFrame([], spec.schema).write.parquet(path)
        tables[name] = spark.read.parquet(path)
    plan = schema_check.check_schema(tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 7


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_foreign_keys_of_integers(spark, monkeypatch, limit):
    """By bits of the known keys and by a join; limits of the type, both signs, other widths on either side."""
    monkeypatch.setattr(integrity, "KNOWN_ROWS", limit)
    edges = [0, -1, 1, 63, 64, -64, -65, 127, 2**31 - 1, -(2**31), 2**63 - 1, -(2**63), 10**15]
    parent = spark.createDataFrame([(k,) for k in edges] + [(None,), (0,)], "pk long").unionByName(spark.range(1000, 9000, 2).toDF("pk"))
    child = spark.createDataFrame([(k + d,) for k in edges for d in (-1, 0, 1) if -(2**63) <= k + d < 2**63] + [(None,)], "fk long")
    child = child.unionByName(spark.range(900, 9100).toDF("fk")).unionByName(spark.range(3).selectExpr("77L AS fk"))
    known = {r.pk for r in parent.collect()}
    expected = {}
    for (k,) in child.collect():
        if k is not None and k not in known:
            expected[k] = expected.get(k, 0) + 1
    got = integrity.foreign_key(child, "fk", parent, "pk")
    assert {r.fk: r.n for r in got.collect()} == expected
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("LeftAnti" in plan) == (limit == 0) and ("BroadcastHashJoin [_place" in plan) == (limit > 0)
    narrow = child.where("fk BETWEEN -1000 AND 9999").selectExpr("int(fk) AS fk")
    got = integrity.foreign_key(narrow, "fk", parent, "pk").collect()
    assert {r.fk: r.n for r in got} == {k: n for k, n in expected.items() if -1000 <= k <= 9999}


def test_only_violations_of_a_foreign_key_are_shuffled(spark):
    parent, child = spark.range(100_000).toDF("pk"), spark.range(0, 400_000).selectExpr("if(id % 100 = 0, id + 200000, id % 100000) AS fk")
    got = integrity.foreign_key(child, "fk", parent, "pk")
    place, _ = integrity._bit_of(F.col("_pk"))
    keyed = parent.select(F.col("pk").alias("_pk"))
    assert keyed.select(place).distinct().count() < 100_000 / 60
    plan = got._jdf.queryExecution().executedPlan().toString()
    # Of the child's rows, what goes through the one shuffle has met the broadcast keys before.
    child_side = plan[: plan.index("BroadcastExchange")]
    assert child_side.count("Exchange hashpartitioning") == 1 and child_side.index("Exchange hashpartitioning") < child_side.index("BroadcastHashJoin")
    assert got.count() == 4000 and got.agg(F.sum("n")).first()[0] == 4000


def test_schema_report_of_keys_of_all_types(spark):
    """Keys that share parts, signs of zero, NaN, wide decimals, texts that would run together, more flags than a number has bits."""
    many = [f"c{i}" for i in range(70)]
    specs = {
        "mixed": TableSpec("a string, b string, x double, d decimal(30,2), i int", (), (("a", "b"), ("x",), ("d", "a"), ("i", "x", "a", "b"))),
        "wide": TableSpec(", ".join(f"{c} int" for c in many), tuple(many), (), (), ("c0 > 0", "c1 > 0")),
        "names": TableSpec("name string, at timestamp", (), (("name", "at"),), (("name", "keys", "name"),)),
        "keys": TableSpec("name string", ("name",), (("name",),)),
    }
    nan, big = float("nan"), Decimal("1234567890123456789012345.67")
    rows = [("ab", "c", 0.0, big, 1), ("a", "bc", -0.0, big, 1), ("ab", "c", nan, big + 1, 2), ("1:a", None, nan, None, 2), (None, "1:a", None, big, 2)]
    tables = {
        "mixed": spark.createDataFrame(rows, specs["mixed"].schema),
        "wide": spark.createDataFrame([(None,) * 70, tuple(range(70)), (-1, *[None] * 69)], specs["wide"].schema),
        "names": spark.createDataFrame([("x", None), ("x", datetime(2020, 1, 1)), ("x", datetime(2020, 1, 1)), ("y", None), (None, None)], specs["names"].schema),
        "keys": spark.createDataFrame([("x",), ("z",), (None,)], specs["keys"].schema),
    }
    report = {(r.table_name, r.rule, r.subject): r.violations for r in schema_check.check_schema(tables, specs).collect()}
    assert len(report) == 4 + 72 + 2 + 2
    expected = {
        ("mixed", "unique", "a, b"): 2,
        ("mixed", "unique", "x"): 4,
        ("names", "unique", "name, at"): 2,
        ("names", "foreign key", "name -> keys.name"): 1,
        ("keys", "not null", "name"): 1,
        ("wide", "check", "c0 > 0"): 2,
        ("wide", "not null", "c0"): 1,
    } | {("wide", "not null", c): 2 for c in many[1:]}
    assert {k: v for k, v in report.items() if v} == expected


def test_results_of_pairs_take_little_space(spark, tmp_path):
    pairs = spark.range(20_000, numPartitions=1).selectExpr("concat_ws(',', id DIV 1000, 1, 2, 3) AS rectangle", "concat_ws(',', id % 10, 4) AS point")
    plain, packed = (write_csv_results([pairs], f"{tmp_path}/{c}", c)[0] for c in ("none", "gzip"))
    size = [sum(f.stat().st_size for f in Path(p).glob("part-*")) for p in (plain, packed)]
    assert size[1] * 20 < size[0]
    back = spark.read.schema("rectangle string, point string").csv(packed)
    assert back.exceptAll(pairs).isEmpty() and back.count() == 20_000


def test_csv_query_compresses_its_pairs(spark, monkeypatch):
    from workload import queries

    made = []
    run = queries.hot_spots.run_analyses
    monkeypatch.setattr(queries.hot_spots, "run_analyses", lambda *a: made.extend(run(*a)) or made)
    table = spark.range(40).selectExpr(
        "id AS l_orderkey", "id AS l_suppkey", "cast(id + 1 AS double) AS l_quantity", "timestamp '2009-01-01 00:00:00' AS l_shipdate", "id AS s_suppkey"
    )
    monkeypatch.setattr(queries.inputs, "table", lambda *_: table)
    assert queries.sink_csv(spark, "").where("result = 1").count() > 0
    assert list(Path(made[1]).glob("part-*.gz")) and not list(Path(made[1]).glob("part-*.csv"))


ODD_TEXTS = ["1,2", "a", "", None, 'say "hi", you', "back\\slash,", '\\"', " spaced , out ", "tab\tin", "é,ü", "#x,", '","', "'q'"]


def test_lines_of_finished_fields_are_those_of_the_csv_writer(spark, tmp_path):
    """And are read as Spark's reader has them, whichever way a line is taken."""
    rows = [(a, b) for a in ODD_TEXTS for b in ODD_TEXTS if a is not None or b is not None]
    pairs = spark.createDataFrame(rows, "a string, b string")
    lines = sinks.csv_lines(sinks.csv_fields(pairs, "a", "b"))
    ours, theirs = sinks.write_csv_results([lines, pairs], str(tmp_path / "r"), "gzip")
    assert list(Path(ours).glob("part-*.gz"))
    texts = [sorted(r.value for r in spark.read.text(path).collect()) for path in (ours, theirs)]
    assert texts[0] == texts[1]
    read = [text.scan_csv_texts(spark, ours, "a", "b"), spark.read.schema("a string, b string").csv(theirs)]
    assert [df.columns for df in read] == [["a", "b"]] * 2
    a, b = ([tuple(r) for r in df.collect()] for df in read)
    assert sorted(a, key=str) == sorted(b, key=str)
