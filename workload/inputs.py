"""Driver tables read as points, rectangles, trips and ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridshard.functions.parsing import coordinate, parsed_once, strip_parens


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1e3).alias("y")
    )


def rectangles(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS rid",
        "cast(s_suppkey % 45 AS double) AS x1",
        "cast((s_suppkey * 7) % 100 AS double) AS y1",
        "cast(s_suppkey % 45 + 5 AS double) AS x2",
        "cast((s_suppkey * 7) % 100 + 10 AS double) AS y2",
    )


def flat_rectangles(spark, sf_dir) -> DataFrame:
    """Rectangles that tell containment by area from containment by coordinates: some without width
    or height, one that is a point, and some whose edge misses whole numbers by 1e-12."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS rid",
        "s_suppkey % 45 + if(s_suppkey % 10 = 2, 1e-12D, 0D) AS x1",
        "cast((s_suppkey * 7) % 100 AS double) AS y1",
        "s_suppkey % 45 + if(s_suppkey % 10 = 0 OR s_suppkey = 5, 0D, 5D) AS x2",
        "(s_suppkey * 7) % 100 + if(s_suppkey % 10 = 1 OR s_suppkey = 5, 0D, 10D) AS y2",
    )


def customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id1", "c_acctbal / 1e2 AS x1", "cast(c_nationkey AS double) AS y1"
    )


def suppliers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS id2", "s_acctbal / 1e2 AS x2", "cast(s_nationkey AS double) AS y2"
    )


def point_texts(spark, sf_dir, *more: str) -> DataFrame:
    """One ``"x,y"`` text per line item."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat(cast(cast(l_quantity AS int) AS string), ',',"
        " cast(cast(l_extendedprice / 1e3 AS decimal(10,5)) AS string)) AS point",
        *more,
    )


def rectangle_texts(spark, sf_dir, *more: str) -> DataFrame:
    """One zone ``"x1,y1,x2,y2"`` in degrees per supplier."""

    def degrees(hundredths: str) -> str:
        return f"cast(cast(cast({hundredths} AS double) / 1e2 AS decimal(8,2)) AS string)"

    return table(spark, sf_dir, "supplier").selectExpr(
        "concat_ws(',', "
        + ", ".join(
            [
                degrees("-7450 + s_suppkey % 40"),
                degrees("4050 + (s_suppkey * 7) % 40"),
                degrees("-7447 + s_suppkey % 40"),
                degrees("4054 + (s_suppkey * 7) % 40"),
            ]
        )
        + ") AS rectangle",
        *more,
    )


def trip_texts(spark, sf_dir, *more: str) -> DataFrame:
    """Pickup time and ``"(lon,lat)"`` per line item, as texts."""
    lon = "cast(cast(-74.52e0 + 1e-2 * l_quantity + 5e-3 AS decimal(8,3)) AS string)"
    lat = "cast(cast(40.48e0 + 1e-2 * (l_suppkey % 45) + 5e-3 AS decimal(8,3)) AS string)"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss') AS time",
        f"concat('(', {lon}, ',', {lat}, ')') AS point",
        "cast(l_orderkey AS string) AS vendor",
        *more,
    )


def dirty_texts(spark, sf_dir) -> dict[str, tuple[DataFrame, str]]:
    """Lines of each text source and their separator; some are malformed."""
    points = point_texts(spark, sf_dir, "l_linenumber").selectExpr(
        "CASE l_linenumber WHEN 5 THEN '' WHEN 6 THEN '1' WHEN 7 THEN 'a,b' ELSE point END AS point"
    )
    rects = rectangle_texts(spark, sf_dir, "s_suppkey").selectExpr("if(s_suppkey % 7 = 0, '1,2,3', rectangle) AS rectangle")
    trips = trip_texts(spark, sf_dir, "l_linenumber").selectExpr(
        "vendor",
        "if(l_linenumber = 7, '2009-02-30 01:00:00', time) AS time",
        "'0' AS u0", "'0' AS u1", "'0' AS u2",
        "if(l_linenumber = 6, '(1)', point) AS point",
    )
    ratings = rating_lines(spark, sf_dir, "l_linenumber").selectExpr(
        "CASE l_linenumber WHEN 6 THEN '1::2' WHEN 7 THEN 'x::y::z::t' ELSE line END AS line"
    )
    return {"points": (points, "\t"), "rectangles": (rects, "\t"), "trips": (trips, ";"), "ratings": (ratings, "\t")}


def trips(spark, sf_dir) -> DataFrame:
    """Trips with numeric coordinates."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_shipdate AS time",
        "-74.52e0 + 1e-2 * l_quantity + 5e-3 AS lon",
        "40.48e0 + 1e-2 * (l_suppkey % 45) + 5e-3 AS lat",
    )


def pickups(spark, sf_dir) -> DataFrame:
    places = parsed_once(trip_texts(spark, sf_dir), [], {"point": strip_parens(F.col("point"))})
    text = F.col("point")
    return parsed_once(places, ["point"], {"lon": coordinate(text, 0), "lat": coordinate(text, 1)})


def zones(spark, sf_dir) -> DataFrame:
    corners = {name: coordinate(F.col("rectangle"), i) for i, name in enumerate(("x1", "y1", "x2", "y2"))}
    return parsed_once(rectangle_texts(spark, sf_dir), ["rectangle"], corners)


def ratings(spark, sf_dir) -> DataFrame:
    """Ratings 0.1 to 5.0 in tenths."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey AS userid", "l_partkey AS movieid", "l_quantity / 1e1 AS rating"
    )


def rating_batch(spark, sf_dir) -> DataFrame:
    """A batch to append; some of its ratings are above 5."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS userid", "o_orderkey AS movieid", "o_totalprice / 9e4 AS rating"
    )


def ordered_ratings(spark, sf_dir) -> DataFrame:
    """Ratings whose ``movieid`` is unique, as a total order."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS userid", "o_orderkey AS movieid", "o_totalprice / 1e5 AS rating"
    )


def ordered_batch(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "user_id AS userid", "event_id AS movieid", "value / 1e2 AS rating"
    )


def rating_lines(spark, sf_dir, *more: str) -> DataFrame:
    """Lines ``userid::movieid::rating::timestamp`` with half-star ratings."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat_ws('::', cast(l_suppkey AS string), cast(l_partkey AS string),"
        " cast(cast(round(l_discount * 100) / 2 AS decimal(3,1)) AS string),"
        " cast(unix_timestamp(l_shipdate) AS string)) AS line",
        *more,
    )


def schema_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """Driver tables in the places of the movie-ratings schema."""

    def read(name: str, *columns: str) -> DataFrame:
        return table(spark, sf_dir, name).selectExpr(*columns)

    return {
        "users": read("customer", "c_custkey AS userid", "c_name AS name"),
        "movies": read("part", "p_partkey AS movieid", "p_name AS title"),
        "taginfo": read("nation", "n_nationkey AS tagid", "n_name AS content"),
        "genres": read("region", "r_regionkey AS genreid", "r_name AS name"),
        "ratings": read(
            "lineitem",
            "l_suppkey AS userid",
            "l_partkey AS movieid",
            "l_quantity / 9e0 AS rating",
            "l_shipdate AS timestamp",
        ),
        "tags": read(
            "events",
            "user_id AS userid",
            "event_id AS movieid",
            "cast(floor(value / 1e1) AS bigint) AS tagid",
            "ts AS timestamp",
        ),
        "hasagenre": read("part", "p_partkey AS movieid", "p_size AS genreid"),
    }
