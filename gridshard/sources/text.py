"""Scans of the headerless text inputs, with explicit schemas.

Scans keep every row: text that does not parse gives null coordinates, times or
ratings. ``unparsed`` picks those rows out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridshard.functions.parsing import coordinate, parsed_once, strip_parens, timestamp_of


def scan_points(spark: SparkSession, path: str) -> DataFrame:
    """``point`` text ``"x,y"`` in the first tab separated field, as ``point, x, y``."""
    text = F.col("point")
    lines = spark.read.schema("point string").option("sep", "\t").csv(path)
    return parsed_once(lines, ["point"], {"x": coordinate(text, 0), "y": coordinate(text, 1)})


def scan_rectangles(spark: SparkSession, path: str) -> DataFrame:
    """``rectangle`` text ``"x1,y1,x2,y2"`` in the first tab separated field, with its four numbers."""
    text = F.col("rectangle")
    lines = spark.read.schema("rectangle string").option("sep", "\t").csv(path)
    corners = {name: coordinate(text, i) for i, name in enumerate(("x1", "y1", "x2", "y2"))}
    return parsed_once(lines, ["rectangle"], corners)


def _trip_fields(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(", ".join(f"_c{i} string" for i in range(6))).option("sep", ";").csv(path)


def scan_trips(spark: SparkSession, path: str) -> DataFrame:
    """Trips from ``;`` separated text: field 1 is the pickup time, field 5 ``"(lon,lat)"``.

    Gives ``time, lon, lat``.
    """
    point = strip_parens(F.col("_c5"))
    parsed = {"time": timestamp_of(F.col("_c1")), "lon": coordinate(point, 0), "lat": coordinate(point, 1)}
    return parsed_once(_trip_fields(spark, path), [], parsed)


def scan_pickups(spark: SparkSession, path: str) -> DataFrame:
    """Pickup places of a trips file: the ``point`` text without parentheses, and ``lon, lat``."""
    pickups = parsed_once(_trip_fields(spark, path), [], {"point": strip_parens(F.col("_c5"))})
    text = F.col("point")
    return parsed_once(pickups, ["point"], {"lon": coordinate(text, 0), "lat": coordinate(text, 1)})


def scan_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Ratings from ``userid::movieid::rating::timestamp`` text; the timestamp is not kept."""
    return (
        spark.read.schema("userid int, movieid int, rating float, timestamp long")
        .option("sep", "::")
        .csv(path)
        .select("userid", "movieid", "rating")
    )


def scan_csv_texts(spark: SparkSession, path: str, first: str, second: str) -> DataFrame:
    """Two text columns of CSV, as Spark's reader has them.

    Lines of two quoted texts without escapes or empty fields, which are most of what pairs of texts with commas are,
    are cut at their quotes; any other goes to the parser, which takes several times as long.
    """
    line, cut = F.col("value"), F.col("cut")
    # Its reader leaves out lines without a text.
    lines = spark.read.text(path).where(F.trim(line) != "").select(line, F.split(line, '"', 6).alias("cut"))
    a, b = cut[1], cut[3]
    quoted = (F.size(cut) == 5) & (cut[0] == "") & (cut[2] == ",") & (cut[4] == "")
    plain = quoted & (a != "") & (b != "") & ~F.contains(line, F.lit("\\"))
    parsed = F.from_csv(line, f"`{first}` string, `{second}` string")
    row = F.when(plain, F.struct(a.alias(first), b.alias(second))).otherwise(parsed)
    return lines.select(row.alias("row")).select(f"row.`{first}`", f"row.`{second}`")


def unparsed(scanned: DataFrame) -> DataFrame:
    """Rows of a scan in which some value is missing."""
    return scanned.where(_any_null(scanned.columns))


def _any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def reject_counts(scans: dict[str, DataFrame]) -> DataFrame:
    """``source, total, rejected`` of each scan: its rows, and those in which some value is missing."""
    counts = []
    for name, df in scans.items():
        bad = F.count_if(_any_null(df.columns))
        counts.append(df.agg(F.count(F.lit(1)).alias("total"), bad.alias("rejected")).select(F.lit(name).alias("source"), "*"))
    return reduce(DataFrame.unionByName, counts)
