"""CSV results and fragment tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CsvLines:
    """A result whose rows are lines of CSV already, in one text column."""

    lines: DataFrame


def csv_fields(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with ``columns`` as the CSV writer has them, quoted where they need it.

    A join that repeats rows then repeats finished fields, where the writer would look at every character of every pair.
    """
    # The writer gives no text at all for a row without one, so there is another field behind it that is cut off.
    rows = {c: F.to_csv(F.struct(F.col(f"`{c}`").alias("field"), F.lit("x").alias("end"))) for c in columns}
    return df.withColumns({c: F.substr(row, F.lit(1), F.length(row) - 2) for c, row in rows.items()})


def csv_lines(df: DataFrame) -> CsvLines:
    """Rows whose columns are ``csv_fields``."""
    comma = F.lit(",")
    fields = [f for c in df.columns for f in (comma, F.col(f"`{c}`"))]
    return CsvLines(df.select(F.concat(*fields[1:]).alias("line")))


def write_csv_results(results: list[DataFrame | CsvLines], prefix: str, compression: str = "none") -> list[str]:
    """One CSV folder per result: ``prefix`` followed by its position. Replaces what is there.

    ``compression`` is one of Spark's for CSV, which its readers know by the names of the files. Lists of pairs repeat
    themselves, so gzip leaves a small part of them, at its quickest too.
    """
    paths = [f"{prefix}{i}" for i in range(len(results))]
    for result, path in zip(results, paths):
        lines = isinstance(result, CsvLines)
        writer = (result.lines if lines else result).write.mode("overwrite").option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
        writer.text(path) if lines else writer.csv(path)
    return paths


def write_fragments(df: DataFrame, path: str) -> None:
    """Write rows to one folder per ``part_id``; rows without one keep a folder of their own.

    Rows are first gathered by fragment into files of even size, and a fragment that
    holds much of the table is split over many tasks. Adaptive execution does that, so it has to be on.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        raise ValueError("writing fragments needs spark.sql.adaptive.enabled")
    df.hint("rebalance", "part_id").write.partitionBy("part_id").parquet(path)
