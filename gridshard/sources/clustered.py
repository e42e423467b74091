"""Points on storage in the order of a space-filling curve, so that a box reads few row groups.

A point's place on the curve interleaves the bits of its x and y, each as its place among 2^24 steps of the
extent of all points. Points are range-partitioned and sorted by it: a file, and a row group of it, holds
points of a few neighbouring squares, and its statistics are narrow on both axes. The boxes that selections and joins push to the
scan then leave out the row groups elsewhere.

Points without finite coordinates are in no box; they come first. Copies of a point have one place: it is split
over partitions by a hash of the whole row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridshard.functions.parsing import is_finite

_STEPS = 1 << 24
# Rows that reach a row group together before its size is looked at: small groups have narrow statistics.
ROW_GROUP_BYTES = 8 << 20
# Masks that leave 16, 8, 4, 2 and 1 bits together, each with as much room after them.
_SPREAD = tuple((s, sum(((1 << s) - 1) << i for i in range(0, 64, 2 * s)) & ((1 << 63) - 1)) for s in (16, 8, 4, 2, 1))


def _with_gaps(number: Column) -> Column:
    """The bits of a number below 2^31, each followed (to the left) by a 0."""
    bits = number
    for step, mask in _SPREAD:
        bits = bits.bitwiseOR(F.shiftleft(bits, step)).bitwiseAND(F.lit(mask).cast("long"))
    return bits


def curve_place(x: Column, y: Column, extent: tuple[float, float, float, float]) -> Column:
    """Place on the curve of a finite point within ``extent`` (lowest x and y, highest x and y); null for other points."""

    def step(value: Column, low: float, high: float) -> Column:
        # Halved, so that an extent of all doubles has a width.
        width = high / 2 - low / 2
        at = F.lit(0.0) if width == 0 else (value / 2 - F.lit(low / 2)) / F.lit(width) * F.lit(float(_STEPS))
        return F.least(F.greatest(at, F.lit(0.0)), F.lit(float(_STEPS - 1))).cast("long")

    place = _with_gaps(step(x, extent[0], extent[2])).bitwiseOR(F.shiftleft(_with_gaps(step(y, extent[1], extent[3])), 1))
    return F.when(is_finite(x) & is_finite(y), place)


def write_clustered(points: DataFrame, path: str, x: str = "x", y: str = "y", row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Writes ``points`` in curve order, replacing what is there. Adaptive execution sizes the files."""
    finite = points.where(is_finite(F.col(x)) & is_finite(F.col(y)))
    extent = finite.agg(F.min(x), F.min(y), F.max(x), F.max(y)).first()
    place = curve_place(F.col(x), F.col(y), tuple(extent)) if extent[0] is not None else F.lit(None).cast("long")
    plain = [f.name for f in points.schema.fields if not isinstance(f.dataType, T.MapType)]
    placed = points.withColumns({"_place": place, "_tie": F.xxhash64(*plain)})
    dealt = placed.repartitionByRange("_place", "_tie").sortWithinPartitions("_place").drop("_place", "_tie")
    dealt.write.mode("overwrite").option("parquet.block.size", row_group_bytes).parquet(path)


def read_clustered(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
