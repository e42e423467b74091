"""Integrity rules of a schema as jobs that report violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls per column (``column_name, nulls``), all columns in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns]
    return counted.select(F.inline(F.array(*pairs)))


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows. A null is no key."""
    return (
        df.select(*keys)
        .na.drop(subset=keys)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def foreign_key(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Values of ``fk`` that ``parent`` lacks, with their number of rows. Nulls pass.

    Parent keys that are integers are put together as bits, a row for each 64 neighbouring numbers. Up to
    ``KNOWN_ROWS`` such rows, by a measure, are broadcast, and child rows with a known key go no further: only violations
    are shuffled. Otherwise both sides are reduced to their distinct keys before they meet, so a value
    that fills much of a table is one row in the join.
    """
    values = child.select(fk).where(F.col(fk).isNotNull())
    known = parent.select(F.col(pk).alias("_pk")).where(F.col("_pk").isNotNull())
    if all(isinstance(df.schema[c].dataType, _INTEGERS) for df, c in ((child, fk), (parent, pk))):
        place, bit = _bit_of(F.col("_pk"))
        # The estimate may be a few hundredths off.
        if known.agg(F.approx_count_distinct(place, 0.02)).first()[0] <= 0.9 * KNOWN_ROWS:
            bits = known.groupBy(place.alias("_place")).agg(F.bit_or(bit).alias("_bits"))
            return _counted(_without(values, fk, bits), fk)
    return _counted(values, fk).join(known.distinct(), F.col(fk) == F.col("_pk"), "left_anti")


# Some 100 MB as a broadcast table: 128 million keys where they are dense, 2 million where no two are near each other.
KNOWN_ROWS = 2_000_000
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _bit_of(key: Column) -> tuple[Column, Column]:
    """The number of a group of 64 neighbouring keys, and the bit of a key in it."""
    number = key.cast("long")
    return F.shiftright(number, 6), F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(F.lit(63)).cast("int"))


def _without(values: DataFrame, fk: str, bits: DataFrame) -> DataFrame:
    place, bit = _bit_of(F.col(f"`{fk}`"))
    keyed = values.withColumns({"_place": place, "_bit": bit})
    unknown = F.col("_bits").isNull() | (F.col("_bits").bitwiseAND(F.col("_bit")) == 0)
    return keyed.join(F.broadcast(bits), "_place", "left").where(unknown).select(fk)


def _counted(values: DataFrame, fk: str) -> DataFrame:
    return values.groupBy(fk).agg(F.count(F.lit(1)).alias("n"))


def check(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which ``rule`` is false. As in SQL, an unknown result passes."""
    return df.where(~rule)
