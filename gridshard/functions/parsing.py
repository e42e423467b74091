"""Text to typed columns. Bad text becomes null, never a failed job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"


def coordinate(text: Column, index: int) -> Column:
    """The ``index``-th (from 0) number of a comma separated text."""
    if index == 0:
        field = F.substring_index(text, ",", 1)
    elif index == 1:
        # Cheaper than a split, which points by the billion would feel.
        comma = F.instr(text, F.lit(","))
        field = F.when(comma > 0, F.substring_index(F.substr(text, comma + 1), ",", 1))
    else:
        field = F.split_part(text, F.lit(","), F.lit(index + 1))
    return field.try_cast("double")


def strip_parens(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("("), F.lit("")), F.lit(")"), F.lit(""))


def timestamp_of(text: Column) -> Column:
    """Timestamp of ``yyyy-MM-dd HH:mm:ss`` text; fractions of a second are ignored."""
    return F.try_to_timestamp(F.substring(text, 1, len(TIMESTAMP_PATTERN)), F.lit(TIMESTAMP_PATTERN))


def is_finite(value: Column) -> Column:
    """True for a number that is neither null, NaN nor infinite."""
    return F.coalesce(F.abs(value) < F.lit(float("inf")), F.lit(False))


def parsed_once(df: DataFrame, keep: list[str], parsed: dict[str, Column]) -> DataFrame:
    """``df`` with columns ``keep`` and the ``parsed`` ones, each computed once per row.

    Filters on a plain projection move below it and take its expressions along, so
    that every condition would parse the text again. They stay above a generator.
    """
    row = F.struct(*[column.alias(name) for name, column in parsed.items()])
    return df.select(*keep, F.inline(F.array(row)))
