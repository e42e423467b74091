"""Fragment number of a rating under equal-width range partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def range_bound(index: Column, n: int, low: float, high: float) -> Column:
    """Bound number ``index`` (0..n) of ``n`` equal intervals of [low, high]."""
    inner = F.lit(low) + F.lit(high - low) * index.cast("double") / F.lit(float(n))
    return F.when(index >= n, F.lit(high)).otherwise(inner)


def range_part(value: Column, n: int, low: float, high: float) -> Column:
    """Interval of ``value``: the first is closed, later ones open at the bottom.

    The closed form can be one off next to a bound, so it is settled against the
    bounds themselves. Null for values outside [low, high].
    """
    number = value.cast("double")
    v = F.when(number.between(low, high), number)
    ceiling = F.ceil((v - F.lit(low)) * F.lit(float(n)) / F.lit(high - low))
    guess = F.least(F.greatest(ceiling - 1, F.lit(0)), F.lit(n - 1))
    settled = (
        F.when((guess > 0) & (v <= range_bound(guess, n, low, high)), guess - 1)
        .when(v > range_bound(guess + 1, n, low, high), guess + 1)
        .otherwise(guess)
    )
    return F.when(v.isNotNull(), settled.cast("int"))
