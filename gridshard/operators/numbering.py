"""Row numbers over a whole table without putting it in one task.

Rows fall into buckets by the order columns; buckets follow one another in order.
A bucket's first number is the number of rows in the buckets before it, and
within a bucket a window counts on. Bucket bounds are read off a sample and then
fixed, so a row's bucket is a pure function of its values: it is the same in
every pass and in every attempt of a task.

The number of buckets follows the rows. Bounds of the first ``_FIRST_LEVEL`` are constants of
the plan; where more are needed, those buckets are cut again by bounds from a written
table with one row for each, so neither plan nor driver grows with the rows. That table is broadcast,
in measured pieces where it is large, so that a row finds its bucket without being moved.

A value that fills more than a bucket would make its bucket as large as it is
frequent. Such a value shows up as a repeated bound and gets a bucket of its own,
split further by a hash of the whole row; identical rows, which no hash can
split, are counted instead, numbered as one and expanded again.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridshard.functions.parsing import parsed_once
from gridshard.operators.skew import row_bytes, shuffle_partitions
from gridshard.sources.scratch import scratch_path

_FIRST_LEVEL = 1024
_SAMPLES_PER_BUCKET = 64
# A few megabytes.
_BROADCAST_BUCKETS = 100_000
_BROADCAST_BYTES = 256 << 20
_LAST_BUCKET = (1 << 31) - 1
# Rows of a bucket where there are enough for a bucket in every task; fewer than the least are not worth one.
_ROWS_PER_BUCKET = 1_000_000
_LEAST_ROWS = 10_000
_ROWS_PER_CHUNK = 1_000_000


def global_row_number(df: DataFrame, order_by: list[str], name: str = "row_num") -> DataFrame:
    """``df`` with numbers from 1 on in ascending order of ``order_by``, nulls first.

    Rows that tie on ``order_by`` follow each other in an unspecified order.
    """
    nested = [c for c in order_by if isinstance(df.schema[c].dataType, (T.StructType, T.ArrayType, T.VariantType))]
    if nested:
        raise ValueError(f"row numbers are given in the order of plain columns, not {nested}")
    bounds = _bounds(df, order_by)
    hot = any(parts > 1 for _, parts in bounds.first)
    tagged = _tag(df, order_by, bounds)
    offsets = _offsets(tagged)
    if len(bounds.first) * max(1, bounds.second_size) <= _BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    # Ties are settled by the other columns, so that a task run again numbers rows as before.
    others = [c for c in _comparable(df) if c not in order_by]
    w = Window.partitionBy("_bucket", "_sub").orderBy(*order_by, *others)
    plain = tagged.where(F.pmod("_bucket", F.lit(2)) == 0) if hot else tagged
    numbered = (
        plain.withColumn("_in_bucket", F.row_number().over(w).cast("long"))
        .join(offsets, ["_bucket", "_sub"])
        .select(*df.columns, (F.col("_first") + F.col("_in_bucket")).alias(name))
    )
    if not hot:
        return numbered
    tied = tagged.where(F.pmod("_bucket", F.lit(2)) == 1)
    return numbered.unionByName(_number_tied(tied, df, offsets, name))


def _comparable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]


@dataclass(frozen=True)
class Bounds:
    """``first``: upper bounds of the buckets, ascending, each with the number of times it came up.
    ``second``: if they are cut again, (_bucket, _sub_bounds) with an array of keys for each.
    ``pieces``: ranges of buckets, all of them together, whose second bounds are small enough to broadcast."""

    first: list[tuple[tuple, int]]
    second: DataFrame | None = None
    second_size: int = 0
    pieces: tuple[tuple[int, int], ...] = ()


def _bounds(df: DataFrame, order_by: list[str]) -> Bounds:
    """Values of first bounds travel as text, which every plain type can be cast back from."""
    keys = df.select(*order_by)
    total = keys.count()
    buckets = max(total // _ROWS_PER_BUCKET, min(shuffle_partitions(df), total // _LEAST_ROWS)) + 1
    wanted = min(buckets, _FIRST_LEVEL) * _SAMPLES_PER_BUCKET
    # The sample only balances the buckets. It is bounded, so ordering it in one task is.
    sample = keys if total <= wanted else keys.sample(fraction=wanted / total, seed=17)
    position = F.row_number().over(Window.orderBy(*order_by))
    every = max(1, min(total, wanted) // min(buckets, _FIRST_LEVEL))
    rows = (
        sample.withColumn("_position", position)
        .where(F.col("_position") % every == 0)
        .orderBy("_position")
        .select(*[F.col(c).cast("string").alias(c) for c in order_by])
        .collect()
    )
    first = Bounds([(key, len(list(same))) for key, same in groupby(tuple(r) for r in rows)])
    if buckets <= _FIRST_LEVEL:
        return first
    return _second_level(keys, order_by, first, total, -(-buckets // _FIRST_LEVEL))


def _second_level(keys: DataFrame, order_by: list[str], first: Bounds, total: int, parts: int) -> Bounds:
    """Bounds that cut each first bucket into ``parts``, from a sample of that bucket."""
    fraction = min(1.0, _FIRST_LEVEL * parts * _SAMPLES_PER_BUCKET / total)
    sample = _tag(keys.sample(fraction=fraction, seed=18), order_by, first).where(F.pmod("_bucket", F.lit(2)) == 0)
    w = Window.partitionBy("_bucket")
    placed = sample.withColumn("_at", F.row_number().over(w.orderBy(*order_by)) * parts / (F.count(F.lit(1)).over(w) + 1))
    cut = placed.withColumn("_next", F.lag("_at", 1, 0.0).over(w.orderBy(*order_by))).where(F.floor("_at") > F.floor("_next"))
    bounds = cut.groupBy("_bucket").agg(F.sort_array(F.collect_list(F.struct(*order_by))).alias("_sub_bounds"))
    path = scratch_path(keys.sparkSession, "bounds")
    bounds.write.parquet(path)
    stored = keys.sparkSession.read.schema(bounds.schema).parquet(path)
    size = F.expr(f"aggregate(_sub_bounds, 0L, (size, b) -> size + {row_bytes([keys.schema[c] for c in order_by], 'b.')})")
    # A row for each bucket of the first level.
    sizes = stored.select("_bucket", size.alias("size")).orderBy("_bucket").collect()
    return Bounds(first.first, stored, parts, _pieces([(r["_bucket"], r["size"]) for r in sizes]))


def _pieces(sizes: list[tuple[int, int]]) -> tuple[tuple[int, int], ...]:
    """Ranges of buckets, from the first number there can be to the last, with ``_BROADCAST_BYTES`` of bounds each, or one bucket's."""
    starts, held = [-1], 0
    for bucket, size in sizes:
        if held and held + size > _BROADCAST_BYTES:
            starts.append(bucket)
            held = 0
        held += size
    return tuple(zip(starts, [*(s - 1 for s in starts[1:]), _LAST_BUCKET], strict=True))


def _tag(df: DataFrame, order_by: list[str], bounds: Bounds) -> DataFrame:
    """``df`` with ``_bucket`` (odd for the rows equal to a repeated bound) and ``_sub``."""
    tagged = _first_tag(df, order_by, bounds.first)
    if bounds.second is None:
        return tagged
    # Looked up where the row is: rows of a bucket never meet for it. There is one piece unless bounds are very many.
    parts = []
    for low, high in bounds.pieces:
        within = F.col("_bucket").between(low, high)
        rows = tagged.where(within) if len(bounds.pieces) > 1 else tagged
        parts.append(rows.join(F.broadcast(bounds.second.where(within)), "_bucket", "left"))
    cut = reduce(DataFrame.unionByName, parts).withColumn("_first_sub", F.col("_sub")).drop("_sub")
    columns = [_BoundColumn(F.col(f"_sub_bounds.{c}"), F.col(c)) for c in order_by]
    found = _with_bounds_below(cut, columns, bounds.second_size, F.coalesce(F.size("_sub_bounds"), F.lit(0)))
    # Buckets of one value are split by a hash already.
    sub = F.when(F.pmod("_bucket", F.lit(2)) == 0, F.col("_below")).otherwise(F.col("_first_sub"))
    return found.withColumn("_sub", sub.cast("int")).drop("_sub_bounds", "_first_sub", "_below")


def _first_tag(df: DataFrame, order_by: list[str], bounds: list[tuple[tuple, int]]) -> DataFrame:
    if not bounds:
        return df.withColumns({"_bucket": F.lit(0), "_sub": F.lit(0)})
    columns = [_constant(df, c, [key[i] for key, _ in bounds]) for i, c in enumerate(order_by)]
    tagged = _with_bounds_below(df, columns, len(bounds), F.lit(len(bounds)))
    if all(times == 1 for _, times in bounds):
        return tagged.withColumns({"_bucket": F.col("_below") * 2, "_sub": F.lit(0)}).drop("_below")
    times = F.get(F.array(*[F.lit(t) for _, t in bounds]), F.col("_below"))
    own = times > 1
    for column in columns:
        own = own & column.equals(F.col("_below"))
    # As many parts as the value has bounds, and one more for its ragged ends.
    sub = F.when(own, F.pmod(F.xxhash64(*_comparable(df)), times + 1).cast("int")).otherwise(0)
    bucket = F.col("_below") * 2 + F.coalesce(own, F.lit(False)).cast("int")
    return tagged.withColumns({"_bucket": bucket, "_sub": sub}).drop("_below")


def _constant(df: DataFrame, name: str, texts: list[str | None]) -> _BoundColumn:
    as_text = F.from_json(F.lit(json.dumps(texts)), T.ArrayType(T.StringType()))
    return _BoundColumn(as_text.cast(T.ArrayType(df.schema[name].dataType)), F.col(name), None in texts)


class _BoundColumn:
    """One order column of the bounds, as an array, against the same column of a row.

    One array per column: comparing structs is several times slower.
    """

    def __init__(self, bounds: Column, value: Column, has_null: bool = True):
        self.bounds, self.value, self.has_null = bounds, value, has_null

    def is_less(self, i: Column) -> Column:
        """Bound ``i`` comes before the value; nulls come first."""
        bound = F.get(self.bounds, i)
        less = F.coalesce(bound < self.value, F.lit(False))
        return less | (bound.isNull() & self.value.isNotNull()) if self.has_null else less

    def equals(self, i: Column) -> Column:
        return F.get(self.bounds, i).eqNullSafe(self.value)


def _with_bounds_below(df: DataFrame, columns: list[_BoundColumn], most: int, size: Column) -> DataFrame:
    """``df`` with ``_below``, the number of bounds below each row, by halving steps over the sorted bounds.

    There are ``size`` bounds, ``most`` at most. One projection per step is compiled code,
    which ``aggregate`` over the steps is not.
    """
    found = F.col("_found")
    searched = df.withColumn("_found", F.lit(0))
    for i in reversed(range(most.bit_length())):
        bound = found + ((1 << i) - 1)
        below = columns[-1].is_less(bound)
        for column in reversed(columns[:-1]):
            below = column.is_less(bound) | (column.equals(bound) & below)
        step = F.when((bound < size) & below, 1 << i).otherwise(0)
        searched = searched.withColumn("_found", found + step)
    # Filters to come must not take the steps along, each of which doubles them.
    return parsed_once(searched, df.columns, {"_below": found})


def _offsets(tagged: DataFrame) -> DataFrame:
    """Rows before each bucket. One row for each, so one in a million of the rows."""
    before = Window.orderBy("_bucket", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    counts = tagged.groupBy("_bucket", "_sub").agg(F.count(F.lit(1)).alias("_n"))
    first = F.coalesce(F.sum("_n").over(before), F.lit(0))
    return counts.select("_bucket", "_sub", first.alias("_first"))


def _number_tied(tied: DataFrame, df: DataFrame, offsets: DataFrame, name: str) -> DataFrame:
    columns = df.columns
    w = (
        Window.partitionBy("_bucket", "_sub")
        .orderBy(*_comparable(df))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        tied.groupBy("_bucket", "_sub", *columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_before", F.coalesce(F.sum("_copies").over(w), F.lit(0)))
        .join(offsets, ["_bucket", "_sub"])
        .withColumn("_start", F.col("_first") + F.col("_before") + 1)
    )
    last = F.col("_start") + F.col("_copies") - 1
    chunk = F.explode(F.sequence("_start", last, F.lit(_ROWS_PER_CHUNK).cast("long")))
    chunks = starts.select(*columns, last.alias("_last"), chunk.alias("_chunk"))
    end = F.least(F.col("_chunk") + (_ROWS_PER_CHUNK - 1), F.col("_last"))
    return chunks.repartition("_chunk").select(
        *columns, F.explode(F.sequence(F.col("_chunk"), end)).alias(name)
    )
