"""Ratings tables on storage: load, partition into fragments, append batches.

A layout is a table of batches (``sources.batches``): the first one is the partitioned table, each append
adds one. Within a batch there is one sub-folder per ``part_id``; the fragments together, with the rows
that belong to none, are the ratings table itself. A batch and what the metadata says of it become
visible in one step. An append that names its ``batch_id`` can be repeated after any failure: the batch is there once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridshard.operators import layouts
from gridshard.sources.batches import Batch, add_batch, all_commits, committed, read_batches
from gridshard.sources.text import scan_ratings


def load_ratings(spark: SparkSession, text_path: str, table_path: str) -> DataFrame:
    """Load a ratings file into a table, replacing it, and return the table."""
    scan_ratings(spark, text_path).write.mode("overwrite").parquet(table_path)
    return spark.read.parquet(table_path)


def fragments(spark: SparkSession, layout: str) -> DataFrame:
    return read_batches(spark, layout)


def _batches(spark: SparkSession, layout: str, kind: str | None = None) -> tuple[list[Batch], dict]:
    """The batches of a layout, and what its first one notes of it."""
    batches = committed(spark, layout)
    if not batches:
        raise ValueError(f"{layout} is not a layout")
    notes = batches[0].notes
    if kind not in (None, notes["layout"]):
        raise ValueError(f"{layout} is a {notes['layout']} layout, not {kind}")
    return batches, notes


def metadata(spark: SparkSession, layout: str) -> DataFrame:
    """The bounds of a range layout's fragments, or the number of a round-robin layout's and the next one to get a row."""
    batches, notes = _batches(spark, layout)
    if notes["layout"] == "range":
        return layouts.range_bounds(spark, notes["fragments"])
    following = sum(b.rows for b in batches) % notes["fragments"]
    return spark.range(1).select(F.lit(notes["fragments"]).alias("partition_num"), F.lit(following).alias("table_next_insert"))


def _replace(df: DataFrame, layout: str, kind: str, n: int) -> None:
    before = all_commits(df.sparkSession, layout)
    add_batch(df, layout, uuid.uuid4().hex, before, True, {"layout": kind, "fragments": n})


def _is_there(batches: list[Batch], batch_id: str | None) -> bool:
    return any(b.batch_id == batch_id for b in batches)


def partition_by_range(ratings: DataFrame, layout: str, n: int) -> None:
    """Write ratings as ``n`` equal rating ranges. Replaces what is there; ``batches.remove_unread`` then frees its space."""
    _replace(layouts.range_partition(ratings, n), layout, "range", n)


def append_by_range(batch: DataFrame, layout: str, batch_id: str | None = None) -> None:
    """Add a batch of ratings to the fragments of their ranges; nothing if there is one of that id."""
    batches, notes = _batches(batch.sparkSession, layout, "range")
    if not _is_there(batches, batch_id):
        add_batch(layouts.range_partition(batch, notes["fragments"]), layout, batch_id or uuid.uuid4().hex, batches)


def partition_round_robin(ratings: DataFrame, layout: str, n: int, order_by: list[str]) -> None:
    """Write ratings dealt to ``n`` fragments in ``order_by`` order. Replaces what is there."""
    _replace(layouts.round_robin(ratings, n, order_by), layout, "round_robin", n)


def append_round_robin(batch: DataFrame, layout: str, order_by: list[str], batch_id: str | None = None) -> None:
    """Go on dealing a batch where the committed ones stopped; nothing if there is one of that id.

    Where that is follows from the rows of committed batches. Of two batches that are dealt at the same
    time, one fails with ``CommitConflict`` and has to be dealt again.
    """
    batches, notes = _batches(batch.sparkSession, layout, "round_robin")
    if not _is_there(batches, batch_id):
        n = notes["fragments"]
        start = sum(b.rows for b in batches) % n
        add_batch(layouts.round_robin(batch, n, order_by, start), layout, batch_id or uuid.uuid4().hex, batches)


def fragment_sizes(spark: SparkSession, layout: str, n: int) -> DataFrame:
    return layouts.fragment_sizes(fragments(spark, layout).where(F.col("part_id").isNotNull()), n)
