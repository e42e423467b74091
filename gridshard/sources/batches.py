"""Tables that grow by batches, each of which is there as a whole, once, or not at all.

A table is a folder with ``data``, one sub-folder of fragments for each batch, and ``commits``, one small JSON
file for each committed batch, numbered in their order. A batch is first written by Spark to a folder of its
own, which nobody reads yet; then a file that names it appears in ``commits`` by a rename that fails if
another writer took the number meanwhile. Readers read the folders that commits name and nothing else.

So a run that dies before the rename has changed nothing that is read, and its folder can go at any later
time. A run that dies after it and is repeated finds its ``batch_id`` among the commits. A batch that
replaces the table is a commit like any other: readers start at the last of those.

A rename that doesn't overwrite is what HDFS and local disks offer; on object stores without it, let only one
writer add to a table at a time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridshard.sources.sinks import write_fragments


class CommitConflict(RuntimeError):
    """Another batch was committed while this one was written; what depends on its place has to be computed again."""


@dataclass(frozen=True)
class Batch:
    number: int
    batch_id: str
    rows: int
    schema: T.StructType
    folder: str
    replaces: bool = False
    # What the writer wants to find again.
    notes: dict = field(default_factory=dict)


def committed(spark: SparkSession, table: str) -> list[Batch]:
    """Batches of the table in the order of their commits, from the last one that replaced it on."""
    batches = all_commits(spark, table)
    start = max((i for i, b in enumerate(batches) if b.replaces), default=0)
    return batches[start:]


def all_commits(spark: SparkSession, table: str) -> list[Batch]:
    fs, folder = _file_system(spark, f"{table}/commits")
    if not fs.exists(folder):
        return []
    # One line for each batch, whatever the rows.
    columns = "number long, batch_id string, rows long, schema string, folder string, replaces boolean, notes string"
    rows = spark.read.schema(columns).json(f"{table}/commits").orderBy("number").collect()
    return [Batch(**r.asDict() | {"schema": T.StructType.fromJson(json.loads(r["schema"])), "notes": json.loads(r["notes"])}) for r in rows]


def add_batch(df: DataFrame, table: str, batch_id: str, before: list[Batch], replaces: bool = False, notes: dict | None = None) -> Batch:
    """Writes ``df`` (with ``part_id``) as a batch and commits it after the batches ``before``.

    Those are what ``df`` was computed from. If there are others by the time of the
    commit, it fails with ``CommitConflict``, and the table is as it was. Columns are cast to the types of the first batch.
    """
    spark, folder = df.sparkSession, f"_batch={uuid.uuid4().hex}"
    schema = df.schema if replaces or not before else before[0].schema
    if {c.lower() for c in df.columns} != {c.lower() for c in schema.names}:
        raise ValueError(f"the columns of {table} are {schema.names}, not {df.columns}")
    df = df.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields))
    write_fragments(df, f"{table}/data/{folder}")
    # From the footers of what was written: a lazy batch is not computed again.
    rows = spark.read.schema(schema).parquet(f"{table}/data/{folder}").count()
    batch = Batch(max((b.number for b in before), default=-1) + 1, batch_id, rows, schema, folder, replaces, notes or {})
    _commit(spark, table, batch)
    return batch


def read_batches(spark: SparkSession, table: str, batches: list[Batch] | None = None) -> DataFrame:
    """Rows of ``batches`` (default: all committed ones); a filter on ``part_id`` reads only the fragments it names."""
    batches = committed(spark, table) if batches is None else batches
    if not batches:
        raise ValueError(f"no batch of {table} was committed")
    schema = batches[0].schema
    with_batch = T.StructType([*schema.fields, T.StructField("_batch", T.StringType())])
    read = spark.read.schema(with_batch).option("basePath", f"{table}/data")
    return read.parquet(*(f"{table}/data/{b.folder}" for b in batches)).select(*schema.names)


def remove_unread(spark: SparkSession, table: str) -> None:
    """Deletes the data of batches that were replaced, or written and never committed.

    Only while no batch is being written: its folder is not committed yet.
    """
    kept = {b.folder for b in committed(spark, table)}
    fs, folder = _file_system(spark, f"{table}/data")
    for status in fs.listStatus(folder):
        if status.getPath().getName() not in kept:
            fs.delete(status.getPath(), True)


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _commit(spark: SparkSession, table: str, batch: Batch) -> None:
    line = json.dumps(vars(batch) | {"schema": batch.schema.json(), "notes": json.dumps(batch.notes)})
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs, folder = _file_system(spark, f"{table}/commits")
    fs.mkdirs(folder)
    # Spark doesn't read files whose names begin like this.
    staged = hadoop.Path(folder, f"_{uuid.uuid4().hex}")
    out = fs.create(staged, True)
    out.write(bytearray(line.encode()))
    out.close()
    renames = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    plainly = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        renames.rename(fs.makeQualified(staged), fs.makeQualified(hadoop.Path(folder, f"{batch.number:010d}.json")), plainly)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        fs.delete(staged, False)
        raise CommitConflict(f"batch {batch.batch_id!r} of {table} is not the next one any more") from None
