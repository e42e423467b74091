"""Folders for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    """One temporary folder for the process, which goes when it ends."""
    path = tempfile.mkdtemp(prefix="gridshard-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the session names in ``spark.checkpoint.dir``.

    Without that setting only a local session gets a folder, a temporary one:
    executors on other machines could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_folder()
    return f"{base.rstrip('/')}/gridshard-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the scratch folder and read back: for what several jobs read. Executors that are lost take nothing along."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
