"""What the operators on documents share: names, words, and passes over whole texts."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridshard.sources.scratch import scratch_path

# Runs of characters that are not ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"
# Texts handled together by a task; a longer text is handled alone.
SLICE_BYTES = 4 << 20
SLICE_ROWS = 10_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: cuts the lineage, outlives executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.scratch = path
    return back


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` made, once nothing reads them any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front as long as ``df`` has such a column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text leaves 2 modulo 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about SLICE_BYTES of text."""
    start = size = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i - start == SLICE_ROWS or size and size + n > SLICE_BYTES:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it can be printed, else the next of those from 256 on."""
    printed = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in printed else chr(next(others)) for b in range(256)]


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[[list[str | None]], Iterable]],
    fields: list[tuple[str, T.DataType]],
    keep: list[str] | None = None,
    text: str = "text",
) -> DataFrame:
    """Columns ``keep`` (default: all) of ``df`` and those that a function computes from each text.

    ``make`` runs once in each task and returns a function from a list of texts, null
    included, to one sequence of values for each of ``fields``.
    """
    keep = df.columns if keep is None else keep
    made = T.StructType([T.StructField(n, t) for n, t in fields])

    # Only texts go to Python and only what is made of them comes back.
    @F.arrow_udf(made)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from pyspark.sql.pandas.types import to_arrow_schema

        compute, arrow = make(), to_arrow_schema(made)
        for texts in batches:
            parts = []
            for start, end in slices(texts):
                columns = compute(texts.slice(start, end - start).to_pylist())
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)]
                parts.append(pa.StructArray.from_arrays(arrays, fields=list(arrow)))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct(list(arrow)))
        give_back()

    # Not to be computed again for each of its fields, or for a filter.
    result = fresh(df, "made_of_text")
    whole = df.select(*(F.col(f"`{c}`") for c in keep), run.asNondeterministic()(F.col(f"`{text}`")).alias(result))
    return whole.select(*(F.col(f"`{c}`") for c in keep), *(F.col(f"`{result}`.`{n}`").alias(n) for n, _ in fields))


def give_back() -> None:
    """Returns freed memory to the system: a Python worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)
