"""Sharding by extendible hashing, in DataFrame operations.

A document hashes to 60 bits of an md5 of its id and text. The directory is a tree over the leading bits: a bucket
whose documents exceed the byte limit is split on its next bit, and only such a
bucket, so every leaf is a shard that fits and small neighbours stay whole. Bytes of a
bucket at every depth come from one aggregation of the bytes at a fine depth, some 16
to 32 times the number of shards; only the documents of buckets that are still too
large there go into a further round, eight bits finer.

Documents with equal hashes (equal rows) can't be told apart by more bits. A bucket
left with one hash gets overflow pages instead, filled one after the other by the number of
the row within the bucket, counted in two steps so that no task holds the bucket. A
document larger than the limit is a shard of its own, marked oversized.

The directory grows with the shards, so nothing of it is broadcast: it meets the documents' hashes in merge joins,
of which adaptive execution splits a prefix that many documents share.

Nulls: a null id or text counts as empty text; an empty text has 0 bytes. An empty table has no shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridshard.llm.common import documents, fresh, written

SHARD_BYTES = 1 << 20
HASH_BITS = 60
# How many more bits than shards need the first round looks at, and each further round.
FINER_BITS = 4
ROUND_BITS = 8
RESULT = ("n_bytes", "depth", "prefix", "page", "shard_bytes", "oversized")


def document_hash(doc_id: str = "doc_id", text: str = "text") -> Column:
    whole = F.concat(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(f"`{text}`"), F.lit("")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def text_bytes(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long")


def leading_bits(hash_: str, depth: str | int) -> Column:
    return F.expr(f"shiftright({hash_}, {HASH_BITS} - ({depth}))")


def directory(rows: DataFrame, limit: int, first: int, last: int) -> DataFrame:
    """The leaf, if it lies at one of the depths, above every prefix (fine) of ``last`` bits that is in use.

    ``rows`` (hash, bytes) lie in buckets that are split at depth first - 1. Leaves come with
    their depth, prefix, bytes and whether their documents share one hash.
    """
    ends = (F.min("hash").alias("low"), F.max("hash").alias("high"))
    fine = written(rows.groupBy(leading_bits("hash", last).alias("fine")).agg(F.sum("bytes").alias("bytes"), *ends), "shard-fine")
    above = fine.select("*", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("depth"))
    above = above.withColumn("prefix", F.expr(f"shiftright(fine, {last} - depth)"))
    nodes = above.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.min("low").alias("low"), F.max("high").alias("high"))
    one_hash = F.col("low") == F.col("high")
    nodes = written(nodes.withColumn("one_hash", one_hash).withColumn("split", (F.col("bytes") > limit) & ~one_hash), "shard-nodes")
    parents = nodes.where("split").select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    under_split = nodes.withColumn("parent", F.shiftright("prefix", 1)).join(parents.hint("merge"), ["depth", "parent"], "left_semi")
    leaves = nodes.where(F.col("depth") == first).unionByName(under_split.where(F.col("depth") > first).select(nodes.columns)).where(~F.col("split"))
    leaves = leaves.select("depth", "prefix", F.col("bytes").alias("shard_bytes"), "one_hash")
    return written(above.select("fine", "depth", "prefix").join(leaves.hint("merge"), ["depth", "prefix"]), "shard-directory")


def assign_shards(docs: DataFrame, limit: int = SHARD_BYTES, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default: all) with RESULT: the document's bytes, its shard (depth and
    leading bits of the bucket, overflow page), the bytes of the shard, and whether a single document exceeds the limit.

    A column of ``docs`` with one of these names gives way.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in RESULT]
    hash_, size = fresh(docs, "shard_hash"), fresh(docs, "shard_size")
    rows = docs.select(*(F.col(f"`{c}`") for c in keep), document_hash().alias(hash_), text_bytes().alias(size))
    if "text" not in map(str.lower, keep):
        rows = written(rows, "shard-rows")
    total = rows.agg(F.sum(size)).first()[0] or 0
    first, last = 0, min(HASH_BITS, FINER_BITS + max(0, math.ceil(math.log2(max(1, total) / limit))))
    names = {c: fresh(rows, "shard_" + c) for c in ("fine", "depth", "prefix", "bytes", "one_hash")}
    found = []
    while True:
        leaves = directory(rows.select(F.col(hash_).alias("hash"), F.col(size).alias("bytes")), limit, first, last)
        leaves = leaves.select(*(F.col(c).alias(names[c.removeprefix("shard_")]) for c in leaves.columns))
        joined = rows.join(leaves.hint("merge"), leading_bits(f"`{hash_}`", last) == F.col(names["fine"]), "left")
        found.append(joined.where(F.col(names["fine"]).isNotNull()))
        if last == HASH_BITS:
            break
        rows = written(joined.where(F.col(names["fine"]).isNull()).select(rows.columns), "shard-rest")
        if rows.isEmpty():
            break
        first, last = last + 1, min(HASH_BITS, last + ROUND_BITS)
    placed = found[0]
    for more in found[1:]:
        placed = placed.unionByName(more)

    def result(df: DataFrame, page: Column, shard_bytes: Column) -> DataFrame:
        return df.select(
            *(F.col(f"`{c}`") for c in keep),
            F.col(size).alias("n_bytes"),
            F.col(names["depth"]).alias("depth"),
            F.col(names["prefix"]).alias("prefix"),
            page.cast("long").alias("page"),
            shard_bytes.alias("shard_bytes"),
            (F.col(size) > limit).alias("oversized"),
        )

    overflows = F.col(names["one_hash"]) & (F.col(names["bytes"]) > limit)
    plain = result(placed.where(~overflows), F.lit(0), F.col(names["bytes"]))
    return plain.unionByName(_paged(placed.where(overflows), limit, hash_, size, result))


def _paged(rows: DataFrame, limit: int, hash_: str, size: str, result) -> DataFrame:
    """Rows of buckets with one hash, in pages of as many rows as fit."""
    chunk, place, before, n, largest = (fresh(rows, "page_" + c) for c in ("chunk", "place", "before", "n", "largest"))
    rows = written(rows.withColumn(chunk, F.spark_partition_id()), "shard-overflow")
    counts = rows.groupBy(hash_, chunk).agg(F.count("*").alias(n), F.max(size).alias(largest))
    upto = Window.partitionBy(hash_).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(before, F.coalesce(F.sum(n).over(upto), F.lit(0))).withColumn(
        largest, F.max(largest).over(Window.partitionBy(hash_))
    )
    # As large as a chunk of the input at most.
    within = Window.partitionBy(hash_, chunk).orderBy(size)
    numbered = rows.withColumn(place, F.row_number().over(within)).join(counts.hint("merge"), [hash_, chunk])
    fit = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col(largest)))
    page = F.floor((F.col(before) + F.col(place) - 1) / fit)
    numbered = numbered.withColumn(place, page.cast("long"))
    totals = numbered.groupBy(F.col(hash_).alias(chunk + "_of"), F.col(place).alias(chunk + "_page")).agg(F.sum(size).alias(chunk + "_bytes"))
    numbered = numbered.join(totals.hint("merge"), (F.col(hash_) == F.col(chunk + "_of")) & (F.col(place) == F.col(chunk + "_page")))
    return result(numbered, F.col(place), F.col(chunk + "_bytes"))


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """``docs`` as Parquet, a folder with one file for each shard."""
    shard = F.concat_ws("-", "depth", "prefix", "page")
    assigned = assign_shards(docs, limit).withColumn("shard", shard).drop(*RESULT)
    assigned.repartition("shard").write.partitionBy("shard").parquet(path)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(documents(spark, sf_dir), keep=["doc_id"])


OP8_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, {HASH_BITS // 4}))::BIGINT AS h
  FROM documents
), nodes AS (
  SELECT depth, h >> ({HASH_BITS} - depth) AS prefix, sum(n_bytes)::BIGINT AS bytes, min(h) < max(h) AS many, max(n_bytes) AS largest
  FROM d, (SELECT unnest(range(0, {HASH_BITS + 1})) AS depth) GROUP BY ALL
), leaf AS (
  SELECT doc_id, n_bytes, h, coalesce(max(depth) FILTER (bytes > {SHARD_BYTES} AND many) + 1, 0)::INT AS depth
  FROM (SELECT rowid_, doc_id, n_bytes, h, depth, bytes, many
        FROM (SELECT row_number() OVER () AS rowid_, * FROM d) JOIN nodes ON h >> ({HASH_BITS} - depth) = prefix)
  GROUP BY rowid_, doc_id, n_bytes, h
), placed AS (
  SELECT doc_id, n_bytes, h, leaf.depth, prefix, bytes,
         CASE WHEN many OR bytes <= {SHARD_BYTES} THEN 0
              ELSE (row_number() OVER (PARTITION BY h) - 1) // greatest(1, {SHARD_BYTES} // largest) END::BIGINT AS page
  FROM leaf JOIN nodes ON leaf.depth = nodes.depth AND h >> ({HASH_BITS} - leaf.depth) = prefix
)
SELECT doc_id, n_bytes, depth, prefix::BIGINT AS prefix, page,
       sum(n_bytes) OVER (PARTITION BY depth, prefix, page)::BIGINT AS shard_bytes, n_bytes > {SHARD_BYTES} AS oversized
FROM placed
"""
