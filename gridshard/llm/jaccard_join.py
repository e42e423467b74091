"""Documents whose word n-grams overlap: an exact Jaccard join with set-relation skipping.

A document's set holds its distinct n-grams (SHINGLE words) as 64-bit hashes; a shorter text has one, of all its
words. Two documents link when the sets' Jaccard similarity is PERCENT or more. The result is
one row for each document with its component, so links between many copies are never listed.

1. Every text is hashed once. A document's prefix, the smaller half of its hashes, must share a stated
   number of them with the prefix of any document it links with. Prefix hashes, each once for a
   chunk of texts, go to buckets by hash, packed in arrays; a bucket answers how many of
   a document's hashes came from elsewhere, too. Documents below the number have no link and
   are done; so is a document with a passage that many others share but little else.
2. The sets of the others, one for each distinct set, are ordered by how rare their hashes are. Sets
   that share one of the rarest may link; connected by that they form groups, and no link leads out of a group.
3. A group is one task's work; a large one is cut into blocks, and every pair of blocks is a task of
   its own, so memory has a bound and no pair is missed. Within, index lists and answers are skipped as set_relations says.
4. The links found, a star for each block pair, give the components.

Nulls: a null text, or one without words, has an empty set and is linked with nothing, its component is its
own id. Null ids do not count for the smallest id; a component of only null ids has a null id. Rows
that repeat are copies of each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gridshard.llm.common import discard, documents, fresh, give_back, slices, written
from gridshard.llm.graphs import components
from gridshard.llm.set_relations import least_overlap, linked

SHINGLE = 5
# Texts whose hashes are sorted together, and text for each bucket of hashes.
CHUNK_BYTES = 16 << 20
CHUNK_DOCS = 30_000
BUCKET_BYTES = 12 << 20
# What a block of a group may hold.
BLOCK_SETS = 1024
BLOCK_TOKENS = 1 << 20
CACHE_WORDS = 200_000
_LOCAL = 0xFFFF
_P = [np.uint64(pow(0x9E3779B97F4A7C15, i + 1, 1 << 64)) for i in range(64)]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sorted distinct n-gram hashes of texts."""

    def __init__(self, n: int = SHINGLE):
        self.n, self.words = n, _WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode().lower().split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        h = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        size = min(self.n, len(h))
        total = h[: len(h) - size + 1] * _P[0]
        for k in range(1, size):
            total += h[k : len(h) - size + 1 + k] * _P[k]
        # A text of fewer words is no n-gram of another.
        hashes = np.sort(_mixed(total + np.uint64(size)))
        keep = np.ones(len(hashes), bool)
        keep[1:] = hashes[1:] != hashes[:-1]
        return hashes[keep]


def shared_wanted(n: np.ndarray | int) -> np.ndarray | int:
    """k: linked sets share their k first common hashes within the prefixes of both."""
    return np.maximum(1, n // 4)


def half(n: np.ndarray | int) -> np.ndarray | int:
    """The length of the prefix that holds the k first common hashes."""
    return n - least_overlap(n) + shared_wanted(n)


_ROW = "doc_id {id}, row_key long, fp string, n int, chunk long, ref int, here int, bucket int, hashes binary, refs binary"


def _hashed(docs: DataFrame, doc_id: str, text: str, buckets: int, shingle: int) -> DataFrame:
    """A row for each document (fp is its set's fingerprint) and a row for each chunk and bucket of hashes."""
    schema = T._parse_datatype_string(_ROW.format(id=docs.schema[doc_id].dataType.simpleString()))

    def chunk_rows(ids: list, keys: list, sets: list[np.ndarray], arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
        fps = [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets]
        chunk = int.from_bytes(hashlib.blake2b(repr(fps).encode(), digest_size=8).digest(), "big", signed=True)
        ref: dict[str, int] = {}
        first = []
        for fp, s in zip(fps, sets, strict=True):
            if fp is not None and fp not in ref:
                ref[fp] = len(ref)
                first.append(s)
        here = np.zeros(len(first), np.int64)
        blobs: list[tuple[int, bytes, bytes]] = []
        if first:
            sizes = half(np.array([len(s) for s in first]))
            hashes = _mixed(np.concatenate([s[:k] for s, k in zip(first, sizes, strict=True)]) + np.uint64(1))
            owner = np.repeat(np.arange(len(first)), sizes)
            order = np.argsort(hashes)
            hashes, owner = hashes[order], owner[order]
            start = np.ones(len(hashes), bool)
            start[1:] = hashes[1:] != hashes[:-1]
            several = np.diff(np.append(np.flatnonzero(start), len(hashes))) > 1
            here += np.bincount(owner[np.repeat(several, np.diff(np.append(np.flatnonzero(start), len(hashes))))], minlength=len(first))
            hashes, owner = hashes[start], np.where(several, _LOCAL, owner[start]).astype("<u2")
            bucket = (hashes >> np.uint64(32)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            bucket, hashes, owner = bucket[order], (hashes[order] & np.uint64(0xFFFFFFFF)).astype("<u4"), owner[order]
            edges = np.append(np.flatnonzero(np.diff(bucket, prepend=bucket[:1] + np.uint64(1))), len(bucket)).tolist()
            blobs = [(int(bucket[a]), hashes[a:b].tobytes(), owner[a:b].tobytes()) for a, b in zip(edges, edges[1:], strict=False)]
        refs = [ref.get(fp) for fp in fps]
        n, m = len(ids), len(blobs)
        columns = [
            ids, keys, fps, [len(s) for s in sets], [chunk] * n, refs, [None if r is None else int(here[r]) for r in refs], *[[None] * n] * 3
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
        for i in range(0, m, 64):
            some = blobs[i : i + 64]
            none = [None] * len(some)
            columns = [none, none, none, none, [chunk] * len(some), none, none, *map(list, zip(*some, strict=True))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, shingler = to_arrow_schema(schema), Shingler(shingle)
        ids, keys, sets, size = [], [], [], 0
        for batch in batches:
            for a, b in slices(batch.column(2)):
                ids += batch.column(0).slice(a, b - a).to_pylist()
                keys += batch.column(1).slice(a, b - a).to_pylist()
                for text in batch.column(2).slice(a, b - a).to_pylist():
                    sets.append(shingler(text))
                    size += len(text or "")
                if size >= CHUNK_BYTES or len(ids) >= CHUNK_DOCS:
                    yield from chunk_rows(ids, keys, sets, arrow)
                    ids, keys, sets, size = [], [], [], 0
        if ids:
            yield from chunk_rows(ids, keys, sets, arrow)
        give_back()

    return docs.select(doc_id, _row_key(doc_id, text), text).mapInArrow(run, schema)


def _row_key(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id).cast("string"), F.col(text)).alias("row_key")


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, refs, counts): of a bucket, how many hashes of each document came from other chunks, too."""
    chunks, hashes, refs, sizes = [], [], [], []
    for batch in batches:
        for chunk, h, r in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("chunk", "hashes", "refs")), strict=True):
            chunks.append(chunk)
            hashes.append(np.frombuffer(h, "<u4"))
            refs.append(np.frombuffer(r, "<u2"))
            sizes.append(len(refs[-1]))
    which = np.repeat(np.arange(len(chunks)), sizes)
    hashes, refs = np.concatenate(hashes), np.concatenate(refs)
    ranked = np.sort(hashes)
    again = ranked[1:][ranked[1:] == ranked[:-1]]
    known = refs != _LOCAL
    which, hashes, refs = which[known], hashes[known], refs[known]
    shared = np.zeros(len(hashes), bool)
    if len(again):
        shared = again[np.minimum(np.searchsorted(again, hashes), len(again) - 1)] == hashes
    keys, n = np.unique(which[shared].astype(np.int64) << 16 | refs[shared], return_counts=True)
    edges = np.searchsorted(keys >> 16, np.arange(len(chunks) + 1)).tolist()
    refs, n = (keys & 0xFFFF).astype("<u2"), n.astype("<u4")
    some = [(c, refs[a:b].tobytes(), n[a:b].tobytes()) for c, a, b in zip(chunks, edges, edges[1:], strict=False) if a < b]
    types = (pa.int64(), pa.binary(), pa.binary())
    columns = zip(*some, strict=True) if some else [[]] * 3
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["chunk", "refs", "counts"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, ref, elsewhere): the answers of all buckets for the documents of a chunk."""
    chunk, total = None, np.zeros(1 << 16, np.int64)
    for batch in batches:
        for chunk, refs, counts in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("chunk", "refs", "counts")), strict=True):
            np.add.at(total, np.frombuffer(refs, "<u2"), np.frombuffer(counts, "<u4"))
    found = np.flatnonzero(total)
    columns = [np.full(len(found), chunk, np.int64), found.astype(np.int32), total[found]]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["chunk", "ref", "elsewhere"])


def _candidates(hashed: DataFrame) -> DataFrame:
    """(fp, row_key): distinct sets that share enough of their prefix to have a link, and a document that has it."""
    docs = hashed.where(F.col("bucket").isNull() & (F.col("n") > 0))
    blobs = hashed.where(F.col("bucket").isNotNull()).select("bucket", "chunk", "hashes", "refs")
    answers = blobs.groupBy("bucket").applyInArrow(_answers, "chunk long, refs binary, counts binary")
    answers = answers.groupBy("chunk").applyInArrow(_summed, "chunk long, ref int, elsewhere long")
    wanted = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * 75 / 100) / 4))
    shared = F.col("here") + F.coalesce(F.col("elsewhere"), F.lit(0))
    some = docs.select("fp", "row_key", "n", "chunk", "ref", "here").join(answers, ["chunk", "ref"], "left")
    return some.where(shared >= wanted).groupBy("fp").agg(F.min("row_key").alias("row_key"))


def _sets(docs: DataFrame, candidates: DataFrame, repeated: bool, doc_id: str, text: str, shingle: int) -> DataFrame:
    """(fp, n, hashes) of the candidates, from the texts of their documents; ``repeated``: some of these come more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(shingle)
        for batch in batches:
            for a, b in slices(batch.column(0)):
                sets = [shingler(t) for t in batch.column(0).slice(a, b - a).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() for s in sets], pa.string()),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["fp", "n", "hashes"],
                )

    # A merge join at every size: whether the candidates could be broadcast doesn't change the plan.
    keys = candidates.select("row_key").hint("merge")
    texts = docs.select(F.col(text).alias("text"), _row_key(doc_id, text)).join(keys, "row_key", "left_semi")
    sets = texts.select("text").mapInArrow(run, "fp string, n int, hashes array<long>").where(F.col("n") > 0)
    return sets.groupBy("fp").agg(F.first("n").alias("n"), F.first("hashes").alias("hashes")) if repeated else sets


def _groups(sets: DataFrame) -> DataFrame:
    """(id, group): sets that share one of the rarest hashes of each, connected. A set that shares none has no row."""
    every = sets.select("id", "n", F.explode("hashes").alias("hash"))
    # Here and below, aggregates are written before they are joined with what they were made of: adaptive
    # execution splits a hot key only in a join of two plain shuffles.
    frequency = written(every.groupBy("hash").agg(F.count("*").cast("int").alias("f")).where("f > 1"), "jaccard-frequencies")
    # Merge joins at every size, as above.
    repeated = every.join(frequency.hint("merge"), "hash")
    # Hashes of one set only come first in its order, and nothing else has them.
    own = F.col("n") - F.count("*").over(Window.partitionBy("id"))
    place = own + F.row_number().over(Window.partitionBy("id").orderBy("f", "hash"))
    length = F.col("n") - F.ceil(F.col("n") * 75 / 100) + 1
    prefix = repeated.select("id", "hash", place.alias("place"), length.alias("length")).where(F.col("place") <= F.col("length"))
    prefix = written(prefix.select("id", "hash"), "jaccard-prefixes")
    least = written(prefix.groupBy("hash").agg(F.min("id").alias("b")), "jaccard-least")
    edges = prefix.join(least.hint("merge"), "hash").select(F.col("id").alias("a"), "b")
    groups = components(edges)
    discard(frequency, prefix, least)
    return groups.select(F.col("node").alias("id"), F.col("root").alias("group"))


def _links(sets: DataFrame, groups: DataFrame, weights: DataFrame) -> DataFrame:
    """(fp, root, links) for each set in each pair of blocks of its group."""
    members = groups.join(sets.select("id", "fp", "n"), "id").join(weights, "fp")
    sizes = members.groupBy("group").agg(F.count("*").alias("sets"), F.sum("n").alias("tokens")).where("sets > 1")
    sizes = written(sizes, "jaccard-sizes")
    n_blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("int")
    members = members.join(sizes.select("group", n_blocks.alias("blocks")), "group")
    members = members.withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    members = members.select("id", "fp", "weight", "group", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = members.join(sets.select("id", "hashes"), "id")
    rows = rows.select("*", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        fps = table["fp"].to_pylist()
        weights = np.array(table["weight"].to_pylist(), np.int64)
        block = np.array(table["block"].to_pylist(), np.int64)
        hashes = [np.sort(x.values.to_numpy(zero_copy_only=False)) for x in table["hashes"]]
        left = np.flatnonzero(block == table["left"][0].as_py())
        right = np.flatnonzero(block == table["right"][0].as_py())
        if len(left) and len(right):
            roots, links = linked(hashes, weights, left, right)
        else:
            roots, links = list(range(len(fps))), np.zeros(len(fps), np.int64)
        return pa.table({"fp": fps, "root": [fps[r] for r in roots], "links": links})

    return rows.groupBy("group", "left", "right").applyInArrow(run, "fp string, root string, links long")


def _classes(docs: DataFrame, doc_id: str, text: str, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row_key, fp, n) of each document, and (fp, root, component_id, n_links) of each distinct set."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    hashed = written(_hashed(docs, doc_id, text, total // BUCKET_BYTES + 1, shingle), "jaccard-hashes")
    rows = written(hashed.where(F.col("bucket").isNull()).select("doc_id", "row_key", "fp", "n"), "jaccard-rows")
    candidates = written(_candidates(hashed), "jaccard-candidates")
    discard(hashed)
    classes = rows.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    repeated = not rows.join(candidates.select("row_key"), "row_key").groupBy("row_key").count().where("count > 1").isEmpty()
    sets = _sets(docs, candidates, repeated, doc_id, text, shingle)
    sets = written(sets.withColumn("id", F.monotonically_increasing_id()), "jaccard-sets")
    groups = written(_groups(sets), "jaccard-groups")
    found = written(_links(sets, groups, classes.select("fp", F.col("copies").alias("weight"))), "jaccard-links")
    discard(candidates, sets, groups)
    roots = components(found.select(F.col("fp").alias("a"), F.col("root").alias("b")))
    others = found.groupBy("fp").agg(F.sum("links").alias("others"))
    classes = classes.join(roots, F.col("fp") == F.col("node"), "left").join(others, "fp", "left")
    n_links = F.coalesce("others", F.lit(0)) + F.col("copies") - 1
    classes = written(classes.select("fp", "least", F.coalesce("root", "fp").alias("root"), n_links.alias("n_links")), "jaccard-classes")
    smallest = written(classes.groupBy("root").agg(F.min("least").alias("component_id")), "jaccard-smallest")
    return rows, classes.join(smallest, "root").select("fp", "root", "component_id", "n_links")


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id that links lead to) and n_links (other documents
    that a document links with, copies included) of each document."""
    rows, classes = _classes(docs, doc_id, text, shingle)
    n_shingles = F.col("n").cast("long").alias("n_shingles")
    full = rows.where("n > 0").join(classes, "fp").select("doc_id", n_shingles, "component_id", "n_links")
    return full.union(rows.where("n = 0").select("doc_id", n_shingles, "doc_id", F.lit(0).cast("long")))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without those linked, directly or not, to one that stays: of each component the document with the
    smallest id, null last, the first in an order of hashes if several have it, and of rows equal in id and text one.

    Documents without words stay.
    """
    rows, classes = _classes(docs, doc_id, text, shingle)
    grouped = written(rows.where("n > 0").join(classes.select("fp", "root"), "fp").select("doc_id", "row_key", "root"), "jaccard-grouped")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    first = written(grouped.groupBy("root").agg(F.min(order).alias("first")), "jaccard-first")
    stays = F.col("row_key").eqNullSafe(F.col("first.row_key")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    judged = grouped.join(first, "root").withColumn("stays", stays)
    names = {c: fresh(docs, c) for c in ("jaccard_key", "jaccard_lost_key", "jaccard_lost_id")}
    lost = judged.where(~F.col("stays")).select(F.col("row_key").alias(names["jaccard_lost_key"]), F.col("doc_id").alias(names["jaccard_lost_id"])).distinct()
    lost = written(lost, "jaccard-lost")
    key = F.col(names["jaccard_key"])
    same = (key == F.col(names["jaccard_lost_key"])) & F.col(doc_id).eqNullSafe(F.col(names["jaccard_lost_id"]))
    kept = docs.withColumn(names["jaccard_key"], _row_key(doc_id, text)).join(lost, same, "left_anti")
    repeated = judged.where("stays").groupBy("root").count().where("count > 1")
    if not repeated.isEmpty():
        words = F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]")) > 0
        kept = kept.where(words).dropDuplicates([names["jaccard_key"], doc_id]).unionByName(kept.where(~F.coalesce(words, F.lit(False))))
    return kept.drop(names["jaccard_key"])


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


OP10_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + {SHINGLE - 1}), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS i FROM d WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_have AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM both_have JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * o >= 75 * (x.n + y.n - o)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT d.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, component_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM d LEFT JOIN sizes USING (doc_id) JOIN least ON d.doc_id = least.a LEFT JOIN counts ON d.doc_id = counts.a
"""
