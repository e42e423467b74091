"""Quality by the votes of labelled neighbours in a latent-semantic space.

A text's terms are its words, the shapes of its words (letters and digits stand for their kind, runs for one, punctuation for
itself), and marks of its length and of how often it repeats itself. Terms are hashed to TERMS dimensions, weighted
by log frequency and rarity, and projected to RANK dimensions by a truncated singular value decomposition of the
labelled sample. The labelled vectors, at most about SAMPLE of them, are broadcast; the cosines of every
document with all of them are computed in blocks, exactly, and the NEIGHBOURS closest vote with
the cosine to the power SHARPNESS as weight.

Nulls: a null text is an empty one, and gets its score like any other. Rows of labels without id or label
teach nothing; an id with several labels counts with their mean. Without any label every score is 0.5.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridshard.llm.common import documents, held_out, map_texts, slices

TERMS = 4096
RANK = 64
SAMPLE = 4096
NEIGHBOURS = 25
SHARPNESS = 4
BLOCK_ROWS = 512
# Of two parts of a vector, words and shapes, the second says more about quality.
SHAPE_WEIGHT = 2.0
THRESHOLD = 0.7
CACHE_WORDS = 300_000
_RUN = re.compile(r"[^\W\d_]+")
_REPEATED = re.compile(r"(x|X|d)\1+")


class _Kinds(dict):
    """Maps a character to x, X, d or itself, for str.translate."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        kind = self[code] = "d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c
        return kind


class _Slots(dict):
    def __missing__(self, term: str) -> int:
        import xxhash

        slot = self[term] = xxhash.xxh32_intdigest(term.encode()) % (TERMS // 2)
        return slot


class Terms:
    """Hashed term counts of texts: words in the lower half of the slots, shapes and marks in the upper."""

    def __init__(self):
        self.kinds, self.words, self.shapes = _Kinds(), _Slots(), _Slots()

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        text = text or ""
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        if len(self.shapes) > CACHE_WORDS:
            self.shapes.clear()
        words = Counter(_RUN.findall(text.lower()))
        pieces = text.split()
        shapes = Counter(_REPEATED.sub(r"\1", " ".join(pieces).translate(self.kinds)).split())
        counts: Counter = Counter()
        for w, n in words.items():
            counts[self.words[w]] += n
        for s, n in shapes.items():
            counts[TERMS // 2 + self.shapes[s]] += n
        weight = max(1, len(pieces)) // 4 + 1
        lines = text.count("\n") + 1
        for mark in (
            f"length {int(math.log2(len(pieces) + 1))}",
            f"distinct {int(10 * len(set(pieces)) / max(1, len(pieces)))}",
            f"words a line {int(math.log2(len(pieces) / lines + 1))}",
        ):
            counts[TERMS // 2 + self.shapes[mark]] += weight
        slots = np.fromiter(counts.keys(), np.int32, len(counts))
        return slots, np.fromiter(counts.values(), np.float32, len(counts))


def term_rows(texts: list[str | None], terms: Terms) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots, log frequencies and the number of slots of each text, text after text."""
    each = [terms(t) for t in texts]
    sizes = np.array([len(s) for s, _ in each], np.int64)
    return np.concatenate([s for s, _ in each]), np.log1p(np.concatenate([n for _, n in each])), sizes


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


class Neighbours:
    """Labelled vectors and what projects texts to them."""

    def __init__(self, slots: np.ndarray, values: np.ndarray, sizes: np.ndarray, labels: np.ndarray, rank: int = RANK):
        self.labels = labels.astype(np.float32)
        n = len(sizes)
        self.projection = None
        if n == 0:
            return
        frequency = np.bincount(slots, minlength=TERMS)
        self.rarity = np.log((1 + n) / (1 + frequency)).astype(np.float32) + 1
        owner = np.repeat(np.arange(n), sizes)
        matrix = np.zeros((n, TERMS), np.float32)
        matrix[owner, slots] = self._weighted(slots, values, owner, n)
        # A random projection, sharpened by a few products with the matrix, holds the leading directions.
        basis = np.random.default_rng(7).standard_normal((TERMS, min(rank + 16, n, TERMS))).astype(np.float32)
        for _ in range(4):
            basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
        _, _, directions = np.linalg.svd(matrix @ basis, full_matrices=False)
        self.projection = np.ascontiguousarray(basis @ directions[:rank].T)
        self.vectors = _unit(matrix @ self.projection)

    def _weighted(self, slots: np.ndarray, values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Values by rarity, with words and shapes each brought to a fixed length."""
        values = values * self.rarity[slots]
        part = 2 * owner + (slots >= TERMS // 2)
        length = np.sqrt(np.bincount(part, values.astype(np.float64) ** 2, 2 * n))[part]
        return (values * np.where(slots >= TERMS // 2, SHAPE_WEIGHT, 1) / length).astype(np.float32)

    def project(self, slots: np.ndarray, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        owner = np.repeat(np.arange(len(sizes)), sizes)
        weighted = self._weighted(slots, values, owner, len(sizes))
        # Every text has terms, its marks at least.
        return _unit(np.add.reduceat(self.projection[slots] * weighted[:, None], np.cumsum(sizes) - sizes, axis=0))

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        out = [self._block(vectors[i : i + BLOCK_ROWS]) for i in range(0, len(vectors), BLOCK_ROWS)]
        return np.concatenate(out) if out else np.empty(0)

    def _block(self, vectors: np.ndarray) -> np.ndarray:
        cosines = vectors @ self.vectors.T
        k = min(NEIGHBOURS, cosines.shape[1])
        nearest = np.argpartition(cosines, -k, axis=1)[:, -k:]
        near = np.maximum(np.take_along_axis(cosines, nearest, axis=1), 0).astype(np.float64) ** SHARPNESS
        total = near.sum(axis=1)
        votes = (near * self.labels[nearest]).sum(axis=1)
        return np.where(total > 0, votes / np.where(total > 0, total, 1), float(self.labels.mean()))

    def judge(self, texts: list[str | None], terms: Terms) -> np.ndarray:
        if self.projection is None or not texts:
            return np.full(len(texts), 0.5)
        out = [self.scores(self.project(*term_rows(texts[i : i + BLOCK_ROWS], terms))) for i in range(0, len(texts), BLOCK_ROWS)]
        return np.clip(np.concatenate(out), 0.0, 1.0)


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each id: of its texts the one with the smallest hash."""
    import xxhash

    terms, best, kind = Terms(), {}, None
    for batch in batches:
        kind, texts = batch.column(0).type, batch.column(2)
        for a, b in slices(texts):
            for i, label, text in zip(*(c.slice(a, b - a).to_pylist() for c in batch.columns), strict=True):
                place = xxhash.xxh64_intdigest((text or "").encode()) >> 1
                if i not in best or place < best[i][0]:
                    best[i] = place, label, *terms(text)
    if best:
        places, labels, slots, counts = zip(*best.values(), strict=True)
        columns = [pa.array(list(best), kind), pa.array(labels, pa.float64()), pa.array(places, pa.int64()), pa.array(slots, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.float32()))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "place", "slots", "counts"])


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label: str = "quality") -> Neighbours:
    """Neighbours from about ``sample`` labelled rows of ``docs`` (doc_id, text), all if there are fewer, by a hash of the id.

    An id with several texts teaches by the one with the smallest hash. What reaches the driver is the term counts of
    one text for each id of the sample, TERMS for each at most.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.groupBy("doc_id").agg(F.avg(label).alias("label"))
    chance = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = known.where(chance * F.lit(known.count()) < sample)
    rows = docs.join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text")
    made = rows.mapInArrow(_terms_of, T.StructType([docs.schema["doc_id"], *T._parse_datatype_string("label double, place long, slots array<int>, counts array<float>")]))
    # About ``sample`` rows.
    made = made.groupBy("doc_id", "label").agg(F.min_by(F.struct("slots", "counts"), "place").alias("terms")).select("doc_id", "label", "terms.*")
    found = sorted(made.collect(), key=lambda r: (r.doc_id, r.slots))
    slots = np.array([i for r in found for i in r.slots], np.int32)
    counts = np.array([n for r in found for n in r.counts], np.float32)
    return Neighbours(slots, np.log1p(counts), np.array([len(r.slots) for r in found], np.int64), np.array([r.label for r in found]))


def scored(docs: DataFrame, model: Neighbours, keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """Columns ``keep`` of ``docs`` (default: all) with the score of ``text``; a column of that name gives way."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != name]

    def make():
        terms = Terms()
        return lambda texts: (shared.value.judge(texts, terms),)

    return map_texts(docs, make, [(name, T.DoubleType())], keep)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    found = scored(docs, learn(docs, labels), ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
