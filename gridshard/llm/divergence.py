"""How far the sources of a language are apart in their words, and the words by which each differs from its language.

Terms are counted over whole texts and kept if MIN_DOCS documents of a language have them. A kept term's share in a
source is its count, smoothed and in parts of SCALE, and the distance of two shares p and q is floor((p - q)^2 / (p + q)).

**Words of a source.** The distance of a source's share from its language's grows with the count in the source and falls with
the count in the language, and equal distances are ranked by the term. So a term is out of the first k as soon as k others dominate
it: counts in the source at least as high, in the language at most as high, and earlier in UTF-8. Each partition keeps
the terms of a source that fewer than k others dominate there, its k-skyband; skybands are merged by hashed parts of the terms, and
what is left is ranked exactly. A task holds skybands and a block of terms at a time.

**Pairs of sources.** Terms are dealt to slices; a slice of a language is a matrix of shares, terms by sources, of bounded size, against
which a block of the sources is compared column by column in numpy. The slices' sums are added up by Spark.
The rows of the result are all pairs of sources of a language, so a language's sources are taken to be a number of which that many pairs
can be written; a term's counts in all of them are one row.

Shares are computed without overflow (long division in steps, or decimals), so results are exact.

Nulls: null text, lang and source are empty text. Repeated rows are documents of their own. Sources without
kept terms have pairs (all shares are equal, in a language without kept terms all distances are 0). Columns other than these three are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridshard.llm.common import documents, give_back, written

MIN_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
# Different terms of groups a task counts before it passes them on.
HELD_TERMS = 200_000
# Terms of a source that are taken into a skyband together.
SKYBAND_ROWS = 16_384
_CHUNK = 512
# Numbers in a matrix of shares, and sources that are compared with all others in a task.
SLICE_SHARES = 1 << 16
BLOCK_SOURCES = 64
# Skybands of a source are merged by so many hashed parts before the terms are ranked.
MERGED_PARTS = 8

# Bytes in no term become blanks, A to Z become a to z.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def grouped(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term and rows that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: defaultdict[tuple[str, str], defaultdict[bytes, int]] = defaultdict(lambda: defaultdict(int))
        rows: defaultdict[tuple[str, str], Counter] = defaultdict(Counter)
        held = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for (lang, source), terms in counts.items():
                columns = [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array(terms.keys(), pa.binary()).cast(pa.string()),
                    pa.array(terms.values(), pa.int64()),
                    pa.array(map(rows[lang, source].__getitem__, terms), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
            counts.clear()
            rows.clear()

        for batch in batches:
            for lang, source, text in zip(*batch.columns, strict=True):
                group = lang.as_py(), source.as_py()
                found = Counter(text.as_py().encode().translate(_TERM_BYTES).split())
                terms = counts[group]
                held -= len(terms)
                for term, n in found.items():
                    terms[term] += n
                held += len(terms)
                rows[group].update(found.keys())
                if held >= HELD_TERMS:
                    yield from flushed()
                    held = 0
        yield from flushed()
        give_back()

    found = grouped(docs).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, total, counts) of terms in at least ``min_docs`` rows of a language; counts has (source, n) of each source with the term."""
    totals = term_counts(docs).groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("counts")
    )
    return totals.where(F.col("docs") >= min_docs).drop("docs")


def source_groups(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, no, n, lang_n, v, sources): occurrences of kept terms in a source and in its language, kept terms and sources of the language."""
    in_source = terms.select("lang", F.inline("counts")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    in_lang = terms.groupBy("lang").agg(F.sum("total").alias("lang_n"), F.count("*").alias("v"))
    by_lang = Window.partitionBy("lang")
    named = grouped(docs).select("lang", "source").distinct()
    numbered = named.withColumns({"no": F.row_number().over(by_lang.orderBy("source")) - 1, "sources": F.count("*").over(by_lang)})
    joined = numbered.join(in_source, ["lang", "source"], "left").join(in_lang, "lang", "left")
    return joined.select("lang", "source", "no", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n", "lang_n", "v", "sources")))


def _share(n: str, total: str) -> Column:
    return F.expr(f"1L + (cast({SCALE} AS decimal(10,0)) * (cast({n} AS decimal(20,0)) + 2BD)) div cast({total} + 2 * v AS decimal(20,0))")


# The term part.


def skyband(n: np.ndarray, total: np.ndarray, terms: np.ndarray, k: int) -> np.ndarray:
    """Places of the terms that fewer than ``k`` others dominate, by higher ``n``, lower ``total`` and earlier term."""
    if len(n) <= k:
        return np.arange(len(n))
    rank = np.empty(len(terms), np.int64)
    rank[np.argsort(terms)] = np.arange(len(terms))
    # Whatever dominates a term comes before it.
    order = np.lexsort((rank, total, -n))
    total, rank = total[order], rank[order]
    kept = np.empty(0, np.int64)
    for start in range(0, len(order), _CHUNK):
        chunk = np.arange(start, min(start + _CHUNK, len(order)))
        # What is dominated by dropped terms is dominated by k that are kept.
        above = _dominators(kept, chunk, total, rank)
        chunk, above = chunk[above < k], above[above < k]
        within = (total[chunk][:, None] <= total[chunk]) & (rank[chunk][:, None] < rank[chunk]) & (chunk[:, None] < chunk)
        kept = np.concatenate([kept, chunk[above + within.sum(axis=0) < k]])
    return order[kept]


def _dominators(kept: np.ndarray, chunk: np.ndarray, total: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """How many of the ``kept``, all of which come before, dominate each of ``chunk``."""
    count = np.zeros(len(chunk), np.int64)
    for start in range(0, len(kept), 4 * _CHUNK):
        some = kept[start : start + 4 * _CHUNK]
        count += ((total[some][:, None] <= total[chunk]) & (rank[some][:, None] < rank[chunk])).sum(axis=0)
    return count


_POINTS = "lang string, source string, term string, n long, total long"


def skybands(points: DataFrame, k: int = TOP) -> DataFrame:
    """Of ``points`` (lang, source, term, n, total), those in the k-skyband of their source within their partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict[tuple[str, str], list[tuple[np.ndarray, ...]]] = defaultdict(list)
        waiting: Counter = Counter()

        def reduce(group: tuple[str, str]) -> None:
            n, total, terms = map(np.concatenate, zip(*held[group], strict=True))
            kept = skyband(n, total, terms, k)
            held[group] = [(n[kept], total[kept], terms[kept])]
            waiting[group] = 0

        for batch in batches:
            table = pa.table(batch)
            langs, sources = table["lang"].to_pylist(), table["source"].to_pylist()
            groups: defaultdict[tuple[str, str], list[int]] = defaultdict(list)
            for i, group in enumerate(zip(langs, sources, strict=True)):
                groups[group].append(i)
            n, total = table["n"].to_numpy(), table["total"].to_numpy()
            terms = np.array([t.encode() for t in table["term"].to_pylist()], object)
            for group, at in groups.items():
                held[group].append((n[at], total[at], terms[at]))
                waiting[group] += len(at)
                # As many as a skyband holds, at least, so that its part in the work stays small.
                if waiting[group] >= max(SKYBAND_ROWS, len(held[group][0][0])):
                    reduce(group)
        for group in list(held):
            reduce(group)
            ((n, total, terms),) = held.pop(group)
            columns = [
                pa.array([group[0]] * len(n), pa.string()),
                pa.array([group[1]] * len(n), pa.string()),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(n, pa.int64()),
                pa.array(total, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "total"])
        give_back()

    return points.select("lang", "source", "term", "n", "total").mapInArrow(run, _POINTS)


def source_terms(terms: DataFrame, groups: DataFrame, k: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): the ``k`` terms of a source that are the farthest above the language's share."""
    points = terms.select("lang", "term", "total", F.inline("counts")).where("n > 0")
    some = skybands(points, k)
    part = F.pmod(F.xxhash64("term"), F.lit(MERGED_PARTS))
    merged = skybands(some.repartition("lang", "source", part), k)
    known = merged.withColumnRenamed("n", "count").join(groups, ["lang", "source"])
    shares = known.withColumns({"p": _share("count", "n"), "q": _share("total", "lang_n")}).where("p > q")
    valued = shares.select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    return _ranked(valued).where(F.col("rank") <= k)


def _ranked(valued: DataFrame) -> DataFrame:
    return valued.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


# The pair part.


def shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * n / total), by long division: no number on the way is more than 1,000 times ``total``."""
    share, rest = np.divmod(n, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        share = share * 1000 + digits
    return share + 1


def _distances(left: pa.Table, right: pa.Table, block_sources: int) -> pa.Table:
    """The summed distances of the sources of a block from all sources, over the terms of a slice."""
    if not left.num_rows:
        return pa.table([pa.array([], t) for t in (pa.string(), pa.int32(), pa.int32(), pa.int64())], names=["lang", "no", "other", "value"])
    groups = right.sort_by("no")
    block = groups["block"][0].as_py()
    totals = groups["n"].to_numpy() + 2 * groups["v"].to_numpy()
    n_terms, n_sources = left.num_rows, len(totals)
    lists = left["counts"].combine_chunks()
    flat = lists.flatten()
    row = np.repeat(np.arange(n_terms), lists.value_lengths().to_numpy())
    column = np.searchsorted(np.array([s.encode() for s in groups["source"].to_pylist()]), np.array([s.encode() for s in flat.field("source").to_pylist()]))
    counts = np.zeros((n_terms, n_sources), np.int64)
    counts[row, column] = flat.field("n").to_numpy(zero_copy_only=False)
    p = shares(counts + 2, totals)
    ours = range(block * block_sources, min((block + 1) * block_sources, n_sources))
    values = []
    for i in ours:
        own = p[:, i : i + 1]
        values.append(((p - own) ** 2 // (p + own)).sum(axis=0))
    return pa.table(
        {
            "lang": pa.array([groups["lang"][0].as_py()] * (len(ours) * n_sources), pa.string()),
            "no": pa.array(np.repeat(np.array(ours), n_sources), pa.int32()),
            "other": pa.array(np.tile(np.arange(n_sources), len(ours)), pa.int32()),
            "value": pa.array(np.concatenate(values), pa.int64()),
        }
    )


def source_pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): the distance of each source from each other one of its language."""
    shape = groups.where("no = 0").select("lang", F.expr(f"cast(ceil(v * sources / {SLICE_SHARES}) AS int)").alias("slices"), "sources")
    blocks = F.expr(f"explode(sequence(0, cast((sources - 1) div {BLOCK_SOURCES} AS int)))").alias("block")
    dealt = terms.join(shape, "lang").withColumn("slice", F.expr("cast(pmod(xxhash64(term), slices) AS int)"))
    dealt = dealt.select("lang", "slice", blocks, "counts")
    every = groups.drop("sources").join(shape, "lang").where("slices > 0").select("*", F.expr("explode(sequence(0, slices - 1))").alias("slice"))
    every = every.select("lang", "slice", blocks, "no", "source", "n", "v")
    keys, size = ["lang", "slice", "block"], BLOCK_SOURCES

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _distances(left, right, size)

    sums = dealt.groupBy(*keys).cogroup(every.groupBy(*keys)).applyInArrow(run, "lang string, no int, other int, value long")
    sums = sums.groupBy("lang", "no", "other").agg(F.sum("value").alias("value"))
    own = groups.select("lang", "source", "no")
    others = groups.select("lang", F.col("source").alias("item"), F.col("no").alias("other"))
    # The result itself: all pairs of sources of a language.
    pairs = own.join(others, "lang").where("no <> other").join(sums, ["lang", "no", "other"], "left")
    return _ranked(pairs.select("lang", "source", "item", F.coalesce("value", F.lit(0)).cast("long").alias("value")))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, k: int = TOP) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank."""
    terms = written(kept_terms(docs, min_docs), "terms")
    groups = written(source_groups(docs, terms), "groups")
    parts = {"pair": source_pairs(terms, groups), "term": source_terms(terms, groups, k)}
    whole = [df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank")) for part, df in parts.items()]
    return whole[0].unionByName(whole[1])


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(documents(spark, sf_dir))


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
found AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
counted AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT row) AS docs FROM found GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::HUGEINT AS total FROM counted GROUP BY ALL HAVING sum(docs) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(total)::HUGEINT AS lang_n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
dense AS (
  SELECT g.lang, g.source, k.term, k.total, coalesce(c.n, 0)::HUGEINT AS n
  FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT lang, source, sum(n)::HUGEINT AS source_n FROM dense GROUP BY ALL),
shared AS (
  SELECT d.lang, d.source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (source_n + 2 * v) AS p,
         1 + (1000000000::HUGEINT * (total + 2)) // (lang_n + 2 * v) AS q
  FROM dense d JOIN sums s ON d.lang = s.lang AND d.source = s.source JOIN langs l ON d.lang = l.lang),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shared a JOIN shared b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
valued AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM shared WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM valued)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
