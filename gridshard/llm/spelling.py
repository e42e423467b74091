"""Groups of words that are spelled alike: each word's most frequent neighbour at one edit, and where following those leads.

Words are counted over whole texts; those of MIN_LENGTH code points and MIN_COUNT occurrences are compared.
The join of words at one edit is asymmetric. A word of length L, the longer of a pair or either of two equally long ones, gives two disjoint
chunks, its first half and the rest. The other word gives its grams at every place a chunk can have moved to:
of one edit, it touches one chunk only; the other one stands where it stood (an edit after it) or
is moved by the difference of the lengths, one place at most (an edit before it). Words that share a chunk are
verified by their edit distance. Where the edit can be placed in either chunk (one of a run of equal letters), it counts as in the last
place possible, so a pair is found once.

A chunk that many words share would make all pairs of them candidates. Such a chunk is made longer: the
part of the word in which the edit has to be, the gap, is cut into two chunks in turn, of which one edit preserves one, again and
again, until few words share what surrounds the gap. With a gap of one letter that are the words that differ in
that letter alone. No word is left out for it, and nothing is enumerated but pairs of small groups.

Nulls: a null text has no words, a null doc_id counts as empty text. A repeated row counts again. Columns other
than doc_id and text are ignored. Ties of frequency go to the smaller word in order of code points. Without words there are no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridshard.llm.common import discard, documents, give_back, written

MIN_LENGTH = 5
MIN_COUNT = 3
# One in so many runs of letters has a letter deleted.
ERROR_IN = 97
# A form is so many times as frequent as the word.
FORM_TIMES = 2
# Candidate pairs of a chunk beyond which it is made longer.
MAX_PAIRS = 1024
# Different words a task counts before it passes them on.
HELD_WORDS = 200_000

# In UTF-8: a to z and U+00C0 to U+00FF, once A to Z are lower-cased.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _misspelt(run: bytes, crc: int) -> bytes:
    word = run.decode()
    at = crc % len(word)
    return (word[:at] + word[at + 1 :]).encode()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all texts: lower-cased runs of letters, some with a letter deleted as a hash of document and run says."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict[bytes, int] = defaultdict(int)

        def flushed() -> pa.RecordBatch:
            words, counts = pa.array(held.keys(), pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())
            held.clear()
            return pa.RecordBatch.from_arrays([words, counts], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                # One text at a time as a Python object.
                raw, of_doc = (text.as_py() or "").encode(), zlib.crc32(f"{doc_id.as_py()}:".encode())
                for word, n in Counter(_RUN.findall(raw.translate(_LOWER))).items():
                    # Too short whatever is deleted.
                    if len(word) < MIN_LENGTH:
                        continue
                    crc = zlib.crc32(word, of_doc)
                    held[word if crc % ERROR_IN else _misspelt(word, crc)] += n
                if len(held) >= HELD_WORDS:
                    yield flushed()
        yield flushed()
        give_back()

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def words_of(docs: DataFrame) -> DataFrame:
    return word_counts(docs).where((F.length("word") >= MIN_LENGTH) & (F.col("n") >= MIN_COUNT))


def _around(gap_start: str, gap_end: str) -> Column:
    """Hash of what surrounds the gap of a word of ``length`` letters, as seen from a word that may be one shorter."""
    return F.expr(
        f"xxhash64(length, {gap_start}, {gap_end}, left(word, {gap_start}),"
        f" right(word, cast(length - {gap_end} AS int)))"
    ).alias("around")


def _halved(rows: DataFrame) -> DataFrame:
    """Rows of (word, n, length, gap_start, gap_end, longer), once for either half of the gap, with the hash of what surrounds it."""
    halves = "array(struct((gap_start + gap_end) div 2 AS a, gap_end AS b), struct(gap_start AS a, (gap_start + gap_end) div 2 AS b))"
    cut = rows.withColumn("gap", F.explode(F.expr(halves)))
    cut = cut.select("word", "n", "length", F.col("gap.a").cast("int").alias("gap_start"), F.col("gap.b").cast("int").alias("gap_end"), "longer")
    return cut.where("gap_start < gap_end").select("*", _around("gap_start", "gap_end"))


def _whole(words: DataFrame) -> DataFrame:
    """Each word as the longer one of a pair or as long as the other, and as the one that is a letter shorter: the gap is all of it."""
    roles = "array(struct(length(word) AS length, true AS longer), struct(length(word) + 1 AS length, false AS longer))"
    rows = words.select("word", "n", F.expr(f"inline({roles})"))
    return rows.select("word", "n", "length", F.lit(0).alias("gap_start"), F.col("length").alias("gap_end"), "longer")


def _verified(rows: DataFrame) -> DataFrame:
    """Pairs (word, n, near, near_n) of rows with the same surroundings that are one edit apart, with the edit in the gap."""
    chunks = rows.where("longer").select("around", "word", "n", "gap_start", "gap_end")
    grams = rows.select("around", F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("longer").alias("same_length"))
    one_edit = F.expr(
        "levenshtein(word, near, 1) = 1 AND (word < near OR NOT same_length)"
        # What the two have in common from the start ends in the gap.
        " AND startswith(near, left(word, gap_start)) AND NOT startswith(near, left(word, gap_end))"
    )
    return chunks.hint("merge").join(grams, "around").where(one_edit).select("word", "n", "near", "near_n")


def near_pairs(words: DataFrame, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """Pairs (word, n, near, near_n) of words (word, n) at one edit, each once."""
    rows, found, old = _halved(_whole(words)), [], []
    while True:
        sizes = rows.groupBy("around").agg(F.count_if("longer").alias("chunks"), F.count("*").alias("grams"), F.max(F.expr("gap_end - gap_start")).alias("gap"))
        crowded = written(sizes.where(f"gap > 1 AND chunks * grams > {max_pairs}").select("around"), "crowded")
        if crowded.isEmpty():
            found.append(written(_verified(rows), "near"))
            discard(crowded, *old)
            break
        found.append(written(_verified(rows.join(crowded, "around", "left_anti")), "near"))
        halved = written(_halved(rows.join(crowded, "around", "left_semi")), "halved")
        discard(crowded, *old)
        rows, old = halved, [halved]
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words (word, form): the last word that forms lead to. A form is more frequent, so there are no circles."""
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        new = written(step, "roots")
        discard(at)
        at = new.drop("moved")
        at.scratch = new.scratch
        if new.where("moved").isEmpty():
            return at


def spelling_groups(docs: DataFrame, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every counted word."""
    words = written(words_of(docs), "words")
    pairs = near_pairs(words, max_pairs)
    both = "inline(array(struct(word AS word, near AS near, near_n AS near_n), struct(near AS word, word AS near, n AS near_n)))"
    best = pairs.selectExpr(both).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    best = best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    frequent = F.col("near_n") >= FORM_TIMES * F.col("n")
    known = written(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(frequent, F.col("near")).alias("form"),
            F.when(frequent, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(documents(spark, sf_dir))


# Runs beyond those that can be counted are left out early. A CRC is folded byte by byte through its table.
OP11_SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                          lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))),
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT coalesce(doc_id::VARCHAR, '') AS doc_id,
               unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[a-z\x{C0}-\x{FF}]+')) AS run
        FROM documents)
  WHERE length(run) >= 5 GROUP BY ALL),
bytes AS (
  SELECT *, flatten(list_transform(string_split(doc_id || ':' || run, ''),
                    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END)) AS b
  FROM runs),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS h
  FROM bytes, tab),
words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                    ELSE run END AS word, n
        FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
less AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, (list(near ORDER BY near_n DESC, near))[1] AS near, max(near_n) AS near_n FROM near GROUP BY word),
known AS (
  SELECT w.word, CASE WHEN near_n >= 2 * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
steps AS (
  SELECT word, word AS root FROM known
  UNION ALL SELECT s.word, k.form FROM steps s JOIN known k ON s.root = k.word WHERE k.form IS NOT NULL)
SELECT k.word, k.form, s.root, k.n, k.n_near, k.form_n
FROM known k JOIN steps s ON k.word = s.word JOIN known r ON s.root = r.word WHERE r.form IS NULL
"""
