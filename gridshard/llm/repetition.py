"""Quality rules on repetition: how much of a text lies inside repeated n-grams and lines.

Words of a batch of texts become numbers; the hash of every window of n words is read
off one running polynomial hash in numpy, with the number of the text mixed in, so all
texts of a slice are handled at once. Equal hashes are only candidates: neighbours in hash order are compared
word by word, and should they differ, windows are grouped by their words instead.

A text is kept if the base rules hold and, for each length of n-grams, the share of its
word characters inside n-grams found twice or more stays within a limit, and so does
the share inside lines that repeat an earlier line.

Nulls: a null text is an empty one, without words; it fails the base rules.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridshard.llm.common import documents, map_texts

SYMBOLS = "#*$%&|<>"
BASE_WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
# Percent of the word characters inside repeated n-grams of each length. Short n-grams of common words
# repeat in any long text, so they get more room.
NGRAM_LIMITS = {5: 35, 6: 32, 8: 30, 10: 28}
LINE_LIMIT = 30

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_LINE_BLANKS = " \t\x0b\x0c\r"

FIELDS = [(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars")]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit scramble without collisions."""
    x = x * _SPREAD
    x ^= x >> np.uint64(32)
    x *= _SPREAD
    return x ^ (x >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def repeated_starts(ids: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Starts of the windows of ``n`` words that occur more than once in their text.

    ``ids`` numbers the words of texts that follow each other, ``text`` says whose they are.
    """
    if len(ids) < n:
        return np.empty(0, np.int64)
    values = _mixed(ids.astype(np.uint64) + np.uint64(1))
    power = _powers(_BASE, len(ids) + 1)
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * power[:-1], dtype=np.uint64)])
    starts = np.flatnonzero(text[: len(ids) - n + 1] == text[n - 1 :])
    # All windows are moved to the highest power, so that place doesn't matter.
    last = len(ids) - n
    hashes = (running[starts + n] - running[starts]) * power[last - starts]
    hashes = _mixed(hashes ^ _mixed(text[starts].astype(np.uint64)))
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    equal = np.flatnonzero(ranked[1:] == ranked[:-1])
    a, b = starts[order[equal]], starts[order[equal + 1]]
    same = text[a] == text[b]
    for k in range(n):
        same &= ids[a + k] == ids[b + k]
    if not same.all():
        rows = np.column_stack([text[starts], *(ids[starts + k] for k in range(n))])
        _, group, size = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        return starts[size[group.ravel()] > 1]
    found = np.zeros(len(ids), bool)
    found[a] = found[b] = True
    return np.flatnonzero(found)


def covered(starts: np.ndarray, n: int, n_words: int) -> np.ndarray:
    """Which words lie in a window that begins at one of ``starts``."""
    edges = np.zeros(n_words + 1, np.int64)
    edges[starts] += 1
    np.subtract.at(edges, starts + n, 1)
    return np.cumsum(edges[:-1]) > 0


def repeated_lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and the characters of their words."""
    lines = [line for line in text.split("\n") if line.strip(_LINE_BLANKS)]
    seen: set[str] = set()
    number = chars = 0
    if len(set(lines)) < len(lines):
        for line in lines:
            if line in seen:
                number += 1
                chars += sum(len(w.decode()) for w in line.encode().split())
            seen.add(line)
    return number, chars


def measure(texts: list[str | None], lengths: tuple[int, ...]) -> list:
    """FIELDS and, for each of ``lengths``, the characters inside repeated n-grams, for each text."""
    texts = [t or "" for t in texts]
    number: dict[bytes, int] = defaultdict(count().__next__)
    each = [t.encode().split() for t in texts]
    n_words = np.array([len(w) for w in each], np.int64)
    total = int(n_words.sum())
    ids = np.fromiter((number[w] for words in each for w in words), np.int64, total)
    chars = np.array([len(w.decode()) for w in number] or [0], np.int64)[ids]
    text = np.repeat(np.arange(len(texts)), n_words)

    def by_text(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(values)])
        ends = np.cumsum(n_words)
        return sums[ends] - sums[ends - n_words]

    repeats = {n: covered(repeated_starts(ids, text, n), n, total) for n in {BASE_WINDOW, *lengths}}
    lines = [repeated_lines(t) for t in texts]
    return [
        n_words,
        by_text(chars),
        [sum(map(t.count, SYMBOLS)) for t in texts],
        [n for n, _ in lines],
        by_text(repeats[BASE_WINDOW].astype(np.int64)),
        [c for _, c in lines],
        *(by_text(np.where(repeats[n], chars, 0)) for n in lengths),
    ]


def repetition(
    docs: DataFrame,
    keep: list[str] | None = None,
    ngram_limits: dict[int, float] | None = None,
    line_limit: float = LINE_LIMIT,
    text: str = "text",
) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default: all) with the measures, base_failed and kept.

    Measures are FIELDS and dup_{n}gram_chars for each n-gram length. A column of ``docs``
    with the name of a measure gives way.
    """
    limits = NGRAM_LIMITS if ngram_limits is None else ngram_limits
    lengths = tuple(sorted(limits))
    fields = FIELDS + [(f"dup_{n}gram_chars", T.LongType()) for n in lengths]
    names = {n for n, _ in fields} | {"base_failed", "kept"}
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    measured = map_texts(docs, lambda: lambda texts: measure(texts, lengths), fields, keep, text)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    within = 100 * F.col("dup_line_chars") <= line_limit * F.col("word_chars")
    for n in lengths:
        within &= 100 * F.col(f"dup_{n}gram_chars") <= limits[n] * F.col("word_chars")
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & within)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = repetition(documents(spark, sf_dir), keep=["doc_id"])
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return measured.select(*first, *(c for c in measured.columns if c not in first))


def _sql() -> str:
    """The measures by grouping the windows of each text by their words."""
    lengths = sorted({BASE_WINDOW, *NGRAM_LIMITS})
    chars = ", ".join(
        f"coalesce(c{n}.chars, 0)::BIGINT AS dup_{n}gram_chars" for n in sorted(NGRAM_LIMITS)
    )
    windows = "".join(
        f""", g{n} AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + {n - 1}), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM d WHERE len(w) >= {n})
), r{n} AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS i
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g{n}) WHERE n > 1
), c{n} AS (
  SELECT doc_id, count(*) AS n, sum(len(w[i])) AS chars FROM r{n} JOIN d USING (doc_id) GROUP BY doc_id
)"""
        for n in lengths
    )
    joins = "".join(f" LEFT JOIN c{n} USING (doc_id)" for n in lengths)
    limits = " AND ".join(f"100 * dup_{n}gram_chars <= {NGRAM_LIMITS[n]} * word_chars" for n in sorted(NGRAM_LIMITS))
    word = r"[^\x20\x09-\x0D]+"
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(t, '{word}') AS w FROM documents
), lines AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY place) AS nth
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS place FROM d)
  WHERE regexp_matches(line, '{word}')
), dup_lines AS (
  SELECT doc_id, count(*) AS n, sum(len(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g'))) AS chars FROM lines WHERE nth > 1 GROUP BY doc_id
){windows}, m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(dup_lines.n, 0)::BIGINT AS n_dup_lines, coalesce(c{BASE_WINDOW}.n, 0)::BIGINT AS n_repeat_words,
         coalesce(dup_lines.chars, 0)::BIGINT AS dup_line_chars, {chars}
  FROM d LEFT JOIN dup_lines USING (doc_id){joins}
)
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed,
       NOT base_failed AND 100 * dup_line_chars <= {LINE_LIMIT} * word_chars AND {limits} AS kept
FROM m
"""


OP2_SQL = _sql()
