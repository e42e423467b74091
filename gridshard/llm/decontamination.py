"""Benchmark decontamination with one Aho-Corasick automaton over the normalised benchmark.

Texts are normalised alike: A-Z lower-cased, words are runs of letters, digits and
characters beyond ASCII. A window is 13 consecutive words of an item, or all words
of a shorter one. Each word of the benchmark becomes one character and any other
word another, so the automaton reads a document once, a character for each word, and
where it finds a window is the number of a word; only in documents with hits are
words mapped back to places in the original text.

The windows are broadcast in parts of WINDOWS_PER_PART, found by a hash. A benchmark
up to that size is one part and one pass; beyond it, each further part reads what the
pass before it has written, so a task never holds more than a part.

Nulls: a null text has no words. A null item id counts as empty text. An item without words,
or a document without, is in no match. Repeated items and rows are each matched in full.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridshard.llm.common import documents, fresh, map_texts, written

WINDOW_WORDS = 13
# Contaminated: at least one word in 20 is hit.
HIT_WORDS_IN = 20
# A node for each word of each window, some 100 bytes: 100 MB at most in a Python worker. Their words
# can't be more than there are characters.
WINDOWS_PER_PART = 80_000
# ASCII to lower case; ASCII characters that are in no word become blanks.
_NORMAL = bytes(c if chr(c).islower() or chr(c).isdigit() or c > 127 else c + 32 if chr(c).isupper() else 32 for c in range(128)) + bytes(range(128, 256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_UNKNOWN = "\x00"

HITS = [
    ("n_words", T.LongType()),
    ("starts", T.ArrayType(T.IntegerType())),
    ("ends", T.ArrayType(T.IntegerType())),
    ("items", T.ArrayType(T.StringType())),
]


def normal_words(text: str | None) -> list[bytes]:
    return text.encode().translate(_NORMAL).split() if text else []


def word_spans(text: str) -> list[tuple[int, int]]:
    """Start and end of each word in the original text."""
    return [m.span() for m in _WORD.finditer(text)]


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW_WORDS, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(words, items): every distinct window, as text with blanks, and the ids of its items, sorted."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, texts = (c.to_pylist() for c in batch.columns)
            pairs = set()
            for item, whole in zip(items, texts, strict=True):
                words = normal_words(whole)
                for i in range(min(len(words), max(1, len(words) - window + 1))):
                    pairs.add((b" ".join(words[i : i + window]), item))
                    if len(words) <= window:
                        break
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.decode() for w, _ in pairs], pa.string()), pa.array([i for _, i in pairs], pa.string())], names=["words", "item"]
            )

    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    windows = rows.mapInArrow(cut, "words string, item string")
    return windows.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items"))


class WindowFinder:
    """One automaton over windows given as lists of words."""

    def __init__(self, windows: list[tuple[str, list[str]]]):
        import ahocorasick

        self.letters: dict[bytes, str] = {}
        self.automaton = ahocorasick.Automaton()
        for text, items in windows:
            words = text.encode().split(b" ")
            self.automaton.add_word("".join(map(self._letter, words)), (len(words), items))
        self.automaton.make_automaton()
        self.empty = not windows

    def _letter(self, word: bytes) -> str:
        """The word's character; surrogates are left out."""
        n = len(self.letters) + 1
        return self.letters.setdefault(word, chr(n if n < 0xD800 else n + 0x800))

    def find(self, words: list[bytes]) -> list[tuple[int, int, list[str]]]:
        """(first word, word after the last, items) of every occurrence of a window."""
        if self.empty or not words:
            return []
        get = self.letters.get
        line = "".join([get(w, _UNKNOWN) for w in words])
        return [(end - n + 1, end + 1, items) for end, (n, items) in self.automaton.iter(line)]


_finders: dict[str, WindowFinder] = {}


def _finder(shared) -> WindowFinder:
    """A worker builds the automaton of a broadcast once and holds one at a time."""
    if shared.key not in _finders:
        _finders.clear()
        _finders[shared.key] = WindowFinder(shared.windows.value)
    return _finders[shared.key]


class _Shared:
    """A broadcast part of the windows, and a key that tells parts apart."""

    def __init__(self, spark: SparkSession, windows: list[tuple[str, list[str]]]):
        self.key = hashlib.sha256(repr(windows).encode()).hexdigest()
        self.windows = spark.sparkContext.broadcast(windows)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _parts(benchmark: DataFrame, window: int, per_part: int) -> tuple[int, Iterator[_Shared]]:
    """The number of parts and, one after the other, the parts: per_part windows or little more each."""
    spark = benchmark.sparkSession
    windows = written(benchmark_windows(benchmark, window), "benchmark-windows")
    n = max(1, -(-windows.count() // per_part))
    part = F.pmod(F.xxhash64("words"), F.lit(n))
    return n, (_Shared(spark, [(r.words, r.items) for r in windows.where(part == i).collect()]) for i in range(n))


def _search(shared: _Shared) -> Callable:
    def make():
        finder = _finder(shared)

        def compute(texts):
            counts, starts, ends, items = [], [], [], []
            for text in texts:
                words = normal_words(text)
                found = finder.find(words)
                spans = _merged([(s, e) for s, e, _ in found])
                counts.append(len(words))
                starts.append([s for s, _ in spans])
                ends.append([e for _, e in spans])
                items.append(sorted({i for _, _, each in found for i in each}))
            return counts, starts, ends, items

        return compute

    return make


def with_hits(docs: DataFrame, benchmark: DataFrame, names: dict[str, str], keep: list[str], window: int = WINDOW_WORDS, per_part: int = WINDOWS_PER_PART) -> DataFrame:
    """Columns ``keep`` of ``docs`` with n_words, the merged runs of hit words (starts, ends) and
    the items that occur, under the names that ``names`` gives them."""
    n_parts, parts = _parts(benchmark, window, per_part)
    fields = [(names[n], t) for n, t in HITS]
    if n_parts == 1:
        return map_texts(docs, _search(next(parts)), fields, keep)
    text = fresh(docs, "searched_text")
    current, kept = docs.withColumn(text, F.col("text")), [*keep, text]
    for i, shared in enumerate(parts):
        found = [(n if i == 0 else n + "_more", t) for n, t in fields]
        current = map_texts(current, _search(shared), found, kept, text)
        for name, _ in fields[1:] if i else []:
            current = current.withColumn(name, F.concat(name, name + "_more"))
        current = written(current.select(*kept, *(n for n, _ in fields)), "benchmark-hits")
        kept = [*keep, text, *(n for n, _ in fields)]
    runs = F.array_sort(F.arrays_zip(F.col(names["starts"]).alias("s"), F.col(names["ends"]).alias("e")))
    zero = F.array().cast("array<struct<s:int,e:int>>")
    merged = F.aggregate(
        runs,
        zero,
        lambda acc, r: F.when((F.size(acc) > 0) & (r["s"] <= F.get(acc, F.size(acc) - 1)["e"]),
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                     F.array(F.struct(F.get(acc, F.size(acc) - 1)["s"].alias("s"), F.greatest(F.get(acc, F.size(acc) - 1)["e"], r["e"]).alias("e"))))
        ).otherwise(F.concat(acc, F.array(F.struct(r["s"].alias("s"), r["e"].alias("e"))))),
    )
    return current.withColumn(text, merged).select(
        *keep,
        names["n_words"],
        F.col(f"{text}.s").alias(names["starts"]),
        F.col(f"{text}.e").alias(names["ends"]),
        F.array_sort(F.array_distinct(names["items"])).alias(names["items"]),
    )


def contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, **options) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default: all) with n_words, n_hit, n_items, items_sha256 and contaminated.

    A column of ``docs`` with one of these names gives way.
    """
    report = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in report]
    names = {n: fresh(docs, "found_" + n) for n, _ in HITS}
    found = with_hits(docs, benchmark, names, keep, **options)
    lengths = F.zip_with(names["starts"], names["ends"], lambda s, e: (e - s).cast("long"))
    n_hit = F.aggregate(lengths, F.lit(0).cast("long"), lambda a, n: a + n)
    n_words = F.col(names["n_words"])
    return found.select(
        *(F.col(f"`{c}`") for c in keep),
        n_words.alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(names["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names["items"]).cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (HIT_WORDS_IN * n_hit >= n_words)).alias("contaminated"),
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated."""
    names = {n: fresh(docs, "found_" + n) for n, _ in HITS}
    found = with_hits(docs, benchmark, names, docs.columns, **options)
    n_hit = F.aggregate(F.zip_with(names["starts"], names["ends"], lambda s, e: e - s), F.lit(0), lambda a, n: a + n)
    return found.where((n_hit == 0) | (HIT_WORDS_IN * n_hit < F.col(names["n_words"]))).select(*(F.col(f"`{c}`") for c in docs.columns))


def hit_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, per_part: int = WINDOWS_PER_PART) -> DataFrame:
    """(doc_id, start, end, passage): the runs of hit words, by character in the original text."""
    names = {n: n for n, _ in HITS}
    found = with_hits(docs.select("doc_id", "text"), benchmark, names, ["doc_id", "text"], window, per_part)

    def to_text(batches):
        for batch in batches:
            rows = []
            for doc_id, text, starts, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = word_spans(text)
                for s, e in zip(starts, ends, strict=True):
                    rows.append((doc_id, at[s][0], at[e - 1][1], text[at[s][0] : at[e - 1][1]]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 4, [batch.schema.field(0).type, pa.int32(), pa.int32(), pa.string()], strict=True)], names=["doc_id", "start", "end", "passage"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("passage", T.StringType())])
    return found.where(F.size("starts") > 0).select("doc_id", "text", "starts", "ends").mapInArrow(to_text, schema)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(documents(spark, sf_dir), benchmark, keep=["doc_id"])


_SQL_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP9_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW_WORDS}) AS n, array_to_string(list_slice(w, i, i + {WINDOW_WORDS - 1}), ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW_WORDS - 2}, 2))) AS i FROM b WHERE len(w) > 0)
), places AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS words
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), hits AS (SELECT doc_id, i, p.n, item_id FROM places p JOIN windows USING (n, words)),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND {HIT_WORDS_IN} * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
