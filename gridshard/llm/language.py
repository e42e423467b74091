"""Language identification, word first.

A word that the training texts know scores by its log frequency in each language. A word
they don't know scores by its longest known character n-gram suffixes and prefixes: all n-grams of
one length that are known are averaged, and only if none is known the next shorter length is tried.
A text's language has the highest sum over its words. Words are letters with the marks that go with them.

The model is learned in Spark from at most about TRAIN_DOCS labelled texts of each language and MAX_TRAIN_DOCS in
all, picked by a hash of id and text; rows equal in both are one. What the texts have at least MIN_SEEN times
is known. The model, a row for each known term with the languages that have it, is as bounded as the sample, and it is broadcast.

Nulls: a null text, or one without a letter, is UNKNOWN with score 0; so is any text if no
language could be learned. Rows without language or text teach nothing; a null id counts as empty text. Ties go to the first language in code point order.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridshard.llm.common import discard, documents, fresh, give_back, held_out, map_texts, slices, written
from gridshard.llm.repair import expand_ranges

UNKNOWN = "und"
TRAIN_DOCS = 2_000
MAX_TRAIN_DOCS = 40_000
MIN_SEEN = 2
LENGTHS = (5, 4, 3, 2, 1)
# Words that a worker remembers the scores of, and scores it remembers.
CACHE_WORDS = 100_000
CACHE_SCORES = 2_000_000
_RUN = regex.compile(r"\p{L}[\p{L}\p{M}]*")
FIELDS = [("lang_pred", T.StringType()), ("score", T.DoubleType())]


def words_of(text: str) -> list[str]:
    return _RUN.findall(text.lower())


def has_letter(text: str | None) -> bool:
    return text is not None and (re.search("[A-Za-z]", text) is not None or any(map(str.isalpha, text)))


def ngrams(word: str, n: int) -> list[str]:
    # The marks of the ends alone say nothing.
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def training_sample(docs: DataFrame, per_language: int, in_all: int = MAX_TRAIN_DOCS, lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """(lang, text): about ``per_language`` different texts of each language, ``in_all`` at most, all if there are fewer."""
    labelled = docs.where(F.col(lang).isNotNull() & F.col("text").isNotNull())
    pair = F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "text").alias("pair")
    labelled = labelled.select(F.col(lang).cast("string").alias("lang"), "text", pair)
    # Written, so that Spark knows how small it is and leaves the texts where they are. One row for each language.
    sizes = written(labelled.groupBy(F.col("lang").alias("of")).agg(F.approx_count_distinct("pair", 0.02).alias("n")), "language-sizes")
    of_each = min(per_language, in_all // max(1, sizes.count()))
    chance = F.pmod("pair", F.lit(1 << 30)) / F.lit(float(1 << 30))
    # The estimate of n is a few hundredths off, and where there are about as many as wanted, all are taken.
    some = labelled.join(sizes, F.col("lang") == F.col("of")).where(chance * F.col("n") < 1.1 * of_each)
    return some.groupBy("lang", "pair").agg(F.first("text").alias("text")).select("lang", "text")


def _counted(batches):
    """(lang, kind, term, n) of the words and n-grams of a slice of texts; kind is 0 or the n-gram's length."""
    for batch in batches:
        texts = batch.column(1)
        for start, end in slices(texts):
            words: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(batch.column(0).slice(start, end - start).to_pylist(), texts.slice(start, end - start).to_pylist(), strict=True):
                words[lang].update(words_of(text))
            rows = []
            for lang, counts in words.items():
                rows += [(lang, 0, w, n) for w, n in counts.items()]
                for length in LENGTHS:
                    grams: Counter = Counter()
                    for w, n in counts.items():
                        for g in ngrams(w, length):
                            grams[g] += n
                    rows += [(lang, length, g, n) for g, n in grams.items()]
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.string(), pa.int64()), strict=True)], names=["lang", "kind", "term", "n"])
    give_back()


class LanguageModel:
    """Log frequencies of words and n-grams by language: for each term those of the languages that have it."""

    def __init__(self, rows: list[tuple[str, int, str, int]], totals: dict[tuple[str, int], tuple[int, int]]):
        """``totals`` has for each language and kind the number of tokens and of types, known ones and others."""
        self.languages = sorted({lang for lang, _ in totals})
        place = {lang: i for i, lang in enumerate(self.languages)}
        self.at: dict[int, dict[str, int]] = {k: {} for k in (0, *LENGTHS)}
        self.has: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.lacks: dict[int, np.ndarray] = {}
        found: dict[int, list[tuple[int, int, int]]] = {k: [] for k in self.at}
        for lang, kind, term, n in rows:
            terms = self.at[kind]
            found[kind].append((terms.setdefault(term, len(terms)), place[lang], n))
        for kind, of_kind in found.items():
            tokens, types = (np.array([totals.get((lang, kind), (0, 0))[i] for lang in self.languages], float) for i in (0, 1))
            weight = np.log(tokens + 0.5 * (types + 1))
            table = np.array(sorted(of_kind), np.int64).reshape(-1, 3)
            starts = np.searchsorted(table[:, 0], np.arange(len(self.at[kind]) + 1))
            langs = table[:, 1].astype(np.int32)
            # Scores of terms that a language doesn't have, and how much more those score that it has.
            self.lacks[kind] = np.log(0.5) - weight
            self.has[kind] = starts, langs, (np.log(table[:, 2] + 0.5) - np.log(0.5)).astype(np.float32)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.room = min(CACHE_WORDS, max(1, CACHE_SCORES // max(1, len(self.languages))))
        self.table = np.zeros((self.room, len(self.languages)))

    def _terms(self, word: str) -> tuple[int, list[int]]:
        """What a word is scored by: itself if it is known, or its known n-grams of the longest length that has any."""
        at = self.at[0].get(word)
        if at is not None:
            return 0, [at]
        for n in LENGTHS:
            known = [i for i in map(self.at[n].get, ngrams(word, n)) if i is not None]
            if known:
                return n, known
        return 0, []

    def _remember(self, words: list[str]) -> None:
        """The mean scores of the terms of each of some new words, in each language."""
        rows: dict[int, list[int]] = defaultdict(list)
        terms: dict[int, list[list[int]]] = defaultdict(list)
        for word in words:
            row = self.known[word] = len(self.known)
            kind, found = self._terms(word)
            if found:
                rows[kind].append(row)
                terms[kind].append(found)
        n = len(self.languages)
        for kind, found in terms.items():
            starts, langs, more = self.has[kind]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            term = np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))
            counts = starts[term + 1] - starts[term]
            at = expand_ranges(np.arange(len(langs)), starts[term], counts)
            place = np.repeat(np.repeat(np.arange(len(found)), sizes), counts)
            weight = np.repeat(np.repeat(1 / sizes, sizes), counts)
            sums = np.bincount(place * n + langs[at], more[at] * weight, minlength=len(found) * n)
            self.table[rows[kind]] = self.lacks[kind] + sums.reshape(-1, n)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its probability among those learned, with words taken as independent."""
        return self.judge(text)[:2]

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """What ``predict`` says, and whether any word or n-gram of the text is known."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, False
        counts = Counter(words_of(text))
        total, words = np.zeros(len(self.languages)), list(counts)
        for start in range(0, len(words), self.room):
            some = words[start : start + self.room]
            if len(self.known) + len(some) > self.room:
                self.forget()
            self._remember([w for w in some if w not in self.known])
            total += np.array([counts[w] for w in some]) @ self.table[[self.known[w] for w in some]]
        best = int(np.argmax(total))
        # What is known has a score below 0 in some language.
        return self.languages[best], 1.0 / float(np.exp(np.maximum(total - total[best], -700.0)).sum()), bool(total.any())

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "table")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self.forget()


def learn(docs: DataFrame, per_language: int = TRAIN_DOCS, in_all: int = MAX_TRAIN_DOCS, min_seen: int = MIN_SEEN) -> LanguageModel:
    """A model of the texts and languages of ``docs`` (doc_id, text, lang): of their terms those seen at least ``min_seen`` times in a language."""
    counts = training_sample(docs, per_language, in_all).mapInArrow(_counted, "lang string, kind int, term string, n long")
    counts = written(counts.groupBy("lang", "kind", "term").agg(F.sum("n").alias("n")), "language-counts")
    totals = {(r.lang, r.kind): (r.tokens, r.types) for r in counts.groupBy("lang", "kind").agg(F.sum("n").alias("tokens"), F.count("*").alias("types")).collect()}
    # As many as the bounded sample has.
    rows = counts.where(F.col("n") >= min_seen).toArrow()
    discard(counts)
    return LanguageModel(list(zip(*(rows[c].to_pylist() for c in ("lang", "kind", "term", "n")), strict=True)), totals)


def predicted(docs: DataFrame, model: LanguageModel, keep: list[str] | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default: all) with the predicted language and its score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable:
        model = shared.value
        return lambda texts: tuple(zip(*map(model.predict, texts), strict=True)) or ((), ())

    return map_texts(docs, make, [(n, t) for n, (_, t) in zip(names, FIELDS, strict=True)], keep)


def identify(docs: DataFrame, train: Column, keep: list[str] | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with predictions of a model learned from its rows where ``train`` holds."""
    return predicted(docs, learn(docs.where(train)), keep, names)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    found = identify(docs, ~held_out(), ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def only_known(docs: DataFrame, margin: float, train: Column) -> DataFrame:
    """The rows of ``docs`` whose language can be told: some word or n-gram is known, and the most probable
    language has at least ``margin`` times the probability it would have by chance, 1 / the number of languages (or 1, if that is less).

    If no language could be learned there is nothing to tell it by, and all texts with a letter stay.
    """
    model = learn(docs.where(train))
    least = min(1.0, margin / max(1, len(model.languages)))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = fresh(docs, "lang_told")

    def make() -> Callable:
        model = shared.value

        def told(text: str | None) -> bool:
            if not model.languages:
                return has_letter(text)
            _, score, known = model.judge(text)
            return known and score >= least

        return lambda texts: [list(map(told, texts))]

    found = map_texts(docs, make, [(kept, T.BooleanType())])
    return found.where(F.col(kept)).select(*(F.col(f"`{c}`") for c in docs.columns))
