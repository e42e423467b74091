import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpus_pipeline import known_language
from gridshard.llm import language as L
from gridshard.llm.common import held_out

SYLLABLES = {"en": ["the", "ing", "sh", "wh"], "de": ["sch", "ung", "ein", "zu"], "fr": ["eau", "tre", "oi", "é"]}


def text_in(lang, rng, n=30):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def training(make_docs, n=60):
    rng = random.Random(1)
    return make_docs([(i, text_in(lang, rng), lang, "s") for i in range(n) for lang in [list(SYLLABLES)[i % 3]]])


def test_held_out_accuracy_on_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    found = L.identify(docs, ~held_out(), ["doc_id", "lang"]).where(held_out())
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.99


def test_known_words_come_first_and_then_the_longest_ngrams():
    totals = {(lang, k): (10, 5) for lang in ("a", "b") for k in (0, *L.LENGTHS)}
    rows = [("a", 0, "word", 5), ("b", 5, "<word", 9), ("b", 3, "<un", 4), ("a", 2, "un", 4)]
    model = L.LanguageModel(rows, totals)
    assert model.predict("word")[0] == "a"
    assert model.predict("words")[0] == "b"  # unknown: its 5-gram decides
    assert model.predict("unx")[0] == "b"  # the 3-gram before the 2-gram
    # Equal scores go to the first language.
    assert model.predict("zzz") == ("a", 0.5)


def test_words_beyond_the_cache_score_the_same(monkeypatch, make_docs):
    docs = training(make_docs)
    model = L.learn(docs)
    text = " ".join(r.text for r in docs.take(20)) + " quite unknown words"
    expected = model.predict(text)
    monkeypatch.setattr(L, "CACHE_WORDS", 7)
    model.forget()
    assert model.predict(text) == pytest.approx(expected)


def test_edge_cases(make_docs, edge_docs, no_docs):
    model = L.learn(training(make_docs))
    got = L.predicted(edge_docs, model, ["doc_id", "text"]).collect()
    for r in got:
        letters = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.lang_pred != "und") == letters and 0 <= r.score <= 1
        assert r.lang_pred in ("und", *SYLLABLES)
    assert L.predicted(no_docs, model).count() == 0
    # Nothing to learn from: everything is unknown.
    assert {r.lang_pred for r in L.predicted(edge_docs, L.learn(no_docs)).collect()} == {"und"}
    kept = L.only_known(edge_docs, 1.1, F.lit(True))
    assert kept.columns == edge_docs.columns and {1, 2, 3, 12}.isdisjoint(r.doc_id for r in kept.collect())
    digits = make_docs([(1, "12 34 ²½Ⅷ _", "en", "s"), (2, "你", "en", "s")])
    assert [r.lang_pred for r in L.predicted(digits, model).orderBy("doc_id").collect()] == ["und", "de"]


def test_terms_seen_once_are_not_known(make_docs):
    docs = make_docs([(1, "a a a b b c d", "x", "s"), (2, "q q", "y", "s")])
    assert set(L.learn(docs).at[0]) == {"a", "b", "q"}
    assert set(L.learn(docs, min_seen=1).at[0]) == {"a", "b", "c", "d", "q"}


def test_marks_belong_to_words():
    assert L.words_of("हिन्दी में लिखा") == ["हिन्दी", "में", "लिखा"]
    assert L.words_of("E\u0301te\u0301 x2y_z") == ["e\u0301te\u0301", "x", "y", "z"]


def brute_predictions(rows, train, min_seen=2):
    """The languages of all rows, learned from all of ``train``, with plain dictionaries."""
    counts = {}
    for _, text, lang, _ in {(r[0], r[1], r[2], None) for r in train if r[1] is not None and r[2] is not None}:
        terms = counts.setdefault(lang, {k: Counter() for k in (0, *L.LENGTHS)})
        for word in L.words_of(text):
            terms[0][word] += 1
            for n in L.LENGTHS:
                terms[n].update(L.ngrams(word, n))
    languages = sorted(counts)

    def score(kind, term, lang):
        seen = counts[lang][kind]
        n = seen[term] if seen[term] >= min_seen else 0
        return math.log(n + 0.5) - math.log(seen.total() + 0.5 * (len(seen) + 1))

    def known(kind, term):
        return any(counts[lang][kind][term] >= min_seen for lang in languages)

    def word_scores(word):
        if known(0, word):
            return [score(0, word, lang) for lang in languages]
        for n in L.LENGTHS:
            grams = [g for g in L.ngrams(word, n) if known(n, g)]
            if grams:
                return [sum(score(n, g, lang) for g in grams) / len(grams) for lang in languages]
        return [0.0] * len(languages)

    out = []
    for _, text, *_ in rows:
        if text is None or not any(map(str.isalpha, text)) or not languages:
            out.append(("und", 0.0))
            continue
        sums = [sum(column) for column in zip(*map(word_scores, L.words_of(text)), strict=True)]
        best = max(range(len(sums)), key=lambda i: (sums[i], -i))
        out.append((languages[best], 1 / sum(math.exp(max(s - sums[best], -700)) for s in sums)))
    return out


def test_learning_and_scoring_against_brute_force(make_docs, edge_rows):
    rng = random.Random(3)
    rows = [(i, text_in(lang, rng, rng.randrange(1, 12)), lang, "s") for i in range(90) for lang in [list(SYLLABLES)[i % 3]]]
    rows += edge_rows + [(200, "schwh eauing नमस्ते", None, None), (201, "schwh eauing", "fr", None)]
    expected = brute_predictions(rows, rows)
    got = L.identify(make_docs(rows), F.lit(True), ["doc_id", "text"]).collect()
    by_row = {(r[0], r[1]): e for r, e in zip(rows, expected, strict=True)}
    assert len(got) == len(rows)
    for r in got:
        lang, score = by_row[r.doc_id, r.text]
        assert r.score == pytest.approx(score, abs=1e-4)
        assert r.lang_pred == lang or score < 0.51


def test_query_against_brute_force(spark):
    """Learned from rows that are not held out only, on the smallest documents (all of which are in the sample)."""
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    out = {r[0]: zlib.crc32(str(r[0]).encode()) % 4 == 2 for r in rows}
    expected = brute_predictions(rows, [r for r in rows if not out[r[0]]])
    got = {r.doc_id: r for r in L.op7(spark, sf_dir).collect()}
    for row, (lang, score) in zip(rows, expected, strict=True):
        r = got[row[0]]
        assert (r.held_out, r.lang_pred) == (out[row[0]], lang) and r.score == pytest.approx(score, abs=1e-4)


@pytest.mark.parametrize("ids", [[None], [1, 2, 3]])
def test_every_language_is_learned_whatever_the_ids(make_docs, ids):
    rng = random.Random(4)
    rows = [(ids[i % len(ids)], text_in(lang, rng), lang, "s") for i in range(300) for lang in SYLLABLES]
    sample = L.training_sample(make_docs(rows + rows[:600]), 20).collect()
    sizes = Counter(r.lang for r in sample)
    assert set(sizes) == set(SYLLABLES) and all(8 <= n <= 40 for n in sizes.values())
    # A row that is there many times is one.
    assert len({(r.lang, r.text) for r in sample}) == len(sample)


def test_the_sample_is_bounded_over_all_languages(make_docs):
    rng = random.Random(5)
    rows = [(i, f"{text_in('en', rng)}", f"l{i % 50}", "s") for i in range(5000)]
    assert L.training_sample(make_docs(rows), 80, in_all=1000).count() < 1500


def test_a_model_of_many_languages_is_small():
    """Terms of one language each: a row doesn't grow with the languages."""
    languages = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(200)]
    rows = [(lang, 0, f"{lang}word{chr(97 + i // 10)}{chr(97 + i % 10)}", 3) for lang in languages for i in range(100)]
    model = L.LanguageModel(rows, {(lang, k): (1000, 100) for lang in languages for k in (0, *L.LENGTHS)})
    assert sum(a.nbytes for a in model.has[0]) < 20 * len(rows) and model.table.nbytes <= 8 * L.CACHE_SCORES
    assert all(model.predict(f"{lang}wordah")[0] == lang for lang in languages)


@pytest.mark.parametrize("n", [2, 5])
def test_texts_stay_if_their_language_can_be_told(make_docs, n):
    # The languages share their words but for one each.
    rows = [(i, f"abc bcd abc own{'xyzuv'[i % n]} own{'xyzuv'[i % n]}", f"l{i % n}", "s") for i in range(4 * n)]
    probes = [(100, "abc", None, "s"), (101, "你好", None, "s"), (102, "abc ownx 你好", None, "s"), (103, "...", None, "s"), (104, None, None, "s"), (105, "owny", None, "s")]
    kept = known_language(None, make_docs(rows + probes), "").select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == [*range(4 * n), 102, 105]


def test_without_labels_texts_with_a_letter_stay(make_docs):
    rows = [(1, "abc", None, "s"), (2, "12", None, "s"), (3, None, None, "s"), (4, "é", None, "s"), (5, "", None, "s")]
    assert sorted(r.doc_id for r in known_language(None, make_docs(rows), "").collect()) == [1, 4]


def test_one_language_alone_is_told(make_docs):
    rows = [(i, "some words of it", "en", "s") for i in range(8)] + [(20, "words", None, "s"), (21, "你好", None, "s")]
    assert sorted(r.doc_id for r in known_language(None, make_docs(rows), "").collect()) == [*range(8), 20]
