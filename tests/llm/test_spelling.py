import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridshard.llm import spelling

LOWER = {c: c + 32 for c in range(65, 91)}
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute_counts(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[a-zÀ-ÿ]+", (text or "").translate(LOWER)):
            crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = crc % len(run)
            counts[run[:at] + run[at + 1 :] if crc % 97 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute_groups(counts):
    rows, forms = [], {}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 2 * n:
            forms[w] = best
    for w, n in counts.items():
        root = w
        while root in forms:
            root = forms[root]
        form = forms.get(w)
        rows.append((w, form, root, n, len(near[w]), counts[form] if form else None))
    return rows


def near_words(rng, n, letters, sizes):
    """Words of which many are an edit or two apart, with runs of equal letters."""
    words = ["".join(rng.choice(letters) for _ in range(rng.choice(sizes))) for _ in range(n // 4)]
    while len(words) < n:
        w = rng.choice(words)
        i = rng.randrange(len(w))
        words.append(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :], w[:i] + w[i] + w[i:]]))
    return [w for w in words if len(w) >= 5]


@pytest.mark.parametrize("max_pairs", [1, 30, 1_000_000])
def test_pairs_against_all_pairs(spark, max_pairs):
    rng = random.Random(max_pairs)
    words = sorted({*near_words(rng, 300, "ab", range(5, 9)), *near_words(rng, 300, "abcàé", range(5, 14))})
    table = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long").repartition(5)
    got = Counter(tuple(sorted((r["word"], r["near"]))) for r in spelling.near_pairs(table, max_pairs).collect())
    expected = {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if one_edit(a, b)}
    assert set(got) == expected
    assert set(got.values()) == {1}


def test_a_chunk_that_all_words_share_is_made_longer(spark, monkeypatch):
    """A thousand words with the same beginning: few candidates are verified."""
    rng = random.Random(1)
    words = sorted({"prefixe" + "".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(1000)})
    table = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    candidates = []
    verified = spelling._verified

    def counted(rows):
        sizes = rows.groupBy("around").agg(F.count_if("longer").alias("c"), F.count("*").alias("g"))
        candidates.append(sizes.agg(F.sum(F.col("c") * F.col("g"))).first()[0] or 0)
        return verified(rows)

    monkeypatch.setattr(spelling, "_verified", counted)
    pairs = spelling.near_pairs(table, 64)
    assert {tuple(sorted((r[0], r[2]))) for r in pairs.collect()} == {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if one_edit(a, b)}
    assert sum(candidates) < len(words) * 100


def test_groups_against_brute_force(make_docs):
    rng = random.Random(2)
    words = near_words(rng, 250, "abcdé", range(5, 10))
    weighted = [w for i, w in enumerate(words) for _ in range(rng.choice([1, 3, 7, 20, 60]))]
    rows = [(i, " ".join(rng.choices(weighted, k=300)) + "; Ab×cdEĀabcde-X", "en", "a") for i in range(40)]
    got = spelling.spelling_groups(make_docs(rows, clashing=True))
    assert got.columns == COLUMNS
    expected = brute_groups(brute_counts(rows))
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    # Chains of more than one step, and words with a letter deleted.
    assert any(form and root != form for _, form, root, *_ in expected)


def test_letters_deleted_by_the_hash(make_docs):
    runs = ["abcdefgh"] * 400
    rows = [(i, " ".join(["abcdefgh"] * 3), None, None) for i in range(len(runs))]
    got = {r["word"]: r["n"] for r in spelling.words_of(make_docs(rows)).collect()}
    assert got == brute_counts(rows) and len(got) > 1


def test_edge_cases(edge_docs, edge_rows):
    got = spelling.spelling_groups(edge_docs)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute_groups(brute_counts(edge_rows)), key=str)


def test_repeated_rows_and_small_memory(make_docs, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    rows = [(1, "alpha alphb alpho gamma delta deltas", "en", "a")] * 5 + [(None, "alpha gamma", None, None)] * 2
    got = spelling.spelling_groups(make_docs(rows))
    assert sorted(map(tuple, got.collect())) == sorted(brute_groups(brute_counts(rows)))


def test_no_words(no_docs, make_docs):
    for docs in (no_docs, make_docs([(1, None, None, None), (2, "", "en", "a"), (3, "word", "en", "a")])):
        out = spelling.spelling_groups(docs)
        assert out.columns == COLUMNS and out.collect() == []
