import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridshard.llm import divergence

LOWER = {c: c + 32 for c in range(65, 91)}
COLUMNS = ["lang", "source", "part", "item", "value", "rank"]
BILLION = 10**9


def brute(rows, min_docs=10, k=10):
    counts, in_docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        counts[lang, source].update(terms)
        in_docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in in_docs[lang].items() if n >= min_docs]
        sources = sorted(s for g, s in groups if g == lang)
        total = Counter()
        for s in sources:
            total.update(counts[lang, s])

        def share(counter, term):
            return 1 + BILLION * (counter[term] + 2) // (sum(counter[t] for t in kept) + 2 * len(kept))

        p = {s: {t: share(counts[lang, s], t) for t in kept} for s in sources}
        q = {t: share(total, t) for t in kept}
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, k)):
                ranked = sorted(items, key=lambda i: (-i[1], i[0].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(ranked[:most], 1)]
    return out


def some_rows(rng, n, sources, langs=("en", "de", None)):
    words = [f"{a}{b}" for a in "abcdefghij" for b in ("", "x", "é", "Ü", "你", "zz")]
    rows = []
    for i in range(n):
        source = rng.choice(sources)
        own = rng.sample(words, 12) if source is None else words[: 10 + 7 * len(source)]
        rows.append((i, " ".join(rng.choices(own, k=rng.randrange(40))), rng.choice(langs), source))
    return rows


def compare(got, expected):
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_against_brute_force(make_docs):
    rows = some_rows(random.Random(1), 300, ["a", "bb", "ccc", "dddd", None])
    compare(divergence.divergence(make_docs(rows, clashing=True)), brute(rows))


def test_small_skybands_slices_and_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_TERMS", 7)
    monkeypatch.setattr(divergence, "SKYBAND_ROWS", 3)
    monkeypatch.setattr(divergence, "_CHUNK", 2)
    monkeypatch.setattr(divergence, "SLICE_SHARES", 40)
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", 2)
    rows = some_rows(random.Random(2), 250, ["a", "bb", "ccc", "dddd", None])
    for k in (1, 3):
        compare(divergence.divergence(make_docs(rows), 5, k), brute(rows, 5, k))


def test_skyband_keeps_what_fewer_than_k_dominate():
    rng = np.random.default_rng(3)
    for size, most in ((5, 4), (400, 6), (3000, 40), (2000, 10**6)):
        n, total = rng.integers(1, most, size), rng.integers(1, most, size)
        terms = np.array([f"t{i}".encode() for i in rng.permutation(size)], object)
        got = set(divergence.skyband(n, total, terms, 4).tolist())
        for i in range(size):
            above = (n >= n[i]) & (total <= total[i]) & (terms < terms[i])
            assert (above.sum() < 4) == (i in got)


def test_shares_of_large_counts():
    rng = random.Random(4)
    counts = [rng.randrange(10**14) for _ in range(500)]
    totals = [c + rng.randrange(1, 10**15) for c in counts]
    got = divergence.shares(np.array(counts), np.array(totals))
    assert got.tolist() == [1 + BILLION * c // t for c, t in zip(counts, totals)]


def test_groups_without_terms_and_languages_without_kept_terms(make_docs):
    rows = [(i, "alpha beta gamma" if i % 2 else "beta", "en", f"s{i % 3}") for i in range(30)]
    rows += [(50, None, "en", "empty"), (51, "", "en", None), (52, "alone", "xx", "a"), (53, "else", "xx", "b"), (54, None, None, None)]
    expected = brute(rows)
    assert ("xx", "a", "pair", "b", 0, 1) in expected and any(r[1] == "empty" for r in expected)
    compare(divergence.divergence(make_docs(rows)), expected)


def test_edge_cases(edge_docs, edge_rows):
    compare(divergence.divergence(edge_docs), brute(edge_rows))
    compare(divergence.divergence(edge_docs, 1), brute(edge_rows, 1))


def test_ties_go_by_bytes(make_docs):
    rows = [(i, "zz é Ab \U0001f600 ￿ you", "en", "a") for i in range(12)] + [(20 + i, "you you you", "en", "b") for i in range(12)]
    expected = brute(rows)
    assert [r[3] for r in sorted(expected, key=lambda r: r[5]) if r[1:3] == ("a", "term")] == ["ab", "zz", "é", "￿", "\U0001f600"]
    compare(divergence.divergence(make_docs(rows)), expected)


@pytest.mark.parametrize("min_docs", [1, 10])
def test_no_rows(no_docs, min_docs):
    out = divergence.divergence(no_docs, min_docs)
    assert out.columns == COLUMNS and out.collect() == []
