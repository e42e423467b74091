import random
from collections import defaultdict

import numpy as np
import pytest

from gridshard.llm import jaccard_join as J
from gridshard.llm import set_relations
from gridshard.llm.graphs import components

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(text):
    w = (text or "").translate(LOWER).encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """(n_shingles, component, links) of each row."""
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))
    links = [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)].append(r[0])
    return [(r[0], len(sets[i]), min(least[find(i)], default=None), links[i]) for i, r in enumerate(rows)]


def near_copies(seed, n=60):
    """Families of texts with edits, some beyond the threshold, some on it, and a passage that all share."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(12)]
    rows = []
    for i in range(n):
        if i % 6 == 0:
            base = [f"{rng.randrange(50)}" for _ in range(rng.choice([3, 5, 8, 20, 60]))] + (passage if rng.random() < 0.7 else [])
        text = list(base)
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(9)}"
        rows.append((1000 - i, " ".join(text).upper() if i % 4 == 0 else "  ".join(text), "en", "s"))
    return rows


def key(r):
    return tuple(-1 if v is None else v for v in r)


@pytest.mark.parametrize("seed", range(4))
def test_components_and_links_equal_brute_force(make_docs, edge_rows, seed):
    rows = near_copies(seed) + edge_rows
    got = [tuple(r) for r in J.jaccard_components(make_docs(rows)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_blocks_buckets_and_chunks_lose_no_link(make_docs, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_SETS", 4)
    monkeypatch.setattr(J, "BUCKET_BYTES", 500)
    rows = near_copies(7, 90) + [(i, f"{' '.join(map(str, range(40)))} {i % 30}", "en", "s") for i in range(60)]
    got = [tuple(r) for r in J.jaccard_components(make_docs(rows)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_one_of_each_group_stays(make_docs, edge_rows, edge_docs, no_docs):
    rows = near_copies(3) + [r for r in edge_rows if r[0] is not None]
    expected = sorted({r[0] for r, (i, n, c, _) in zip(rows, brute(rows), strict=True) if n == 0 or i == c})
    assert sorted(r.doc_id for r in J.one_of_each(make_docs(rows)).collect()) == expected
    kept = J.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    assert [r.text for r in kept.collect() if r.doc_id is None] == ["some words of nobody"]
    assert J.one_of_each(no_docs).count() == J.jaccard_components(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_prefix_counts_hold_for_linked_sets(seed):
    """Linked sets share the promised number of hashes within the halves."""
    rng = np.random.default_rng(seed)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        a = np.sort(rng.choice(10_000, n, replace=False))
        b = np.unique(np.concatenate([a[rng.random(n) < 0.9], rng.integers(0, 10_000, rng.integers(0, 5))]))
        if len(b) and 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b)):
            both = np.intersect1d(a[: J.half(len(a))], b[: J.half(len(b))])
            for x in (a, b):
                assert len(both) >= J.shared_wanted(set_relations.least_overlap(len(x)))


@pytest.mark.parametrize("seed", range(10))
def test_links_within_a_group(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**60, 50)
    sets = [np.unique(np.concatenate([base[rng.random(50) < 0.93], rng.integers(0, 2**60, rng.integers(0, 8))])) for _ in range(40)]
    sets += [np.unique(rng.integers(0, 2**60, 3)) for _ in range(5)]
    weights = rng.integers(1, 4, len(sets))
    links = {(i, j) for i in range(len(sets)) for j in range(len(sets)) if i != j and 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))}
    every = np.arange(len(sets))
    roots, counts = set_relations.linked(sets, weights, every, every)
    assert counts.tolist() == [sum(weights[j] for i, j in links if i == k) for k in range(len(sets))]
    assert all(roots[i] == roots[j] for i, j in links)
    _, across = set_relations.linked(sets, weights, every[:20], every[20:])
    assert across.tolist() == [sum(weights[j] for i, j in links if i == k and (i < 20) != (j < 20)) for k in range(len(sets))]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)}
