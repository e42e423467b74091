import random
from collections import defaultdict

import pytest

from gridshard.llm import mixing

WEIGHTS = (1.0, 2.0, 3.0)


def water_filled(sizes, weights, share, most):
    """Targets by giving out what is left, again and again."""
    target = dict.fromkeys(sizes, 0.0)
    full = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        free = {s: weights[s] for s in sizes if s not in full}
        for s in free:
            target[s] = left * free[s] / sum(free.values())
        over = {s for s in free if target[s] > most * sizes[s]}
        if not over:
            return target | {s: most * sizes[s] for s in full}
        full |= over


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_words_taken(make_docs, seed):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 40)), "en", f"s{min(rng.randrange(8), rng.randrange(8))}") for i in range(400)]
    got = mixing.mix_report(make_docs(rows), WEIGHTS).collect()
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len(text.split())
    expected = water_filled(sizes, {s: WEIGHTS[i % 3] for i, s in enumerate(sorted(sizes))}, 1.0, 3)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert taken[s] == int(expected[s] + 0.5)
    assert sorted(got) == sorted(mixing.mix_report(make_docs(rows), WEIGHTS).collect())


def test_mix_holds_the_words_that_the_report_says(make_docs):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{i}" for _ in range(rng.randrange(1, 30))), "en", "abcd"[i % 4]) for i in range(120)]
    docs = make_docs(rows)
    taken = {r.doc_id: r.taken for r in mixing.mix_report(docs, WEIGHTS).collect()}
    words = defaultdict(int)
    for r in mixing.mix(docs, WEIGHTS).collect():
        words[r.doc_id] += len(r.text.split())
    assert words == {d: n for d, n in taken.items() if n}


def test_edge_cases(edge_docs, edge_rows, no_docs):
    report = mixing.mix_report(edge_docs, WEIGHTS).collect()
    assert len(report) == len(edge_rows)
    assert all(r.size == 0 and r.taken == 0 for r in report if r.doc_id in (1, 2, 3, 12))
    # A null source is the last one.
    assert {r.source_size for r in report if r.source is None} == {1}
    mixed = mixing.mix(edge_docs, WEIGHTS)
    assert mixed.columns == edge_docs.columns
    assert {r["Score"] for r in mixed.collect()} == {"kept as it is"}
    # Without words a document stays once.
    assert sum(r.doc_id == 2 for r in mixed.collect()) == 1
    assert mixing.mix_report(no_docs, WEIGHTS).count() == mixing.mix(no_docs, WEIGHTS).count() == 0


@pytest.mark.parametrize("doc_id", [None, 7])
def test_rows_without_ids_of_their_own_are_not_all_cut(make_docs, doc_id):
    """Texts that share an id have places of their own: one of a source is cut, within its text as it is."""
    rng = random.Random(11)
    rows = [(doc_id, "  ".join(f"w{i}\n" for _ in range(rng.randrange(2, 30))), "en", "abc"[i % 3]) for i in range(90)]
    whole = {r[1]: r[3] for r in rows}
    cut = [r for r in mixing.mix(make_docs(rows), WEIGHTS).collect() if r.text not in whole]
    assert 1 <= len(cut) <= 3 and len({r.source for r in cut}) == len(cut)
    for r in cut:
        (text,) = [t for t in whole if t.startswith(r.text + "\n")]
        assert whole[text] == r.source


def test_equal_ids_share_what_is_left(make_docs):
    rows = [(1, "a b c d", "en", "x")] * 50 + [(2, "a b", "en", "y")]
    got = mixing.mix_report(make_docs(rows), WEIGHTS).collect()
    assert len({r.taken for r in got if r.doc_id == 1}) == 1
