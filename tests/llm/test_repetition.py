import random
import re
from collections import Counter

import numpy as np
import pytest

from gridshard.llm import repetition as R

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)

    def inside(n):
        windows = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        counts = Counter(windows)
        return {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(n)}

    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, dup = set(), []
    for line in lines:
        if line in seen:
            dup.append(line)
        seen.add(line)
    out = {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall("[#*$%&|<>]", text)),
        "n_dup_lines": len(dup),
        "n_repeat_words": len(inside(8)),
        "dup_line_chars": sum(len("".join(WORD.findall(x))) for x in dup),
    }
    out |= {f"dup_{n}gram_chars": sum(len(words[i]) for i in inside(n)) for n in R.NGRAM_LIMITS}
    out["base_failed"] = out["n_words"] < 20 or 100 * out["n_repeat_words"] > 30 * out["n_words"]
    limits = all(100 * out[f"dup_{n}gram_chars"] <= m * out["word_chars"] for n, m in R.NGRAM_LIMITS.items())
    out["kept"] = not out["base_failed"] and limits and 100 * out["dup_line_chars"] <= R.LINE_LIMIT * out["word_chars"]
    return out


def test_measures_equal_brute_force(make_docs, edge_rows):
    rng = random.Random(3)
    rows = list(edge_rows)
    for i in range(300):
        words = [rng.choice("ab#|*") * rng.randrange(1, 3) for _ in range(rng.randrange(60))]
        rows.append((100 + i, "".join(w + rng.choice(" \n") for w in words), "en", "s"))
    got = R.repetition(make_docs(rows), keep=["doc_id", "text"]).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.asDict() == {"doc_id": r.doc_id, "text": r.text} | brute(r.text)


def test_equal_hashes_are_compared_word_by_word(monkeypatch):
    ids = np.array([1, 2, 3, 1, 2, 3, 4, 5, 6])
    text = np.zeros(9, np.int64)
    expected = R.repeated_starts(ids, text, 3).tolist()
    assert expected == [0, 3]
    # Every window has the same hash now.
    monkeypatch.setattr(R, "_mixed", lambda x: np.zeros_like(x))
    assert R.repeated_starts(ids, text, 3).tolist() == expected


def test_windows_stay_within_a_text():
    ids = np.array([1, 2, 1, 2, 1, 2])
    assert R.repeated_starts(ids, np.array([0, 0, 1, 1, 2, 2]), 2).tolist() == []
    assert R.repeated_starts(ids, np.zeros(6, np.int64), 2).tolist() == [0, 1, 2, 3, 4]


def test_clashing_names_and_no_rows(edge_docs, no_docs):
    out = R.repetition(edge_docs)
    assert out.columns.count("n_words") == 1 and {type(r.n_words) for r in out.collect()} == {int}
    assert R.repetition(no_docs).count() == 0


@pytest.mark.parametrize(("text", "kept"), [("the cat sat on a mat " * 10, False), (" ".join(f"w{i}" for i in range(40)), True)])
def test_verdict(make_docs, text, kept):
    assert R.repetition(make_docs([(1, text, "en", "s")])).first().kept is kept
