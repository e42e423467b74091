import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridshard.llm import repair as R

PATH = R.default_tokenizer()
ENCODER = R.TextEncoder(PATH)


def direct(text):
    return ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \t\n\r\x0b\x0c\xa0 \x1c　'sve.,*3aZé你\U0001f600"), max_size=40), max_size=5))
def test_texts_encode_as_the_tokenizer_does(texts):
    assert [x.tolist() for x in ENCODER.encode(texts)] == [direct(t) for t in texts]


def test_characters_are_cut_as_the_tokenizer_does():
    characters = [chr(c) for c in (*range(1, 0xD800), *range(0xE000, 0x10000), *range(0x1F300, 0x1FB00))]
    texts = ["".join(f"a{c}1{c}!{c}  {c} \n{c}\t" for c in characters[i : i + 20]) for i in range(0, len(characters), 20)]
    assert [x.tolist() for x in ENCODER.encode(texts)] == [direct(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("'stmdrevl  \n\u3000a1.")), max_size=4))
def test_contractions_and_spaces_are_cut_as_the_tokenizer_does(texts):
    assert [x.tolist() for x in ENCODER.encode(texts)] == [direct(t) for t in texts]


def test_a_word_is_encoded_once_whatever_stands_around_it():
    encoder = R.TextEncoder(PATH)
    marks = [a + b for a in ".,;:!?*)" for b in ".,;:!?*)"]
    texts = [" ".join(f"Reference{m}" for m in marks), "\n".join(f" Reference{m}" for m in marks)]
    assert [x.tolist() for x in encoder.encode(texts)] == [direct(t) for t in texts]
    # The word with a blank and without, the marks, a line feed and the end of a text.
    assert len(encoder.known) <= len(marks) + 4


def test_other_tokenizers_get_whole_texts(tmp_path):
    from tokenizers import Tokenizer, normalizers

    other = Tokenizer.from_file(PATH)
    other.normalizer = normalizers.Lowercase()
    other.save(path := str(tmp_path / "lower.json"))
    texts = ["The CAT's hat", " É. ", None, ""]
    got = R.TextEncoder(path).encode(texts)
    assert [x.tolist() for x in got] == [other.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_encoding_beyond_the_cache(monkeypatch):
    monkeypatch.setattr(R, "CACHE_PIECES", 64)
    monkeypatch.setattr(R, "CACHE_IDS", 300)
    encoder, rng = R.TextEncoder(PATH), random.Random(1)
    texts = [" ".join("".join(rng.choice("abcé") for _ in range(rng.randrange(1, 9))) for _ in range(60)) for _ in range(40)] + ["x" * 5000, None, ""]
    assert [x.tolist() for x in encoder.encode(texts)] == [direct(t) for t in texts]


def test_long_words(monkeypatch):
    monkeypatch.setattr(R, "LONG_WORD", 20)
    texts = ["é" * 30 + " " + "ab" * 40 + "'s" + " " * 50 + "x", "\n" * 40, "你好" * 20 + "." * 25]
    assert [x.tolist() for x in R.TextEncoder(PATH).encode(texts)] == [direct(t) for t in texts]


def shard_of(n_base, rules, lengths, symbols):
    return R.Shard(n_base, *(x.astype("<u4").tobytes() for x in (rules, lengths, symbols)))


@pytest.mark.parametrize("n_base", [4, 50_257, 70_000])
@pytest.mark.parametrize("min_pairs", [2, 5])
def test_grammar_round_trip_and_random_access(n_base, min_pairs):
    rng = np.random.default_rng(n_base + min_pairs)
    phrases = [rng.integers(0, n_base, rng.integers(1, 9)) for _ in range(12)]
    runs = [np.full(n, 3) for n in (2, 3, 7, 50)]
    ids = np.concatenate([*(phrases[i] for i in rng.integers(0, 12, 400)), *runs]).astype(np.uint32)
    rules, lengths, symbols = R.compress(ids, n_base, min_pairs)
    assert len(symbols) < len(ids)
    shard = shard_of(n_base, rules, lengths, symbols)
    assert shard.all_ids().tolist() == ids.tolist()

    def spelled(symbol):
        return [symbol] if symbol < n_base else [x for s in rules[symbol - n_base].tolist() for x in spelled(s)]

    for i in range(len(rules)):
        assert shard._expanded(np.array([n_base + i])).tolist() == spelled(n_base + i) and len(spelled(n_base + i)) == lengths[i]
    # No pair is left that is frequent enough; one that overlaps itself may count twice.
    pairs = Counter(zip(symbols.tolist(), symbols[1:].tolist(), strict=False))
    assert all(n < min_pairs for (a, b), n in pairs.items() if a != b)
    for _ in range(200):
        a, b = sorted(rng.integers(0, len(ids) + 1, 2))
        assert shard.ids(a, b).tolist() == ids[a:b].tolist()


@pytest.mark.parametrize("ids", [[], [1], [1, 1], [2] * 9])
def test_grammar_of_tiny_sequences(ids):
    assert shard_of(10, *R.compress(np.array(ids, np.uint32), 10, 2)).all_ids().tolist() == ids


def expected(rows):
    out, start = [], 0
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc_id, text, *_ in rows:
        ids = [*direct(text), 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("shard_tokens", [50, 10**6])
def test_files_round_trip(spark, make_docs, edge_rows, tmp_path, shard_tokens):
    path = str(tmp_path / "tokens")
    R.write_token_files(make_docs(edge_rows, clashing=True), path, PATH, shard_tokens=shard_tokens, min_pairs=3)
    got = [tuple(r) for r in R.read_token_files(spark, path).orderBy("start").collect()]
    # Equal ids have equal texts here, so their order doesn't show.
    assert got == expected(edge_rows)
    with_ids = R.read_token_files(spark, path, with_ids=True).collect()
    texts = {r[0]: r[1] for r in edge_rows}
    assert all(r.ids == [*direct(texts[r.doc_id]), 0] for r in with_ids)


def test_no_documents(no_docs):
    assert R.token_table(no_docs, PATH).count() == 0
