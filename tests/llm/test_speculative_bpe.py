import hashlib
import json
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from gridshard.llm import speculative_bpe as sb
from gridshard.llm.repair import default_tokenizer

PARTS = [
    "a", "b", "th", "in", " ", "  ", "\n", "'s", "'re", "'", "1", "12", "!", "<|endoftext|>", "é", "ß", "你", "\U0001f600", "\xa0",
    "　", "\x85", "\x1c", "ก", "ing", "zz", "A", "՘", "\x00", "-" * 20, "�", "á",
]


@pytest.fixture(scope="module")
def bpe():
    return sb.SpeculativeBpe(default_tokenizer())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer())


def by_library(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def split(ids, sizes):
    ends = np.append(0, np.cumsum(sizes)).tolist()
    return [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]


def test_texts_as_the_library_encodes_them(bpe, library):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(50))) for _ in range(5000)]
    ids, sizes = bpe.encode(texts)
    assert split(ids, sizes) == by_library(library, texts)
    assert bpe.decode(ids, sizes) == texts


def test_random_words_and_how_many_were_merged_exactly(bpe, library):
    rng = random.Random(4)
    words = list({"".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 30))) for _ in range(10_000)})
    before = bpe.merged_words
    assert split(*bpe.encode_words(words)) == by_library(library, words)
    # Both ways were taken.
    assert 0 < bpe.merged_words - before < len(words)


def test_pairs_stand_apart_as_merging_says(bpe, library):
    rng = random.Random(5)
    letters = [i for i, t in enumerate(bpe.tokens) if t.isalpha() and t.isascii()]
    pairs = [(rng.choice(letters), rng.choice(letters)) for _ in range(5000)]
    apart = bpe.stand_apart(*np.array(pairs).T)
    expected = [bpe.merge_exactly(bpe.tokens[a] + bpe.tokens[b]) == [a, b] for a, b in pairs]
    alone = [bpe.merge_exactly(bpe.tokens[a]) == [a] and bpe.merge_exactly(bpe.tokens[b]) == [b] for a, b in pairs]
    assert all(alone)
    assert apart.tolist() == expected
    assert 0 < sum(expected) < len(pairs)


def test_both_ways_of_exact_merging(bpe):
    rng = random.Random(6)
    words = [bytes(rng.choice(b"etaoinsh ") for _ in range(rng.randrange(1, 90))) for _ in range(2000)]
    assert split(*bpe.merge_many(words)) == [bpe.merge_exactly(w) for w in words]
    assert split(*bpe.merge_many([])) == []


def test_decoding_any_ids(bpe, library):
    rng = random.Random(7)
    runs = [[rng.randrange(50_257) for _ in range(rng.randrange(9))] for _ in range(5000)]
    flat = np.array([i for r in runs for i in r])
    got = bpe.decode(flat, np.array([len(r) for r in runs]))
    assert got == [library.decode(r, skip_special_tokens=False) for r in runs]


def test_memory_that_is_full_and_texts_cut_between_words(library, monkeypatch):
    monkeypatch.setattr(sb, "KNOWN_WORDS", 50)
    monkeypatch.setattr(sb, "KNOWN_IDS", 120)
    monkeypatch.setattr(sb, "PART_CHARS", 40)
    small = sb.SpeculativeBpe(default_tokenizer())
    rng = random.Random(8)
    texts = ["".join(rng.choice([*PARTS, " the", " of x", "eta" * 70]) for _ in range(rng.randrange(200))) for _ in range(100)]
    ids, sizes = small.encode(texts)
    assert split(ids, sizes) == by_library(library, texts)
    assert small.decode(ids, sizes) == texts


def test_a_long_word(bpe, library):
    rng = random.Random(9)
    text = "".join(rng.choice("etaoinshrdlu") for _ in range(40_000))
    assert bpe.encode([text])[0].tolist() == library.encode(text).ids


def tiny(tmp_path, merges, name="tiny.json"):
    """A tokenizer file with a few merges."""
    vocab = {s: i for i, s in enumerate(sb.byte_symbols())}
    for a, b in merges:
        vocab.setdefault(a + b, len(vocab))
    spec = json.loads(open(default_tokenizer(), encoding="utf-8").read())
    spec["model"] |= {"vocab": vocab, "merges": [list(m) for m in merges]}
    spec["added_tokens"] = []
    path = tmp_path / name
    path.write_text(json.dumps(spec))
    return str(path)


def test_random_small_grammars(tmp_path):
    rng = random.Random(10)
    for n in range(30):
        symbols, merges = list("abc"), []
        for _ in range(rng.randrange(1, 25)):
            pair = (rng.choice(symbols), rng.choice(symbols))
            if pair not in merges and len(pair[0] + pair[1]) < 12:
                merges.append(pair)
                symbols.append(pair[0] + pair[1])
        path = tiny(tmp_path, merges, f"{n}.json")
        own, library = sb.SpeculativeBpe(path), Tokenizer.from_file(path)
        words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 40))) for _ in range(200)]
        assert split(*own.encode(words)) == by_library(library, words)


def test_a_token_made_in_two_ways_is_always_merged(tmp_path):
    path = tiny(tmp_path, [("a", "b"), ("b", "c"), ("ab", "c"), ("a", "bc")])
    own, library = sb.SpeculativeBpe(path), Tokenizer.from_file(path)
    assert not own.speculates
    words = ["abc", "bcabc", "ababc", "aabcc"]
    assert split(*own.encode(words)) == by_library(library, words)
    assert own.merged_words == own.seen_words


def test_other_kinds_of_files_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        sb.SpeculativeBpe(public_tokenizers.path("word_bpe_49k.json"))


def digest(data):
    return hashlib.sha256(data).hexdigest()


def test_round_trip_of_edge_cases(edge_docs, edge_rows, library):
    expected = []
    for doc_id, text, *_ in edge_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert back == (text or "")
        expected.append((doc_id, len(ids), digest(np.array(ids, "<u4").tobytes()), digest(back.encode())))
    got = [tuple(r) for r in sb.round_trip(edge_docs, default_tokenizer()).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_lists_of_ids_and_back(edge_docs, edge_rows, library):
    tokens = sb.encoded(edge_docs, default_tokenizer())
    name = next(c for c in tokens.columns if c.endswith("ids") and c != "ids")
    back = sb.decoded(tokens, default_tokenizer(), name)
    rows = back.collect()
    assert len(rows) == len(edge_rows)
    for row in rows:
        assert row[name] == library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["decoded"] == (row["text"] or "")
        assert row["ids"] == "kept as it is"


def test_no_rows(no_docs):
    out = sb.round_trip(no_docs, default_tokenizer())
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.collect() == []
    assert sb.decoded(sb.encoded(no_docs, default_tokenizer()), default_tokenizer()).collect() == []


def test_query_against_the_library(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = sb.op12(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row["doc_id"]] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), digest(np.array(ids, "<u4").tobytes()))
        assert row["decoded_sha256"] == digest(library.decode(ids, skip_special_tokens=False).encode())
