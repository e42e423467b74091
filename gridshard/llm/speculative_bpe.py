"""Byte-level BPE by speculation: longest matches are proposed, checked pair by pair, and merged exactly only where they fail.

A text is cut into words as the tokenizer's file says. For each word that is not remembered,

1. the longest token at every place of all new words is found at once (a trie as a table, one
   step for a character of all places in numpy), and the tokens that lead from a word's start to its end are proposed;
2. every pair of neighbouring tokens is checked in numpy: the merges that made the two are undone, latest first,
   and at each step the symbols that face each other must not have a merge that would have come earlier. Tokens that
   are each encoded as themselves and of which every two neighbours pass are what merging gives;
3. the words with a pair that fails, and only those, are merged step by step, the lowest rank first.

Decoding puts the bytes of the tokens one after the other; bytes that are no UTF-8 become U+FFFD.

Nulls: a null text is an empty one, without tokens. Texts of any length are cut between words into parts
of a few MB. Repeated rows are encoded alike, each for itself; columns are carried whatever their names.
Files other than byte-level BPE with the usual word pattern are refused.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridshard.llm.common import byte_symbols, documents, fresh, map_texts
from gridshard.llm.repair import default_tokenizer, expand_ranges

# Words and token ids that a task remembers; beyond that it starts anew.
KNOWN_WORDS = 300_000
KNOWN_IDS = 3_000_000
# Longer texts are cut between words.
PART_CHARS = 2 << 20
# Words of so many bytes are merged together with others, a merge of each at a time.
STEPWISE = 64

# How byte-level BPE cuts texts into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_CUT = re.compile(r"(?<=[!-~]) (?=[!-~])")
# Beyond these a text may have a character that is newer than the tokenizer's or this library's tables.
_LATER = re.compile("[^\x00-˿‐-‧ぁ-ゖ一-龥가-힣]")
# In no UTF-8 text.
_END = 0xFF
_NEVER = np.int64(1) << 40


class _Known(dict):
    """Numbers words as they come up and lists the new ones."""

    def __init__(self, words: Iterable[str]):
        super().__init__((w, i) for i, w in enumerate(words))
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class SpeculativeBpe:
    """encode and decode of a tokenizer file, for many texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        _check_kind(spec)
        self._read_tokens(spec)
        self._read_merges(spec["model"])
        self.words = regex.compile(WORDS)
        self.speculates = self._one_way_to_each()
        if self.speculates:
            self._build_trie(np.flatnonzero(self._sound()))
        self.merged_words = self.seen_words = 0
        self._forget()

    # What the file says.

    def _read_tokens(self, spec: dict) -> None:
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        self.vocab = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        n = max(*self.vocab.values(), *self.added.values(), -1) + 1
        tokens = [b""] * n
        for token, i in (self.vocab | self.added).items():
            inside = all(c in byte_of for c in token)
            tokens[i] = bytes(byte_of[c] for c in token) if inside else token.encode()
        self.tokens = tokens
        self.size = np.fromiter(map(len, tokens), np.int64, n)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.of_byte = np.array([self.vocab[s] for s in byte_symbols()], np.int64)
        inside = "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True))
        self.between_added = re.compile(f"({inside})") if inside else None

    def _read_merges(self, model: dict) -> None:
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.full(len(self.tokens), -1, np.int64)
        self.right = self.left.copy()
        # The rank of the merge that makes a token, -1 for single bytes.
        self.rank = self.left.copy()
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.made_twice = False
        for rank, (a, b) in enumerate(pairs):
            left, right, made = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.merge[left, right] = rank, made
            self.made_twice |= bool(self.rank[made] >= 0)
            self.left[made], self.right[made], self.rank[made] = left, right, rank
        keys = np.array([(a << 32) | b for a, b in self.merge], np.int64)
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        merges = np.array(list(self.merge.values()), np.int64).reshape(-1, 2)[order]
        self.pair_ranks = np.append(merges[:, 0], _NEVER)
        self.pair_made = np.append(merges[:, 1], -1)
        self.pair_maybe = np.zeros(1 << 22, bool)
        self.pair_maybe[_slot(keys)] = True

    def _one_way_to_each(self) -> bool:
        """Whether each token comes from one merge, of older tokens: what the check of pairs rests on."""
        made = np.flatnonzero(self.rank >= 0)
        older = (self.rank[self.left[made]] < self.rank[made]) & (self.rank[self.right[made]] < self.rank[made])
        return not self.made_twice and bool(older.all())

    def _sound(self) -> np.ndarray:
        """Tokens that are encoded as themselves: single bytes, and merges of two that are, which meet no other merge on the way."""
        sound = np.zeros(len(self.tokens), bool)
        sound[self.of_byte] = True
        made = np.flatnonzero(self.rank >= 0)
        made = made[np.argsort(self.rank[made])]
        apart = np.zeros(len(self.tokens), bool)
        apart[made] = self.stand_apart(self.left[made], self.right[made], finally_too=False)
        for i in made.tolist():
            sound[i] = apart[i] and sound[self.left[i]] and sound[self.right[i]]
        return sound

    def _build_trie(self, ids: np.ndarray) -> None:
        """``next`` leads from a node that goes on, and a byte, to a node (0: none); ``ends`` has the token that ends at a node."""
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for i in ids.tolist():
            if _END in self.tokens[i]:
                continue
            node = 0
            for byte in self.tokens[i]:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    ends.append(-1)
                node = children[node][byte]
            ends[node] = i
        # Nodes that go on come first and have a row of the table.
        order = sorted(range(len(children)), key=lambda n: not children[n])
        number = {n: k for k, n in enumerate(order)}
        self.n_rows = sum(map(bool, children))
        self.next = np.zeros((max(self.n_rows, 1), 256), np.int32)
        for n in order[: self.n_rows]:
            for byte, child in children[n].items():
                self.next[number[n], byte] = number[child]
        self.ends = np.array([ends[n] for n in order], np.int32)

    # Checks of pairs.

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of each pair among all merges, the last place if it has none."""
        keys = (a << 32) | b
        places = np.full(len(keys), len(self.pair_keys) - 1)
        some = np.flatnonzero(self.pair_maybe[_slot(keys)])
        found = np.searchsorted(self.pair_keys, keys[some])
        same = self.pair_keys[found] == keys[some]
        places[some[same]] = found[same]
        return places

    def stand_apart(self, left: np.ndarray, right: np.ndarray, finally_too: bool = True) -> np.ndarray:
        """Whether merging never joins anything across the border of two neighbouring tokens.

        ``finally_too=False`` lets the two themselves be joined once they stand.
        """
        apart = np.ones(len(left), bool)
        at, a, b = np.arange(len(left)), left, right
        # When one of the two that face each other went into something else. Twice the rank, as of equal merges the left comes first.
        gone = np.full(len(left), 2 * _NEVER if finally_too else -1)
        while len(at):
            joined = 2 * self.pair_ranks[self._pair(a, b)] < gone
            apart[at[joined]] = False
            ra, rb = self.rank[a], self.rank[b]
            go_on = ~joined & ((ra >= 0) | (rb >= 0))
            at, a, b, ra, rb = at[go_on], a[go_on], b[go_on], ra[go_on], rb[go_on]
            undo_left = ra > rb
            gone = np.where(undo_left, 2 * ra, 2 * rb + 1)
            a, b = np.where(undo_left, self.right[a], a), np.where(undo_left, b, self.left[b])
        return apart

    # Words.

    def propose(self, text: np.ndarray) -> np.ndarray:
        """Tokens of longest matches one after the other; -1 for each ``_END`` byte, which no match crosses."""
        n = len(text)
        padded = np.append(text, np.full(1, _END, np.uint8))
        best, length = np.full(n, -1, np.int32), np.ones(n, np.int32)
        at, node, depth = np.arange(n), np.zeros(n, np.int32), 0
        while len(at):
            node = self.next[node, padded[at + depth]]
            depth += 1
            there = node > 0
            at, node = at[there], node[there]
            token = self.ends[node]
            whole = token >= 0
            best[at[whole]], length[at[whole]] = token[whole], depth
            on = (node < self.n_rows) & (at + depth < n)
            at, node = at[on], node[on]
        steps, places, place = length.tolist(), [], 0
        while place < n:
            places.append(place)
            place += steps[place]
        return best[places]

    def merge_exactly(self, word: bytes) -> list[int]:
        """Tokens of a word by its merges: the lowest rank first, of equal ones the left one."""
        ids = self.of_byte[np.frombuffer(word, np.uint8)].tolist()
        after = [*range(1, len(ids)), -1]
        before = [*range(-1, len(ids) - 1)]
        merge = self.merge
        heap = [(m[0], i, m[1]) for i in range(len(ids) - 1) if (m := merge.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, i, made = heapq.heappop(heap)
            j = after[i]
            # Either of the two may have gone into something else since.
            if j < 0 or ids[i] < 0 or merge.get((ids[i], ids[j])) != (rank, made):
                continue
            ids[i], ids[j] = made, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if m := merge.get((made, ids[k])):
                    heapq.heappush(heap, (m[0], i, m[1]))
            h = before[i]
            if h >= 0 and (m := merge.get((ids[h], made))):
                heapq.heappush(heap, (m[0], h, m[1]))
        return [i for i in ids if i >= 0]

    def merge_many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``merge_exactly`` for many words, a merge of each at a time: token ids one after the other, and how many each has."""
        short = np.flatnonzero(np.fromiter((len(w) <= STEPWISE for w in words), bool, len(words)))
        n = len(words)
        texts = [words[i] for i in short.tolist()]
        word = np.repeat(short, np.fromiter(map(len, texts), np.int64, len(texts)))
        ids = self.of_byte[np.frombuffer(b"".join(texts), np.uint8)]
        none = len(self.pair_keys) - 1
        pair = np.full(len(ids), none)
        inside = np.flatnonzero(word[1:] == word[:-1])
        pair[inside] = self._pair(ids[inside], ids[inside + 1])
        done_ids, done_word = [], []
        while len(ids):
            rank = self.pair_ranks[pair]
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            sizes = np.diff(starts, append=len(ids))
            least = np.minimum.reduceat(rank, starts)
            over = np.repeat(least == _NEVER, sizes)
            done_ids.append(ids[over])
            done_word.append(word[over])
            # The leftmost of the pairs of lowest rank in each word that has one.
            at = np.flatnonzero((rank == np.repeat(least, sizes)) & ~over)
            at = at[np.diff(word[at], prepend=-1) != 0]
            ids[at] = self.pair_made[pair[at]]
            stays = ~over
            stays[at + 1] = False
            moved = np.cumsum(stays) - 1
            ids, word, pair, at = ids[stays], word[stays], pair[stays], moved[at]
            pair[at] = none
            after = at[at + 1 < len(ids)]
            after = after[word[after] == word[after + 1]]
            pair[after] = self._pair(ids[after], ids[after + 1])
            before = at[at > 0] - 1
            before = before[word[before] == word[before + 1]]
            pair[before] = self._pair(ids[before], ids[before + 1])
        for i in np.setdiff1d(np.arange(n), short).tolist():
            one = self.merge_exactly(words[i])
            done_ids.append(np.array(one, np.int64))
            done_word.append(np.full(len(one), i))
        word = np.concatenate([np.empty(0, np.int64), *done_word])
        order = np.argsort(word, kind="stable")
        return np.concatenate([np.empty(0, np.int64), *done_ids])[order], np.bincount(word, minlength=n)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, one after the other, and how many each has."""
        raw = [w.encode() for w in words]
        self.seen_words += len(raw)
        if not self.speculates:
            self.merged_words += len(raw)
            return self.merge_many(raw)
        ids = self.propose(np.frombuffer(b"\xff".join([*raw, b""]), np.uint8)).astype(np.int64)
        ends = np.flatnonzero(ids < 0)
        word = np.repeat(np.arange(len(raw)), np.diff(ends, prepend=-1) - 1)
        ids = np.delete(ids, ends)
        same = np.flatnonzero(word[1:] == word[:-1])
        apart = self.stand_apart(ids[same], ids[same + 1])
        failed = np.unique(word[same[~apart]])
        sizes = np.bincount(word, minlength=len(raw))
        if not len(failed):
            return ids, sizes
        self.merged_words += len(failed)
        exact, exact_sizes = self.merge_many([raw[i] for i in failed.tolist()])
        # The proposals first, then what replaces those that failed.
        starts = np.cumsum(sizes) - sizes
        starts[failed] = len(ids) + np.cumsum(exact_sizes) - exact_sizes
        sizes[failed] = exact_sizes
        return expand_ranges(np.concatenate([ids, exact]), starts, sizes), sizes

    # Texts.

    def _forget(self) -> None:
        self.known = _Known(self.added)
        n = len(self.added)
        self.known_ids = np.empty(KNOWN_IDS, np.uint32)
        self.known_ids[:n] = list(self.added.values())
        self.known_starts = np.zeros(KNOWN_WORDS + 1, np.int64)
        self.known_starts[1 : n + 1] = np.arange(1, n + 1)

    def split(self, text: str) -> list[str]:
        """Words and added tokens of a text, in order."""
        if self.between_added is None or not self.between_added.search(text):
            return self._split_plain(text)
        out: list[str] = []
        for i, piece in enumerate(self.between_added.split(text)):
            out += [piece] if i % 2 else self._split_plain(piece)
        return out

    def _split_plain(self, text: str) -> list[str]:
        if not text.isascii() and _LATER.search(text) and any(unicodedata.category(c) == "Cn" for c in set(text)):
            # Whether that is a letter depends on the version of the tables.
            spans = _library(self.path).pre_tokenizer.pre_tokenize_str(text)
            return [text[a:b] for _, (a, b) in spans]
        return self.words.findall(text)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, one after the other, and how many each has."""
        ids, sizes = [np.empty(0, np.uint32)], np.zeros(len(texts), np.int64)
        words: list[str] = []
        counts: list[tuple[int, int]] = []

        def flush() -> None:
            nonlocal words, counts
            made, each = self._encode_known(words)
            ends = np.cumsum(np.append(0, each))
            done = 0
            for i, n in counts:
                sizes[i] += ends[done + n] - ends[done]
                done += n
            ids.append(made)
            words, counts = [], []

        for i, text in enumerate(texts):
            for part in _parts(text or ""):
                found = self.split(part)
                if words and len(words) + len(found) > KNOWN_WORDS:
                    flush()
                words += found
                counts.append((i, len(found)))
        flush()
        return np.concatenate(ids), sizes

    def _encode_known(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        step = KNOWN_WORDS // 4
        for at in range(0, len(words), step):
            some = words[at : at + step]
            if len(self.known) + len(some) > KNOWN_WORDS:
                self._forget()
            first = len(self.known)
            number = np.fromiter(map(self.known.__getitem__, some), np.int64, len(some))
            if not self._learn(first):
                # Very long words: more ids than are remembered.
                self._forget()
                made, each = self.encode_words(some) if not self.added.keys() & set(some) else _joined([self._alone(w) for w in some])
                ids.append(made.astype(np.uint32))
                sizes.append(each)
                continue
            each = self.known_starts[number + 1] - self.known_starts[number]
            ids.append(expand_ranges(self.known_ids, self.known_starts[number], each))
            sizes.append(each)
        return np.concatenate(ids), np.concatenate(sizes)

    def _alone(self, word: str) -> list[int]:
        return [self.added[word]] if word in self.added else self.encode_words([word])[0].tolist()

    def _learn(self, first: int) -> bool:
        """Encodes the words numbered from ``first`` on; false if there is no room for their ids."""
        new, self.known.new = self.known.new, []
        if not new:
            return True
        made, sizes = self.encode_words(new)
        start = int(self.known_starts[first])
        if start + len(made) > KNOWN_IDS:
            return False
        self.known_ids[start : start + len(made)] = made
        self.known_starts[first + 1 : first + 1 + len(new)] = start + np.cumsum(sizes)
        return True

    def decode_bytes(self, ids: np.ndarray) -> np.ndarray:
        return expand_ranges(self.bytes, self.start[ids], self.size[ids])

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The text of each of the runs of ``sizes`` ids."""
        raw = self.decode_bytes(ids).tobytes()
        # Where each run ends, in bytes.
        ends = np.append(0, np.cumsum(self.size[ids]))[np.append(0, np.cumsum(sizes))].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


def _check_kind(spec: dict) -> None:
    model, pre, post = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("decoder") or {}
    plain = {"dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"}
    if model.get("type") != "BPE" or any(model.get(k) for k in plain):
        raise ValueError("not a plain BPE model")
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or post.get("type") != "ByteLevel":
        raise ValueError("not a byte-level tokenizer")
    if pre.get("add_prefix_space") or not pre.get("use_regex", True):
        raise ValueError("words are not cut by the usual pattern")
    if any(t.get(k) for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens that take in their surroundings")


def _slot(keys: np.ndarray) -> np.ndarray:
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)


def _joined(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.fromiter((i for row in rows for i in row), np.int64, int(sizes.sum())), sizes


def _parts(text: str) -> Iterable[str]:
    """The text cut before single blanks between ASCII characters, where a word begins anyway."""
    start = 0
    while len(text) - start > PART_CHARS and (cut := _CUT.search(text, start + PART_CHARS)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def _library(path: str):
    from tokenizers import Tokenizer

    if path not in _libraries:
        _libraries[path] = Tokenizer.from_file(path)
    return _libraries[path]


_libraries: dict = {}
_coders: dict[str, SpeculativeBpe] = {}


def coder(path: str) -> SpeculativeBpe:
    """One for all tasks of a worker."""
    if path not in _coders:
        _coders[path] = SpeculativeBpe(path)
    return _coders[path]


def encoded(docs: DataFrame, tokenizer_path: str, name: str = "ids", text: str = "text") -> DataFrame:
    """``docs`` with the token ids of each text, as a list."""

    def make():
        bpe = coder(tokenizer_path)

        def compute(texts):
            ids, sizes = bpe.encode(texts)
            return [pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes)).astype(np.int32), pa.array(ids.astype(np.int32)))]

        return compute

    return map_texts(docs, make, [(fresh(docs, name), T.ArrayType(T.IntegerType()))], text=text)


def decoded(tokens: DataFrame, tokenizer_path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``tokens`` with the text of each list of token ids; a null list has a null text."""

    @F.arrow_udf(T.StringType())
    def run(lists: pa.Array) -> pa.Array:
        bpe = coder(tokenizer_path)
        flat = np.asarray(lists.flatten(), np.int64)
        sizes = np.fromiter((len(v) if v is not None else 0 for v in lists), np.int64, len(lists))
        texts = bpe.decode(flat, sizes)
        return pa.array([t if v else None for t, v in zip(texts, lists.is_valid().to_pylist(), strict=True)], pa.string())

    return tokens.withColumn(fresh(tokens, name), run(F.col(f"`{ids}`")))


def round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the token ids and of the text decoded from them.

    Encodes and decodes in one pass, as the ids are larger than the texts.
    """

    def make():
        bpe = coder(tokenizer_path)

        def compute(texts):
            ids, sizes = bpe.encode(texts)
            raw = ids.astype("<u4").tobytes()
            ends = (4 * np.append(0, np.cumsum(sizes))).tolist()
            back = bpe.decode(ids, sizes)
            return [
                sizes,
                [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(ends, ends[1:])],
                [hashlib.sha256(t.encode()).hexdigest() for t in back],
            ]

        return compute

    fields = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    return map_texts(docs, make, fields, keep=["doc_id"])


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir), default_tokenizer())
