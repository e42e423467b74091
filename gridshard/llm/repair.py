"""Token ids in files compressed by a Re-Pair grammar.

Documents are dealt out in order of their ids; a task encodes whole texts and closes a
shard at the end of the document with which it holds SHARD_TOKENS or more. Within a
shard the most frequent pairs of neighbouring ids are replaced by nonterminals, over
and over: a round counts all pairs in numpy and replaces those at least
an eighth as frequent as the most frequent one, until none is as frequent as MIN_PAIRS. A pair that could overlap a more frequent pair of its round waits for the next one.

A shard is one row of a Parquet table, written by Spark, so a task that is lost is run again and leaves no
half-written file. The row holds the rules (two symbols each), the number of ids each
rule expands to, the remaining sequence of symbols, and where each document starts. To read a range of ids,
the lengths of the symbols give the first and last symbol that have to be expanded.

Texts are encoded by the tokenizers library. Byte-level BPE cuts texts into words by one pattern and merges within
words only. That pattern is applied here in numpy to all texts of a slice, and the library's model gets each different word once;
their ids are remembered. Texts with a special token, or with characters that are a letter or number in some versions of Unicode
only, go to the library whole, as do all texts if a tokenizer is of another kind.

Nulls: a null text is an empty one, its only id is the end id. A null doc_id comes first. Documents with
equal ids follow each other by a hash of the text, then by the text.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gridshard.llm.common import byte_symbols, documents, give_back, slices
from gridshard.sources.scratch import scratch_path

END_ID = 0
SHARD_TOKENS = 1_000_000
MIN_PAIRS = 64
# Words and their ids that a task remembers.
CACHE_PIECES = 350_000
CACHE_IDS = 4_000_000
# Words of so many bytes are encoded like texts.
LONG_WORD = 4096

_TABLE_BITS = 16

SHARD_SCHEMA = (
    "part int, shard int, part_start long, n_tokens long, n_base int, doc_ids {id}, doc_starts array<long>, "
    "rules binary, rule_lengths binary, symbols binary"
)


_NOTHING = np.empty(0, np.uint32)


class _Numbered(dict):
    """Numbers keys as they come up and lists those that are new."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n


class TextEncoder:
    """encode() of a tokenizer, for many texts."""

    def __init__(self, path: str):
        # Spark runs as many tasks as there are cores.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special)) if special else None
        self.model, cut = self.tokenizer.model, self.tokenizer.pre_tokenizer
        # Whether the tokenizer cuts texts into words as below; else it is given whole texts.
        self.cuts = (
            isinstance(self.model, models.BPE)
            and isinstance(cut, pre_tokenizers.ByteLevel)
            and cut.use_regex
            and not cut.add_prefix_space
            and self.tokenizer.normalizer is self.tokenizer.truncation is self.tokenizer.padding is None
        )
        # Filled in as characters come up.
        self.kind_of = np.zeros(0x110000, np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.known = _Numbered()
        self.ids = np.empty(CACHE_IDS, np.uint32)
        # There is room for half as many more: those of the slice with which it is exceeded.
        self.starts = np.zeros(CACHE_PIECES + CACHE_PIECES // 2 + 1, np.int64)
        self.seen = np.zeros(CACHE_PIECES + CACHE_PIECES // 2, np.int32)

    def _forget_rare(self) -> None:
        """Leaves the words that came up again, if those are less than half of what has room."""
        old, ids, starts, n = self.known, self.ids, self.starts, len(self.known)
        again = np.flatnonzero(self.seen[:n] > 1)
        sizes = starts[again + 1] - starts[again]
        kept = expand_ranges(ids, starts[again], sizes)
        self._forget()
        if len(again) <= CACHE_PIECES // 2 and len(kept) <= CACHE_IDS // 2:
            words = list(old)
            self.known.update(zip([words[i] for i in again.tolist()], range(len(again)), strict=True))
            self.ids[: len(kept)] = kept
            self.starts[1 : len(again) + 1] = np.cumsum(sizes)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        made: list = [_NOTHING] * len(texts)
        whole = [i for i, text in enumerate(texts) if text and (not self.cuts or (self.special and self.special.search(text)))]
        raw = {i: text.encode() for i, text in enumerate(texts) if text}
        for i in whole:
            del raw[i]
        joined = _joined(raw.values())
        kinds = self._kinds(joined)
        if len(odd := np.flatnonzero(kinds == _ODD)):
            places = list(raw)
            for k in np.unique(np.searchsorted(np.flatnonzero(kinds == _END), odd)).tolist():
                whole.append(places[k])
                del raw[places[k]]
            joined = _joined(raw.values())
            kinds = self._kinds(joined)
        for i in whole:
            made[i] = self.whole(texts[i])
        if raw:
            for i, ids in zip(raw, self._encode_joined(joined, kinds), strict=True):
                made[i] = ids
        return made

    def _kinds(self, text: np.ndarray) -> np.ndarray:
        """The kind of the character that each byte belongs to."""
        kinds = _BYTE_KINDS[text]
        first = np.flatnonzero((text >= 0xC0) & (text < _END_BYTE))
        if len(first):
            more = 1 + (text[first] >= 0xE0) + (text[first] >= 0xF0)
            point = text[first] & (0x3F >> more)
            at = [(k, np.flatnonzero(more >= k)) for k in (1, 2, 3)]
            for k, those in at:
                point[those] = point[those] << 6 | text[first[those] + k] & 0x3F
            for c in np.unique(point[self.kind_of[point] == 0]).tolist():
                self.kind_of[c] = _kind(chr(c))
            kind = self.kind_of[point]
            kinds[first] = kind
            for k, those in at:
                kinds[first[those] + k] = kind[those]
        return kinds

    def _encode_joined(self, text: np.ndarray, kinds: np.ndarray) -> list[np.ndarray]:
        """The ids of each of the joined texts."""
        starts = _word_starts(text, kinds)
        bounds = pa.py_buffer(np.append(starts, len(text)).astype(np.int32))
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, bounds, pa.py_buffer(text)]).dictionary_encode()
        ids, first, size = self._ids_of(_spelled(words.dictionary))
        word = words.indices.to_numpy()
        size = size[word]
        ids = expand_ranges(ids, first[word], size)
        ends = np.cumsum(size)[kinds[starts] == _END].tolist()
        return [ids[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where those of each of the different words start and how many they are."""
        if len(words) <= CACHE_PIECES // 2:
            if len(self.known) > CACHE_PIECES:
                self._forget_rare()
            before = len(self.known)
            number = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            new, self.known.new = self.known.new, []
            ids, sizes = self._tokenized(new)
            start = int(self.starts[before])
            if start + len(ids) <= CACHE_IDS:
                self.ids[start : start + len(ids)] = ids
                self.starts[before + 1 : before + 1 + len(new)] = start + np.cumsum(sizes)
                self.seen[number] += 1
                return self.ids, self.starts[number], self.starts[number + 1] - self.starts[number]
            self._forget()
        # More than is remembered.
        ids, sizes = self._tokenized(words)
        return ids, np.cumsum(sizes) - sizes, sizes

    def _tokenized(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words and how many each has. The byte at the end of a text has none."""
        tokenize, ids, ends = self.model.tokenize, array("I"), []
        for word in words:
            if len(word) >= LONG_WORD:
                # In numbers, not in objects for each token.
                ids.extend(self.whole(word.translate(_SYMBOL_BYTES).encode("latin-1").decode()))
            elif word != _END_WORD:
                ids.extend([token.id for token in tokenize(word)])
            ends.append(len(ids))
        return np.array(ids, np.uint32), np.diff(np.array(ends, np.int64), prepend=0)


def _joined(texts: Iterable[bytes]) -> np.ndarray:
    """All texts with ``_END_BYTE`` after each."""
    return np.frombuffer(b"".join(chain.from_iterable((text, _END_TEXT) for text in texts)), np.uint8)


def _spelled(words: pa.Array) -> list[str]:
    """Words in the characters that stand for their bytes."""
    _, bounds, data = words.buffers()
    bounds = np.frombuffer(bounds, np.int32)[words.offset : words.offset + len(words) + 1].tolist()
    text = _BYTE_SYMBOLS[np.frombuffer(data, np.uint8)[: bounds[-1]]].tobytes().decode("utf-16-le")
    return [text[a:b] for a, b in pairwise(bounds)]


def _kind(c: str) -> int:
    """Letter, number, white space or other, as tokenizers cut texts; odd if that may depend on the version of the tables."""
    if c in _SPACES:
        return _SPACE
    now, before = (_GENERAL.get(table.category(c)[0], _OTHER) for table in (unicodedata, unicodedata.ucd_3_2_0))
    return now if now == before and unicodedata.category(c) != "Cn" else _ODD


_LETTER, _NUMBER, _OTHER, _SPACE, _END, _ODD = range(1, 7)
_GENERAL = {"L": _LETTER, "N": _NUMBER}
_SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_END_TEXT = b"\xff"
# In no UTF-8 text.
_END_BYTE = 0xFF
_BYTE_KINDS = np.array([_kind(chr(b)) if b < 0x80 else _ODD for b in range(255)] + [_END], np.uint8)
_BYTE_SYMBOLS = np.array([ord(c) for c in byte_symbols()], "<u2")
_SYMBOL_BYTES = {ord(c): b for b, c in enumerate(byte_symbols())}
_END_WORD = byte_symbols()[_END_BYTE]


def _word_starts(text: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    r"""Where the words of byte-level BPE start: ``'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+``.

    The byte after each text is a word too.
    """
    space = kinds == _SPACE
    ends = kinds == _END
    before_word = ~(space | ends)[1:]
    start = ends.copy()
    start[0] = True
    # A blank belongs to the word after it.
    start[1:] |= (kinds[1:] != kinds[:-1]) & ~((text[:-1] == ord(" ")) & before_word)
    # The last of several spaces before a word stands apart from those before it.
    last = np.flatnonzero(space[:-1] & before_word)
    for _ in range(2):
        last = np.where(text[last] & 0xC0 == 0x80, last - 1, last)
    start[last] = True
    at = np.flatnonzero(text == ord("'"))
    at = at[start[at]]
    one, two = text[at + 1], text[np.minimum(at + 2, len(text) - 1)]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    start[at[short | long] + 1] = False
    start[at[short] + 2] = True
    start[at[long] + 3] = True
    return np.flatnonzero(start)


_encoders: dict[str, TextEncoder] = {}


def _encoder(path: str) -> TextEncoder:
    """One encoder for all tasks of a worker."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


def expand_ranges(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[start : start + length] of every pair, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]


def _frequent_pairs(keys: np.ndarray, min_pairs: int) -> list[int]:
    """The pairs in ``keys`` at least an eighth as frequent as the most frequent one, that one first."""
    ranked = np.sort(keys)
    edge = np.flatnonzero(ranked[1:] != ranked[:-1])
    ends = np.append(edge, len(ranked) - 1)
    counts = np.diff(ends, prepend=-1)
    frequent = np.flatnonzero(counts >= max(min_pairs, int(counts.max()) // 8))
    pairs, counts = ranked[ends[frequent]], counts[frequent]
    return pairs[np.lexsort((pairs, -counts))].tolist()


def _chosen(pairs: list[int], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of which none can overlap another, and a table that leads from a key's slot to its pair.

    A pair waits for a later round if a more frequent one has its slot, or its left symbol on the
    right or the other way round.
    """
    lefts: set[int] = set()
    rights: set[int] = set()
    chosen: list[int] = []
    table = np.full(1 << _TABLE_BITS, -1, np.int16)
    for key, slot in zip(pairs, _slots(np.array(pairs, np.uint64), bits).tolist(), strict=True):
        left, right = key >> bits, key & ((1 << bits) - 1)
        if left in rights or right in lefts or (left == right and left in lefts) or table[slot] >= 0 or len(chosen) > 30_000:
            continue
        lefts.add(left)
        rights.add(right)
        table[slot] = len(chosen)
        chosen.append(key)
    return np.array(chosen, np.uint64), table


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    """A place in a table for each key: its upper bits after a multiplication."""
    if bits == 16:
        return (keys.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(32 - _TABLE_BITS)
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TABLE_BITS)


def _keys(symbols: np.ndarray, bits: int) -> np.ndarray:
    """Each pair of neighbours as one number, of 32 bits while symbols have 16."""
    if bits == 16:
        return (symbols[:-1] << np.uint32(16)) | symbols[1:]
    return (symbols[:-1].astype(np.uint64) << np.uint64(32)) | symbols[1:]


def compress(ids: np.ndarray, n_base: int, min_pairs: int = MIN_PAIRS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules, rule_lengths, symbols): symbol n_base + i stands for the two symbols of rule i."""
    symbols = ids.astype(np.uint32)
    rules: list[np.ndarray] = []
    lengths = np.ones(n_base, np.int64)
    while len(symbols) > 1:
        n_symbols = len(lengths)
        bits = 16 if n_symbols <= 1 << 16 else 32
        keys = _keys(symbols, bits)
        frequent = _frequent_pairs(keys, min_pairs)
        if not frequent:
            break
        chosen, table = _chosen(frequent, bits)
        rule = table[_slots(keys, bits)]
        at = np.flatnonzero(rule >= 0)
        rule = rule[at]
        hit = chosen[rule] == keys[at]
        at, rule = at[hit], rule[hit]
        # What is right in one chosen pair is left in none, so only a pair of twice the same symbol overlaps itself.
        twin = symbols[at] == symbols[at + 1]
        if twin.any():
            run_start = np.concatenate([[True], np.diff(at) != 1])
            first = np.maximum.accumulate(np.where(run_start, at, -1))
            every_second = ~twin | ((at - first) % 2 == 0)
            at, rule = at[every_second], rule[every_second]
        symbols[at] = n_symbols + rule.astype(np.uint32)
        symbols = np.delete(symbols, at + 1)
        left, right = chosen >> np.uint64(bits), chosen & np.uint64((1 << bits) - 1)
        rules.append(np.column_stack([left, right]).astype(np.uint32))
        lengths = np.concatenate([lengths, lengths[left.astype(np.int64)] + lengths[right.astype(np.int64)]])
    return np.concatenate(rules) if rules else np.empty((0, 2), np.uint32), lengths[n_base:], symbols


class Shard:
    """A shard as read: any range of its ids without expanding the rest."""

    def __init__(self, n_base: int, rules: bytes, rule_lengths: bytes, symbols: bytes):
        self.symbols = np.frombuffer(symbols, "<u4")
        lengths = np.ones(n_base + len(rules) // 8, np.int64)
        lengths[n_base:] = np.frombuffer(rule_lengths, "<u4")
        self.lengths = lengths
        self.starts = np.cumsum(lengths) - lengths
        # What every symbol stands for, one after the other; a rule's symbols are older than the rule.
        self.expansions = np.empty(int(lengths.sum()), np.uint32)
        self.expansions[:n_base] = np.arange(n_base)
        for i, (left, right) in enumerate(np.frombuffer(rules, "<u4").reshape(-1, 2).tolist()):
            at = int(self.starts[n_base + i])
            for part in (left, right):
                start, n = int(self.starts[part]), int(lengths[part])
                self.expansions[at : at + n] = self.expansions[start : start + n]
                at += n

    @cached_property
    def ends(self) -> np.ndarray:
        return np.cumsum(self.lengths[self.symbols])

    def _expanded(self, symbols: np.ndarray) -> np.ndarray:
        return expand_ranges(self.expansions, self.starts[symbols], self.lengths[symbols])

    def ids(self, start: int, end: int) -> np.ndarray:
        if start >= end:
            return np.empty(0, np.uint32)
        first = int(np.searchsorted(self.ends, start, "right"))
        last = int(np.searchsorted(self.ends, end, "left"))
        offset = int(self.ends[first - 1]) if first else 0
        return self._expanded(self.symbols[first : last + 1])[start - offset : end - offset]

    def all_ids(self) -> np.ndarray:
        return self._expanded(self.symbols)


def encode_shards(docs: DataFrame, tokenizer_path: str, shard_tokens: int = SHARD_TOKENS, min_pairs: int = MIN_PAIRS) -> DataFrame:
    """Shards (SHARD_SCHEMA) of the texts of ``docs`` in order of doc_id."""
    id_type = docs.schema["doc_id"].dataType
    schema = T._parse_datatype_string(SHARD_SCHEMA.format(id=f"array<{id_type.simpleString()}>"))
    placed = docs.select("doc_id", "text", F.xxhash64("text").alias("place"))
    placed = placed.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, encoder = to_arrow_schema(schema), _encoder(tokenizer_path)
        part, shard, written = TaskContext.get().partitionId(), 0, 0
        ids, starts, held, n = [], [], [], 0

        def close() -> pa.RecordBatch:
            rules, lengths, symbols = compress(np.concatenate(held), encoder.size, min_pairs)
            row = [part, shard, written, n, encoder.size, ids, starts, rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(), symbols.astype("<u4").tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow, strict=True)], schema=arrow)

        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            for a, b in slices(texts):
                encoded = encoder.encode(texts.slice(a, b - a).to_pylist())
                for doc_id, each in zip(doc_ids.slice(a, b - a).to_pylist(), encoded, strict=True):
                    made = np.append(each, np.uint32(END_ID))
                    ids.append(doc_id)
                    starts.append(n)
                    held.append(made)
                    n += len(made)
                    if n >= shard_tokens:
                        yield close()
                        shard, written = shard + 1, written + n
                        ids, starts, held, n = [], [], [], 0
        if ids:
            yield close()
        give_back()

    return placed.select("doc_id", "text").mapInArrow(run, schema)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, **options) -> None:
    encode_shards(docs, tokenizer_path, **options).write.parquet(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids of each document."""
    shards = spark.read.parquet(path)
    id_type = shards.schema["doc_ids"].dataType.elementType
    # One row for each task that wrote: their order is the order of the documents.
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("doc_id", id_type),
            T.StructField("in_part", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
        + [T.StructField("ids", T.ArrayType(T.LongType()))] * with_ids
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        # A worker that encoded before needs that no more.
        _encoders.clear()
        give_back()
        arrow = to_arrow_schema(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {f.name: batch.column(k)[i].as_py() for k, f in enumerate(batch.schema) if f.name != "doc_ids"}
                ids = Shard(row["n_base"], row["rules"], row["rule_lengths"], row["symbols"]).all_ids().astype("<u4")
                starts = np.array(row["doc_starts"], np.int64)
                ends = np.append(starts[1:], row["n_tokens"])
                each = [ids[a:b] for a, b in zip(starts, ends, strict=True)]
                columns = [
                    np.full(len(starts), row["part"]),
                    batch.column(batch.schema.get_field_index("doc_ids"))[i].values,
                    row["part_start"] + starts,
                    ends - starts,
                    [zlib.crc32(x.tobytes()) for x in each],
                ]
                if with_ids:
                    columns.append([x.tolist() for x in each])
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
        give_back()

    columns = ["part", "part_start", "n_tokens", "n_base", "doc_ids", "doc_starts", "rules", "rule_lengths", "symbols"]
    decoded = shards.select(*columns).mapInArrow(run, schema).join(bases, "part")
    return decoded.select("doc_id", (F.col("base") + F.col("in_part")).alias("start"), *decoded.columns[3:6], *["ids"] * with_ids).drop("base")


def token_table(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Writes ``docs`` to token files in the shared scratch folder and reads them back."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_token_files(docs, path, tokenizer_path, **options)
    return read_token_files(docs.sparkSession, path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(documents(spark, sf_dir), default_tokenizer())
