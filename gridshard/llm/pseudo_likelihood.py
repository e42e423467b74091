"""Scores of documents by masked pseudo-likelihood.

A small network sees the WINDOW words before a word and the WINDOW after it and gives a probability to every
word of the vocabulary; a document's score is the sum of the log-probabilities of all its words, each given its
neighbours. Words are runs without ASCII white space, A-Z lower-cased.

- The vocabulary comes from counts over all documents: the words that make up WORD_SHARE of all, 1 / WORD_SHARE at
  most, and come LEAST_COUNT times; and OTHER classes, by a hash, for the rest. A word of a class is scored by the
  log-probability of the class in its place plus that of
  the word within the class, which is its share of the class's count plus one; a word without a count has that one.
  The shares of at most HOT_WORDS frequent words are broadcast, the others joined by word. As a neighbour, a word
  outside the vocabulary is seen as its class.
- Every word is masked once, BATCH at a time. Texts are dealt, by a hash of their words, to ROUNDS rounds and to shards of some
  SHARD_WORDS words, MAX_SHARDS at most. In a round each shard trains from the same start, on its texts in the order of
  their hashes, and the networks, weighted by their words, are averaged, FAN_IN at a time: the start of the next round.
  So the network, but for the rounding of sums, depends on the texts alone and not on files, partitions or executors. Equal texts are trained on
  once, with their number as weight.
- The output is a softmax over groups of words of like frequency and one over the words of a group, so
  a word costs two square roots of the vocabulary.

Nulls: a null text, or one without words, has log_likelihood 0, and a null mean. Without any word in the corpus every
document is so.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gridshard.llm.common import discard, documents, give_back, map_texts, slices, written

WORD_SHARE = 2.0**-15
LEAST_COUNT = 8
OTHER = 64
WINDOW = 2
NEIGHBOURS = (*range(-WINDOW, 0), *range(1, WINDOW + 1))
WIDTH = 24
ROUNDS = 4
SHARD_WORDS = 1 << 22
MAX_SHARDS = 4096
BATCH = 4096
RATE = 0.1
FAN_IN = 64
BLOCK_FLOATS = 8192
# What these make stays in the processor's cache.
CHUNK_WORDS = 1 << 12
CACHE_WORDS = 500_000
HOT_WORDS = 1 << 18
# Parts of shares are added as whole numbers, so their sum doesn't depend on their order.
SHARE_UNIT = 2.0**-32
# Words of a shard that are made into one array.
HELD_WORDS = 1 << 18
# Different words of a slice that are Python's at a time.
LOOKED_UP = 1 << 13
NAMES = ("n_words", "log_likelihood", "mean_log_probability")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, as ``words_of`` has them, and the number of words of each."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    lists = pc.ascii_split_whitespace(pc.if_else(pc.equal(texts, ""), None, texts))
    return lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)


class Vocabulary:
    """Words by their frequency, with the classes of all others at the end of a square of groups; ``pad`` is no word."""

    def __init__(self, words: list[str]):
        self.words, self.others = words, OTHER
        self.groups = math.isqrt(len(words) + self.others - 1) + 1
        self.size = self.pad = self.groups**2

    def other_class(self, word: bytes) -> int:
        """The class of a word that isn't in the vocabulary."""
        return self.size - self.others + zlib.crc32(word) % self.others

    def other_classes(self, words: list[bytes]) -> np.ndarray:
        return (self.size - self.others + np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % self.others).astype(np.int32)

    def padded(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The ids with WINDOW pads around each of the texts of ``sizes`` words."""
        out = np.full(len(ids) + 2 * WINDOW * len(sizes), self.pad, np.int32)
        out[word_places(sizes)] = ids
        return out


def _as_list(words: pa.Array) -> list[bytes]:
    """As ``to_pylist``, in a tenth of the time."""
    return words.to_numpy(zero_copy_only=False).tolist()


class Numbers(dict):
    """The number of each word."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__((w.encode(), i) for i, w in enumerate(vocabulary.words))
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
            self.__init__(self.vocabulary)
            if word in self:
                return self[word]
        n = self[word] = self.vocabulary.other_class(word)
        return n

    def ids(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' words, and the number of words of each."""
        words, sizes = split_words(pa.array(texts, pa.string()))
        found = words.dictionary_encode()
        # Each different word is looked up once. As Python's they are many times as large, so some are held at a time.
        different, numbers = found.dictionary.cast(pa.binary()), array("i")
        for i in range(0, len(different), LOOKED_UP):
            numbers.extend(map(self.__getitem__, _as_list(different.slice(i, LOOKED_UP))))
        return np.asarray(numbers, np.int32)[found.indices.to_numpy()], sizes

    def padded(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = self.ids(texts)
        return self.vocabulary.padded(ids, sizes), sizes


class Codes(Numbers):
    """The number of each word of the vocabulary, one after these for each hot word, and after them for each other word until ``forget``."""

    def __init__(self, vocabulary: Vocabulary, hot: pa.Array, shares: np.ndarray):
        super().__init__(vocabulary)
        after = vocabulary.pad + 1
        words = _as_list(hot)
        self.update(zip(words, range(after, after + len(words)), strict=True))
        self.classes = np.concatenate([np.arange(after, dtype=np.int32), vocabulary.other_classes(words)])
        self.shares = np.concatenate([np.zeros(after), shares])
        self.cold: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.classes) + len(self.cold)
        self.cold.append(word)
        return n

    def forget(self) -> None:
        for w in self.cold:
            del self[w]
        self.cold = []

    def split(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The codes with classes for all words outside the vocabulary, and the shares of these words, 0 for cold words."""
        classes = np.concatenate([self.classes, self.vocabulary.other_classes(self.cold)])
        shares = np.concatenate([self.shares, np.zeros(len(self.cold))])
        return classes[codes], shares[codes]

    def cold_counts(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each text's cold words begin, their places in ``cold`` and how often the text has each."""
        places = codes - len(self.classes)
        at = np.flatnonzero(places >= 0)
        width = max(1, len(self.cold))
        pairs, n = np.unique(np.repeat(np.arange(len(sizes)), sizes)[at] * width + places[at], return_counts=True)
        return np.searchsorted(pairs, np.arange(len(sizes) + 1) * width), pairs % width, n


def word_places(sizes: np.ndarray) -> np.ndarray:
    """Where the words stand in ``padded``."""
    return np.arange(int(sizes.sum())) + np.repeat(2 * WINDOW * np.arange(len(sizes)) + WINDOW, sizes)


class Network:
    """Both softmaxes over one hidden layer, the sum of a vector for each neighbour and place, cut off at 0."""

    NAMES = ("inputs", "hidden_bias", "group_out", "group_bias", "word_out", "word_bias")

    def __init__(self, vocabulary: Vocabulary, counts: np.ndarray):
        """``counts`` of the words set the start: each word as likely as it is frequent."""
        self.groups = groups = vocabulary.groups
        rng = np.random.default_rng(11)
        scale = np.float32(0.1)
        self.inputs = scale * rng.standard_normal((2 * WINDOW, vocabulary.size + 1, WIDTH)).astype(np.float32)
        self.hidden_bias = np.full(WIDTH, 0.1, np.float32)
        self.group_out = scale * rng.standard_normal((groups, WIDTH)).astype(np.float32)
        self.word_out = scale * rng.standard_normal((groups, groups, WIDTH)).astype(np.float32)
        counts = counts.astype(np.float64).reshape(groups, groups) + 0.1
        self.group_bias = np.log(counts.sum(axis=1) / counts.sum()).astype(np.float32)
        self.word_bias = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, values: np.ndarray) -> Network:
        for n in self.NAMES:
            old = getattr(self, n)
            setattr(self, n, values[: old.size].reshape(old.shape).astype(np.float32))
            values = values[old.size :]
        return self

    def _forward(self, padded: np.ndarray, places: np.ndarray) -> tuple:
        """Places by the group of their word, with hidden layer and both outputs, a column for each place."""
        order = np.argsort((padded[places] // self.groups).astype(np.uint8), kind="stable")
        places = places[order]
        hidden = np.zeros((len(places), WIDTH), self.inputs.dtype) + self.hidden_bias
        for table, k in zip(self.inputs, NEIGHBOURS, strict=True):
            hidden += table.take(padded[places + k], axis=0)
        np.maximum(hidden, 0, out=hidden)
        group, word = np.divmod(padded[places], self.groups)
        edges = np.searchsorted(group, np.arange(self.groups + 1))
        # Sums and maxima over the rows of such arrays are several times as fast as over their columns.
        columns = np.ones((WIDTH + 1, len(places)), hidden.dtype)
        columns[:WIDTH] = hidden.T
        by_group = np.concatenate([self.group_out, self.group_bias[:, None]], axis=1) @ columns
        by_word = np.empty_like(by_group)
        weights = np.concatenate([self.word_out, self.word_bias[:, :, None]], axis=2)
        for g in np.flatnonzero(np.diff(edges)):
            a, b = edges[g], edges[g + 1]
            np.matmul(weights[g], columns[:, a:b], out=by_word[:, a:b])
        return order, hidden, group, word, edges, by_group, by_word

    def log_probabilities(self, padded: np.ndarray, places: np.ndarray) -> np.ndarray:
        out = np.empty(len(places), np.float32)
        for i in range(0, len(places), CHUNK_WORDS):
            order, _, group, word, _, by_group, by_word = self._forward(padded, places[i : i + CHUNK_WORDS])
            out[i + order] = _exponentials(by_group, group)[1] + _exponentials(by_word, word)[1]
        return out

    def gradients(self, padded: np.ndarray, places: np.ndarray, weights: np.ndarray | None = None) -> tuple[dict[str, np.ndarray], float]:
        """Of the mean log loss at ``places``, weighted if ``weights`` are given, and that loss."""
        out, ids, loss = self.sparse_gradients(padded, places, weights)
        inputs = np.zeros_like(self.inputs)
        inputs[:, ids] = out["inputs"]
        return out | {"inputs": inputs}, loss

    def sparse_gradients(self, padded: np.ndarray, places: np.ndarray, weights: np.ndarray | None = None) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
        """As ``gradients``, but of the inputs only the rows of the words that are there, and these words."""
        order, hidden, group, word, edges, by_group, by_word = self._forward(padded, places)
        at = np.arange(len(places))
        share = np.full(len(places), 1 / len(places), np.float32) if weights is None else (weights[order] / weights.sum()).astype(np.float32)
        out, loss = {}, 0.0
        for z, target in ((by_group, group), (by_word, word)):
            total, logs = _exponentials(z, target)
            loss -= float(logs @ share)
            z *= share / total
            z[target, at] -= share
        out["group_out"], out["group_bias"] = by_group @ hidden, by_group.sum(axis=1)
        back = by_group.T @ self.group_out
        out["word_out"], out["word_bias"] = np.zeros_like(self.word_out), np.zeros_like(self.word_bias)
        used = np.flatnonzero(np.diff(edges))
        out["word_bias"][used] = np.add.reduceat(by_word, edges[used], axis=1).T
        for g in used:
            a, b = edges[g], edges[g + 1]
            np.matmul(by_word[:, a:b], hidden[a:b], out=out["word_out"][g])
            back[a:b] += by_word[:, a:b].T @ self.word_out[g]
        back *= hidden > 0
        out["hidden_bias"] = back.sum(axis=0)
        # A word is a neighbour of the places around its own: words are ordered once and their sums made of the rows before and after.
        low = places.min() - WINDOW
        ids = padded[low : places.max() + WINDOW + 1]
        rows = np.zeros((len(ids) + 2 * WINDOW, WIDTH), back.dtype)
        rows[places[order] - low + WINDOW] = back
        # Of two bytes they are sorted by radix.
        by_id = np.argsort(ids.astype(np.uint16), kind="stable")
        ranked = ids[by_id]
        first = np.flatnonzero(np.diff(ranked, prepend=-1))
        out["inputs"] = [np.add.reduceat(rows.take(by_id + WINDOW - k, axis=0), first, axis=0) for k in NEIGHBOURS]
        return out, ranked[first], loss


def _exponentials(z: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Makes ``z`` its exponentials, up to a factor for each column; their sums, and the log of what ``target`` has of them."""
    z -= z.max(axis=0)
    own = z[target, np.arange(len(target))]
    np.exp(z, out=z)
    total = z.sum(axis=0)
    return total, own - np.log(total)


class Trainer:
    """Steps whose size for each weight falls with its past gradients."""

    def __init__(self, network: Network):
        self.network = network
        self.past = {n: np.full_like(getattr(network, n), 1e-6) for n in Network.NAMES}

    def flat(self) -> np.ndarray:
        """The network's weights and what is kept of past gradients."""
        return np.concatenate([self.network.flat(), *(self.past[n].ravel() for n in Network.NAMES)])

    def load(self, values: np.ndarray) -> Trainer:
        weights = sum(p.size for p in self.past.values())
        self.network.load(values[:weights])
        values = values[weights:]
        for n, old in self.past.items():
            self.past[n] = values[: old.size].reshape(old.shape).astype(np.float32)
            values = values[old.size :]
        return self

    def step(self, padded: np.ndarray, places: np.ndarray, weights: np.ndarray | None = None) -> float:
        grads, ids, loss = self.network.sparse_gradients(padded, places, weights)
        # The other rows' gradients are 0, which changes nothing.
        for table, kept, g in zip(self.network.inputs, self.past["inputs"], grads.pop("inputs"), strict=True):
            past = kept.take(ids, axis=0) + g * g
            kept[ids] = past
            table[ids] -= RATE * g / np.sqrt(past)
        for name, g in grads.items():
            self.past[name] += g * g
            getattr(self.network, name)[...] -= RATE * g / np.sqrt(self.past[name])
        return loss


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all words of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(0)):
                counts = split_words(batch.column(0).slice(a, b - a))[0].value_counts()
                yield pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], names=["word", "n"])
        give_back()

    counted = docs.select(text).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    """The vocabulary, and the counts of its words and of the classes of the others."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(LEAST_COUNT, math.ceil(total * WORD_SHARE))
    # 1 / WORD_SHARE rows at most.
    top = counts.where(F.col("n") >= least).orderBy(F.desc("n"), "word").collect()
    words = Vocabulary([r.word for r in top])
    totals = np.zeros(words.size)
    totals[: len(top)] = [r.n for r in top]
    for r in counts.where(F.col("n") < least).groupBy(_kind(words)).agg(F.sum("n").alias("n")).collect():
        totals[words.size - words.others + r.kind] = r.n
    return words, totals


def _kind(words: Vocabulary) -> Column:
    return (F.crc32(F.col("word").cast("binary")) % words.others).cast("int").alias("kind")


def word_shares(counts: DataFrame, words: Vocabulary) -> tuple[DataFrame, Column]:
    """(word, n, share) of every counted word outside the vocabulary, and the share of a word without a count, as logs."""
    # 1 / WORD_SHARE rows at most.
    known = counts.sparkSession.createDataFrame([(w,) for w in words.words], "word string")
    rest = counts.join(F.broadcast(known), "word", "left_anti")
    totals = np.ones(words.others)
    for r in rest.groupBy(_kind(words)).agg(F.sum("n").alias("n")).collect():
        totals[r.kind] += r.n
    unseen = F.element_at(F.array(*(F.lit(float(x)) for x in -np.log(totals))), _kind(words) + 1)
    return rest.select("word", "n", (F.log("n") + unseen).alias("share")), unseen


def hot_shares(shares: DataFrame) -> tuple[pa.Array, np.ndarray]:
    """Words (binary) and shares of the most frequent, HOT_WORDS at most: those above the count where there would be more.

    In two buffers, as each Python worker keeps what is broadcast.
    """
    by_n = shares.groupBy("n").agg(F.count("*").alias("words"))
    upto = F.sum("words").over(Window.orderBy(F.desc("n")))
    least = by_n.select("n", upto.alias("upto")).where(F.col("upto") <= HOT_WORDS).agg(F.min("n")).first()[0]
    if least is None:
        return pa.array([], pa.binary()), np.zeros(0)
    # HOT_WORDS rows.
    hot = shares.where(F.col("n") >= least).select("word", "share").toArrow()
    return hot["word"].cast(pa.binary()).combine_chunks(), hot["share"].to_numpy()


def _in_two_bytes(ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """The numbers of each text's words, 2 bytes each."""
    raw, ends = ids.astype("<u2").tobytes(), (2 * np.append(0, np.cumsum(sizes))).tolist()
    return [raw[a:b] for a, b in zip(ends, ends[1:])]


def training_texts(docs: DataFrame, text: str, words: Vocabulary) -> DataFrame:
    """(ids, copies, place): different texts as the numbers of their words, 2 bytes each, how many there are of each, and a hash."""

    def make():
        numbers = Numbers(words)
        return lambda texts: [_in_two_bytes(*numbers.ids(texts))]

    return _different(map_texts(docs.select(F.col(f"`{text}`").alias("text")), make, [("ids", T.BinaryType())], []))


def _different(numbered: DataFrame) -> DataFrame:
    return numbered.where(F.length("ids") > 0).groupBy("ids").agg(F.count("*").alias("copies")).withColumn("place", F.xxhash64("ids"))


def _trained(texts: DataFrame, words: Vocabulary, counts: np.ndarray, shards: int, start) -> DataFrame:
    """(part, block, weight, values): what each shard of ``texts`` makes of the broadcast ``start``, cut into blocks, times its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, shard, seen, held, copies, size = None, None, 0, [], [], 0

        def learn() -> None:
            nonlocal held, copies, size
            sizes = np.fromiter(map(len, held), np.int64, len(held))
            padded, place = words.padded(np.concatenate(held), sizes), word_places(sizes)
            weights = np.repeat(np.array(copies, np.float64), sizes)
            for i in range(0, len(place), BATCH):
                trainer.step(padded, place[i : i + BATCH], weights[i : i + BATCH])
            held, copies, size = [], [], 0

        def done() -> Iterator[pa.RecordBatch]:
            if held:
                learn()
            values = trainer.flat() * np.float64(seen)
            for k, i in enumerate(range(0, len(values), BLOCK_FLOATS)):
                row = (shard, k, float(seen), values[i : i + BLOCK_FLOATS])
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int64(), pa.int32(), pa.float64(), pa.list_(pa.float64())), strict=True)], names=["part", "block", "weight", "values"])

        for batch in batches:
            for of, n, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if of != shard:
                    if shard is not None:
                        yield from done()
                    trainer, shard, seen = Trainer(Network(words, counts)), of, 0
                    if start is not None:
                        trainer.load(start.value)
                held.append(np.frombuffer(ids, "<u2").astype(np.int32))
                copies.append(n)
                size += len(held[-1])
                seen += len(held[-1])
                if size >= HELD_WORDS:
                    learn()
        if shard is not None:
            yield from done()
        give_back()

    dealt = texts.withColumn("shard", F.pmod("place", F.lit(shards)))
    # Twice as many, as shards fall into partitions by chance.
    dealt = dealt.repartition(2 * shards, "shard").sortWithinPartitions("shard", "place", "ids")
    return dealt.select("shard", "copies", "ids").mapInArrow(run, "part long, block int, weight double, values array<double>")


def _added(table: pa.Table) -> pa.Table:
    """The sum of some networks' blocks, in the order of their parts."""
    table = table.combine_chunks().sort_by("part")
    values = np.sum([x.values.to_numpy() for x in table["values"]], axis=0)
    part, block = table["part"][0].as_py() // FAN_IN, table["block"][0].as_py()
    weight = sum(table["weight"].to_pylist())
    return pa.table({"part": [part], "block": pa.array([block], pa.int32()), "weight": [weight], "values": [values]})


def train(docs: DataFrame, text: str = "text", counts: DataFrame | None = None) -> tuple[Vocabulary, Network] | None:
    """The vocabulary and the network; none without words. ``counts``, if given, are those of the texts' words."""
    counted = written(word_counts(docs, text), "word-counts") if counts is None else counts
    words, totals = vocabulary(counted)
    if counts is None:
        discard(counted)
    return _network(training_texts(docs, text, words), words, totals)


def _network(different: DataFrame, words: Vocabulary, totals: np.ndarray) -> tuple[Vocabulary, Network] | None:
    n_words = int(totals.sum())
    if not n_words:
        return None
    texts = written(different, "training")
    shards = min(MAX_SHARDS, -(-n_words // SHARD_WORDS))
    start = None
    for r in range(ROUNDS):
        some = texts.where(F.pmod(F.shiftright("place", 40), F.lit(ROUNDS)) == r)
        values = _averaged(_trained(some, words, totals, shards, start), shards)
        if values is not None:
            start = texts.sparkSession.sparkContext.broadcast(values)
    discard(texts)
    return words, Trainer(Network(words, totals)).load(start.value).network


def _averaged(nets: DataFrame, shards: int) -> np.ndarray | None:
    nets = written(nets, "networks")
    while shards > 1:
        key = F.floor(F.col("part") / FAN_IN).alias("key")
        before, nets = nets, written(nets.groupBy("block", key).applyInArrow(_added, nets.schema), "networks")
        discard(before)
        shards = -(-shards // FAN_IN)
    # One network, or none if the round had no texts.
    rows = nets.orderBy("block").collect()
    discard(nets)
    return np.concatenate([np.array(r["values"]) / r["weight"] for r in rows]) if rows else None


def scored(docs: DataFrame, model: tuple[Vocabulary, Network] | None, keep: list[str] | None = None, text: str = "text", counts: DataFrame | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default: all) with n_words, log_likelihood and mean_log_probability.

    ``counts`` (word, n) say how likely each word of a class is; without them a word outside the vocabulary
    is scored as its class. Columns of ``docs`` with these names give way.
    """
    keep = _kept(docs, keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    if model is not None and counts is not None:
        shares, unseen = word_shares(counts, model[0])
        return _scored_by_word(_numbered(docs, model[0], shares, keep, text), shared, shares, unseen, keep)
    return _with_mean(map_texts(docs, lambda: _by_class(shared), [(NAMES[0], T.LongType()), (NAMES[1], T.DoubleType())], keep, text))


def trained_and_scored(docs: DataFrame, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """As ``scored``, with the model that ``train`` makes of these texts and with their counts. Words are numbered once for both."""
    keep = _kept(docs, keep)
    counts = written(word_counts(docs, text), "word-counts")
    words, totals = vocabulary(counts)
    if not totals.sum():
        return scored(docs, None, keep, text)
    shares, unseen = word_shares(counts, words)
    numbered = _numbered(docs, words, shares, keep, text)
    model = _network(_different(numbered.select("ids")), words, totals)
    return _scored_by_word(numbered, docs.sparkSession.sparkContext.broadcast(model), shares, unseen, keep)


def _kept(docs: DataFrame, keep: list[str] | None) -> list[str]:
    return [c for c in (docs.columns if keep is None else keep) if c.lower() not in NAMES]


def _with_mean(scores: DataFrame) -> DataFrame:
    return scores.withColumn(NAMES[2], F.when(F.col(NAMES[0]) > 0, F.col(NAMES[1]) / F.col(NAMES[0])))


def _text_sums(each: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(each.astype(np.float64))])
    ends = np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes]


def _by_class(shared):
    words, network = shared.value or (Vocabulary([]), None)
    numbers = Numbers(words)

    def compute(texts):
        padded, sizes = numbers.padded(texts)
        if network is None:
            return sizes, np.zeros(len(sizes))
        return sizes, _text_sums(network.log_probabilities(padded, word_places(sizes)), sizes)

    return compute


def _numbered(docs: DataFrame, words: Vocabulary, shares: DataFrame, keep: list[str], text: str) -> DataFrame:
    """(kept_0, ..., row, ids, share, cold, times), written: columns ``keep``, a number for the row, the numbers of its words, 2 bytes
    each, the sum of the shares of its hot words, and its other words outside the vocabulary with how often it has each."""
    context = docs.sparkSession.sparkContext
    known, hot = context.broadcast(words), context.broadcast(hot_shares(shares))
    words_type, counts_type = T.ArrayType(T.StringType()), T.ArrayType(T.IntegerType())

    def make():
        from pyspark.sql.pandas.types import to_arrow_type

        codes = Codes(known.value, *hot.value)

        def compute(texts):
            numbers, sizes = codes.ids(texts)
            ids, each = codes.split(numbers)
            starts, which, n = codes.cold_counts(numbers, sizes)
            left = pa.array(codes.cold, pa.binary()).cast(pa.string()).take(pa.array(which))
            codes.forget()
            starts = pa.array(starts, pa.int32())
            lists = [pa.ListArray.from_arrays(starts, v).cast(to_arrow_type(t)) for v, t in ((left, words_type), (pa.array(n, pa.int32()), counts_type))]
            return _in_two_bytes(ids, sizes), _text_sums(each, sizes), *lists

        return compute

    kept = docs.select(*(F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(keep)), F.col(f"`{text}`").alias("text"))
    fields = [("ids", T.BinaryType()), ("share", T.DoubleType()), ("cold", words_type), ("times", counts_type)]
    made = map_texts(kept, make, fields, [c for c in kept.columns if c != "text"])
    return written(made.withColumn("row", F.monotonically_increasing_id()), "numbered")


def _scored_by_word(numbered: DataFrame, shared, shares: DataFrame, unseen: Column, keep: list[str]) -> DataFrame:
    """The shares of words that aren't hot are joined by word and added to what the network says and to those of hot words."""
    kept = [f"kept_{i}" for i in range(len(keep))]

    def make():
        words, network = shared.value

        def compute(texts):
            sizes = np.fromiter(map(len, texts), np.int64, len(texts)) // 2
            padded = words.padded(np.frombuffer(b"".join(texts), "<u2"), sizes)
            return sizes, _text_sums(network.log_probabilities(padded, word_places(sizes)), sizes)

        return compute

    made = map_texts(numbered, make, [("n_words", T.LongType()), ("said", T.DoubleType())], [*kept, "row", "share"], "ids")
    made = written(made, "scored")
    found = numbered.select("row", F.explode(F.arrays_zip(F.col("cold").alias("word"), "times")).alias("found")).select("row", "found.*")
    found = found.join(shares.select("word", "share"), "word", "left")
    share = F.coalesce("share", unseen)
    sums = found.groupBy("row").agg(F.sum(F.col("times") * F.round(share / SHARE_UNIT).cast("long")).alias("more"))
    whole = F.col("said") + F.col("share") + F.coalesce(F.col("more") * SHARE_UNIT, F.lit(0.0))
    out = made.join(sums, "row", "left").select(*(F.col(c).alias(name) for c, name in zip(kept, keep, strict=True)), F.col("n_words").alias(NAMES[0]), whole.alias(NAMES[1]))
    return _with_mean(out)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trained_and_scored(documents(spark, sf_dir), ["doc_id"])
