import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridshard.llm import pseudo_likelihood as L


WORDS = L.Vocabulary([f"w{i}" for i in range(300)])


def network(seed=0):
    rng = np.random.default_rng(seed)
    net = L.Network(WORDS, rng.integers(1, 100, WORDS.size))
    net.group_out += rng.standard_normal(net.group_out.shape).astype(np.float32)
    return net


def one_by_one(net, ids, i):
    """The log-probability of every word at place ``i``, by the definition."""
    padded = [WORDS.pad] * L.WINDOW + list(ids) + [WORDS.pad] * L.WINDOW
    j = i + L.WINDOW
    around = [padded[j + k] for k in range(-L.WINDOW, L.WINDOW + 1) if k]
    hidden = np.maximum(sum(net.inputs[k][w].astype(float) for k, w in enumerate(around)) + net.hidden_bias, 0)

    def softmax(z):
        z = z - z.max()
        return np.exp(z) / np.exp(z).sum()

    group = softmax(net.group_out @ hidden + net.group_bias)
    return np.concatenate([group[g] * softmax(net.word_out[g] @ hidden + net.word_bias[g]) for g in range(net.groups)])


def test_scores_equal_the_definition_and_sum_to_one():
    net, rng = network(), random.Random(1)
    numbers = L.Numbers(WORDS)
    texts = [" ".join(f"W{rng.randrange(400)}" for _ in range(n)) for n in (7, 0, 1, 30)] + [None]
    padded, sizes = numbers.padded(texts)
    assert sizes.tolist() == [7, 0, 1, 30, 0]
    got = net.log_probabilities(padded, L.word_places(sizes))
    at = 0
    for text, n in zip(texts, sizes, strict=True):
        ids = [numbers[w] for w in L.words_of(text)]
        for i in range(n):
            p = one_by_one(net, ids, i)
            assert p.sum() == pytest.approx(1, abs=1e-5)
            assert got[at] == pytest.approx(np.log(p[ids[i]]), abs=1e-4)
            at += 1


@pytest.mark.parametrize("weighted", [False, True])
def test_gradients_equal_differences(weighted):
    net = network(3)
    for name in net.NAMES:
        setattr(net, name, getattr(net, name).astype(np.float64))
    padded = np.array([WORDS.pad, WORDS.pad, 5, 350, 33, 5, WORDS.pad, WORDS.pad], np.int32)
    places = np.arange(2, 6)
    weights = np.array([1.0, 3.0, 1.0, 2.0]) if weighted else np.ones(4)
    grads, loss = net.gradients(padded, places, weights if weighted else None)

    def mean():
        return -float(np.average(net.log_probabilities(padded, places).astype(float), weights=weights))

    assert loss == pytest.approx(mean(), abs=1e-5)
    rng = np.random.default_rng(0)
    for name, g in grads.items():
        where = np.argwhere(np.abs(g) > 1e-3)
        at = tuple(where[rng.integers(len(where))])
        table, step = getattr(net, name), 1e-3
        table[at] += step
        up = mean()
        table[at] -= 2 * step
        down = mean()
        table[at] += step
        assert (up - down) / (2 * step) == pytest.approx(float(g[at]), rel=0.01, abs=2e-4), name


def corpus(make_docs):
    rng = random.Random(2)
    cycle = [f"w{i}" for i in range(12)]
    return make_docs([(i, " ".join(cycle * rng.randrange(200, 400)), "en", "s") for i in range(60)])


def test_training_learns_what_neighbours_say(make_docs):
    docs = corpus(make_docs)
    words, net = L.train(docs)
    again_words, again = L.train(docs)
    assert words.words == again_words.words and np.array_equal(net.flat(), again.flat())
    probe = make_docs([(1, " ".join([f"w{i}" for i in range(12)] * 3), "en", "s"), (2, " ".join([f"w{i * 5 % 12}" for i in range(36)]), "en", "s")])
    a, b = L.scored(probe, (words, net)).orderBy("doc_id").collect()
    # Each word alone has a chance of one in twelve.
    assert a.mean_log_probability > np.log(1 / 12) + 1 > b.mean_log_probability + 1
    assert a.mean_log_probability == pytest.approx(a.log_likelihood / a.n_words)


def test_vocabulary_counts_every_word(make_docs, monkeypatch):
    monkeypatch.setattr(L, "LEAST_COUNT", 2)
    words, totals = L.vocabulary(L.word_counts(make_docs([(1, "b b a A c d e", "en", "s"), (2, "d", "en", "s")])))
    assert words.words == ["a", "b", "d"] and totals.sum() == 8 and totals[words.other_class(b"c")] >= 1
    # A ninth of all words.
    monkeypatch.setattr(L, "WORD_SHARE", 1 / 3)
    assert L.vocabulary(L.word_counts(make_docs([(1, "b b b a a c d e f", "en", "s")])))[0].words == ["b"]


def test_the_vocabulary_is_a_square_with_the_classes_at_its_end():
    for n in (0, 1, 36, 37, 1000, 32_768):
        words = L.Vocabulary(["w"] * n)
        assert n + words.others <= words.size == words.groups**2 < n + words.others + 2 * words.groups + 1 and words.size < 1 << 16
        assert all(words.size - words.others <= words.other_class(b"%d" % i) < words.size for i in range(200))


@pytest.mark.parametrize("shard_words", [1 << 20, 2000])
def test_the_network_does_not_depend_on_partitions(make_docs, monkeypatch, shard_words):
    """Scores are equal over 1, 8 and 64 partitions, with a third of the rows equal, in one shard and in several."""
    monkeypatch.setattr(L, "SHARD_WORDS", shard_words)
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{int(rng.random() ** 2 * 80)}" for _ in range(rng.randrange(1, 90))), "en", "s") for i in range(200)]
    rows += [(1000 + i, "w1 w2 w3 w1 w2", "en", "s") for i in range(100)]
    docs, scores = make_docs(rows), []
    for n in (1, 8, 64):
        dealt = docs.repartition(n)
        scores.append({r.doc_id: r.log_likelihood for r in L.scored(dealt, L.train(dealt)).collect()})
    assert scores[0] == pytest.approx(scores[1], abs=1e-3) and scores[0] == pytest.approx(scores[2], abs=1e-3)


def test_rounds_start_from_the_average(make_docs, monkeypatch):
    """In many shards of few words, more rounds over the same words get further than one."""
    monkeypatch.setattr(L, "SHARD_WORDS", 3000)
    rng = random.Random(7)
    words = [f"w{i}" for i in range(12)]
    rows = [(i, " ".join((words * 9)[rng.randrange(12) :][: rng.randrange(40, 96)]), "en", "s") for i in range(600)]
    docs, means = make_docs(rows), {}
    for rounds in (1, 4):
        monkeypatch.setattr(L, "ROUNDS", rounds)
        out = L.scored(docs, L.train(docs)).groupBy().sum("log_likelihood", "n_words").first()
        means[rounds] = out[0] / out[1]
    assert means[4] > means[1] > np.log(1 / 12)


def test_edge_cases(edge_docs, no_docs, make_docs):
    out = L.scored(edge_docs, L.train(edge_docs))
    assert out.columns.count("n_words") == 1
    for r in out.collect():
        assert (r.mean_log_probability is None) == (r.n_words == 0)
        assert r.log_likelihood <= 0 and (r.n_words > 0 or r.log_likelihood == 0)
    assert L.train(no_docs) is None and L.train(make_docs([(1, None, "en", "s")])) is None
    assert L.scored(no_docs, None).count() == 0
    assert {r.log_likelihood for r in L.scored(edge_docs, None).collect()} == {0.0}


@pytest.mark.parametrize("hot", [0, 7, 1 << 18])
def test_each_word_counts_not_only_its_class(make_docs, monkeypatch, hot):
    monkeypatch.setattr(L, "HOT_WORDS", hot)
    monkeypatch.setattr(L, "LEAST_COUNT", 100)
    rng = random.Random(4)
    rows = [(i, " ".join(["a", "b", "d"] * 9 + [f"w{int(rng.random() ** 3 * 60)}" for _ in range(40)]), "en", "s") for i in range(20)]
    docs, probe = make_docs(rows), [(1, "a b w0 W0 w59 neverseen neverseen", "en", "s"), (2, None, "en", "s"), (3, "a d", "en", "s"), (3, "a d", "en", "s")]
    counts = L.word_counts(docs)
    model = L.train(docs, counts=counts)
    words = model[0]
    assert words.words == L.train(docs)[0].words and {"a", "b", "d"} <= set(words.words)
    n = {r.word.encode(): r.n for r in counts.collect()}
    totals = {}
    for w in n.keys() - {x.encode() for x in words.words}:
        totals[words.other_class(w)] = totals.get(words.other_class(w), 0) + n[w]
    by_class = {r.doc_id: r for r in L.scored(make_docs(probe), model).collect()}
    by_word = L.scored(make_docs(probe, clashing=True), model, counts=counts).orderBy("doc_id").collect()
    assert [r.doc_id for r in by_word] == [1, 2, 3, 3]
    for r in by_word:
        rest = [w for w in L.words_of(r.text) if w.decode() not in words.words]
        shares = sum(np.log(n.get(w, 1) / (totals.get(words.other_class(w), 0) + 1)) for w in rest)
        assert r.n_words == by_class[r.doc_id].n_words
        assert r.log_likelihood == pytest.approx(by_class[r.doc_id].log_likelihood + shares, abs=1e-6)
    # A word that is rarer than another of its class is less likely.
    assert by_word[0].log_likelihood < by_class[1].log_likelihood


@pytest.mark.parametrize("shards", [1, 5])
def test_every_word_is_a_target_once(make_docs, shards):
    docs = make_docs([(i, f"a{i} b c"[: 2 + 2 * (i % 3)], "en", "s") for i in range(9)] + [(9, "x " * 10_001, "en", "s"), (10, None, "en", "s"), (11, "", "en", "s"), (12, "x " * 10_001, "en", "s")])
    counts = L.word_counts(docs)
    words, totals = L.vocabulary(counts)
    texts = L.training_texts(docs, "text", words)
    # Equal numbers are one text, with how many there are.
    assert texts.selectExpr("sum(copies * length(ids) div 2)").first()[0] == counts.groupBy().sum("n").first()[0]
    trained = [L._trained(texts.where(F.pmod(F.shiftright("place", 40), F.lit(L.ROUNDS)) == r), words, totals, shards, None) for r in range(L.ROUNDS)]
    seen = sum(t.where("block = 0").groupBy().sum("weight").first()[0] or 0 for t in trained)
    assert seen == texts.selectExpr("sum(length(ids) div 2)").first()[0]


def test_numbering_holds_the_words_of_one_text():
    """Of a slice of four megabytes the words would take ten times as much."""
    import tracemalloc

    texts = [" ".join(f"w{i}x{j}" for j in range(100)) for i in range(2000)]
    numbers = L.Numbers(L.Vocabulary([]))
    first = numbers.ids(texts)
    tracemalloc.start()
    ids, sizes = numbers.ids(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sizes.tolist() == [100] * 2000 and ids.tolist() == first[0].tolist()
    assert peak < 4_000_000


def test_words_of_texts_are_numbered_once(make_docs, monkeypatch):
    """For training and for scores, with what training and scoring apart give."""
    monkeypatch.setattr(L, "LEAST_COUNT", 100)
    monkeypatch.setattr(L, "HOT_WORDS", 7)
    rng = random.Random(8)
    rows = [(i, " ".join(["a", "b", "d"] * 9 + [f"w{int(rng.random() ** 3 * 60)}" for _ in range(40)]), "en", "s") for i in range(20)]
    docs = make_docs([*rows, rows[3], (30, None, "en", "s"), (31, " \n", "en", "s"), (None, "a w1 zä", "en", "s")])
    counts = L.word_counts(docs)
    apart = L.scored(docs, L.train(docs, counts=counts), ["doc_id"], counts=counts)
    read, map_texts = [], L.map_texts
    monkeypatch.setattr(L, "documents", lambda *_: docs)
    monkeypatch.setattr(L, "map_texts", lambda df, make, fields, keep=None, text="text": read.append(text) or map_texts(df, make, fields, keep, text))
    together = L.op4(docs.sparkSession, "")
    assert read == ["text", "ids"] and together.columns == apart.columns
    got, wanted = ([sorted(map(tuple, df.fillna(-1.0, "mean_log_probability").fillna(-1, "doc_id").collect())) for df in (together, apart)])
    assert len(got) == 24 and [r[:2] for r in got] == [r[:2] for r in wanted]
    for a, b in zip(got, wanted, strict=True):
        assert a[2:] == pytest.approx(b[2:], abs=1e-3)


def test_a_step_changes_only_inputs_that_are_there():
    """As much as one by the gradients of all inputs."""
    rng = np.random.default_rng(5)
    padded, sizes = WORDS.padded(rng.integers(0, WORDS.size, 40).astype(np.int32), np.array([7, 1, 32])), np.array([7, 1, 32])
    places = L.word_places(sizes)[3:35]
    trainer, net = L.Trainer(network(2)), network(2)
    past = {n: np.full_like(getattr(net, n), 1e-6) for n in net.NAMES}
    for _ in range(3):
        ids, loss = trainer.network.sparse_gradients(padded, places)[1:]
        grads, same = net.gradients(padded, places)
        assert loss == pytest.approx(same, abs=1e-6) and len(ids) < 45
        rest = np.setdiff1d(np.arange(WORDS.size + 1), ids)
        assert not grads["inputs"][:, rest].any()
        trainer.step(padded, places)
        for name, g in grads.items():
            past[name] += g * g
            getattr(net, name)[...] -= L.RATE * g / np.sqrt(past[name])
            assert np.allclose(getattr(net, name), getattr(trainer.network, name), atol=1e-5), name


def test_words_of_a_slice_are_those_of_each_text():
    import pyarrow as pa

    texts = ["  A b\t\tÄé \n", "", None, " \r\n", "c\x0bd\x0ce\x1cf\x85g h i\x00", "B", "x" * 9000]
    words, sizes = L.split_words(pa.array(["left out", *texts]).slice(1))
    assert [w.encode() for w in words.to_pylist()] == [w for t in texts for w in L.words_of(t)]
    assert sizes.tolist() == [len(L.words_of(t)) for t in texts]
    for none in ([], [None, ""]):
        ids, sizes = L.Numbers(WORDS).ids(none)
        assert len(ids) == 0 and sizes.tolist() == [0] * len(none)


def test_each_different_word_is_looked_up_once():
    class Counted(L.Numbers):
        looked_up = 0

        def __getitem__(self, word):
            type(self).looked_up += 1
            return super().__getitem__(word)

    ids, sizes = Counted(WORDS).ids(["w1 w2 W1 other"] * 50 + [None, "w2"])
    assert Counted.looked_up == 3 and ids[:4].tolist() == [1, 2, 1, WORDS.other_class(b"other")] and ids[-1] == 2 and sizes.sum() == 201
