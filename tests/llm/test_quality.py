import numpy as np
from pyspark.sql import functions as F

from gridshard.llm import quality as Q
from gridshard.llm.common import held_out

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = Q.scored(docs, Q.learn(docs, labels.where(~held_out())), ["doc_id"]).join(labels.where(held_out()), "doc_id")
    right = ((F.col("score") >= Q.THRESHOLD).cast("int") == F.col("quality")).cast("int")
    assert found.agg(F.avg(right)).first()[0] > 0.97


def test_votes_equal_all_cosines_one_by_one(monkeypatch):
    rng = np.random.default_rng(1)
    model = Q.Neighbours(np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(0, np.int64), np.zeros(0))
    model.labels = rng.integers(0, 2, 200).astype(np.float32)
    model.vectors = Q._unit(rng.standard_normal((200, 8)).astype(np.float32))
    vectors = Q._unit(rng.standard_normal((50, 8)).astype(np.float32))
    monkeypatch.setattr(Q, "BLOCK_ROWS", 7)
    got = model.scores(vectors)
    for v, s in zip(vectors, got, strict=True):
        cosines = np.array([float(v @ w) for w in model.vectors])
        near = np.argsort(-cosines)[: Q.NEIGHBOURS]
        weights = np.maximum(cosines[near], 0) ** Q.SHARPNESS
        assert abs(s - (weights * model.labels[near]).sum() / weights.sum()) < 1e-4


def test_projection_is_the_truncated_decomposition():
    rng = np.random.default_rng(2)
    sizes = np.full(30, 6)
    slots = np.concatenate([rng.choice(Q.TERMS, 6, replace=False) for _ in sizes]).astype(np.int32)
    values = rng.random(len(slots)).astype(np.float32) + 0.5
    model = Q.Neighbours(slots, values, sizes, np.ones(30), rank=30)
    matrix = np.zeros((30, Q.TERMS), np.float32)
    owner = np.repeat(np.arange(30), sizes)
    matrix[owner, slots] = model._weighted(slots, values, owner, 30)
    # With full rank, cosines in the space are those of the terms themselves.
    terms = Q._unit(matrix)
    assert np.allclose(model.vectors @ model.vectors.T, terms @ terms.T, atol=1e-3)
    assert np.allclose(model.project(slots, values, sizes), model.vectors, atol=1e-4)


def test_edge_cases(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(5, 1), (6, 1), (8, 0), (8, 1), (None, 0), (4, None), (99, 1)], "doc_id long, quality int")
    model = Q.learn(edge_docs, labels)
    assert len(model.labels) == 3 and set(model.labels.tolist()) == {0.5, 1.0}
    out = Q.scored(edge_docs, model)
    assert all(0 <= r.score <= 1 for r in out.collect()) and out.count() == edge_docs.count()
    assert [c.lower() for c in out.columns].count("score") == 1
    assert Q.scored(no_docs, model).count() == 0
    nothing = Q.learn(no_docs, labels)
    assert {r.score for r in Q.scored(edge_docs, nothing).collect()} == {0.5}


def test_a_repeated_id_teaches_once(spark, make_docs):
    copies = [(1, "many copies", "en", "s")] * 300 + [(1, f"text {i}", "en", "s") for i in range(50)]
    docs = make_docs([*copies, (2, "other words", "en", "s"), (3, None, "en", "s")])
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    model = Q.learn(docs, labels)
    assert model.labels.tolist() == [1, 0, 0]
    assert np.array_equal(model.vectors, Q.learn(docs.repartition(5, "text"), labels).vectors)
