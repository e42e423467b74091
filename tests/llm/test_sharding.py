import hashlib
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridshard.llm import sharding as S


def brute(rows, limit):
    """(doc_id, depth, prefix) by splitting buckets one after the other; bytes of each bucket."""
    docs = []
    for doc_id, text, *_ in rows:
        name = f"{'' if doc_id is None else doc_id}:{text or ''}"
        docs.append((int(hashlib.md5(name.encode()).hexdigest()[:15], 16), len((text or "").encode()), doc_id))
    out, todo = [], [(0, 0, docs)]
    while todo:
        depth, prefix, bucket = todo.pop()
        if sum(b for _, b, _ in bucket) > limit and len({h for h, _, _ in bucket}) > 1:
            for bit in (0, 1):
                part = [d for d in bucket if d[0] >> (59 - depth) & 1 == bit]
                if part:
                    todo.append((depth + 1, prefix * 2 + bit, part))
        else:
            out += [(i, depth, prefix) for _, _, i in bucket]
    return out


@pytest.mark.parametrize("limit", [50, 400, 5_000, 10**9])
def test_same_buckets_as_splitting_one_by_one(make_docs, edge_rows, limit):
    rng = random.Random(limit)
    rows = edge_rows + [(100 + i, "x" * rng.randrange(300), "en", "s") for i in range(300)]
    got = S.assign_shards(make_docs(rows), limit).collect()
    assert sorted((r.doc_id or 0, r.depth, r.prefix) for r in got) == sorted((i or 0, d, p) for i, d, p in brute(rows, limit))
    shards = defaultdict(list)
    for r in got:
        shards[r.depth, r.prefix, r.page].append(r)
    for members in shards.values():
        assert {r.shard_bytes for r in members} == {sum(r.n_bytes for r in members)}
        if sum(r.n_bytes for r in members) > limit:
            assert len([r for r in members if r.n_bytes]) == 1 and members[0].oversized


def test_equal_rows_get_overflow_pages(make_docs):
    rows = [(1, "abcde", "en", "s")] * 100 + [(2, "other", "en", "s")]
    got = [r for r in S.assign_shards(make_docs(rows), 12, keep=["doc_id"]).collect() if r.doc_id == 1]
    pages = defaultdict(int)
    for r in got:
        pages[r.page] += 1
    assert pages == dict.fromkeys(range(50), 2)
    assert {r.shard_bytes for r in got} == {10}


def test_writes_a_folder_for_each_shard(spark, make_docs, tmp_path):
    docs = make_docs([(i, "x" * 50, "en", "s") for i in range(200)])
    path = str(tmp_path / "shards")
    S.write_shards(docs, path, 1000)
    back = spark.read.parquet(path)
    assert back.drop("shard").exceptAll(docs).isEmpty() and back.count() == 200
    assert back.groupBy("shard").agg(F.sum(F.length("text")).alias("n")).where("n > 1000").isEmpty()
    assert all(sum(f.endswith(".parquet") for f in os.listdir(f"{path}/{d}")) == 1 for d in os.listdir(path) if d.startswith("shard="))


def test_empty_table_and_no_python(no_docs, edge_docs):
    assert S.assign_shards(no_docs).count() == 0
    plan = S.assign_shards(edge_docs, 100)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
