"""The pipeline, stage by stage, against brute force on its own input."""

from collections import Counter

import corpus_pipeline
from gridshard.llm import repair
from gridshard.llm.common import written
from stage_brute import contaminated, jaccard_keep, token_rows

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    seen = [[tuple(r) for r in docs.collect()]]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR), name)
        seen.append([tuple(r) for r in docs.collect()])
        if name != "token_files":
            assert docs.columns == COLUMNS
    start, known, single, clean, mixed, tokens = seen
    assert Counter(known) == Counter(r for r in start if r[1] and any(c.isalpha() for c in r[1]))
    assert Counter(single) == Counter(jaccard_keep(known))
    assert Counter(clean) == Counter(r for r in single if not contaminated(r[1], benchmark))
    texts = {r[0]: r[1] for r in clean}
    assert all(texts[r[0]] == r[1] or texts[r[0]].split()[: len(r[1].split())] == r[1].split() for r in mixed)
    assert all(r[4] == len(r[1]) for r in mixed)
    assert Counter(tokens) == Counter(token_rows(mixed, repair.default_tokenizer()))
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, SF_DIR).collect()) == Counter(tokens)


def test_edge_cases_and_empty_tables(spark, edge_docs, no_docs):
    docs = edge_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF_DIR), "edge")
        assert docs.columns == edge_docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == docs.count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF_DIR).count() == 0
