"""Registered queries against their SQL, and that each has the columns of its contract."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from gridshard.llm import registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
COLUMNS = {
    1: "doc_id size source_size target taken",
    2: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    5: "doc_id held_out score predicted",
    6: "doc_id start n_tokens ids_crc32",
    7: "doc_id held_out lang_pred score",
    9: "doc_id n_words n_hit n_items items_sha256 contaminated",
    10: "doc_id n_shingles component_id",
    11: "word form root n n_near form_n",
    12: "doc_id n_tokens ids_sha256 decoded_sha256",
    13: "lang source part item value rank",
}


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    df = registry.QUERIES[name](spark, SF_DIR)
    result = duck.execute(registry.ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    expected = Counter(tuple(normal(r[names.index(c)]) for c in sorted(names)) for r in result.fetchall())
    assert Counter(tuple(normal(r[c]) for c in sorted(names)) for r in df.collect()) == expected


def test_all_operators_and_the_pipeline_are_registered():
    numbers = Counter(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op"))
    assert numbers == dict.fromkeys(range(1, 14), 1)
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("number", sorted(COLUMNS))
def test_contract_columns(spark, number):
    name = next(n for n in registry.QUERIES if n.startswith(f"op{number}_"))
    df = registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert df.columns[: len(COLUMNS[number].split())] == COLUMNS[number].split()
    # One row for each document, but for words and for groups of documents.
    assert number in (11, 13) or df.count() == 200
