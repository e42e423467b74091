import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use for results or inside.
CLASHING = ("size", "Score", "n_words", "prefix", "text_read", "mix_size", "kept", "found", "jaccard_key", "lang_found", "ids")


def sentence(rng, n, words=60):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text, lang, source) as documents, over three partitions, with columns of clashing names."""

    def make(rows, clashing=False):
        full = [(*r, len(r[1]) if r[1] else None) for r in rows]
        df = spark.createDataFrame(full, COLUMNS)
        if rows:
            df = df.repartition(3)
        for name in CLASHING if clashing else ():
            df = df.withColumn(name, F.lit("kept as it is"))
        return df

    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and very long texts, repeated rows and ties."""
    rng = random.Random(5)
    long_text = sentence(rng, 60_000, 3000)
    near = sentence(rng, 80)
    return [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \t\n\x0b\x0c\r ", None, None),
        (None, "some words of nobody", "de", "b"),
        (None, "some words of nobody", "de", "b"),
        (4, "one", "de", None),
        (5, near, "en", "a"),
        (6, near + " end", "en", "b"),
        (7, near, "en", "c"),
        (7, near, "en", "c"),
        (8, long_text, "de", "c"),
        (9, "ä ö ü ß été — “quoted” 你好 \U0001f600 x", "fr", "b"),
        (10, "a  b\xa0 c d 's <|endoftext|> \x1c e\x00f", "fr", "b"),
        (11, "line\nline\n\nline\n other", "en", "a"),
        (12, None, None, None),
    ]


@pytest.fixture
def edge_docs(make_docs, edge_rows):
    return make_docs(edge_rows, clashing=True)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
