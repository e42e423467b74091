"""From raw documents to token files, in five stages.

Each stage reads what the one before it has written as Parquet. All but the last return the columns of
their input; the last returns a row for each document of the mix as read back from the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridshard.llm import decontamination, jaccard_join, language, mixing, repair
from gridshard.llm.common import documents, held_out, written

# How many times as probable as by chance the most probable language of a document has to be.
LANGUAGE_MARGIN = 1.1
SOURCE_WEIGHTS = (1.0, 2.0, 3.0)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose language can't be told: nothing of them is known, or no language is likelier than by chance.

    Without any labels nothing can be told by its language, and all documents with a letter stay.
    """
    return language.only_known(docs, LANGUAGE_MARGIN, ~held_out())


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by their word 5-grams the one with the smallest id stays."""
    return jaccard_join.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words in benchmark passages go."""
    return decontamination.uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, cut or left out so that sources have their target sizes."""
    mix = mixing.mix(docs, SOURCE_WEIGHTS)
    return mix.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else mix


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document in the token files."""
    return repair.token_table(docs, repair.default_tokenizer())


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard_join", without_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("source_mix", mixed_sources),
    ("token_files", token_files),
]
# SQL can express neither the language model nor the token files.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
