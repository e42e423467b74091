"""Plain versions of what the pipeline's stages decide."""

import zlib

import numpy as np
from tokenizers import Tokenizer

from test_decontamination import brute as decontamination
from test_jaccard_join import brute as jaccard


def jaccard_keep(rows):
    return [r for r, (i, n, c, _) in zip(rows, jaccard(rows), strict=True) if n == 0 or i == c]


def contaminated(text, items):
    return decontamination(text, items)[4]


def token_rows(rows, path):
    """Copies of a document follow each other; a cut copy's place among them is settled by a hash of Spark's."""
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    spark = SparkSession.getActiveSession()
    texts = spark.createDataFrame([(r[1],) for r in rows], "text string").distinct()
    place = {r.text: r.place for r in texts.withColumn("place", F.xxhash64("text")).collect()}
    tokenizer, out, start = Tokenizer.from_file(path), [], 0
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0], place[r[1]], r[1])):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out
