"""Mixing sources to target weights by capped water-filling.

Every source has a weight and a size (words). The words to hand out are shared by
weight; a source may give at most ``max_epochs`` times its size, and what it can't
take is reshared among the others by weight, round by round, until no source is
above its cap. A source's target then means so many whole copies of each of its
documents and one more of some: documents follow each other in a seeded order and
are taken until the words left are used up; the one at the end gives its text up to a word.

Only the point where each source's order is cut has to be known, one row for each
source. It is found in two steps, in sums over ranges of the order and then within
the one range that holds it. A source of n documents has sqrt(n) ranges, so either step
orders some sqrt(n) rows and no task all documents of a source. Texts are not shuffled.

Nulls: a null source is a source of its own, the last; a null text has no words; a
null id counts as empty text in the seeded order. That order is by a hash of id and text, so only rows
equal in both tie in it; those share the words left at the cut in proportion to their sizes, rounded
down. Without documents, or with sizes that are all 0, every target is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gridshard.llm.common import WORD, documents, fresh, word_count, written
from gridshard.operators.numbering import global_row_number

SEED = "mix-1"
MAX_EPOCHS = 3
_HASH_BITS = 52


def seeded_order(doc_id: str, text: str, seed: str) -> Column:
    """52 bits of an md5 of seed, id and text: the place of a document in its source's order."""
    content = F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"))
    name = F.concat(F.lit(seed + ":"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")), F.lit(":"), content)
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, _HASH_BITS // 4), 16, 10).cast("long")


def repeating_weights(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """One row (source, weight) for each distinct source: ``weights`` over and over in code point order, null last."""
    order = sources.select("source").distinct().withColumn("is_null", F.col("source").isNull())
    numbered = global_row_number(order, ["is_null", "source"], "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    return numbered.select("source", weight.cast("double").alias("weight"))


def source_targets(sources: DataFrame, share: float = 1.0, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``sources`` (source, weight, source_size) with ``target``, by rounds of capping and resharing.

    A round is one aggregate of one row; each but the last caps a source at least, in
    practice there are a handful. Null and negative weights count as 0.
    """
    weight = F.greatest(F.coalesce(F.col("weight"), F.lit(0.0)), F.lit(0.0))
    cap = F.col("source_size") * F.lit(max_epochs)
    level, capped = 0.0, -1
    while True:
        full = (cap < F.lit(level) * weight) if capped >= 0 else F.lit(False)
        row = sources.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(full, cap)).alias("given"),
            F.sum(F.when(~full, weight)).alias("weight"),
            F.count(F.when(full, 1)).alias("capped"),
        ).first()
        if row.capped == capped:
            break
        capped = row.capped
        left = (row.total or 0) * share - (row.given or 0)
        level = max(0.0, left / row.weight) if row.weight else (float("inf") if capped else 0.0)
    filled = F.least(cap.cast("double"), F.when(weight > 0, F.lit(level) * weight).otherwise(0.0))
    return sources.withColumn("target", filled)


def cuts(sizes: DataFrame, weights: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """One row for each source: size, target, whole copies and where its order is cut.

    ``sizes`` (source, size, place) has a row for each document. Written, as it is read
    by each of several passes.
    """
    source = F.col("source")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    totals = totals.join(weights.withColumnRenamed("source", "weight_source"), source.eqNullSafe(F.col("weight_source")), "left")
    targets = source_targets(written(totals.drop("weight_source"), "mix-sources"), share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("whole", whole.cast("long")).withColumn(
        "more", F.floor(F.col("target") + 0.5).cast("long") - F.col("whole") * F.col("source_size")
    )
    targets = written(targets.withColumn("n_ranges", F.ceil(F.sqrt("n_docs"))), "mix-targets")

    ours = targets.select(F.col("source").alias("of"), "more", "n_ranges")
    in_range = F.floor(F.col("place") / F.lit(float(1 << _HASH_BITS)) * F.col("n_ranges")).cast("long")
    placed = sizes.join(ours, source.eqNullSafe(F.col("of"))).withColumn("range", in_range)
    before = Window.partitionBy("source").rowsBetween(Window.unboundedPreceding, -1)

    def cut_at(sums: DataFrame, key: str, base: Column) -> DataFrame:
        start = base + F.coalesce(F.sum("words").over(before.orderBy(key)), F.lit(0))
        here = (F.col("start") <= F.col("more")) & (F.col("more") < F.col("start") + F.col("words"))
        return sums.withColumn("start", start).where(here)

    ranges = placed.groupBy("source", "range", "more").agg(F.sum("size").alias("words"))
    cut_range = written(cut_at(ranges, "range", F.lit(0)).select(F.col("source").alias("cut_source"), F.col("range").alias("cut_range"), F.col("start").alias("range_start")), "mix-ranges")
    inside = placed.join(cut_range, source.eqNullSafe(F.col("cut_source")) & (F.col("range") == F.col("cut_range")))
    ties = inside.groupBy("source", "place", "more", "range_start").agg(F.sum("size").alias("words"))
    cut = cut_at(ties, "place", F.col("range_start")).select(
        F.col("source").alias("cut_source"), F.col("place").alias("cut_place"), (F.col("more") - F.col("start")).alias("cut_words"), F.col("words").alias("cut_size")
    )
    out = targets.join(cut, source.eqNullSafe(F.col("cut_source")), "left")
    return written(out.select("source", "source_size", "target", "whole", "cut_place", "cut_words", "cut_size"), "mix-cuts")


def _last_copy(size: Column, place: Column, cut: dict[str, Column]) -> Column:
    """Words taken beyond whole copies: all before the cut, a part at the cut, none after it."""
    at_cut = F.floor(cut["cut_words"] * size / cut["cut_size"]).cast("long")
    before = cut["cut_place"].isNull() | (place < cut["cut_place"])
    return F.when(before, size).when(place == cut["cut_place"], at_cut).otherwise(0)


def plan_mix(docs: DataFrame, weights: tuple[float, ...], share: float, max_epochs: float, seed: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, size, place) of every document, and the cuts of every source."""
    sizes = docs.select("doc_id", "source", word_count().alias("size"), seeded_order("doc_id", "text", seed).alias("place"))
    sizes = written(sizes, "mix-sizes")
    return sizes, cuts(sizes, repeating_weights(sizes, weights), share, max_epochs)


def mix_report(docs: DataFrame, weights: tuple[float, ...], share: float = 1.0, max_epochs: float = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target (its source's) and taken (words, repeats counted) of every document."""
    sizes, at = plan_mix(docs, weights, share, max_epochs, seed)
    at = at.withColumnRenamed("source", "cut_source")
    taken = F.col("whole") * F.col("size") + _last_copy(F.col("size"), F.col("place"), {c: F.col(c) for c in at.columns})
    joined = sizes.join(at, F.col("source").eqNullSafe(F.col("cut_source")), "left")
    return joined.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def mix(docs: DataFrame, weights: tuple[float, ...], share: float = 1.0, max_epochs: float = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mixed corpus, with the columns of ``docs``: a row for each whole copy of a document, and
    one with its text up to a word for a part of a copy, of one document of a source and its copies. What isn't taken is left out.

    A document without words is kept once: it adds nothing to any source.
    """
    _, at = plan_mix(docs, weights, share, max_epochs, seed)
    names = {c: fresh(docs, "mix_" + c) for c in [*at.columns, "size", "place", "words"]}
    size, place, words = (F.col(names[c]) for c in ("size", "place", "words"))
    table = at.select(*(F.col(c).alias(names[c]) for c in at.columns))
    cut = {c: F.col(names[c]) for c in at.columns}
    lengths = F.concat(
        F.array_repeat(size, cut["whole"].cast("int")),
        F.filter(F.array(_last_copy(size, place, cut)), lambda n: n > 0),
    )
    lengths = F.when(size == 0, F.array(F.lit(0).cast("long"))).otherwise(lengths)
    # Each word with what is before it, so that the text stays as it is up to the last word taken.
    first_words = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"[\\x20\\x09-\\x0D]*{WORD}"), F.lit(0)), 1, words.cast("int")), "")
    text = F.when(words < size, first_words).otherwise(F.col("text"))
    return (
        docs.withColumns({names["size"]: word_count(), names["place"]: seeded_order("doc_id", "text", seed)})
        .join(table, F.col("source").eqNullSafe(cut["source"]), "left")
        .select("*", F.explode(lengths).alias(names["words"]))
        .select(*(text.alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in docs.columns))
    )


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = mix_report(documents(spark, sf_dir), weights=(1.0, 2.0, 3.0))
    return report.select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT AS place
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), weighed AS (
  SELECT *, 1e0 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight,
         (SELECT sum(size) FROM d)::BIGINT AS total FROM totals
), levels AS (
  SELECT arg_min(level, full_at) AS level FROM (
    SELECT a.source_size * {MAX_EPOCHS} / a.weight AS full_at,
           (a.total - coalesce((SELECT sum(b.source_size * {MAX_EPOCHS}) FROM weighed b
                                WHERE b.source_size * {MAX_EPOCHS} / b.weight < a.source_size * {MAX_EPOCHS} / a.weight), 0))::DOUBLE
           / (SELECT sum(b.weight) FROM weighed b
              WHERE b.source_size * {MAX_EPOCHS} / b.weight >= a.source_size * {MAX_EPOCHS} / a.weight) AS level
    FROM weighed a) WHERE level <= full_at
), targets AS (
  SELECT *, least(source_size * {MAX_EPOCHS}::DOUBLE, level * weight) AS target,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole,
         floor(target + 0.5)::BIGINT - whole * source_size AS more
  FROM weighed, levels
), ordered AS (
  SELECT d.*, source_size, target, whole, more,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)::BIGINT AS upto,
         sum(d.size) OVER (PARTITION BY d.source, place)::BIGINT AS tied
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (whole * size + CASE WHEN upto <= more THEN size WHEN upto - tied >= more THEN 0
                            ELSE floor((more - upto + tied) * size / tied) END)::BIGINT AS taken
FROM ordered
"""
