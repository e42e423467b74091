"""All rules of a schema over its tables, as one report.

One pass over each table turns rows into findings: a value for each unique key, foreign
key and key that others refer to, and one for all of the row's nulls and failed checks together. Findings are
counted by value, with map-side combine, so a frequent value is one row in what follows.

Values are numbers, not texts: a column of up to 64 bits is one word, itself or by a hash of 64 bits that tells all
values of such a type apart; the words of a key are columns of the aggregation. Only columns of other types (texts, wide decimals) go as text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridshard.sources.schemas import RATINGS_SCHEMA, TableSpec

RULES = "code int, table_name string, rule string, subject string, link int, rank int"
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FIXED = (T.BooleanType, T.FloatType, T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType)
# Nulls and failed checks of a row are bits of a number.
_FLAGS = 62


def check_schema(tables: dict[str, DataFrame], specs: dict[str, TableSpec] = RATINGS_SCHEMA) -> DataFrame:
    """One row per rule: ``table_name, rule, subject, violations`` (violating rows)."""
    rules = _rules(specs)
    ranks = 1 + max((rank for *_, rank in rules), default=0)
    made = {name: _findings(tables[name], name, specs, rules) for name in specs}
    n_words = max((len(words) for found, _ in made.values() for *_, words, _ in found), default=1)
    with_text = any(text is not None for found, _ in made.values() for *_, text in found)
    keys = ["link", *(f"word{i}" for i in range(n_words)), *["text"] * with_text]
    found = reduce(DataFrame.unionAll, [_found(tables[name], made[name][0], n_words, with_text) for name in specs])
    # Of a value, the findings of each rule that names it; the key itself, where there is one, ranks first.
    counted = found.groupBy(*keys).agg(*[F.count_if(F.col("rank") == r).alias(f"n{r}") for r in range(ranks)])
    table = found.sparkSession.createDataFrame(rules, RULES)
    bits = found.sparkSession.createDataFrame([b for _, flags in made.values() for b in flags], "link int, rank int, bit long, code int")
    pairs = [F.struct(F.lit(r).alias("rank"), F.col(f"n{r}").alias("n")) for r in range(ranks)]
    each = counted.select("link", "word0", (F.col("n0") > 0).alias("known"), F.inline(F.array(*pairs))).where("n > 0")
    # One row for each rule of the schema; what a flagged row violates are the rules of its bits.
    kinds = table.where("rule IN ('unique', 'foreign key')").selectExpr("link", "rank", "rule", "0L AS bit", "code").unionByName(bits.withColumn("rule", F.lit("flag")))
    violated = "rule = 'flag' AND word0 & bit <> 0 OR rule = 'unique' AND n > 1 OR rule = 'foreign key' AND NOT known"
    violations = each.join(F.broadcast(kinds), ["link", "rank"]).where(violated).groupBy("code").agg(F.sum("n").alias("violations"))
    report = table.where("rule <> 'known'").join(violations, "code", "left")
    return report.select("table_name", "rule", "subject", F.coalesce("violations", F.lit(0)).cast("long").alias("violations"))


def _rules(specs: dict[str, TableSpec]) -> list[tuple]:
    """A row (RULES) for each rule; keys that foreign keys refer to are rules of their own, ``known``. Foreign keys
    have the link of the key they refer to and rank after it, any other rule has a link of its own."""
    rules = [(parent, "known", key) for parent, key in sorted({(p, k) for s in specs.values() for _, p, k in s.foreign_keys})]
    for name, spec in specs.items():
        rules += [(name, "not null", c) for c in spec.required]
        rules += [(name, "unique", ", ".join(key)) for key in spec.keys]
        rules += [(name, "foreign key", f"{c} -> {parent}.{key}") for c, parent, key in spec.foreign_keys]
        rules += [(name, "check", rule) for rule in spec.checks]
    links = {f"{t}.{subject}": i for i, (t, rule, subject) in enumerate(rules) if rule == "known"}
    met: dict[int, int] = {}
    out = []
    for code, (table, rule, subject) in enumerate(rules):
        link = links[subject.split(" -> ")[1]] if rule == "foreign key" else code
        out.append((code, table, rule, subject, link, met.get(link, 0)))
        met[link] = met.get(link, 0) + 1
    return out


def _words(columns: list[tuple[Column, T.DataType]]) -> tuple[list[Column], Column | None]:
    """The values of a key as 64-bit words and, where there are columns that don't fit one, a text of those."""
    words, texts = [], []
    for column, kind in columns:
        if isinstance(kind, _INTEGERS):
            words.append(column.cast("long"))
        elif isinstance(kind, _FIXED) or isinstance(kind, T.DecimalType) and kind.precision <= 18:
            # Of a single number of 64 bits or less, each step of this hash can be undone: no two have the same.
            words.append(F.xxhash64(column))
        else:
            text = column.cast("string")
            # Lengths keep values apart that would run together.
            texts.append(F.concat(F.length(text), F.lit(":"), text))
    return words, F.concat(*texts) if texts else None


def _findings(df: DataFrame, name: str, specs: dict[str, TableSpec], rules: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """Of one table, (link, rank, condition, words, text) of each finding, and (link, rank, bit, code) of each flag."""
    spec, types = specs[name], {f.name.lower(): f.dataType for f in df.schema.fields}
    places = {(rule, subject): (link, rank) for _, table, rule, subject, link, rank in rules if table == name}
    flagged = [(places["not null", c], F.col(c).isNull()) for c in spec.required]
    flagged += [(places["check", rule], F.coalesce(~F.expr(rule), F.lit(False))) for rule in spec.checks]
    found, flags = [], []
    for start in range(0, len(flagged), _FLAGS):
        some = flagged[start : start + _FLAGS]
        # The rows of the first rule's link stand for all of them.
        link, rank = some[0][0]
        word = reduce(Column.bitwiseOR, [F.when(when, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, (_, when) in enumerate(some)])
        found.append((link, rank, word != 0, [word], None))
        flags += [(link, rank, 1 << i, code) for i, ((code, _), _) in enumerate(some)]
    for key in spec.keys:
        complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
        found.append((*places["unique", ", ".join(key)], complete, *_words([(F.col(c), types[c.lower()]) for c in key])))
    referring = [("foreign key", f"{c} -> {parent}.{key}", c, specs[parent].schema[key]) for c, parent, key in spec.foreign_keys]
    referring += [("known", key, key, spec.schema[key]) for rule, key in places if rule == "known"]
    for rule, subject, column, field in referring:
        # Values are compared in the type that the schema gives the key.
        value = F.col(column).cast(field.dataType)
        found.append((*places[rule, subject], F.col(column).isNotNull(), *_words([(value, field.dataType)])))
    return found, flags


def _found(df: DataFrame, findings: list[tuple], n_words: int, with_text: bool) -> DataFrame:
    """(link, rank, word0, ..., text) of one table."""

    def row(link: int, rank: int, when: Column, words: list[Column], text: Column | None) -> Column:
        padded = [*words, *[F.lit(0).cast("long")] * (n_words - len(words))]
        columns = [F.lit(link).alias("link"), F.lit(rank).alias("rank"), *(w.alias(f"word{i}") for i, w in enumerate(padded))]
        columns += [(F.lit("") if text is None else text).alias("text")] * with_text
        return F.when(when, F.struct(*columns))

    return df.select(F.inline(F.array(*(row(*f) for f in findings)))).where("link IS NOT NULL")
