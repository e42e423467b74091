"""Equi joins whose keys may be hot, in as many partitions as there is work for.

What makes a key hot is the pairs it has: the product of its rows on both sides, held
against all pairs of the join. Rows of a hot key are spread over salts of both sides, a row of
one side goes to one of its own salts and all of the other's, so the key's pairs
are cut into parts of less than a partition's share. The result is the plain inner
join whatever was found hot.

The same pass that finds hot keys measures all pairs and bytes of the join. The number of partitions follows
from them and not from the session's setting: adaptive execution can put partitions together, but it can't
split one with many pairs, and where partitions hold few bytes it would put together those that make most.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a task is to make and to read.
PAIRS_PER_PARTITION = 1 << 24
BYTES_PER_PARTITION = 128 << 20
# What the driver and the tasks of a shuffle can keep track of.
MAX_PARTITIONS = 100_000
# A key is cut into parts of a partition's share divided by this: several to a partition even out.
_PARTS_PER_SHARE = 8
# Share of the left rows that keys are counted on. Salts only balance, so an estimate will do.
SAMPLED = 1 / 16
# The keys with most pairs that are looked at: a few megabytes. Any other key has less than that part of all pairs.
MOST_HOT = 1 << 16


@dataclass(frozen=True)
class Work:
    """What a join was measured to make and move, and how."""

    pairs: float = 0
    bytes: float = 0
    partitions: int = 1
    # Hash and number of salts on either side of each key with more than a part of all pairs.
    hot: tuple[tuple[int, int, int], ...] = ()


def shuffle_partitions(df: DataFrame) -> int:
    """The number the session sets; where that isn't a number, one for each core."""
    wanted = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return int(wanted) if wanted.isdigit() else df.sparkSession.sparkContext.defaultParallelism


def partitions_for(pairs: float, size: float, cores: int) -> int:
    """Every core has a partition, and no partition more than its pairs and bytes, as long as that is a number of partitions that can be."""
    return min(MAX_PARTITIONS, max(cores, math.ceil(pairs / PAIRS_PER_PARTITION), math.ceil(size / BYTES_PER_PARTITION)))


def row_bytes(fields: list[T.StructField], of: str = "") -> str:
    """SQL for the size of a row in memory: 16 bytes a column plus its text, binary or nested content; ``of`` goes before its names."""
    # The keys and the hash entry come to about 64 bytes.
    sizes = [f"{64 + 16 * len(fields)}"]
    for field in fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes.append(f"coalesce(octet_length({of}`{field.name}`), 0)")
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            sizes.append(f"coalesce(octet_length(to_json(struct({of}`{field.name}`))), 0)")
    return " + ".join(sizes)


def measure_work(left: DataFrame, right: DataFrame, keys: list[str], sampled: float = 1.0) -> Work:
    """One pass over the right side and ``left``, which is a sample of that share of the left side."""

    def rows(df: DataFrame, side: str, share: float) -> DataFrame:
        size = F.expr(row_bytes([f for f in df.schema.fields if f.name not in keys]))
        sums = df.select(F.xxhash64(*keys).alias("_hash"), size.alias("_size")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_size"))
        n, none = F.col("_n") / share, F.lit(0.0)
        return sums.select("_hash", (n if side == "l" else none).alias("_l"), (n if side == "r" else none).alias("_r"), (F.col("_size") / share).alias("_size"))

    both = rows(left, "l", sampled).unionByName(rows(right, "r", 1.0))
    work = both.groupBy("_hash").agg(*(F.sum(c).alias(c) for c in ("_l", "_r", "_size"))).withColumn("_pairs", F.col("_l") * F.col("_r"))
    total = Observation()
    top = work.observe(total, F.sum("_pairs").alias("pairs"), F.sum("_size").alias("size")).orderBy(F.desc("_pairs")).limit(MOST_HOT).collect()
    if len(top) < MOST_HOT:
        # All keys there are. Where Spark knows that beforehand it sorts without a limit and runs, and counts, twice.
        pairs, size = (sum(r[c] for r in top) for c in ("_pairs", "_size"))
    else:
        pairs, size = total.get["pairs"], total.get["size"]
    partitions = partitions_for(pairs, size, left.sparkSession.sparkContext.defaultParallelism)
    if not pairs:
        return Work(0, size, partitions)
    part = pairs / (partitions * _PARTS_PER_SHARE)
    hot = []
    for row in top:
        cuts = math.ceil(row["_pairs"] / part)
        if cuts > 1:
            # As many salts on each side as make the copied rows fewest.
            n_left = min(cuts, max(1, round(math.sqrt(cuts * row["_l"] / row["_r"]))))
            hot.append((row["_hash"], n_left, -(-cuts // n_left)))
    return Work(pairs, size, partitions, tuple(hot))


def sample_of(df: DataFrame) -> DataFrame:
    return df.sample(SAMPLED, 29)


def spread(salts: Column, columns: list[str]) -> Column:
    """A salt below ``salts``, the same in every attempt of a task.

    The input partition is part of the hash, so identical rows spread as well.
    """
    return F.pmod(F.xxhash64(F.spark_partition_id(), *columns), salts.cast("long")).cast("int")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread_left: list[str],
    spread_right: list[str],
    condition: Column | None = None,
    left_sample: DataFrame | None = None,
    order_left: tuple[str, ...] = (),
) -> DataFrame:
    """Inner shuffle join on ``keys`` that splits hot keys, in as many partitions as its pairs and bytes make up.

    ``spread_left`` and ``spread_right`` are columns that differ between most rows of a key. ``left_sample`` is what
    ``sample_of`` leaves of the left side, for callers that can take it earlier. Within a key, left rows come in the order of
    ``order_left``: where neighbours pair with almost the same rows, pairs take a fraction of the space when stored.
    """
    left_sample = sample_of(left) if left_sample is None else left_sample
    on, work = list(keys), measure_work(left_sample, right, keys, SAMPLED)
    if work.hot:
        hot = left.sparkSession.createDataFrame(work.hot, "_hash long, _salts_l int, _salts_r int")
        left = _salted(left, hot, keys, "_salts_l", "_salts_r", "_salt_l", "_salt_r", spread_left)
        right = _salted(right, hot, keys, "_salts_r", "_salts_l", "_salt_r", "_salt_l", spread_right)
        on += ["_salt_l", "_salt_r"]
    n = work.partitions
    left = in_order(left.repartition(n, *on), *on, *order_left)
    joined = left.join(right.repartition(n, *on).hint("merge"), on, "inner")
    if condition is not None:
        joined = joined.where(condition)
    return joined.drop("_salt_l", "_salt_r")


def in_order(df: DataFrame, *columns: Column | str) -> DataFrame:
    """``df`` sorted within its partitions, beneath a join too: Spark drops such a sort if nothing up to the join depends on the order."""
    return df.sortWithinPartitions(*columns).where(F.monotonically_increasing_id() >= 0)


def _salted(df, hot, keys, own, other, own_salt, other_salt, columns):
    # A bounded number of rows for each shuffle partition: safe to broadcast.
    tagged = df.withColumn("_hash", F.xxhash64(*keys)).join(F.broadcast(hot), "_hash", "left")
    own_salts = F.coalesce(F.col(own), F.lit(1))
    copies = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
    return (
        tagged.withColumn(own_salt, spread(own_salts, columns))
        .withColumn(other_salt, F.explode(copies))
        .drop("_hash", own, other)
    )
