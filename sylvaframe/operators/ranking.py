"""Dense ranks, splits and shards without sending a whole group to one task.

A group (a source file, say) may hold any share of the data, so a window over
it alone would be one task's work. Rows are cut into buckets by their sort
key first; a bucket's rows are ranked in a window of their own, and the rows
ahead of it come from a prefix sum over one line per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize

ROWS_PER_BUCKET = 100_000
HASH_RANGE = 2**32
_MULTIPLIER = 2_654_435_761


def shared_hash(value: Column, seed: int = 42) -> Column:
    """A 32-bit multiplicative hash of a whole number that any SQL engine can restate."""
    return F.pmod(F.pmod(value.cast("long"), F.lit(2**31)) * F.lit(_MULTIPLIER) + F.lit(seed), F.lit(HASH_RANGE))


def shared_text_hash(value: Column, seed: int = 42) -> Column:
    """As shared_hash for a string: the leading 32 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), value).cast("binary")), 1, 8), 16, 10).cast("long")


def order_hash(df: DataFrame, key: str, seed: int = 42) -> Column:
    """A 32-bit hash of ``key``, a number or a string. Rows without a key get one of the whole row, so they don't all meet."""
    whole = df.schema[key].dataType.typeName() in ("byte", "short", "integer", "long")
    own = shared_hash(F.col(key), seed) if whole else shared_text_hash(F.col(key).cast("string"), seed)
    return F.coalesce(own, F.pmod(F.xxhash64(*df.columns), F.lit(HASH_RANGE)))


def ranked(df: DataFrame, group: list[str], key: str, ties: list[str], key_range: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``df`` with ``rank`` (from 1, within the group, by key then ties, nulls first) and ``of`` (rows in the group).

    With ``key_range`` the key is a whole number of [0, key_range), spread evenly,
    and buckets are even cuts of it. Otherwise it may be of any orderable type:
    buckets are ranges that Spark cuts by a sample, and the rows are written once.
    """
    if key_range is None:
        buckets = max(1, -(-df.count() // rows_per_bucket))
        cut = df.repartitionByRange(buckets, *group, key, *ties).withColumn("_bucket", F.spark_partition_id().cast("long"))
        work = materialize(cut, "ranges")
    else:
        width = max(1, key_range // max(1, -(-df.count() // rows_per_bucket)))
        work = df.withColumn("_bucket", F.coalesce(F.floor(F.col(key) / F.lit(width)).cast("long"), F.lit(-1)))
    counted = work.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"),
        F.sum("_n").over(Window.partitionBy(*group)).alias("of"),
    )
    order = Window.partitionBy(*group, "_bucket").orderBy(key, *ties)
    match = F.col("_bucket") == F.col("_b")
    for i, g in enumerate(group):
        match &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    out = work.withColumn("_within", F.row_number().over(order)).join(placed, match)
    return out.select(*df.columns, (F.col("_ahead") + F.col("_within")).alias("rank"), "of")


def partition_of(ordinal: Column, total: Column, parts: int | None) -> Column:
    """Part of a batch when ``total`` batches go to parts whose sizes differ by one at most, larger first."""
    n = F.lit(parts or 1)
    base, extra = F.floor(total / n), total % n
    cut = extra * (base + 1)
    later = extra + F.floor((ordinal - cut) / F.greatest(base, F.lit(1)))
    return F.when(ordinal < cut, F.floor(ordinal / (base + 1))).otherwise(later).cast("long")


def split_name(rank: Column, of: Column, train: float = 0.8, dev: float = 0.1) -> Column:
    """train, dev or test, whose sizes are cut down to whole numbers, test taking the rest."""
    first, second = F.floor(of * F.lit(train)), F.floor(of * F.lit(dev))
    return F.when(rank <= first, "train").when(rank <= first + second, "dev").otherwise("test")


def rank_in_split(rank: Column, of: Column, train: float = 0.8, dev: float = 0.1) -> Column:
    first, second = F.floor(of * F.lit(train)), F.floor(of * F.lit(dev))
    return rank - F.when(rank <= first, F.lit(0)).when(rank <= first + second, first).otherwise(first + second)


def shard_of(rank: Column, size: int) -> Column:
    """Shard of a rank from 1."""
    return F.floor((rank - 1) / F.lit(size)).cast("long")
