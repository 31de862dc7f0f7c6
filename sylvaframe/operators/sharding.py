"""Splits, shards, partitions and their counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import HASH_RANGE, ROWS_PER_BUCKET, order_hash, partition_of, rank_in_split, ranked, shard_of, split_name


#: name -> function of (groups, key, group columns, shard_size, **options) that adds split, ordinal and shard_index.
STRATEGIES: dict[str, Callable[..., DataFrame]] = {}


def strategy(name: str):
    def register(f):
        STRATEGIES[name] = f
        return f

    return register


@strategy("random")
def split_and_shard(
    groups: DataFrame, key: str, group: list[str] | None = None, shard_size: int = 500, train: float = 0.8, dev: float = 0.1, seed: int = 42, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Adds split, ordinal (from 0 within the split) and shard_index, per source file (``group``).

    Rows are shuffled by a hash of ``key``, a number or a string; split sizes are
    exact, and rows without a key take part.
    """
    group = group or []
    hashed = groups.withColumn("_hash", order_hash(groups, key, seed))
    out = ranked(hashed, group, "_hash", [key], HASH_RANGE, rows_per_bucket)
    place = rank_in_split(F.col("rank"), F.col("of"), train, dev)
    return out.select(
        *groups.columns,
        split_name(F.col("rank"), F.col("of"), train, dev).alias("split"),
        (place - 1).cast("long").alias("ordinal"),
        shard_of(place, shard_size).alias("shard_index"),
    )


def shard_in_order(groups: DataFrame, ordinal: str, group: list[str] | None = None, shard_size: int = 500, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Adds shard_index, total_shards, start_idx and end_idx (beyond the last) by the given order."""
    out = ranked(groups, group or [], ordinal, [ordinal], None, rows_per_bucket)
    size = F.lit(shard_size)
    shard = shard_of(F.col("rank"), shard_size)
    return out.select(
        *groups.columns,
        shard.alias("shard_index"),
        F.ceil(F.col("of") / size).cast("long").alias("total_shards"),
        (shard * size).cast("long").alias("start_idx"),
        F.least((shard + 1) * size, F.col("of")).cast("long").alias("end_idx"),
    )


@strategy("single")
def one_split(groups: DataFrame, key: str, group: list[str] | None = None, shard_size: int = 500, split: str = "train", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """All rows in one split, in the order of ``key``."""
    out = ranked(groups, group or [], key, [], None, rows_per_bucket)
    return out.select(*groups.columns, F.lit(split).alias("split"), (F.col("rank") - 1).cast("long").alias("ordinal"), shard_of(F.col("rank"), shard_size).alias("shard_index"))


def shard_counts(sharded: DataFrame, *keys: str) -> DataFrame:
    """(keys, n_groups, trees_per_group, trees_b_per_group) in the order of ``ordinal``."""
    sizes = F.array_sort(F.collect_list(F.struct("ordinal", F.size("trees").alias("a"), F.size("trees_b").alias("b"))))
    found = sharded.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_groups"), sizes.alias("s"))
    return found.select(
        *keys, "n_groups", F.transform("s", lambda x: x["a"]).alias("trees_per_group"), F.transform("s", lambda x: x["b"]).alias("trees_b_per_group")
    )


def embedded_part(file_number: Column, part: Column) -> Column:
    """``{file}0{part}``, which isn't unique; keep both numbers beside it."""
    return F.concat(file_number.cast("string"), F.lit("0"), part.cast("string"))


def shard_file_name(stem: Column, shard: Column, counts: bool = False, part: Column | None = None) -> Column:
    name = F.concat(F.lit("part_"), part.cast("string")) if part is not None else stem
    return F.concat(name, F.lit("_shard_"), F.lpad(shard.cast("string"), 6, "0"), F.lit("_counts.json" if counts else ".json" if part is None else ".txt"))


def output_folder(split: Column, mode: str, category: Column | None = None, file_number: Column | None = None) -> Column:
    """split[/category][/part-NNNNN] of a shard; text shards lie flat."""
    parts = [split]
    if category is not None:
        parts.append(category)
    if file_number is not None and mode == "json":
        parts.append(F.concat(F.lit("part-"), F.lpad(file_number.cast("string"), 5, "0")))
    return F.concat_ws("/", *parts)


def batches(df: DataFrame, ordinal: str, total_rows: int, batch_size: int, parts: int | None) -> DataFrame:
    """Adds batch_idx and part of the rows numbered by ``ordinal``: arithmetic only, no shuffle."""
    n = -(-total_rows // batch_size)
    batch = F.floor(F.col(ordinal) / F.lit(batch_size)).cast("long")
    return df.withColumn("batch_idx", batch).withColumn("part", partition_of(F.col("batch_idx"), F.lit(n), parts))
