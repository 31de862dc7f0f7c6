"""Contrastive layouts: triplets and anchor groups by equal and unequal labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LAYOUTS = ("triplet", "infonce", "supervised")


def triplets(items: DataFrame, key: str = "id", label: str = "label") -> DataFrame:
    """(anchor, positive, negative): each item, each other of its label, each of another label.

    The result is cubic by definition; positives come by an equi-join on the
    label, and each (anchor, positive) then meets the items of the other labels.
    """
    rows = items.select(F.col(key).alias("k"), F.col(label).alias("l")).where("l IS NOT NULL")
    a, p, n = (rows.toDF(f"k{x}", f"l{x}") for x in "apn")
    pairs = a.join(p, (F.col("la") == F.col("lp")) & (F.col("ka") != F.col("kp")))
    return pairs.join(n, F.col("la") != F.col("ln")).select(F.col("ka").alias("anchor"), F.col("kp").alias("positive"), F.col("kn").alias("negative"))


def pool_sizes(items: DataFrame, key: str = "id", label: str = "label") -> DataFrame:
    """(anchor, n_positive, n_negative) from label counts alone; the items themselves never meet."""
    rows = items.where(F.col(label).isNotNull())
    counted = rows.groupBy(F.col(label).alias("_l")).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.agg(F.count(F.lit(1)).alias("_all"))
    joined = rows.join(counted, F.col(label) == F.col("_l")).crossJoin(F.broadcast(total))  # one row
    return joined.select(F.col(key).alias("anchor"), (F.col("_n") - 1).alias("n_positive"), (F.col("_all") - F.col("_n")).alias("n_negative"))


def organize(items: DataFrame, layout: str, key: str = "id", label: str = "label") -> DataFrame:
    if layout == "triplet":
        return triplets(items, key, label)
    if layout == "infonce":
        return pool_sizes(items, key, label)
    if layout == "supervised":
        return items.select(F.col(key).alias("anchor"), F.col(label).alias("label"))
    raise ValueError(f"layout {layout!r} is none of {LAYOUTS}")
