"""Connected components by alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond": each step
rewires edges towards the least neighbour, until the graph is a set of stars.
Every step is a combinable min and an equi-join; the edges of each round are
written to the shared folder, which cuts the lineage.

Defined results: an empty table has no components; self-loops, repeated edges
and edges with a null end make none. There are no texts and no extra columns:
what isn't called a or b is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(a, b) pairs of longs to (node, root): root is the least of its component.

    Roots themselves are included. Self-loops and repeated edges do no harm.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            break
        seen = state
        now = materialize(_small_star(_large_star(now).where("a <> b").distinct()).where("a <> b").distinct(), "edges")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
