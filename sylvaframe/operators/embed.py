"""Word embeddings: a bucketed cache table, lookups and the filling of gaps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import materialize

CACHE_BUCKETS = 32
DIM = 768


def hash_encoder(dim: int = DIM) -> Callable[[list[str]], list[np.ndarray]]:
    """Stands in for the language model: unit vectors from hashes of character trigrams."""

    def run(words: list[str]) -> list[np.ndarray]:
        out = []
        for w in words:
            padded = f"^{w}$"
            v = np.zeros(dim, np.float32)
            for i in range(max(1, len(padded) - 2)):
                h = xxhash.xxh64_intdigest(padded[i : i + 3])
                v[h % dim] += 1.0 if h >> 63 else -1.0
            norm = float(np.sqrt((v * v).sum()))
            out.append(v / norm if norm else v)
        return out

    return run


def lookup(words: DataFrame, cache: DataFrame, word: str = "word") -> DataFrame:
    """``words`` with ``embedding``, null for a miss."""
    table = cache.select(F.col("word").alias("_word"), "embedding")
    return words.join(table, F.col(word) == F.col("_word"), "left").drop("_word")


def misses(words: DataFrame, cache: DataFrame, word: str = "word") -> DataFrame:
    """Distinct non-null words the cache lacks."""
    wanted = words.select(F.col(word).alias("word")).where(F.col("word").isNotNull()).distinct()
    return wanted.join(cache.select("word"), "word", "left_anti")


def encode(words: DataFrame, encoder: Callable[[list[str]], list[np.ndarray]]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame({"word": rows["word"], "embedding": encoder(list(rows["word"]))})

    return words.select("word").mapInPandas(run, "word string, embedding array<float>")


class EmbeddingCache:
    """A Parquet table (word, embedding) bucketed by word, so lookups shuffle the words' side only."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = CACHE_BUCKETS):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (word STRING, embedding ARRAY<FLOAT>) USING parquet "
            f"CLUSTERED BY (word) SORTED BY (word) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, rows: DataFrame) -> None:
        out = rows.select("word", "embedding").repartition(self.buckets, "word").write.format("parquet").mode("append")
        out.option("path", self.path).bucketBy(self.buckets, "word").sortBy("word").saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)

    def update(self, rows: DataFrame) -> None:
        """Rows whose word is there replace it, the others are added. The table is written anew."""
        new = materialize(rows.select("word", "embedding").dropDuplicates(["word"]), "changed")
        kept = materialize(self.read().join(new.select("word"), "word", "left_anti"), "kept")
        out = kept.unionByName(new).repartition(self.buckets, "word").write.format("parquet").mode("overwrite")
        out.option("path", self.path).bucketBy(self.buckets, "word").sortBy("word").saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)

    def fill(self, words: DataFrame, encoder: Callable[[list[str]], list[np.ndarray]]) -> None:
        """Encodes each missing word once and appends it."""
        self.add(encode(misses(words, self.read()), encoder))


def prepend_embeddings(groups: DataFrame, cache: DataFrame, trees: str = "trees", key: str = "group_id", use_lemma: bool = False) -> DataFrame:
    """Node features of each graph with their word's embedding in front; zeros for a word not in the cache.

    Only (group, tree, node, word) and the vectors are shuffled, not the graphs' other parts.
    """
    dim = cache.select(F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()[0]
    part = "lemma" if use_lemma else "word"
    nodes = groups.select(key, F.posexplode(f"{trees}.node_texts").alias("tree", "ts")).select(key, "tree", F.posexplode("ts").alias("node", "t")).select(key, "tree", "node", F.col(f"t.{part}").alias("word"))
    vectors = lookup(nodes, cache).withColumn("embedding", F.coalesce("embedding", F.array_repeat(F.lit(0.0).cast("float"), dim)))
    gathered = vectors.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(F.struct("tree", "node"), "embedding"))).alias("_vectors"))

    def one(g, t):
        features = F.transform(g["node_features"], lambda f, n: F.concat(F.element_at(F.col("_vectors"), F.struct(t.alias("tree"), n.alias("node"))), f))
        return g.withField("node_features", features).withField("node_features_need_word_embs_prepended", F.lit(False))

    return groups.join(gathered, key, "left").withColumn(trees, F.transform(trees, one)).drop("_vectors")
