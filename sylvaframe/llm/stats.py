"""Document statistics as built-in Spark expressions.

One pass in the JVM; no Python worker sees a text. All statistics are doubles.
A null text counts as an empty one, for which every statistic is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STOPWORDS = "the|of|and|to|in|that|is|de|la|le|les|et|der|die|und|den|das|el|que|los|en|un"

STATISTICS = (
    "n_chars",
    "n_words",
    "mean_word",
    "symbol_share",
    "bang_share",
    "upper_share",
    "digit_share",
    "bar_share",
    "stop_share",
    "distinct_share",
    "line_words",
    "dup_line_share",
    "ends_well",
)


def statistics(df: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """``keep`` columns, then one double column for each of STATISTICS.

    Shares are per character for character classes and per word for words.
    Three projections: word and line arrays, their counts, the ratios; an array
    that several counts read is thus built once.
    """
    body = F.coalesce(text, F.lit(""))
    kept = [f"k{i}" for i in range(len(keep))]
    names = df.select(*keep).columns
    parts = df.select(
        *[c.alias(k) for c, k in zip(keep, kept)],
        body.alias("body"),
        F.split(F.lower(body), r"\s+").alias("words"),
        F.split(body, "\n").alias("lines"),
    )
    counted = [
        F.length("body").alias("chars"),
        (F.size("words") - F.size(F.filter("words", lambda w: w == ""))).alias("words"),
        (F.size(F.array_distinct("words")) - F.array_contains("words", "").cast("int")).alias("distinct_words"),
        F.regexp_count("body", F.lit(r"[#$%&*^~<>{}\[\]]+")).alias("symbols"),
        F.regexp_count("body", F.lit("!+")).alias("bangs"),
        F.regexp_count("body", F.lit(r"\p{Lu}")).alias("uppers"),
        F.regexp_count("body", F.lit("[0-9]+")).alias("digits"),
        F.regexp_count("body", F.lit(r"\|")).alias("bars"),
        F.size(F.filter("words", lambda w: w.isin(STOPWORDS.split("|")))).alias("stops"),
        F.size("lines").alias("lines"),
        F.size(F.array_distinct("lines")).alias("distinct_lines"),
        F.right(F.rtrim("body"), F.lit(1)).isin(".", "!", "?").cast("double").alias("ends"),
    ]
    raw = parts.select(*kept, *counted)

    def share(top: Column, under: str) -> Column:
        return F.when(F.col(under) > 0, top / F.col(under)).otherwise(F.lit(0.0)).cast("double")

    out = raw.select(
        *kept,
        F.col("chars").cast("double").alias("n_chars"),
        F.col("words").cast("double").alias("n_words"),
        share(F.col("chars"), "words").alias("mean_word"),
        share(F.col("symbols"), "words").alias("symbol_share"),
        share(F.col("bangs"), "words").alias("bang_share"),
        share(F.col("uppers"), "chars").alias("upper_share"),
        share(F.col("digits"), "words").alias("digit_share"),
        share(F.col("bars"), "words").alias("bar_share"),
        share(F.col("stops"), "words").alias("stop_share"),
        share(F.col("distinct_words"), "words").alias("distinct_share"),
        share(F.col("words"), "lines").alias("line_words"),
        share(F.col("lines") - F.col("distinct_lines"), "lines").alias("dup_line_share"),
        F.col("ends").alias("ends_well"),
    )
    return out.toDF(*names, *STATISTICS)


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, max_labelled: int, seed: int = 7):
    """Up to ``max_labelled`` rows (statistics, 0/1 target) as a pandas frame.

    The labels with the least hash of (seed, doc_id) are taken, so the same
    documents are drawn at any partitioning. Labels with a null id or target are
    left out; of several labels for one document the least counts. A document
    without a label takes no part; of several with one id, the text with the
    least hash does, so that rows are bounded too.
    """
    from ..runtime import pick

    chosen = (
        pick(labels, "doc_id", target)
        .where(F.col("doc_id").isNotNull() & F.col(target).isNotNull())
        .groupBy("doc_id")
        .agg(F.min(target).alias("y"))
        .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id")
        .limit(max_labelled)
    )
    # at most max_labelled rows of 16 bytes, whatever the size of the corpus
    joined = pick(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")
    joined = joined.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    frame = statistics(joined, F.col("text"), F.col("doc_id"), F.col("y")).toPandas()
    return frame.sort_values(["doc_id", *STATISTICS], kind="stable").reset_index(drop=True)
