"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are built in the JVM; the trees, flattened into arrays, are walked
by numpy in an Arrow-batched UDF that receives doubles only, never texts.

Defined results: a null text counts as empty; a very long one is judged by its
statistics as any other. With no labels or one class the score is the constant
prior. Ties and repeated rows get equal scores. An empty table gives no rows.
Columns other than doc_id and text are left out, whatever they are called.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import pick
from .gbt import BoostedTrees
from .stats import STATISTICS, labelled_sample, statistics

#: At most so many labelled documents are used for fitting.
MAX_LABELLED = 20_000
#: A document is kept from this probability of good quality on.
KEEP_FROM = 0.5


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> BoostedTrees:
    frame = labelled_sample(docs, labels, "quality", max_labelled)
    return BoostedTrees().fit(frame[list(STATISTICS)].to_numpy(), frame["y"].to_numpy() > 0)


def score_column(model: BoostedTrees) -> Column:
    """The score as a column that isn't deterministic to the optimizer, which would else walk the trees, and build the statistics, once more for a filter on it."""

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(model.predict(np.column_stack([c.to_numpy() for c in columns])))

    return score.asNondeterministic()(*[F.col(s) for s in STATISTICS])


def score_documents(docs: DataFrame, model: BoostedTrees) -> DataFrame:
    """(doc_id, score) of every document; other columns are left out."""
    narrow = pick(docs, "doc_id", "text")
    judged = statistics(narrow, F.col("text"), F.col("doc_id"))
    return judged.withColumn("score", score_column(model)).select("doc_id", "score")


def classifier_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, score) of every document whose score reaches KEEP_FROM."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model).where(F.col("score") >= KEEP_FROM)
