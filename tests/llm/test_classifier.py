import numpy as np
import pytest

from sylvaframe.llm.classifier import classifier_query, score_documents, train
from sylvaframe.llm.gbt import BoostedTrees
from sylvaframe.llm.stats import STATISTICS, labelled_sample, statistics
from pyspark.sql import functions as F

from .oddities import ROWS, clashing, empty, odd


def walked(model, row):
    """One row down each tree, node by node."""
    total = model.base
    for t in range(model.n_trees):
        at = 0
        while model.feature[t, at] >= 0:
            at = 2 * at + (1 if row[model.feature[t, at]] <= model.cut[t, at] else 2)
        total += model.value[t, at]
    return total


def data(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 6))
    x[rng.random((n, 6)) < 0.05] = np.nan
    return x, ((np.nan_to_num(x[:, 0]) * np.nan_to_num(x[:, 1]) > 0) ^ (rng.random(n) < 0.02)).astype(float)


def test_flat_traversal_is_that_of_single_walks():
    x, y = data(1000, 0)
    model = BoostedTrees(n_trees=20).fit(x, y)
    fresh, _ = data(200, 1)
    np.testing.assert_allclose(model.margin(fresh, chunk=33), [walked(model, r) for r in fresh], rtol=1e-12)


def test_learns_an_interaction():
    x, y = data(4000, 2)
    fresh, truth = data(2000, 3)
    assert ((BoostedTrees().fit(x, y).predict(fresh) > 0.5) == truth).mean() > 0.9


@pytest.mark.parametrize("y", [np.zeros(0), np.zeros(5), np.ones(5)])
def test_one_class_or_none(y):
    p = BoostedTrees().fit(np.zeros((len(y), 3)), y).predict(np.zeros((4, 3)))
    assert np.ptp(p) == 0 and 0 < p[0] < 1


def test_held_out_accuracy_on_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = train(docs, labels.where("doc_id % 2 = 0"))
    held = labelled_sample(docs, labels.where("doc_id % 2 = 1"), "quality", 10**6)
    good = held["y"].to_numpy() > 0
    said = model.predict(held[list(STATISTICS)].to_numpy()) >= 0.5
    assert (said == good).mean() > 0.97 and (said & good).sum() / good.sum() > 0.98


def test_query_scores_every_document(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = train(docs, labels)
    frame = statistics(docs, F.col("text"), F.col("doc_id")).toPandas()
    p = np.array([1 / (1 + np.exp(-walked(model, r))) for r in frame[list(STATISTICS)].to_numpy()])
    got = {r["doc_id"]: r["score"] for r in classifier_query(spark, sf).collect()}
    assert got == pytest.approx({i: s for i, s in zip(frame["doc_id"], p) if s >= 0.5})


def test_oddities(spark):
    model = BoostedTrees().fit(np.zeros((0, len(STATISTICS))), np.zeros(0))
    for df, n in ((odd(spark), len(ROWS)), (clashing(spark)[0], len(ROWS)), (empty(spark), 0)):
        out = score_documents(df, model).toPandas()
        assert list(out.columns) == ["doc_id", "score"] and len(out) == n and out["score"].nunique() == min(n, 1)


def test_the_trees_are_walked_once(spark):
    from sylvaframe.llm.classifier import KEEP_FROM, score_documents, train

    from .oddities import odd

    labels = spark.createDataFrame([(1, 1), (6, 0), (8, 0)], "doc_id long, quality int")
    scored = score_documents(odd(spark), train(odd(spark), labels)).where(f"score >= {KEEP_FROM}")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 and plan.count("regexp_count(body, #") + plan.count("[#$%&*^~<>{}") <= 2


def test_an_id_that_is_repeated_gives_one_labelled_row(spark):
    from sylvaframe.llm.stats import labelled_sample

    rows = [(1, f"text {i}") for i in range(500)] + [(2, "other")] * 300 + [(3, None)] * 5
    frame = labelled_sample(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, 1), (2, 0), (3, 1), (9, 1)], "doc_id long, quality int"), "quality", 10)
    assert frame["doc_id"].tolist() == [1, 2, 3]
