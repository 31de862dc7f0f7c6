import numpy as np

from sylvaframe.llm.rules import Condition, apply_rules, covers, learn_from_tables, learn_list, quality_query, rule_expression
from sylvaframe.llm.stats import STATISTICS, labelled_sample, statistics
from pyspark.sql import functions as F

from .oddities import ROWS, clashing, empty, odd, rows_of

SF = "/root/testdata/sf0.01"


def table(n=3000, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.random((n, len(STATISTICS)))
    bad = ((x[:, 3] > 0.9) & (x[:, 7] <= 0.7)) | (x[:, 5] > 0.95)
    return x, bad


def test_planted_rules_are_found():
    x, bad = table()
    rules = learn_list(x, bad)
    fresh, truth = table(seed=1)
    said = np.any([covers(r, fresh) for r in rules], axis=0)
    assert (said & truth).sum() / said.sum() > 0.95 and (said & truth).sum() / truth.sum() > 0.85
    assert {c.statistic for r in rules for c in r} >= {STATISTICS[3], STATISTICS[5]}


def test_nothing_to_learn():
    x, bad = table(50)
    assert learn_list(x, np.zeros(50, bool)) == [] == learn_list(x, np.ones(50, bool)) == learn_list(x[:0], bad[:0])
    rng = np.random.default_rng(3)
    assert learn_list(x, rng.random(50) < 0.5) == []


def test_expression_gives_the_first_rule_that_holds(spark):
    x, _ = table(200)
    rules = [(Condition(STATISTICS[0], True, 0.8), Condition(STATISTICS[1], False, 0.5)), (Condition(STATISTICS[2], True, 0.6),)]
    df = spark.createDataFrame(x.tolist(), list(STATISTICS))
    got = [r[0] for r in df.select(rule_expression(rules)).collect()]
    want = [next((k for k, r in enumerate(rules, 1) if covers(r, row[None])[0]), 0) for row in x]
    assert got == want
    assert [r[0] for r in df.select(rule_expression([])).distinct().collect()] == [0]


def plain_statistics(text):
    import re

    t = text or ""
    lower = [w for w in re.split(r"[ \t\n\x0b\f\r]+", t.lower()) if w]
    lines = t.split("\n")
    n, chars = len(lower), len(t)
    per = lambda a, b: a / b if b else 0.0
    stops = set("the|of|and|to|in|that|is|de|la|le|les|et|der|die|und|den|das|el|que|los|en|un".split("|"))
    return [
        chars, n, per(chars, n), per(len(re.findall(r"[#$%&*^~<>{}\[\]]+", t)), n), per(len(re.findall("!+", t)), n), per(sum(c.isupper() for c in t), chars),
        per(len(re.findall("[0-9]+", t)), n), per(t.count("|"), n), per(sum(w in stops for w in lower), n), per(len(set(lower)), n), per(n, len(lines)),
        per(len(lines) - len(set(lines)), len(lines)), float(t.rstrip(" ")[-1:] in (".", "!", "?") and t.rstrip(" ") != ""),
    ]


def test_statistics_are_those_of_plain_python(spark):
    docs = odd(spark).select("doc_id", "text").unionByName(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))
    rows = statistics(docs, F.col("text"), F.col("text")).collect()
    for r in rows:
        np.testing.assert_allclose(list(r)[1:], plain_statistics(r["text"]), rtol=1e-12)


def test_decisions_on_held_out_labels_spare_good_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rules = learn_from_tables(docs, labels.where("doc_id % 2 = 0"))
    held = labelled_sample(docs, labels.where("doc_id % 2 = 1"), "quality", 10**6)
    x, bad = held[list(STATISTICS)].to_numpy(), held["y"].to_numpy() == 0
    said = np.any([covers(r, x) for r in rules], axis=0)
    assert (said & ~bad).sum() / (~bad).sum() < 0.01
    assert (said & bad).sum() / bad.sum() > 0.9


def test_query_is_the_numpy_decision(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rules = learn_from_tables(docs, labels)
    frame = statistics(docs, F.col("text"), F.col("doc_id")).toPandas()
    hit = np.any([covers(r, frame[list(STATISTICS)].to_numpy()) for r in rules], axis=0)
    assert {r["doc_id"] for r in quality_query(spark, SF).collect()} == set(frame["doc_id"][~hit])
    plan = quality_query(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("rule_number") > 0 and "Python" not in plan


def test_oddities(spark):
    rules = [(Condition("n_words", False, 0.0),)]
    kept = rows_of(apply_rules(odd(spark), rules))
    assert len(kept) == len(ROWS) - 5 and len(rows_of(apply_rules(odd(spark), []))) == len(ROWS)
    df, _ = clashing(spark)
    out = apply_rules(df, rules)
    assert out.columns == df.columns and out.count() == len(kept)
    assert apply_rules(empty(spark), rules).count() == 0
    labels = spark.createDataFrame([(1, 0, 0), (2, None, 0), (None, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    sample = labelled_sample(odd(spark), labels, "quality", 100)
    assert sample["doc_id"].tolist() == [1] and sample["y"].tolist() == [0]
    assert learn_from_tables(odd(spark), labels) == [] == learn_from_tables(empty(spark), labels.limit(0))
