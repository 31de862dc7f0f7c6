"""The whole pipeline against a brute-force one in plain Python."""

import os
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from sylvaframe.llm.mixing import WEIGHTS
from sylvaframe.llm.packing import WINDOW, pieces_of, place
from sylvaframe.llm.rules import covers, learn_from_tables
from sylvaframe.llm.stats import STATISTICS

from .oddities import SCHEMA, clashing, empty, odd
from .test_cpsjoin import exact_groups
from .test_mixing import brute_mix
from .test_packing import ids_of
from .test_rules import plain_statistics

SF = "/root/testdata/sf0.001"


def brute(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    rules = learn_from_tables(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    steps = []
    docs = [d for d in docs if not any(covers(r, np.array([plain_statistics(d[1])]))[0] for r in rules)]
    steps.append(docs)
    least = {}
    for d in docs:
        least[d[1]] = min(least.get(d[1], d[0]), d[0])
    docs = [d for d in docs if least[d[1]] == d[0]]
    steps.append(docs)
    docs = sorted(docs)
    roots, _ = exact_groups([d[1] for d in docs])
    docs = [d for i, d in enumerate(docs) if roots[i] == i]
    steps.append(docs)
    copies = brute_mix(docs, WEIGHTS)
    docs = [d for d in docs for _ in range(copies[(d[0], d[3])])]
    steps.append(docs)
    items = sorted((d[0], len(ids_of(d[1]))) for d in docs)
    pieces = [(i, k, min(WINDOW, n - k * WINDOW)) for i, n in items for k in range(-(-n // WINDOW))]
    window, start = place(np.array([n for *_, n in pieces]), WINDOW)
    return steps, sorted((0, int(w), int(s), i, k, n) for (i, k, n), w, s in zip(pieces, window, start))


def test_run_and_every_stage_match_brute_force(spark):
    steps, packed = brute(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for (name, stage), want in zip(corpus_pipeline.STAGES, steps):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert Counter(r["doc_id"] for r in out.collect()) == Counter(d[0] for d in want), name
        docs = corpus_pipeline.materialize(out, "stage")
    assert sorted(map(tuple, pieces_of(corpus_pipeline.run(spark, SF)).collect())) == packed


@pytest.mark.parametrize("make", [odd, empty, lambda spark: clashing(spark)[0]])
def test_odd_and_empty_tables(spark, tmp_path, make):
    make(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["shard", "window", "n_tokens", "doc_ids", "pieces", "token_ids"]
    assert (out.count() == 0) == (make is empty)
    if make not in (odd, empty):
        make_odd = tmp_path / "odd"
        odd(spark).write.parquet(f"{make_odd}/documents.parquet")
        spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{make_odd}/labels.parquet")
        assert pieces_of(corpus_pipeline.run(spark, str(make_odd))).count() == pieces_of(out).count()


def test_stages_are_the_five_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "MinHash near-dedup", "mixing sources to target weights", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and SCHEMA and os.path.isdir(SF)
