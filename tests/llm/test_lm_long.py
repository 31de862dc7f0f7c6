"""Very long texts beside short ones, and averages over many partitions."""

import random
import tracemalloc

import numpy as np
import pytest

from sylvaframe.llm import lm
from sylvaframe.llm.lm import GRU, WordIds, lay_out, score, start_parameters, train, words_of


def test_slices_give_the_words_of_the_whole(monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(lm, "SLICE", 7)
    for _ in range(300):
        text = "".join(rng.choice(["a", "bc", " ", "\n", " ", "\x1c", "d"]) for _ in range(rng.randint(0, 60)))
        assert sum(words_of(text), []) == text.split()
    assert list(words_of(None)) == list(words_of("")) == []


def test_a_long_text_takes_room_for_itself_only():
    long, short = np.zeros(1_000_000, np.int16), [np.zeros(50, np.int16)] * 100
    tracemalloc.start()
    laid = lay_out([long, *short], 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert laid.tokens.shape[1] == 1 and peak < 40e6


def test_a_long_text_is_scored_as_in_one_walk(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    long = " ".join(rng.choices(words, k=20_000))
    rows = [(1, long), *[(i, " ".join(rng.choices(words, k=5))) for i in range(2, 40)]]
    ids = WordIds(words)
    parameters = start_parameters(np.ones(ids.end + 1))
    got = {r["doc_id"]: r["log_likelihood"] for r in score(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), words, parameters).collect()}
    model = GRU(parameters)
    for i, text in (rows[0], rows[7]):
        assert got[i] == pytest.approx(model.run([ids.encode(text)], 1, learn=False)[0], rel=1e-4)


def test_averages_in_levels_are_those_of_one(spark, monkeypatch):
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, " ".join(rng.choices("abcdef", k=20))) for i in range(60)], "doc_id long, text string").repartition(9)
    words, counts = list("abcdef"), np.ones(lm.WordIds(list("abcdef")).end + 1)
    whole = train(docs, words, counts)
    monkeypatch.setattr(lm, "FAN_IN", 2)
    levels = train(docs, words, counts)
    assert all(np.allclose(whole[k], levels[k], atol=1e-6) for k in whole) and not np.allclose(whole["ex"], start_parameters(counts)["ex"])
