import numpy as np
import pytest
from pyspark.sql import functions as F

from sylvaframe.llm import lm
from sylvaframe.llm.lm import GRU, HIDDEN, UNKNOWN, VOCAB, count_words, in_parts, lm_query, rare_words, score, start_parameters, train, vocabulary

from .oddities import ROWS, empty, odd, rows_of


def corpus(spark, parts=3):
    """Frequent words that fill the vocabulary, and rarer ones of one ending: aaing once, bbing three times."""
    common = " ".join(f"c{i:03d}" for i in range(VOCAB - 1 - UNKNOWN))
    texts = [common] * 8 + ["aaing", "bbing", "bbing", "c001 bbing aab ab", None, ""]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)


def test_rare_words_have_their_own_probability(spark, tmp_path):
    corpus(spark).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in lm_query(spark, str(tmp_path)).collect()}
    assert got[9]["log_likelihood"] - got[8]["log_likelihood"] == pytest.approx(np.log(3), abs=1e-5)
    assert got[9]["log_likelihood"] == got[10]["log_likelihood"] and len(got) == 14


def test_shares_are_those_of_a_count_in_python(spark):
    docs = corpus(spark)
    parts = in_parts(docs)
    counted = lm.materialize(count_words(parts), "words")
    words, counts = vocabulary(docs, counted)
    seen = [w for r in docs.collect() for w in (r["text"] or "").split()]
    ids = lm.WordIds(words)
    for b in range(ids.end - UNKNOWN, ids.end):
        assert counts[b] == sum(w not in words and ids[w] == b for w in seen)
    model = train(docs, words, counts)
    plain = {r["doc_id"]: r["log_likelihood"] for r in score(docs, words, model).collect()}
    for r in score(parts, words, model, rare_words(counted), counts).collect():
        text = next(x["text"] for x in docs.collect() if x["doc_id"] == r["doc_id"]) or ""
        share = sum(np.log(seen.count(w) / counts[ids[w]]) for w in text.split() if w not in words)
        assert r["log_likelihood"] == pytest.approx(plain[r["doc_id"]] + share, abs=1e-4)


def test_vocabulary_grows_with_the_corpus(spark):
    text = " ".join(f"w{i}" for i in range(1000))
    small, large = (spark.range(n).select(F.col("id").alias("doc_id"), F.lit(text).alias("text")) for n in (10, 17_000))
    assert len(vocabulary(small)[0]) == VOCAB - 1 - UNKNOWN < len(vocabulary(large)[0])


@pytest.mark.parametrize("classes", (40, 190, 260))
def test_large_vocabularies_sum_to_one_and_learn(classes):
    n = classes**2
    model = GRU(start_parameters(np.random.default_rng(1).integers(1, 50, n).astype(float)))
    ids = np.arange(n).astype(lm.id_kind(n - 1))
    states = np.tile(np.random.default_rng(3).uniform(-1, 1, HIDDEN).astype(np.float32), (n, 1))
    logp, _, _ = model.log_probs(states, ids, learn=False)
    assert np.exp(logp.astype(np.float64)).sum() == pytest.approx(1, abs=1e-3)
    docs = [np.append(np.tile(ids[-9:-2], 30), ids[-1])] * 4
    before = model.run(docs, 4, learn=False).sum()
    model.run(docs, 4, learn=True)
    assert model.run(docs, 4, learn=False).sum() > before


def test_oddities_with_shares(spark):
    for docs, n in ((odd(spark), len(ROWS)), (empty(spark), 0)):
        parts = in_parts(docs)
        counted = lm.materialize(count_words(parts), "words")
        words, counts = vocabulary(docs, counted)
        out = rows_of(score(parts, words, train(docs, words, counts), rare_words(counted), counts))
        assert len(out) == n and all(np.isfinite(r[2]) for r in out)
