import numpy as np
import pytest

from sylvaframe.llm import lm
from sylvaframe.llm.lm import CLASSES, END, GRU, HIDDEN, VOCAB, WordIds, score, start_parameters, train, vocabulary

from .oddities import ROWS, clashing, empty, odd, rows_of

PER = VOCAB // CLASSES


def plain_log_likelihood(p, doc):
    """One word after the other, all in float64."""
    p = {k: v.astype(np.float64) for k, v in p.items()}
    h, last, total = np.zeros(HIDDEN), END, 0.0
    for word in doc:
        x, g = p["ex"][last], h @ p["wh"]
        z, r = (1 / (1 + np.exp(-(x[a : a + HIDDEN] + g[a : a + HIDDEN]))) for a in (0, HIDDEN))
        n = np.tanh(x[2 * HIDDEN :] + r * g[2 * HIDDEN :])
        h = (1 - z) * n + z * h
        c = h @ p["wc"] + p["bc"]
        k = word // PER
        inner = p["ww"][k * PER : (k + 1) * PER] @ h + p["bw"][k * PER : (k + 1) * PER]
        total += c[k] - np.log(np.exp(c).sum()) + inner[word % PER] - np.log(np.exp(inner).sum())
        last = word
    return total


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    p = start_parameters(rng.integers(1, 50, VOCAB).astype(float))
    for k in ("wc", "ww"):
        p[k] = p[k] * 5
    return p


def test_scores_are_those_of_a_word_by_word_walk(model):
    rng = np.random.default_rng(2)
    docs = [np.append(rng.integers(0, VOCAB - 1, n), END).astype(np.int16) for n in (0, 1, 5, 31, 32, 33, 200, 700)]
    for lanes in (1, 3, 16):
        got = GRU(model).run(docs, lanes, learn=False)
        np.testing.assert_allclose(got, [plain_log_likelihood(model, d) for d in docs], rtol=2e-4)


def test_probabilities_sum_to_one(model):
    states = np.tile(np.random.default_rng(3).uniform(-1, 1, HIDDEN).astype(np.float32), (VOCAB, 1))
    logp, _, _ = GRU(model).log_probs(states, np.arange(VOCAB, dtype=np.int16), learn=False)
    assert np.exp(logp.astype(np.float64)).sum() == pytest.approx(1, abs=1e-3)


def test_gradients_are_the_loss_differences(model):
    rng = np.random.default_rng(4)
    inputs, targets = rng.integers(0, 40, (6, 5)).astype(np.int16), rng.integers(0, VOCAB, (6, 5)).astype(np.int16)
    first = rng.random((6, 5)) < 0.2
    h0 = rng.uniform(-0.5, 0.5, (5, HIDDEN)).astype(np.float32)

    def loss(g):
        states, saved, _ = g.forward(inputs, first, h0, True)
        logp, grads, back = g.log_probs(states.reshape(-1, HIDDEN), targets.ravel(), True)
        return -float(logp.astype(np.float64).mean()), grads, back.reshape(states.shape), saved

    g = GRU(model)
    _, grads, back, saved = loss(g)
    grads |= g.backward(inputs, first, back, saved)
    assert set(grads) == set(lm.NAMES)
    for name, grad in grads.items():
        flat, values = grad.ravel(), g.p[name].ravel()
        for i in np.argsort(-np.abs(flat))[:6]:
            was, eps = values[i], 5e-3
            values[i] = was + eps
            up = loss(g)[0]
            values[i] = was - eps
            down = loss(g)[0]
            values[i] = was
            assert (up - down) / (2 * eps) == pytest.approx(flat[i], rel=0.05, abs=2e-5), name


def test_unknown_words_get_buckets_by_ending():
    ids = WordIds(["cat"])
    assert ids.encode("cat unknowning xxxing cat").tolist()[1] == ids.encode("xxxing").tolist()[0]
    assert ids.encode("cat").tolist() == [0, END] and ids.encode(None).tolist() == [END] == ids.encode("").tolist()
    before = len(ids)
    ids.encode(" ".join(f"w{i}" for i in range(1000)))
    assert len(ids) == before


def test_training_beats_word_frequencies(spark):
    texts = [(i, " ".join(["red", "green", "blue", "black"][(i + k) % 4] for k in range(400)), None, None, 0) for i in range(64)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    words, counts = vocabulary(docs)
    assert set(words) == {"red", "green", "blue", "black"} and counts[END] == 64
    start = start_parameters(counts)
    held_out = spark.createDataFrame([(0, "red green blue black " * 50)], "doc_id long, text string")
    before, after = (score(held_out, words, p).first()["per_word"] for p in (start, train(docs.repartition(2), words, counts)))
    assert after > before + 0.3


def test_oddities(spark):
    docs = odd(spark)
    words, counts = vocabulary(docs)
    model = train(docs, words, counts)
    out = score(docs, words, model).toPandas()
    assert len(out) == len(ROWS) and np.isfinite(out["log_likelihood"]).all()
    assert (out["n_words"] == 1).sum() == 5
    assert out[out["doc_id"] == 2]["log_likelihood"].nunique() == 1
    assert out[out["doc_id"] == 6]["n_words"].item() == 200_001
    assert len(score(clashing(spark)[0], words, model).columns) == 4
    assert score(empty(spark), words, model).count() == 0
    words, counts = vocabulary(empty(spark))
    assert words == [] and rows_of(score(empty(spark), words, train(empty(spark), words, counts))) == []


def test_gates_may_be_pushed_to_their_ends(model):
    """Inputs so far out that a gate's exp is infinite leave states finite, without a warning."""
    far = {k: v.copy() for k, v in model.items()}
    far["ex"] *= np.float32(1000)
    inputs = np.random.default_rng(1).integers(0, VOCAB, (8, 5)).astype(np.int16)
    with np.errstate(all="raise", under="ignore"):
        states, saved, _ = GRU(far).forward(inputs, np.zeros((8, 5), bool), np.zeros((5, HIDDEN), np.float32), True)
    assert np.isfinite(saved).all() and (np.abs(states) <= 1).all()


def test_a_frequent_words_gradient_is_the_sum_of_its_places(model):
    """As summed in float64 over places that have a word each; float32 sums of so many drift from it."""
    rng = np.random.default_rng(5)
    g = GRU(model)
    each, same = np.arange(VOCAB, dtype=np.int16).reshape(32, 32), np.full((32, 32), 7, np.int16)
    first = rng.random(each.shape) < 0.1
    _, saved, _ = g.forward(each, first, np.zeros((32, HIDDEN), np.float32), True)
    back = rng.random((32, 32, HIDDEN)).astype(np.float32)
    places, summed = (g.backward(inputs, first, back, saved)["ex"] for inputs in (each, same))
    np.testing.assert_array_equal(summed[7], places.astype(np.float64).sum(0).astype(np.float32))
    assert not np.delete(summed, 7, 0).any()
