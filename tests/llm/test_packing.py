import random

import numpy as np
import pytest

from sylvaframe.llm.packing import pack, pieces_of, place
from sylvaframe.llm.token_orc import TOKENIZER, load_encoding

from .oddities import ROWS, clashing, empty, odd, rows_of


def brute_place(lengths, capacity):
    """Every open window is tried, the squares are summed afresh for each."""
    windows, out = [], []
    for size in lengths:
        if size >= capacity:
            windows.append(capacity)
            out.append((len(windows) - 1, 0))
            continue
        choices = []
        for w, level in [*((w, lv) for w, lv in enumerate(windows) if lv < capacity and lv + size <= capacity), (None, 0)]:
            after = [lv for i, lv in enumerate(windows) if i != w] + [level + size]
            counts = {}
            for lv in after:
                if lv < capacity:
                    counts[lv] = counts.get(lv, 0) + 1
            choices.append((sum(c * c for c in counts.values()), -level, w))
        cost, neg, _ = min(choices, key=lambda c: c[:2])
        out.append(-neg if neg else 0)
        w = next(w for c, lv, w in reversed(choices) if (c, lv) == (cost, neg))
        if w is None:
            windows.append(size)
            out[-1] = (len(windows) - 1, 0)
        else:
            out[-1] = (w, windows[w])
            windows[w] += size
    return windows, out


@pytest.mark.parametrize("seed", range(6))
def test_placing_is_that_of_summing_all_squares(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 20, 64])
    lengths = [rng.randint(1, capacity + 3 if seed % 2 else capacity // 2) for _ in range(150)]
    lengths = [min(x, capacity) for x in lengths]
    window, start = place(np.array(lengths), capacity)
    _, want = brute_place(lengths, capacity)
    # windows of one level are interchangeable, so the levels chosen are what is compared
    assert start.tolist() == [s for _, s in want]
    fill = {}
    for w, s, n in zip(window.tolist(), start.tolist(), lengths):
        assert fill.get(w, 0) == s
        fill[w] = s + n
    assert max(fill.values()) <= capacity


ENCODING = load_encoding(open(TOKENIZER, "rb").read())
END = ENCODING.max_token_value + 1


def ids_of(text):
    return ENCODING.encode_ordinary(text or "") + [END]


def test_every_token_has_one_place(spark):
    windows = pack(odd(spark), window=16)
    out = pieces_of(windows).toPandas()
    assert out["n_tokens"].sum() == sum(len(ids_of(t)) for _, t, *_ in ROWS)
    seen = set()
    for r in out.itertuples():
        spots = {(r.shard, r.window, k) for k in range(r.start, r.start + r.n_tokens)}
        assert not spots & seen and r.start + r.n_tokens <= 16
        seen |= spots
    assert out["doc_id"].isna().sum() >= 2
    assert (out["doc_id"] == 3).sum() == 1 and out[out["doc_id"] == 3]["n_tokens"].item() == 1


def test_windows_hold_the_documents_tokens(spark):
    """Put together again from the windows, every document's ids are those of its text."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "gamma", "délta"], k=rng.randint(0, 90)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {}
    for w in pack(docs, window=64, docs_per_shard=40).collect():
        assert w["n_tokens"] == len(w["token_ids"]) <= 64 and w["doc_ids"] == [p["doc_id"] for p in w["pieces"]]
        at = 0
        for p in w["pieces"]:
            assert p["start"] == at
            at += p["n_tokens"]
            got[p["doc_id"], p["piece"]] = w["token_ids"][p["start"] : at]
        assert at == w["n_tokens"]
    for i, text in rows:
        assert sum((got[key] for key in sorted(k for k in got if k[0] == i)), []) == ids_of(text)
    full = pack(docs, window=64, docs_per_shard=10**6)
    lengths = [(i, len(ids_of(t))) for i, t in rows]
    pieces = [min(64, n - k * 64) for _, n in lengths for k in range(-(-n // 64))]
    _, start = place(np.array(pieces), 64)
    assert [r["start"] for r in pieces_of(full).orderBy("doc_id", "piece").collect()] == start.tolist()


def test_a_row_repeated_without_end_is_dealt_out(spark):
    rows = [(1, "a hot row")] * 900 + [(None, None)] * 500 + [(i, f"row {i}") for i in range(2, 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = pieces_of(pack(docs, window=32, docs_per_shard=100)).groupBy("shard").count().collect()
    assert len(out) == 15 and max(r["count"] for r in out) < 250 and sum(r["count"] for r in out) == len(rows)


def test_empty_clashing_and_repeatable(spark):
    assert pack(empty(spark)).count() == 0
    df, _ = clashing(spark)
    assert rows_of(pack(df, window=16)) == rows_of(pack(odd(spark).repartition(5), window=16))
