import itertools
import random

import numpy as np
import pytest

from sylvaframe.llm.components import components
from sylvaframe.llm.cpsjoin import THRESHOLD, compare_node, drop_near_copies, groups, near_query, shingles

from .oddities import clashing, empty, odd, rows_of


def exact_groups(texts, threshold=THRESHOLD):
    """Root of each text by comparing all pairs of shingle sets."""
    sets = [set(shingles(t or "", _Cache()).tolist()) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j]:
            both = len(sets[i] & sets[j])
            if both / (len(sets[i]) + len(sets[j]) - both) >= threshold:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], sets


class _Cache(dict):
    def __missing__(self, w):
        import xxhash

        return xxhash.xxh3_64_intdigest(w)


def corpus(seed, n_groups=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    shared = " ".join(rng.choices(vocabulary, k=60))
    texts = []
    for g in range(n_groups):
        base = rng.choices(vocabulary, k=rng.randint(80, 300))
        for _ in range(rng.choice([1, 1, 2, 3, 8])):
            words = [rng.choice(vocabulary) if rng.random() < rng.choice([0, 0.02, 0.06]) else w for w in base]
            texts.append(" ".join(words))
        if g % 5 == 0:
            texts.append(" ".join(rng.choices(vocabulary, k=200)) + " " + shared)
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [0, 1])
def test_groups_match_all_pairs(spark, seed):
    texts = corpus(seed)
    want, _ = exact_groups(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["kept_id"] for r in groups(docs).collect()}
    pairs = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if want[i] == want[j]]
    found = sum(got.get(i) is not None and got.get(i) == got.get(j) for i, j in pairs)
    assert found / len(pairs) >= 0.9
    assert all(want[i] == want[k] for i, k in got.items())


def test_one_of_each_group_stays_and_clean_documents_all_do(spark):
    texts = corpus(2)
    want, _ = exact_groups(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"] for r in drop_near_copies(docs).collect()}
    assert kept >= set(want)
    assert len(kept - set(want)) <= 0.1 * (len(texts) - len(set(want)))


def test_a_node_connects_as_all_pairs_would():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**31, (4, 128)).astype(np.int32)
    sig = base[rng.integers(0, 4, 40)].copy()
    for row in sig:
        row[rng.random(128) < 0.1] = rng.integers(0, 2**31)
    edges = compare_node(np.arange(40), sig, 0.5, 0.13)
    root = list(range(40))
    for a, b, sure in edges:
        assert sure
        root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    for i, j in itertools.combinations(range(40), 2):
        assert (root[i] == root[j]) == ((sig[i] == sig[j]).mean() >= 0.5)


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + k) for k in range(1, 20)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{100 + k: 100 for k in range(20)}, **{200 + i: 200 for i in range(9)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_oddities(spark):
    out = rows_of(drop_near_copies(odd(spark)).select("doc_id", "text"))
    ids = [i for i, _ in out]
    assert ids.count(1) == 1 and ids.count(2) == 0
    # texts without a word resemble nothing, so their rows all stay
    assert ids.count(5) == 2 and ids.count(3) == 1 and ids.count(4) == 1 and ids.count(7) == 1 and ids.count(None) == 2
    assert drop_near_copies(empty(spark)).count() == 0
    df, extra = clashing(spark)
    kept = drop_near_copies(df)
    assert kept.columns == df.columns and kept.count() == len(out)


def test_rows_repeated_in_full_leave_one(spark):
    rows = [(1, "some words that come twice in the very same row")] * 3
    assert drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).count() == 1


def test_a_large_group_of_copies(spark):
    base = " ".join(f"w{i}" for i in range(120))
    rows = [(i, base + f" tail{i % 3}") for i in range(600)] + [(1000 + i, " ".join(f"x{i}_{k}" for k in range(50))) for i in range(50)]
    kept = drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in kept) == [0, *range(1000, 1050)]


def test_query_lists_pairs(spark):
    out = near_query(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "duplicate_of"] and out.where("doc_id <= duplicate_of").count() == 0 and out.count() > 0


def large_clusters(seed):
    """Clusters of near copies of which each text is its own, some of them chains, beside lone texts that share a passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(5000)]
    texts = []
    for size in (300, 120, 60):
        base = rng.choices(vocabulary, k=120)
        texts += [" ".join(rng.choice(vocabulary) if rng.random() < 0.04 else w for w in base) for _ in range(size)]
    chain = rng.choices(vocabulary, k=200)
    for _ in range(40):
        chain = chain[15:] + rng.choices(vocabulary, k=15)
        texts.append(" ".join(chain))
    passage = " ".join(rng.choices(vocabulary, k=70))
    texts += [passage + " " + " ".join(rng.choices(vocabulary, k=60)) for _ in range(150)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("big", [20, 100])
def test_large_nodes_are_judged_by_pivots(spark, big, monkeypatch):
    from sylvaframe.llm import cpsjoin

    texts = large_clusters(3)
    want, sets = exact_groups(texts)
    stepped = []
    step = cpsjoin.pivot_step
    monkeypatch.setattr(cpsjoin, "pivot_step", lambda *a: stepped.append(1) or step(*a))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["kept_id"] for r in groups(docs, leaf=8, big=big, trees=12).collect()}
    assert stepped and all(want[i] == want[k] for i, k in got.items())
    grouped = [i for i in range(len(texts)) if want.count(want[i]) > 1]
    head = {w: min(i for i in grouped if want[i] == w) for w in {want[i] for i in grouped}}
    assert sum(got.get(i) == head[want[i]] for i in grouped) / len(grouped) >= 0.97


def test_no_task_compares_more_than_a_big_node(spark, monkeypatch):
    """A third of all rows are near copies: the work of a task doesn't grow with their number."""
    from sylvaframe.llm import cpsjoin

    texts = [" ".join(f"w{k if k != i % 97 else f'x{i}'}" for k in range(100)) for i in range(400)] + [" ".join(f"y{i}_{k}" for k in range(30)) for i in range(800)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sizes = []
    real = cpsjoin.materialize

    def watched(df, label):
        out = real(df, label)
        if label == "nodes":
            sizes.extend(r["n"] for r in out.where("stop").collect())
        return out

    monkeypatch.setattr(cpsjoin, "materialize", watched)
    got = groups(docs, big=50).collect()
    assert max(sizes) <= 64 and {r["kept_id"] for r in got} == {0} and len(got) == 400


def at_the_threshold(n):
    """Pairs of texts whose trigrams' Jaccard similarity is 1/2 exactly, or just below."""
    texts = []
    for i in range(n):
        same, more = 2 * (20 + i % 30), 20 + i % 30
        base = [f"p{i}_{k}" for k in range(same + 2)]
        texts.append(" ".join(base + [f"q{i}_{k}" for k in range(more)]))
        texts.append(" ".join(base + [f"r{i}_{k}" for k in range(more + i % 2)]))
    return texts


def test_no_pair_at_the_threshold_is_left_out(spark):
    texts = at_the_threshold(300)
    want, _ = exact_groups_of_neighbours(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["kept_id"] for r in groups(docs).collect()}
    assert got == want and len(got) == 300


def exact_groups_of_neighbours(texts):
    """As exact_groups, where only texts 2k and 2k + 1 share anything."""
    sets = [set(shingles(t, _Cache()).tolist()) for t in texts]
    alike = [len(a & b) / len(a | b) >= THRESHOLD for a, b in zip(sets[::2], sets[1::2])]
    return {i: 2 * (i // 2) for k, yes in enumerate(alike) if yes for i in (2 * k, 2 * k + 1)}, sets


@pytest.mark.parametrize("make", [lambda: corpus(4), lambda: large_clusters(5)])
def test_whatever_the_trees_leave_out_is_found(spark, make, monkeypatch):
    """One tree finds few links; small chunks and samples make all parts of the join meet."""
    from sylvaframe.llm import cpsjoin

    monkeypatch.setattr(cpsjoin, "CHUNK", 3_000)
    monkeypatch.setattr(cpsjoin, "ORDER_SAMPLE", 50)
    texts = make()
    want, _ = exact_groups(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["kept_id"] for r in groups(docs, trees=1, leaf=4).collect()}
    assert got == {i: w for i, w in enumerate(want) if want.count(w) > 1}
