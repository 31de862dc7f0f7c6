"""Flat parsing against the expressions, odd backends, and the model adapters with stand-in modules."""

import dataclasses
import random
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sylvaframe.config import Config, load_config
from sylvaframe.operators import flat, parse
from sylvaframe.operators.parse import BACKENDS, Backend, register
from sylvaframe.plans.dataset import build_dataset, parse_pairs

MIXED = {"parser": {"parsers": ["chain", "rules"], "sources": {"tree": "chain", "deps": "chain", "pos_tags": "rules", "lemmas": "rules", "morph": "rules"}}}


def pairs_of(spark):
    rng = random.Random(4)
    words = ["the", "of", "Dog", "barked", "quickly", "12", "and", "it", "visible", "étés", "boxes", "running", "a", "x"]
    text = lambda: " ".join(rng.choice(words) + rng.choice(["", "", "", ".", "!"]) for _ in range(rng.randint(0, 60)))
    rows = [(str(i), text(), rng.choice([text(), "", None]), "x") for i in range(80)] + [(None, None, None, None), ("e", "", "", "x"), ("e", "", "", "x")]
    return spark.createDataFrame(rows, "pair_id string, text string, text_b string, label string")


def without_flat(monkeypatch):
    for name in ("rules", "chain"):
        monkeypatch.setitem(BACKENDS, name, dataclasses.replace(BACKENDS[name], flat=None))


def test_flat_parsing_gives_what_expressions_do(spark, monkeypatch):
    pairs = pairs_of(spark)
    for config in (Config(), load_config(MIXED)):
        lines = lambda df: sorted(map(str, df.collect()))
        new, trees = lines(build_dataset(pairs, config)), lines(parse_pairs(pairs, config))
        with monkeypatch.context() as m:
            without_flat(m)
            assert new == lines(build_dataset(pairs, config)) and trees == lines(parse_pairs(pairs, config))


def test_the_plan_parses_once(spark):
    plan = build_dataset(pairs_of(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 and "Exchange" not in plan
    # tokens of the two sides, below the one Python node only
    assert plan.count("regexp_extract_all") == 2


def test_cached_input_is_parsed_too(spark):
    pairs = pairs_of(spark).cache()
    assert build_dataset(pairs).count() == build_dataset(pairs_of(spark)).count()
    pairs.unpersist()


def brute(heads):
    """Pre-order of places, or None if the heads (1-based, 0 for the root) make no tree."""
    kids = {h: [i for i, x in enumerate(heads, 1) if x == h] for h in range(len(heads) + 1)}
    if len(kids[0]) != 1:
        return None
    out, stack = [], [kids[0][0]]
    while stack:
        i = stack.pop()
        out.append(i)
        stack.extend(reversed(kids[i]))
    return out if len(out) == len(heads) else None


def test_any_heads_against_a_walk():
    rng = random.Random(8)
    lists = [[rng.randint(0, n) if rng.random() < 0.3 else max(0, i - rng.randint(0, 2)) for i in range(n)] for n in (rng.randint(1, 9) for _ in range(400))]
    nodes = [[{"idx": i, "word": "w", "lemma": "w", "pos": "X", "head": h, "rel": "dep", "morph": None} for i, h in enumerate(heads, 1)] for heads in lists]
    t = flat.Tokens(np.r_[0, np.cumsum([len(x) for x in lists])], pa.array(["w"] * sum(map(len, lists))))
    f = flat.from_lists(lambda: lambda _: nodes)()(t)
    parent, depth, ok = flat.shape_of(f)
    want = [brute(heads) for heads in lists]
    assert ok.tolist() == [w is not None for w in want] and 50 < ok.sum() < 390
    kept, parent, depth, _ = flat.checked(t, {"x": flat.from_lists(lambda: lambda _: nodes)()}, {"tree": "x"}, 1, 50)
    place = flat.pre_order_places(kept, parent, depth)
    got = [(np.argsort(place[a:b]) + 1).tolist() for a, b in zip(kept.first, kept.first[1:])]
    assert got == [w for w in want if w is not None]


def test_unknown_heads_repeated_ids_and_missing_nodes(spark):
    trees = {"gap": [(2, 0), (5, 2), (9, 5)], "twice": [(1, 0), (1, 1), (2, 1)], "nowhere": [(1, 0), (2, 7), (3, 1)], "none": []}
    make = lambda kind: lambda: lambda lists: [[{"idx": i, "word": "w", "lemma": None, "pos": "X", "head": h, "rel": "r", "morph": {}} for i, h in trees[kind]] for _ in lists]
    pairs = spark.createDataFrame([("1", "one two three.", "", "x")], "pair_id string, text string, text_b string, label string")
    for kind, kept in (("gap", 1), ("twice", 0), ("nowhere", 0), ("none", 0)):
        register(Backend("odd", frozenset({"tree_structure", "dependency_labels", "pos_tags", "lemmas", "morph"}), batch=make(kind)))
        try:
            out = build_dataset(pairs, load_config({"parser": {"parsers": ["odd"], "sources": {k: "odd" for k in parse.FEATURE_SOURCES}}})).collect()
            assert len(out) == kept
            if kept:
                assert (out[0]["trees"][0]["from_idx"], out[0]["trees"][0]["to_idx"]) == ([0, 1], [1, 2])
            # as the giver of features only, a node it lacks keeps its own
            sources = {k: "rules" for k in parse.FEATURE_SOURCES} | {"pos_tags": "odd"}
            mixed = build_dataset(pairs, load_config({"parser": {"parsers": ["rules", "odd"], "sources": sources}})).collect()
            assert len(mixed) == kept
            if kept:
                places = [f[:18].index(1.0) for f in mixed[0]["trees"][0]["node_features"]]
                assert 16 in places and places != [16] * 3
        finally:
            del BACKENDS["odd"]


CONLL = "# text\n1-2\tdel\t_\t_\t_\t_\t_\t_\n1\tThe\tthe\tDET\tDT\tDefinite=Def|PronType=Art\t2\tdet\t_\t_\n2\tdog\tdog\tNOUN\tNN\t_\t3\tnsubj\n3\truns\t_\t_\tVB\tTense=Pres\t0\troot\n"


def test_adapters_of_model_parsers_with_stand_in_modules(monkeypatch):
    assert [(n["idx"], n["head"], n["pos"], n["rel"], n["morph"]) for n in parse.conll_nodes(CONLL)] == [(1, 2, "DET", "det", {"Definite": "Def", "PronType": "Art"}), (2, 3, "NOUN", "nsubj", {}), (3, 0, None, "root", {"Tense": "Pres"})]

    class Biaffine:
        @classmethod
        def load(cls, name):
            return cls()

        def predict(self, lists, batch_size, prob):
            assert all(lists)
            return types.SimpleNamespace(sentences=[CONLL] * len(lists))

    package, module = types.ModuleType("diaparser"), types.ModuleType("diaparser.parsers")
    module.Parser = Biaffine
    monkeypatch.setitem(sys.modules, "diaparser", package)
    monkeypatch.setitem(sys.modules, "diaparser.parsers", module)
    got = parse._biaffine_batch("m")()([["The", "dog", "runs"], []])
    assert [n["word"] for n in got[0]] == ["The", "dog", "runs"] and got[1] == []

    class Token:
        def __init__(self, i, word, head):
            self.i, self.text, self.lemma_, self.pos_, self.dep_ = i, word, word.lower(), "NOUN", "dep"
            self.head = self if head == i else types.SimpleNamespace(i=head)
            self.morph = types.SimpleNamespace(to_dict=lambda: {"Number": "Sing"})

    pipeline, tokens = types.ModuleType("spacy"), types.ModuleType("spacy.tokens")
    tokens.Doc = lambda vocab, words: [Token(i, w, max(0, i - 1)) for i, w in enumerate(words)]
    pipeline.load = lambda name: types.SimpleNamespace(vocab=None, pipe=lambda docs: docs)
    monkeypatch.setitem(sys.modules, "spacy", pipeline)
    monkeypatch.setitem(sys.modules, "spacy.tokens", tokens)
    assert [(n["idx"], n["head"]) for n in parse._pipeline_batch("m")()([["a", "b", "c"]])[0]] == [(1, 0), (2, 1), (3, 2)]
    monkeypatch.setattr(parse, "_installed", lambda name: True)
    try:
        assert parse.register_models() == ["spacy", "diaparser"] and BACKENDS["diaparser"].flat_loader()
    finally:
        del BACKENDS["spacy"], BACKENDS["diaparser"]
