import random

import pytest
from pyspark.sql import functions as F

from sylvaframe.functions import tree as R
from sylvaframe.functions.features import DEPENDENCIES, MORPH, POS, edge_features, feature_dims, morph_vector, one_hot
from sylvaframe.functions.viz import draw, side_by_side, tree_dot, with_pair_text, with_tree_text
from sylvaframe.schemas import NODES


def nodes(heads, ids=None):
    ids = ids or range(1, len(heads) + 1)
    return [(i, f"w{i}", f"l{i}", "NOUN", h, "root" if h == 0 else f"d{i}", None) for i, h in zip(ids, heads)]


def frame(spark, trees):
    return spark.createDataFrame([(k, t) for k, t in enumerate(trees)], f"k int, n {NODES}")


def run(spark, trees, expression):
    return [r[1] for r in sorted(frame(spark, trees).select("k", expression(F.col("n"))).collect(), key=lambda r: r[0])]


def random_heads(rng):
    n = rng.randint(1, 14)
    order = list(range(1, n + 1))
    rng.shuffle(order)
    heads = [0] * n
    for k, i in enumerate(order[1:], 1):
        heads[i - 1] = rng.choice(order[:k])
    return heads


class Plain:
    def __init__(self, heads):
        self.heads = heads
        self.root = heads.index(0) + 1
        self.kids = {i: [j for j, h in enumerate(heads, 1) if h == i] for i in range(1, len(heads) + 1)}

    def pre(self, i):
        return [i] + [x for k in self.kids[i] for x in self.pre(k)]

    def post(self, i):
        return [x for k in self.kids[i] for x in self.post(k)] + [i]

    def level(self):
        queue, out = [self.root], []
        while queue:
            i = queue.pop(0)
            out.append(i)
            queue += self.kids[i]
        return out

    def height(self, i):
        return 1 + max((self.height(k) for k in self.kids[i]), default=0)


@pytest.fixture(scope="module")
def plains():
    rng = random.Random(7)
    return [Plain(random_heads(rng)) for _ in range(60)]


def test_orders_match_plain_walks(spark, plains):
    trees = [nodes(p.heads) for p in plains]
    assert run(spark, trees, R.pre_order) == [p.pre(p.root) for p in plains]
    assert run(spark, trees, R.post_order) == [p.post(p.root) for p in plains]
    assert run(spark, trees, R.level_order) == [p.level() for p in plains]
    assert run(spark, trees, R.height) == [p.height(p.root) for p in plains]
    assert run(spark, trees, R.subtree_sizes) == [[len(p.pre(i)) for i in range(1, len(p.heads) + 1)] for p in plains]
    assert run(spark, trees, lambda n: R.subtree(n, F.lit(1))) == [p.pre(1) for p in plains]
    assert all(run(spark, trees, R.is_tree))


def test_orders_do_not_depend_on_places(spark, plains):
    rng = random.Random(1)
    shuffled = []
    for p in plains:
        # idx values with gaps, as after an edit
        t = [(i * 3, w, lm, pos, h * 3, rel, m) for i, w, lm, pos, h, rel, m in nodes(p.heads)]
        shuffled.append(rng.sample(t, len(t)))
    assert run(spark, shuffled, R.pre_order) == [[3 * i for i in p.pre(p.root)] for p in plains]
    assert all(run(spark, shuffled, R.is_tree))


def test_what_is_no_tree(spark):
    cases = [[], None, nodes([2, 1]), nodes([0, 0]), nodes([0, 3, 2]), nodes([0, 9]), nodes([1]), nodes([0, 1], [1, 1]), nodes([0, 1, 1])]
    assert run(spark, cases, R.is_tree) == [False] * 8 + [True]
    assert run(spark, cases, R.root_idx)[3] == 2


def test_graph_invariants(spark, plains):
    trees = [nodes(p.heads) for p in plains]
    for p, g in zip(plains, run(spark, trees, lambda n: R.to_graph(n, F.lit("t")))):
        n, order = len(p.heads), p.pre(p.root)
        assert len(g["from_idx"]) == len(g["to_idx"]) == len(g["edge_features"]) == n - 1
        assert len(g["graph_idx"]) == len(g["node_features"]) == len(g["node_texts"]) == n and set(g["graph_idx"]) == {0} and g["n_graphs"] == 1
        assert [x["word"] for x in g["node_texts"]] == [f"w{i}" for i in order]
        at = {i: k for k, i in enumerate(order)}
        assert list(zip(g["from_idx"], g["to_idx"])) == [(at[i], at[k]) for i in order for k in p.kids[i]]
        assert all(a < b for a, b in zip(g["from_idx"], g["to_idx"]))
        assert {len(v) for v in g["node_features"]} == {36} and {len(v) for v in g["edge_features"]} <= {70}


def test_swap_exchanges_places(spark):
    tree = [(1, "root", "r", "VERB", 0, "root", None), (2, "n1", "a", "NOUN", 1, "dep1", None), (3, "n2", "b", "NOUN", 1, "dep2", None), (4, "kid", "c", "ADJ", 2, "amod", None)]
    out = run(spark, [tree], lambda n: R.swap_nodes(n, F.lit(2), F.lit(3)))[0]
    assert [(r["word"], r["head"], r["rel"]) for r in out] == [("root", 0, "root"), ("n1", 1, "dep2"), ("n2", 1, "dep1"), ("kid", 3, "amod")]
    up = run(spark, [tree], lambda n: R.swap_nodes(n, F.lit(1), F.lit(2)))[0]
    assert [(r["word"], r["head"]) for r in up] == [("root", 2), ("n1", 0), ("n2", 2), ("kid", 1)]
    twice = run(spark, [tree], lambda n: R.swap_nodes(R.swap_nodes(n, F.lit(1), F.lit(4)), F.lit(1), F.lit(4)))[0]
    assert [tuple(r) for r in twice] == tree


def test_children(spark):
    tree = nodes([0, 1, 2, 1])
    assert [r["idx"] for r in run(spark, [tree], lambda n: R.remove_child(n, F.lit(2)))[0]] == [1, 4]
    new = R.node(F.lit(9), F.lit("x"), F.lit("x"), F.lit("X"), F.lit(0), F.lit("?"))
    out = run(spark, [tree], lambda n: R.replace_child(n, F.lit(2), new))[0]
    assert [(r["idx"], r["head"], r["rel"]) for r in out] == [(1, 0, "root"), (4, 1, "d4"), (9, 1, "d2")]
    out = run(spark, [tree], lambda n: R.replace_child(n, F.lit(2), new, F.lit("obj")))[0]
    assert out[-1]["rel"] == "obj"
    out = run(spark, [tree], lambda n: R.modify(n, lambda x: x["idx"] > 2, lambda x: x.withField("pos", F.lit("ADV"))))[0]
    assert [r["pos"] for r in out] == ["NOUN", "NOUN", "ADV", "ADV"]


def test_columns_and_counting_from_zero(spark):
    df = spark.createDataFrame([(["a", "b"], ["VERB", "NOUN"], [0, 1], ["root", "obj"]), (["a"], ["VERB", "X"], [0], ["root"])], "w array<string>, p array<string>, h array<int>, r array<string>")
    got = [r[0] for r in df.select(R.from_columns(F.col("w"), F.col("w"), F.col("p"), F.col("h"), F.col("r"))).collect()]
    assert [(n["idx"], n["word"], n["head"]) for n in got[0]] == [(1, "a", 0), (2, "b", 1)] and got[1] is None
    rows = [([(0, "dog", "dog", "NOUN", "nsubj", 1, {}), (1, "runs", "run", "VERB", "ROOT", 1, {})],)]
    df = spark.createDataFrame(rows, "t array<struct<idx:int,text:string,lemma:string,pos:string,dep:string,head_idx:int,morph:map<string,string>>>")
    got = df.select(R.from_zero_based(F.col("t"))).first()[0]
    assert [(n["idx"], n["head"], n["rel"]) for n in got] == [(1, 2, "nsubj"), (2, 0, "root")]


def test_checks(spark):
    good = nodes([0, 1, 1])
    bad = [(i, w, lm, "_" if i == 2 else p, h, r, m) for i, w, lm, p, h, r, m in good]
    nameless = [(i, w, lm, p, h, None if i == 2 else r, m) for i, w, lm, p, h, r, m in good]
    assert run(spark, [good, bad, nameless, None], R.contents_ok) == [True, False, False, False]
    assert run(spark, [good, nodes([0, 1]), None], R.size_ok) == [True, False, False]


def test_vectors(spark):
    df = spark.createDataFrame([("ADJ", {"Number": "Sing", "Case": "Nom"}), ("UNKNOWN", None), (None, {})], "p string, m map<string,string>")
    rows = df.select(one_hot(F.col("p"), "pos_tags"), morph_vector(F.col("m")), edge_features(F.col("p"))).collect()
    assert [r[0].index(1.0) for r in rows] == [0, 17, 17] and {sum(r[0]) for r in rows} == {1.0}
    assert [r[2].index(1.0) for r in rows] == [69, 69, 69]
    assert rows[0][1] == [1, 0, 0, 1, 0, 1, 0, 1, 1, 0] + [0, 1] * 4 and rows[1][1] == [0] * 18 and rows[2][1] == [0, 1] * 9
    assert (len(POS), len(DEPENDENCIES), len(MORPH)) == (17, 69, 9) and len(set(DEPENDENCIES)) == 69
    assert (DEPENDENCIES[0], DEPENDENCIES[36], DEPENDENCIES[37], DEPENDENCIES[-1]) == ("nsubj", "dep", "acl:relcl", "nmod:npmod")
    assert feature_dims() == {"node": 36, "edge": 70, "pos": 18, "morph": 18} and feature_dims(768)["node"] == 804
    with pytest.raises(ValueError):
        one_hot(F.col("p"), "colours")


def test_drawings(spark):
    tree = [(1, "cat", "cat", "NOUN", 2, "nsubj", {"Number": "Sing"}), (2, "chases", "chase", "VERB", 0, "root", None), (3, "mouse", "mouse", "NOUN", 2, "obj", {})]
    want = "└── chases (VERB)\n    ├── cat (NOUN) --nsubj--> [Number: Sing]\n    └── mouse (NOUN) --obj-->"
    df = frame(spark, [tree, None]).withColumn("label", F.lit("neutral"))
    shown = [r["d"] for r in sorted(with_tree_text(df, "n", "d", True).collect())]
    assert shown == [want, "<empty tree>"] and "d" not in df.columns
    pair = with_pair_text(df, "n", "n", "label", "p").where("k = 0").first()["p"].split("\n")
    assert pair[0].startswith("Premise:") and "Hypothesis:" in pair[0] and pair[-1] == "Relationship: neutral" and len({line.rfind("└") for line in pair[2:3]}) == 1
    assert side_by_side("a", "b").split("\n")[2] == "a    b" and draw([]) == "<empty tree>"
    dot = frame(spark, [[(1, 'say "x"', "s", "VERB", 0, "root", None), (2, "b", "b", "X", 1, "obj", None)]]).select(tree_dot(F.col("n"))).first()[0]
    assert dot.splitlines() == ["digraph {", "\trankdir=TB", '\t1 [label="say \\"x\\"\\nVERB"]', '\t1 -> 2 [label="obj"]', '\t2 [label="b\\nX"]', "}"]
