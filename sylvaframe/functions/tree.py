"""Dependency trees as flat node arrays.

A tree is ``array<struct<idx, word, lemma, pos, head, rel, morph>>`` in token
order; ``idx`` counts from 1 and ``head`` is the parent's idx, 0 at the root.
Orders, depths and subtrees all come from one array of root-to-node paths:
arrays compare element by element, and a prefix comes first, so sorting the
paths is pre-order. All of it are expressions, evaluated in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import NODE
from .features import edge_features, node_features
from .text import bind

_NO_PATH = "array<int>"
_BEYOND = 2**31 - 1


def node(idx: Column, word: Column, lemma: Column, pos: Column, head: Column, rel: Column, morph: Column | None = None) -> Column:
    morph = F.lit(None).cast("map<string,string>") if morph is None else morph
    return F.struct(
        idx.cast("int").alias("idx"), word.alias("word"), lemma.alias("lemma"), pos.alias("pos"), head.cast("int").alias("head"), rel.alias("rel"), morph.alias("morph")
    )


def _rebuilt(n: Column, **changed: Column) -> Column:
    names = ("idx", "word", "lemma", "pos", "head", "rel", "morph")
    return F.struct(*[changed.get(k, n[k]).alias(k) for k in names])


def by_idx(nodes: Column, idx: Column) -> Column:
    """The node ``idx``, null if there is none. Direct where nodes stand at their own idx, as they do unless a tree was edited."""
    direct = F.get(nodes, idx - 1)
    return F.when(direct["idx"] == idx, direct).otherwise(F.get(F.filter(nodes, lambda n: n["idx"] == idx), F.lit(0)))


def parent_places(nodes: Column) -> Column:
    """For each node its parent's place in the array, from 1; 0 for a root, null for an unknown head."""

    def of(ids: Column) -> Column:
        def place(n: Column) -> Column:
            there = F.when(F.get(ids, n["head"] - 1) == n["head"], n["head"]).otherwise(F.nullif(F.array_position(ids, n["head"]), F.lit(0)).cast("int"))
            return F.when(n["head"] == 0, F.lit(0)).otherwise(there)

        return F.transform(nodes, place)

    return bind(F.transform(nodes, lambda n: n["idx"]), of)


def paths(nodes: Column) -> Column:
    """For each node its path of idx values from a root; null where none is reached."""

    def all_paths(up: Column) -> Column:
        steps = F.sequence(F.lit(1), F.greatest(F.size(up), F.lit(1)))

        def walk(n: Column, i: Column) -> Column:
            # at: the place of the node above the path so far, 0 once the root is in it
            begun = F.struct(F.get(up, i).alias("at"), F.array(n["idx"]).alias("path"))

            def step(acc: Column, _: Column) -> Column:
                more = F.struct(F.get(up, acc["at"] - 1).alias("at"), F.concat(F.array(F.get(nodes, acc["at"] - 1)["idx"]), acc["path"]).alias("path"))
                return F.when(acc["at"] > 0, more).otherwise(acc)

            return F.aggregate(steps, begun, step, lambda acc: F.when(acc["at"] == 0, acc["path"]))

        return F.transform(nodes, walk)

    return bind(parent_places(nodes), all_paths)


def root_idx(nodes: Column) -> Column:
    """The last node whose head is 0; null if there is none."""
    return F.try_element_at(F.filter(nodes, lambda n: n["head"] == 0), F.lit(-1))["idx"]


def is_tree(nodes: Column) -> Column:
    """One root reaches every node, each idx occurs once. False for an empty or null array."""
    return F.coalesce(tree_order(nodes).isNotNull(), F.lit(False))


def tree_order(nodes: Column) -> Column:
    """As pre_order for a tree, null for what is none."""

    def of(ps: Column) -> Column:
        order = F.transform(F.array_sort(ps), lambda p: F.element_at(p, -1))
        unique = F.size(F.array_distinct(order)) == F.size(nodes)
        # sorted, all paths begin with the root if the first and the last do
        one_root = F.element_at(F.array_min(ps), 1) == F.element_at(F.array_max(ps), 1)
        ok = F.when(F.size(ps) < 1, False).when(F.exists(ps, lambda p: p.isNull()), False).otherwise(one_root & unique)
        return F.when(ok, order)

    return bind(paths(nodes), of)


def build_tree(nodes: Column) -> Column:
    """The nodes if they are a tree, else null."""
    return F.when(is_tree(nodes), nodes)


def _ordered(nodes: Column, key: Callable[[Column], Column]) -> Column:
    pairs = F.arrays_zip(paths(nodes).alias("path"), nodes.alias("node"))
    keyed = F.transform(pairs, lambda x: F.struct(key(x["path"]).alias("k"), x["node"]["idx"].alias("idx")))
    return F.transform(F.array_sort(keyed), lambda x: x["idx"])


def pre_order(nodes: Column) -> Column:
    """idx values, a parent before its children, children in token order."""
    return _ordered(nodes, lambda p: p)


def post_order(nodes: Column) -> Column:
    return _ordered(nodes, lambda p: F.concat(p, F.array(F.lit(_BEYOND))))


def level_order(nodes: Column) -> Column:
    return _ordered(nodes, lambda p: F.concat(F.array(F.size(p)), p))


def height(nodes: Column) -> Column:
    """Nodes on the longest path from the root."""
    return F.array_max(F.transform(paths(nodes), lambda p: F.size(p)))


def subtree(nodes: Column, idx: Column) -> Column:
    """idx values of the subtree at ``idx``, in pre-order."""
    inside = F.filter(paths(nodes), lambda p: F.array_contains(p, idx))
    return F.transform(F.array_sort(inside), lambda p: F.element_at(p, -1))


def subtree_sizes(nodes: Column) -> Column:
    """For each node, in token order, the nodes below it and itself."""
    return bind(paths(nodes), lambda ps: F.transform(nodes, lambda n: F.size(F.filter(ps, lambda p: F.array_contains(p, n["idx"])))))


# -- edits -----------------------------------------------------------------------


def add_child(nodes: Column, child: Column, parent: Column, rel: Column) -> Column:
    return F.concat(nodes, F.array(_rebuilt(child, head=parent.cast("int"), rel=rel)).cast(f"array<{NODE}>"))


def remove_child(nodes: Column, idx: Column) -> Column:
    """Without the node ``idx`` and all below it."""
    gone = subtree(nodes, idx)
    return F.filter(nodes, lambda n: ~F.array_contains(gone, n["idx"]))


def replace_child(nodes: Column, old: Column, new: Column, rel: Column | None = None) -> Column:
    """``new`` in the place of the subtree ``old``; its relation stays unless one is given."""
    was = F.element_at(F.filter(nodes, lambda n: n["idx"] == old), 1)
    return add_child(remove_child(nodes, old), new, was["head"], was["rel"] if rel is None else rel)


def modify(nodes: Column, condition: Callable[[Column], Column], change: Callable[[Column], Column]) -> Column:
    """``change(node)`` for the nodes for which ``condition(node)`` holds."""
    return F.transform(nodes, lambda n: F.when(condition(n), change(n)).otherwise(n))


def swap_nodes(nodes: Column, a: Column, b: Column) -> Column:
    """Two nodes change places: each gets the other's head, relation and children."""
    other = lambda i: F.when(i == a, b).when(i == b, a).otherwise(i)
    at = F.map_from_entries(F.transform(nodes, lambda n: F.struct(n["idx"], F.struct(n["head"].alias("head"), n["rel"].alias("rel")))))

    def swapped(places: Column) -> Column:
        def one(n: Column) -> Column:
            place = F.element_at(places, other(n["idx"]))
            return _rebuilt(n, head=other(place["head"]), rel=place["rel"])

        return F.transform(nodes, one)

    return bind(at, swapped)


# -- CoNLL columns ---------------------------------------------------------------


def from_columns(words: Column, lemmas: Column, tags: Column, heads: Column, rels: Column) -> Column:
    """Aligned lists as nodes; null where the lengths differ."""
    same = F.size(F.array_distinct(F.array(*[F.size(c) for c in (words, lemmas, tags, heads, rels)]))) == 1
    rows = F.arrays_zip(words.alias("w"), lemmas.alias("l"), tags.alias("p"), heads.alias("h"), rels.alias("r"))
    return F.when(same, F.transform(rows, lambda x, i: node(i + 1, x["w"], x["l"], x["p"], x["h"], x["r"])))


def from_zero_based(tokens: Column) -> Column:
    """(idx, text, lemma, pos, dep, head_idx, morph) counted from 0, the root told by ``ROOT``."""

    def one(t: Column) -> Column:
        is_root = t["dep"] == "ROOT"
        return node(t["idx"] + 1, t["text"], t["lemma"], t["pos"], F.when(is_root, 0).otherwise(t["head_idx"] + 1), F.when(is_root, "root").otherwise(t["dep"]), t["morph"])

    return F.transform(tokens, one)


# -- JSON ------------------------------------------------------------------------

_DOCUMENT = "struct<word:string,lemma:string,pos_tag:string,idx:int,features:map<string,string>,dependency_to_parent:string,head:int>"


def _node_document(n: Column) -> Column:
    fields = {"word": n["word"], "lemma": n["lemma"], "pos_tag": n["pos"], "idx": n["idx"], "features": n["morph"], "dependency_to_parent": n["rel"], "head": n["head"]}
    return F.struct(*[c.alias(k) for k, c in fields.items()])


def _document_node(d: Column) -> Column:
    return node(d["idx"], d["word"], d["lemma"], d["pos_tag"], d["head"], d["dependency_to_parent"], d["features"])


def node_to_json(n: Column) -> Column:
    return F.to_json(_node_document(n))


def node_from_json(text: Column) -> Column:
    """The node; null for what isn't JSON."""
    return bind(F.from_json(text, _DOCUMENT), lambda d: F.when(d["idx"].isNotNull(), _document_node(d)))


def tree_to_json(nodes: Column) -> Column:
    """``{"nodes": [...]}`` in token order; every depth is kept, as each node names its head."""
    return F.to_json(F.struct(F.transform(nodes, _node_document).alias("nodes")))


def tree_from_json(text: Column) -> Column:
    """The nodes if they are a tree, else null."""
    return bind(F.transform(F.from_json(text, f"struct<nodes:array<{_DOCUMENT}>>")["nodes"], _document_node), build_tree)


# -- checks ----------------------------------------------------------------------


def size_ok(nodes: Column, least: int = 3, most: int = 50) -> Column:
    return F.coalesce(F.size(nodes).between(least, most), F.lit(False))


def contents_ok(nodes: Column) -> Column:
    """Every node has a part of speech, every one but the root a relation."""
    named = lambda c: F.coalesce(~c.isin("", "_"), F.lit(False))
    return F.coalesce(F.forall(nodes, lambda n: named(n["pos"]) & ((n["head"] == 0) | named(n["rel"]))), F.lit(False))


# -- graphs ----------------------------------------------------------------------


def _edges(nodes: Column, order: Column) -> Column:
    place = lambda i: F.array_position(order, i).cast("int") - 1
    inner = F.filter(nodes, lambda n: n["head"] != 0)
    return F.array_sort(F.transform(inner, lambda n: F.struct(place(n["head"]).alias("from"), place(n["idx"]).alias("to"), n["rel"].alias("rel"))))


def edges(nodes: Column) -> Column:
    """(from, to, rel) in pre-order of the parents; places in pre-order, from 0."""
    return bind(pre_order(nodes), lambda order: _edges(nodes, order))


def to_graph(nodes: Column, text: Column) -> Column:
    """The graph of a tree; embeddings aren't stored but joined later."""

    def with_order(order: Column) -> Column:
        parts = F.struct(F.transform(order, lambda i: by_idx(nodes, i)).alias("n"), _edges(nodes, order).alias("e"))

        def graph(x: Column) -> Column:
            return F.struct(
                F.transform(x["n"], lambda n: node_features(n)).alias("node_features"),
                F.transform(x["e"], lambda e: edge_features(e["rel"])).alias("edge_features"),
                F.transform(x["e"], lambda e: e["from"]).alias("from_idx"),
                F.transform(x["e"], lambda e: e["to"]).alias("to_idx"),
                F.transform(x["n"], lambda _: F.lit(0)).alias("graph_idx"),
                F.lit(1).alias("n_graphs"),
                F.transform(x["n"], lambda n: F.struct(n["word"].alias("word"), n["lemma"].alias("lemma"))).alias("node_texts"),
                F.lit(True).alias("node_features_need_word_embs_prepended"),
                text.alias("text"),
            )

        return bind(parts, graph)

    return F.when(nodes.isNotNull(), bind(pre_order(nodes), with_order))
