"""Trees and graphs of many sentences at once, as flat arrays.

The nodes of all sentences of an Arrow batch lie end to end in numpy arrays; one
function parses, merges, checks and orders them, and gives finished trees or
graphs back. A step is one numpy operation over all nodes (or over one depth of
all trees), and a word is tagged once however often it occurs, so the cost is
far below that of expressions that are interpreted for each node. Strings are
codes into lists of distinct values.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import DEPENDENCIES, MORPH, POS
from ..runtime import once
from ..schemas import GRAPH, NODES

#: Rows of token lists that are turned into graphs together; bounds what a task holds.
ROWS_AT_ONCE = 250


@dataclass
class Tokens:
    """Sentences end to end: ``first`` has each sentence's first place and, last, the number of all tokens."""

    first: np.ndarray
    words: pa.Array

    @property
    def sentence(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def lists(self) -> list[list[str]]:
        return pa.ListArray.from_arrays(pa.array(self.first, pa.int32()), self.words).to_pylist()


@dataclass
class Coded:
    """Values as codes into a list of distinct ones."""

    codes: np.ndarray
    values: list

    def take(self, at: np.ndarray) -> Coded:
        return Coded(self.codes[at], self.values)

    def array(self, kind: pa.DataType) -> pa.Array:
        return pa.array(self.values, kind).take(pa.array(self.codes))

    def test(self, holds: Callable) -> np.ndarray:
        return np.array([holds(v) for v in self.values], bool)[self.codes] if len(self.values) else np.zeros(len(self.codes), bool)

    def where(self, take: np.ndarray, other: Coded) -> Coded:
        """``other``'s value where ``take`` holds; ``other`` is aligned."""
        return Coded(np.where(take, other.codes + len(self.values), self.codes), self.values + other.values)


def coded(values: list) -> Coded:
    names: dict = {}
    codes = np.array([names.setdefault(_key(v), len(names)) for v in values], np.int64)
    firsts: list = [None] * len(names)
    for v, c in zip(values, codes):
        firsts[c] = v
    return Coded(codes, firsts)


def _key(value):
    return tuple(sorted(value.items())) if isinstance(value, dict) else value


@dataclass
class Flat:
    """Nodes of many sentences; the fields of ``schemas.NODE`` as columns."""

    first: np.ndarray
    idx: np.ndarray
    words: pa.Array
    lemma: Coded
    pos: Coded
    head: np.ndarray
    rel: Coded
    morph: Coded

    @property
    def sentence(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


FlatParser = Callable[[Tokens], Flat]

# -- the built-in parsers ------------------------------------------------------------


@dataclass(frozen=True)
class Lexicon:
    determiners: tuple[str, ...]
    adpositions: tuple[str, ...]
    pronouns: tuple[str, ...]
    conjunctions: tuple[str, ...]

    def tag(self, word: str) -> str:
        low = word.lower()
        if re.fullmatch("[0-9]+", low):
            return "NUM"
        if not any(unicodedata.category(c)[0] in "LN" for c in low):
            return "PUNCT"
        for name, words in (("DET", self.determiners), ("ADP", self.adpositions), ("PRON", self.pronouns), ("CCONJ", self.conjunctions)):
            if low in words:
                return name
        for name, endings in (("ADV", ("ly",)), ("VERB", ("ed", "ing", "es")), ("ADJ", ("ble", "ous", "ful", "ive"))):
            if any(low.endswith(e) and len(low) >= len(e) + 2 for e in endings):
                return name
        return "NOUN"


def word_lemma(word: str) -> str:
    return re.sub("(?<=[a-z]{3})(ing|ed|es|s)$", "", word.lower())


def word_morph(word: str, pos: str) -> dict[str, str]:
    low = word.lower()
    if pos == "NOUN":
        return {"Number": "Plur" if low.endswith("s") else "Sing"}
    if pos == "VERB":
        return {"Tense": "Past" if low.endswith("ed") else "Pres", "VerbForm": "Fin"}
    return {}


class Words:
    """What a parser says of each distinct word, kept for the next batches; emptied when large, as a cache may be."""

    def __init__(self, describe: Callable[[str], tuple]):
        self.describe, self.known = describe, {}

    def columns(self, words: pa.Array) -> list[Coded]:
        found = pc.dictionary_encode(words)
        names, codes = found.dictionary.to_pylist(), found.indices.to_numpy().astype(np.int64)
        if len(self.known) > 500_000:
            self.known = {}
        rows = []
        for w in names:
            row = self.known.get(w)
            if row is None:
                row = self.known[w] = self.describe(w)
            rows.append(row)
        out = []
        for k in range(len(rows[0]) if rows else 0):
            column = coded([r[k] for r in rows])
            out.append(Coded(column.codes[codes], column.values))
        return out


_LEANING = ("DET", "ADP", "ADJ", "NUM", "CCONJ")
_RELATIONS = {"DET": "det", "ADP": "case", "ADJ": "amod", "NUM": "nummod", "ADV": "advmod", "CCONJ": "cc", "PUNCT": "punct", "VERB": "conj"}


def _empty(t: Tokens) -> Flat:
    none = lambda: Coded(np.empty(0, np.int64), [])
    return Flat(t.first, np.empty(0, np.int64), t.words, none(), none(), np.empty(0, np.int64), none(), none())


def rule_parser(lexicon: Lexicon) -> Callable[[], FlatParser]:
    """As ``operators.parse.rule_nodes``."""

    def load() -> FlatParser:
        def describe(w: str) -> tuple:
            pos = lexicon.tag(w)
            return word_lemma(w), pos, word_morph(w, pos)

        words = Words(describe)

        def run(t: Tokens) -> Flat:
            if not len(t.words):
                return _empty(t)
            lemma, pos, morph = words.columns(t.words)
            s = t.sentence
            idx = np.arange(len(s)) - t.first[s] + 1
            n = np.diff(t.first)[s]
            verb = pos.test(lambda p: p == "VERB")
            root = np.full(len(t.first) - 1, 1 << 40)
            np.minimum.at(root, s[verb], idx[verb])
            root = np.where(root == 1 << 40, 1, root)[s]
            leans = pos.test(lambda p: p in _LEANING) & (idx < n)
            head = np.where(idx == root, 0, np.where(leans, idx + 1, root))
            names = ["root", *dict.fromkeys(_RELATIONS.values()), "nsubj", "obj"]
            by_pos = np.array([names.index(_RELATIONS[p]) if p in _RELATIONS else -1 for p in pos.values])[pos.codes]
            rel = np.where(by_pos >= 0, by_pos, np.where(idx < root, names.index("nsubj"), names.index("obj")))
            return Flat(t.first, idx, t.words, lemma, pos, head, Coded(np.where(idx == root, 0, rel), names), morph)

        return run

    return load


def chain_parser(lexicon: Lexicon) -> Callable[[], FlatParser]:
    """As ``operators.parse.chain_nodes``."""

    def load() -> FlatParser:
        words = Words(lambda w: (w.lower(), lexicon.tag(w)))

        def run(t: Tokens) -> Flat:
            if not len(t.words):
                return _empty(t)
            lemma, pos = words.columns(t.words)
            idx = np.arange(len(t.words)) - t.first[t.sentence] + 1
            rel = Coded((idx > 1).astype(np.int64), ["root", "dep"])
            return Flat(t.first, idx, t.words, lemma, pos, idx - 1, rel, Coded(np.zeros(len(idx), np.int64), [None]))

        return run

    return load


def from_lists(batch: Callable[[], Callable[[list[list[str]]], list]]) -> Callable[[], FlatParser]:
    """A batch backend (lists of tokens to lists of node mappings) as a flat parser."""

    def load() -> FlatParser:
        parse = batch()

        def run(t: Tokens) -> Flat:
            trees = [list(nodes or []) for nodes in parse(t.lists())]
            nodes = [n for tree in trees for n in tree]
            first = np.r_[0, np.cumsum([len(tree) for tree in trees])].astype(np.int64)
            column = lambda name: coded([n.get(name) for n in nodes])
            number = lambda name: np.array([-1 if n.get(name) is None else int(n[name]) for n in nodes], np.int64)
            return Flat(first, number("idx"), pa.array([n.get("word") for n in nodes], pa.string()), column("lemma"), column("pos"), number("head"), column("rel"), column("morph"))

        return run

    return load


# -- trees -----------------------------------------------------------------------------


def places(flat: Flat, sentence: np.ndarray, idx: np.ndarray) -> np.ndarray:
    """Place of the node ``idx`` of a sentence, -1 if it has none; the first of several."""
    n = len(flat.idx)
    if not n:
        return np.full(len(idx), -1)
    direct = flat.first[sentence] + idx - 1
    inside = (idx >= 1) & (direct < flat.first[sentence + 1])
    hit = inside & (flat.idx[np.where(inside, direct, 0)] == idx)
    if hit.all():
        return direct
    span = int(max(flat.idx.max(), idx.max(initial=0))) + 2
    key = flat.sentence * span + np.clip(flat.idx, -1, None)
    order = np.argsort(key, kind="stable")
    wanted = sentence * span + idx
    at = np.minimum(np.searchsorted(key[order], wanted), n - 1)
    found = order[at]
    return np.where(hit, direct, np.where((key[found] == wanted) & (idx >= 0), found, -1))


def shape_of(flat: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parent's place, depth, whether the sentence is a tree); a root is its own parent.

    A tree has one root, which reaches every node, and no idx twice.
    """
    s, n = flat.sentence, len(flat.idx)
    sentences = len(flat.first) - 1
    is_root = flat.head == 0
    here = np.arange(n)
    parent = np.where(is_root, here, places(flat, s, np.where(is_root, flat.idx, flat.head)))
    bad = parent < 0
    parent = np.where(bad, here, parent)
    up, depth = parent.copy(), (parent != here).astype(np.int64)
    longest = int(np.diff(flat.first).max(initial=1))
    for _ in range(max(1, longest).bit_length()):
        depth, up = depth + depth[up], up[up]
    bad |= ~is_root[up]
    bad |= places(flat, s, flat.idx) != here  # an idx that stood before
    count = lambda mask: np.bincount(s[mask], minlength=sentences)
    ok = (np.diff(flat.first) > 0) & (count(is_root) == 1) & (count(bad) == 0)
    return parent, depth, ok


def pre_order_places(flat: Flat, parent: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Each node's place in its tree's pre-order, from 0; children stand by idx. For trees only."""
    n = len(parent)
    place = np.zeros(n, np.int64)
    if not n:
        return place
    by_depth = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[by_depth], np.arange(depth.max() + 2))
    levels = [by_depth[a:b] for a, b in zip(cuts, cuts[1:])]
    size = np.ones(n, np.int64)
    for level in levels[:0:-1]:
        np.add.at(size, parent[level], size[level])
    inner = np.flatnonzero(depth > 0)
    inner = inner[np.lexsort((flat.idx[inner], parent[inner]))]
    before = np.zeros(n, np.int64)
    if len(inner):
        total = np.cumsum(size[inner]) - size[inner]
        starts = np.r_[True, parent[inner][1:] != parent[inner][:-1]]
        before[inner] = total - np.repeat(total[starts], np.diff(np.r_[np.flatnonzero(starts), len(inner)]))
    for level in levels[1:]:
        place[level] = place[parent[level]] + 1 + before[level]
    return place


def subset(flat: Flat, keep: np.ndarray) -> Flat:
    """The sentences for which ``keep`` holds."""
    at = np.flatnonzero(keep[flat.sentence])
    first = np.r_[0, np.cumsum(np.diff(flat.first)[keep])].astype(np.int64)
    return Flat(first, flat.idx[at], flat.words.take(pa.array(at)), flat.lemma.take(at), flat.pos.take(at), flat.head[at], flat.rel.take(at), flat.morph.take(at))


def merged(flats: dict[str, Flat], sources: dict[str, str]) -> Flat:
    """The tree parser's nodes with features of the others by idx; see ``operators.parse.merge_trees``."""
    base = flats[sources["tree"]]
    out = Flat(**vars(base))
    s = base.sentence
    for feature, name in (("pos_tags", "pos"), ("lemmas", "lemma"), ("deps", "rel"), ("morph", "morph")):
        giver = sources.get(feature, sources["tree"])
        if giver == sources["tree"]:
            continue
        other = flats[giver]
        at = places(other, s, base.idx)
        found = at >= 0
        own: Coded = getattr(base, name)
        if not found.any():
            continue
        given: Coded = getattr(other, name).take(np.where(found, at, 0))
        if name == "morph":
            both = coded([_joined(own.values[a], given.values[b]) for a, b in _pairs(own.codes, given.codes)])
            given = Coded(both.codes[_pair_codes(own.codes, given.codes)], both.values)
        taken = found & given.test(lambda v: v is not None)
        setattr(out, name, own.where(taken, given))
    return out


def _pair_codes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]


def _pairs(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    span = int(b.max(initial=0)) + 1
    return [divmod(int(p), span) for p in np.unique(a * span + b)]


def _joined(own: dict | None, given: dict | None) -> dict | None:
    return given if own is None else own if given is None else own | given


def checked(t: Tokens, parsers: dict[str, FlatParser], sources: dict[str, str], least: int, most: int) -> tuple[Flat, np.ndarray, np.ndarray, np.ndarray]:
    """(nodes of the sentences that pass every check, parent, depth, which sentences those are)."""
    flats = {name: parse(t) for name, parse in parsers.items()}
    shapes = {name: shape_of(flat) for name, flat in flats.items()}
    ok = np.ones(len(t.first) - 1, bool)
    for _, _, tree in shapes.values():
        ok &= tree
    base = flats[sources["tree"]]
    flat = merged(flats, sources) if len(flats) > 1 else base
    s = base.sentence
    n = np.diff(base.first)
    ok &= (n >= least) & (n <= most)
    named = lambda v: v not in (None, "", "_")
    bad = ~(flat.pos.test(named) & ((flat.head == 0) | flat.rel.test(named)))
    ok &= np.bincount(s[bad], minlength=len(ok)) == 0
    parent, depth, _ = shapes[sources["tree"]]
    kept = np.flatnonzero(ok[s])
    moved = np.cumsum(ok[s]) - 1  # new places
    return subset(flat, ok), moved[parent[kept]], depth[kept], ok


# -- results as Arrow arrays --------------------------------------------------------------

_STRINGS = pa.map_(pa.string(), pa.string())


def _list(first: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), values)


def _table(rows: np.ndarray, codes: np.ndarray) -> pa.Array:
    """Rows of a small matrix of floats as lists."""
    width = rows.shape[1]
    return _list(np.arange(len(codes) + 1) * width, pa.array(rows[codes].ravel(), pa.float32()))


def _one_hot(values: list, names: tuple[str, ...]) -> np.ndarray:
    at = {n: i for i, n in reversed(list(enumerate(names)))}
    out = np.zeros((max(1, len(values)), len(names) + 1), np.float32)
    for i, v in enumerate(values):
        out[i, at.get(v, len(names))] = 1
    return out


def _morph_rows(values: list, names: tuple[str, ...] = MORPH) -> np.ndarray:
    out = np.zeros((max(1, len(values)), 2 * len(names)), np.float32)
    for i, v in enumerate(values):
        for k, name in enumerate(names):
            out[i, 2 * k + (0 if v is not None and name in v else 1)] = float(v is not None)
    return out


def node_array(flat: Flat) -> pa.Array:
    """array<node> of each sentence."""
    maps = pa.array([None if m is None else list(m.items()) for m in flat.morph.values], _STRINGS).take(pa.array(flat.morph.codes))
    fields = {
        "idx": pa.array(flat.idx, pa.int32()), "word": flat.words, "lemma": flat.lemma.array(pa.string()), "pos": flat.pos.array(pa.string()),
        "head": pa.array(flat.head, pa.int32()), "rel": flat.rel.array(pa.string()), "morph": maps,
    }
    return _list(flat.first, pa.StructArray.from_arrays(list(fields.values()), names=list(fields)))


def graph_array(flat: Flat, parent: np.ndarray, depth: np.ndarray, texts: pa.Array) -> pa.Array:
    """The graph of each sentence, see ``schemas.GRAPH``; nodes in pre-order, edges by (from, to)."""
    n, s = len(flat.idx), flat.sentence
    place = pre_order_places(flat, parent, depth)
    order = np.empty(n, np.int64)
    order[flat.first[s] + place] = np.arange(n)
    combined = flat.pos.codes[order] * max(1, len(flat.morph.values)) + flat.morph.codes[order]
    distinct, codes = np.unique(combined, return_inverse=True)
    pos_at, morph_at = np.divmod(distinct, max(1, len(flat.morph.values)))
    rows = np.hstack([_one_hot(flat.pos.values, POS)[pos_at], _morph_rows(flat.morph.values)[morph_at]])
    inner = np.flatnonzero(depth > 0)
    start, end = place[parent[inner]], place[inner]
    by = np.lexsort((end, start, s[inner]))
    inner, start, end = inner[by], start[by], end[by]
    edges = np.r_[0, np.cumsum(np.bincount(s[inner], minlength=len(flat.first) - 1))]
    texts_of_nodes = pa.StructArray.from_arrays([flat.words.take(pa.array(order)), flat.lemma.take(order).array(pa.string())], names=["word", "lemma"])
    trees = len(flat.first) - 1
    fields = {
        "node_features": _list(flat.first, _table(rows if len(rows) else np.zeros((1, len(POS) + 1 + 2 * len(MORPH))), codes)),
        "edge_features": _list(edges, _table(_one_hot(flat.rel.values, DEPENDENCIES), flat.rel.codes[inner])),
        "from_idx": _list(edges, pa.array(start, pa.int32())), "to_idx": _list(edges, pa.array(end, pa.int32())),
        "graph_idx": _list(flat.first, pa.array(np.zeros(n, np.int32))), "n_graphs": pa.array(np.ones(trees, np.int32)),
        "node_texts": _list(flat.first, texts_of_nodes), "node_features_need_word_embs_prepended": pa.array(np.ones(trees, bool)), "text": texts,
    }
    return pa.StructArray.from_arrays(list(fields.values()), names=list(fields))


def _solved(column: pa.Array, parsers: dict[str, FlatParser], sources: dict[str, str], least: int, most: int, graphs: bool) -> pa.Array:
    per_row = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    inner = column.flatten()
    lengths = pc.fill_null(pc.list_value_length(inner), 0).to_numpy(zero_copy_only=False)
    t = Tokens(np.r_[0, np.cumsum(lengths)].astype(np.int64), inner.flatten())
    flat, parent, depth, ok = checked(t, parsers, sources, least, most)
    texts = pc.binary_join(_list(t.first, t.words).filter(pa.array(ok)), " ") if len(ok) else pa.array([], pa.string())
    row = np.repeat(np.arange(len(per_row)), per_row)
    first = np.r_[0, np.cumsum(np.bincount(row[ok], minlength=len(per_row)))]
    if graphs:
        return _list(first, graph_array(flat, parent, depth, texts))
    return _list(first, pa.StructArray.from_arrays([texts, node_array(flat)], names=["text", "nodes"]))


def _solver(loaders: dict[str, Callable[[], FlatParser]], sources: dict[str, str], least: int, most: int, graphs: bool, outs: dict[str, str]):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        parsers = {name: load() for name, load in loaders.items()}  # once a task
        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                columns = batch.slice(at, ROWS_AT_ONCE).flatten()
                yield pa.StructArray.from_arrays([_solved(c, parsers, sources, least, most, graphs) for c in columns], names=list(outs))

    # not deterministic to the optimizer, which would else parse again for each filter on the result
    kind = ",".join(f"{out}:array<{GRAPH if graphs else TREE}>" for out in outs)
    return F.arrow_udf(run, f"struct<{kind}>").asNondeterministic()


TREE = f"struct<text:string,nodes:{NODES}>"


def with_parsed(rows: DataFrame, columns: dict[str, str], loaders: dict[str, Callable[[], FlatParser]], sources: dict[str, str], least: int, most: int, graphs: bool) -> DataFrame:
    """Adds for each (out, tokens) of ``columns`` an array of trees, struct<text, nodes>, or of graphs.

    ``tokens`` is an array of token arrays; sentences whose trees fail a check
    are left out, and null gives an empty array. All columns go to Python together.
    """
    solver = _solver(loaders, sources, least, most, graphs, columns)
    # a column that isn't deterministic stays one: the optimizer neither moves it into the function's argument nor makes it twice
    tokens = once(F.struct(*[F.col(c) for c in columns.values()]))
    rows = rows.withColumn("_tokens", tokens).drop(*columns.values()).withColumn("_parsed", solver(F.col("_tokens"))).drop("_tokens")
    return rows.withColumns({out: F.col("_parsed")[out] for out in columns}).drop("_parsed")
