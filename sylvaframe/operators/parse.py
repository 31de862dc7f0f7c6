"""Parser backends and the merge of several parsers' trees.

A backend turns an array of tokens into an array of nodes. The built-in ones are
Column expressions and also flat parsers (see ``flat``), which whole datasets
use; model backends (not available offline) are batch functions, loading their
model once per task. All backends see the same token lists, so their nodes meet
by idx.
"""

from __future__ import annotations

import importlib
import importlib.util
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bind
from ..functions.tree import _rebuilt, build_tree, by_idx, contents_ok, node, size_ok
from ..runtime import schema_with
from ..schemas import NODES
from .flat import FlatParser, Lexicon, chain_parser, from_lists, rule_parser

BACKENDS: dict[str, "Backend"] = {}
DETERMINERS = ("the", "a", "an", "this", "that", "le", "la", "les", "der", "die", "das", "el", "los")
ADPOSITIONS = ("of", "in", "on", "at", "by", "for", "with", "to", "from", "de", "en", "mit", "von", "par")
PRONOUNS = ("i", "you", "he", "she", "it", "we", "they", "who", "which")
CONJUNCTIONS = ("and", "or", "but", "et", "und", "y")


@dataclass(frozen=True)
class Backend:
    """``expression``: tokens to nodes as a Column; ``batch``: lists of tokens to lists of node mappings; ``flat``: all sentences' tokens to flat nodes."""

    name: str
    capabilities: frozenset[str]
    expression: Callable[[Column], Column] | None = None
    batch: Callable[[], Callable[[list[list[str]]], list]] | None = field(default=None)
    flat: Callable[[], FlatParser] | None = field(default=None)

    def flat_loader(self) -> Callable[[], FlatParser] | None:
        return self.flat or (from_lists(self.batch) if self.batch else None)

    def parse(self, tokens: Column) -> Column:
        if self.expression is None:
            raise ValueError(f"{self.name} runs in batches; use parse_batches")
        return self.expression(tokens)


def register(backend: Backend) -> Backend:
    BACKENDS[backend.name] = backend
    return backend


def tag(word: Column) -> Column:
    """Part of speech by word lists and endings."""
    low = F.lower(word)
    like = lambda p: F.regexp_like(low, F.lit(p))
    return (
        F.when(like(r"^[0-9]+$"), "NUM")
        .when(~like(r"[\p{L}\p{N}]"), "PUNCT")
        .when(low.isin(*DETERMINERS), "DET")
        .when(low.isin(*ADPOSITIONS), "ADP")
        .when(low.isin(*PRONOUNS), "PRON")
        .when(low.isin(*CONJUNCTIONS), "CCONJ")
        .when(like("..ly$"), "ADV")
        .when(like("..(ed|ing|es)$"), "VERB")
        .when(like("..(ble|ous|ful|ive)$"), "ADJ")
        .otherwise("NOUN")
    )


def lemma(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), "(?<=[a-z]{3})(ing|ed|es|s)$", "")


def morphology(word: Column, pos: Column) -> Column:
    plural = F.when(F.endswith(F.lower(word), F.lit("s")), "Plur").otherwise("Sing")
    tense = F.when(F.endswith(F.lower(word), F.lit("ed")), "Past").otherwise("Pres")
    return (
        F.when(pos == "NOUN", F.create_map(F.lit("Number"), plural))
        .when(pos == "VERB", F.create_map(F.lit("Tense"), tense, F.lit("VerbForm"), F.lit("Fin")))
        .otherwise(F.create_map().cast("map<string,string>"))
    )


def _relation(pos: Column, idx: Column, root: Column) -> Column:
    return (
        F.when(idx == root, "root")
        .when(pos == "DET", "det")
        .when(pos == "ADP", "case")
        .when(pos == "ADJ", "amod")
        .when(pos == "NUM", "nummod")
        .when(pos == "ADV", "advmod")
        .when(pos == "CCONJ", "cc")
        .when(pos == "PUNCT", "punct")
        .when(pos == "VERB", "conj")
        .when(idx < root, "nsubj")
        .otherwise("obj")
    )


def rule_nodes(tokens: Column) -> Column:
    """The first verb (else the first token) is the root; modifiers lean on the next token, all else on the root."""

    def with_tags(tags: Column) -> Column:
        verb = F.array_position(tags, "VERB").cast("int")
        root = F.when(verb > 0, verb).otherwise(F.lit(1))
        n = F.size(tags)

        def one(w: Column, i: Column) -> Column:
            idx, pos = i + 1, F.element_at(tags, i + 1)
            leans = pos.isin("DET", "ADP", "ADJ", "NUM", "CCONJ") & (idx < n)
            head = F.when(idx == root, 0).when(leans, idx + 1).otherwise(root)
            return node(idx, w, lemma(w), pos, head, _relation(pos, idx, root), morphology(w, pos))

        return F.transform(tokens, one)

    return bind(F.transform(tokens, tag), with_tags)


def chain_nodes(tokens: Column) -> Column:
    """Every token hangs on the one before it."""
    return F.transform(tokens, lambda w, i: node(i + 1, w, F.lower(w), tag(w), i, F.when(i == 0, "root").otherwise("dep")))


_LEXICON = Lexicon(DETERMINERS, ADPOSITIONS, PRONOUNS, CONJUNCTIONS)
register(Backend("rules", frozenset({"tree_structure", "dependency_labels", "pos_tags", "lemmas", "morph"}), rule_nodes, flat=rule_parser(_LEXICON)))
register(Backend("chain", frozenset({"tree_structure", "dependency_labels", "pos_tags", "lemmas"}), chain_nodes, flat=chain_parser(_LEXICON)))


def _pipeline_batch(model: str):
    def load():
        nlp = importlib.import_module("spacy").load(model)
        from spacy.tokens import Doc

        def run(lists: list[list[str]]) -> list:
            out = []
            for doc in nlp.pipe([Doc(nlp.vocab, words=ts) for ts in lists]):
                out.append(
                    [
                        {"idx": t.i + 1, "word": t.text, "lemma": t.lemma_, "pos": t.pos_, "head": 0 if t.head.i == t.i else t.head.i + 1, "rel": t.dep_, "morph": t.morph.to_dict()}
                        for t in doc
                    ]
                )
            return out

        return run

    return load


def conll_nodes(lines: str) -> list[dict]:
    """Nodes of one sentence in CoNLL-U columns; comments, word ranges and empty nodes are passed over."""
    out = []
    for line in lines.splitlines():
        cells = line.split("\t")
        if len(cells) < 8 or not cells[0].isdigit():
            continue
        given = lambda k: None if cells[k] in ("", "_") else cells[k]
        morph = dict(f.split("=", 1) for f in (given(5) or "").split("|") if "=" in f)
        out.append({"idx": int(cells[0]), "word": cells[1], "lemma": given(2), "pos": given(3), "head": int(cells[6]), "rel": given(7), "morph": morph})
    return out


def _biaffine_batch(model: str, batch_tokens: int = 50_000):
    """A biaffine parser, which prints its sentences as CoNLL; on a GPU if there is one."""

    def load():
        parser = importlib.import_module("diaparser.parsers").Parser.load(model)

        def run(lists: list[list[str]]) -> list:
            # an empty sentence would upset the model
            full = [ts for ts in lists if ts]
            parsed = iter(parser.predict(full, batch_size=batch_tokens, prob=False).sentences if full else [])
            return [conll_nodes(str(next(parsed))) if ts else [] for ts in lists]

        return run

    return load


def _installed(name: str) -> bool:
    return importlib.util.find_spec(name) is not None


def register_models() -> list[str]:
    """Registers the adapters of the model parsers that are installed, and gives their names."""
    found = []
    if _installed("spacy"):
        register(Backend("spacy", frozenset({"pos_tags", "lemmas", "morph", "ner", "tree_structure", "dependency_labels"}), batch=_pipeline_batch("en_core_web_sm")))
        found.append("spacy")
    if _installed("diaparser"):
        register(Backend("diaparser", frozenset({"tree_structure", "dependency_labels"}), batch=_biaffine_batch("en_ewt-electra")))
        found.append("diaparser")
    return found


register_models()


def gpu_profile(gpus: int = 1, cores: int = 1):
    """A resource profile whose tasks share ``gpus`` GPUs an executor, so that models meet on a GPU as often as it can bear."""
    from pyspark.resource import ExecutorResourceRequests, ResourceProfileBuilder, TaskResourceRequests

    executors = ExecutorResourceRequests().cores(cores).resource("gpu", gpus)
    return ResourceProfileBuilder().require(executors).require(TaskResourceRequests().cpus(1).resource("gpu", gpus / cores)).build


def parse_batches(df: DataFrame, tokens: str, backend: Backend, out: str, profile=None) -> DataFrame:
    """Adds ``out`` (array of node arrays) for ``tokens`` (array of token arrays) by a batch backend.

    ``profile``: a resource profile for the stage, see ``gpu_profile``.
    """
    schema = schema_with(df, out, f"array<{NODES}>")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parse = backend.batch()
        for rows in batches:
            lists = [[list(t) for t in ts] if ts is not None else [] for ts in rows[tokens]]
            flat = iter(parse([t for ts in lists for t in ts]))
            rows[out] = [[next(flat) for _ in ts] for ts in lists]
            yield rows

    return df.mapInPandas(run, schema, profile=profile)


#: Which parser gives what.
FEATURE_SOURCES = {"tree": "rules", "pos_tags": "rules", "morph": "rules", "lemmas": "rules", "deps": "rules"}
_NEEDS = {"tree": "tree_structure", "deps": "dependency_labels", "pos_tags": "pos_tags", "lemmas": "lemmas", "morph": "morph"}


def check_sources(sources: dict[str, str], parsers: list[str]) -> None:
    for feature, parser in sources.items():
        if parser not in parsers:
            raise ValueError(f"{feature} is to come from {parser!r}, which isn't enabled")
        if feature not in _NEEDS or _NEEDS[feature] not in BACKENDS[parser].capabilities:
            raise ValueError(f"{parser} doesn't give {feature}")


def merge_trees(trees: dict[str, Column], sources: dict[str, str]) -> Column:
    """The tree parser's nodes with features copied from the others' by idx.

    Null if any parser has no tree. A node the other parser lacks keeps its own
    value; morphology maps are merged, the copied one's values winning.
    """
    giver = {f: p for f, p in sources.items() if f != "tree" and p != sources["tree"]}
    others = sorted(set(giver.values()))

    def merged(x: Column) -> Column:
        def one(n: Column) -> Column:
            def copied(o: Column) -> Column:
                take = lambda feature, name: F.coalesce(o[giver[feature]][name], n[name]) if feature in giver else n[name]
                changed = {"pos": take("pos_tags", "pos"), "lemma": take("lemmas", "lemma"), "rel": take("deps", "rel")}
                if "morph" in giver:
                    given = o[giver["morph"]]["morph"]
                    own = F.map_filter(n["morph"], lambda k, _: ~F.map_contains_key(given, k))
                    changed["morph"] = F.when(n["morph"].isNull(), given).when(given.isNull(), n["morph"]).otherwise(F.map_concat(own, given))
                return _rebuilt(n, **changed)

            return bind(F.struct(*[by_idx(x[p], n["idx"]).alias(p) for p in others]), copied)

        present = F.lit(True)
        for p in trees:
            present = present & x[p].isNotNull()
        base = x[sources["tree"]]
        return F.when(present, F.transform(base, one) if others else base)

    return bind(F.struct(*[t.alias(p) for p, t in trees.items()]), merged)


def parse_sentence(tokens: Column, parsers: list[str], sources: dict[str, str], min_nodes: int = 3, max_nodes: int = 50) -> Column:
    """The merged, checked tree of a token list; null if it fails a check."""
    check_sources(sources, parsers)
    trees = {p: bind(BACKENDS[p].parse(tokens), build_tree) for p in parsers}
    merged = merge_trees(trees, sources) if len(parsers) > 1 else trees[parsers[0]]
    return bind(merged, lambda t: F.when(size_ok(t, min_nodes, max_nodes) & contents_ok(t), t))
