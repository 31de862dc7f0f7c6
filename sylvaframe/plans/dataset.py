"""From pairs of texts to grouped dependency graphs, as one lazy plan.

A text's sentences, tokens, trees and graphs stay arrays in the text's own row,
from the scan to the sink: nothing is exploded, so nothing has to be grouped
again, and the plan has no shuffle at all. Tables for other uses (one row a
sentence, say) come from exploding at the end.

Cleaning and tokens are built-in expressions; token lists then go to one Arrow
function, which gives the finished graphs, and no other column does. It is told
to the optimizer as not deterministic, so that a filter on its result does not
make it, and the cleaning below it, run twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions.subword import with_known_tokens
from ..functions.text import preprocess, regex_tokens, word_punct_tokens
from ..functions.tree import build_tree, contents_ok, size_ok, to_graph
from ..operators.flat import with_parsed
from ..operators.parse import BACKENDS, merge_trees, parse_batches, parse_sentence
from ..operators.prepare import clean_sentences, keep_group, keep_valid, map_labels, stable_id, without_processed
from ..schemas import GRAPH, NODES
from ..sources.readers import read_pairs


def tokenize(sentence: Column, config: Config) -> Column:
    p = config.preprocessing
    if p.tokenizer == "regex":
        return regex_tokens(sentence, p.min_token_length, p.max_token_length)
    return word_punct_tokens(sentence)


def valid_sentences(text: Column, config: Config) -> Column:
    """array<struct<sent_idx, tokens>> of the sentences that go to the parsers."""
    tokens = F.transform(clean_sentences(text, **config.preprocessing.options()), lambda s: tokenize(s, config))
    p = config.parser
    return keep_valid(tokens, p.min_tokens, p.max_tokens, p.max_trees)


def flat_loaders(config: Config) -> dict | None:
    """The flat parsers of the enabled backends; null if one has none."""
    found = {name: BACKENDS[name].flat_loader() for name in config.parser.parsers}
    return found if all(found.values()) else None


def _trees(rows: DataFrame, tokens: str, out: str, config: Config) -> DataFrame:
    """Adds ``out``: array<struct<text, nodes>> of the checked trees."""
    p = config.parser
    if all(BACKENDS[name].expression for name in p.parsers):
        parsed = F.transform(F.col(tokens), lambda t: F.struct(F.array_join(t, " ").alias("text"), parse_sentence(t, list(p.parsers), p.sources, p.min_nodes, p.max_nodes).alias("nodes")))
    else:
        for name in p.parsers:
            backend = BACKENDS[name]
            column = f"_{name}"
            rows = parse_batches(rows, tokens, backend, column) if backend.batch else rows.withColumn(column, F.transform(tokens, backend.parse))
        zipped = F.arrays_zip(F.col(tokens).alias("t"), *[F.col(f"_{n}").alias(n) for n in p.parsers])

        def merged(x: Column) -> Column:
            tree = merge_trees({n: build_tree(x[n]) for n in p.parsers}, p.sources)
            return F.struct(F.array_join(x["t"], " ").alias("text"), F.when(size_ok(tree, p.min_nodes, p.max_nodes) & contents_ok(tree), tree).alias("nodes"))

        parsed = F.transform(zipped, merged)
    kept = F.filter(parsed, lambda t: t["nodes"].isNotNull())
    done = rows.withColumn(out, F.coalesce(kept, F.array().cast(f"array<struct<text:string,nodes:{NODES}>>")))
    return done.drop(*[f"_{name}" for name in p.parsers])


def _with_tokens(rows: DataFrame, text: str, out: str, config: Config, vocabularies: list[set[str]] | None) -> DataFrame:
    """Adds ``out``: the token arrays of the sentences that go to the parsers."""
    p = config.parser
    found = F.transform(clean_sentences(F.col(text), **config.preprocessing.options()), lambda s: tokenize(s, config))
    rows = rows.withColumn(out, found)
    if config.preprocessing.tokenizer == "vocab":
        rows = with_known_tokens(rows, out, vocabularies or [])
    kept = keep_valid(F.col(out), p.min_tokens, p.max_tokens, p.max_trees)
    return rows.withColumn(out, F.transform(kept, lambda s: s["tokens"]))


def with_group_ids(pairs: DataFrame) -> DataFrame:
    """``pairs`` with a pair_id everywhere: where there is none, an id made of the contents."""
    own = stable_id(F.lit(None), F.col("text"), F.col("text_b"))
    return pairs.withColumn("pair_id", F.coalesce(F.col("pair_id").cast("string"), own))


def token_rows(pairs: DataFrame, config: Config = Config(), vocabularies: list[set[str]] | None = None) -> DataFrame:
    """(group_id, text, text_clean, text_b, text_b_clean, label, _a, _b): the last two hold the token lists that are parsed."""
    opts = config.preprocessing.options()
    rows = with_group_ids(pairs).select(
        F.col("pair_id").alias("group_id"),
        "text",
        preprocess(F.col("text"), **opts).alias("text_clean"),
        "text_b",
        preprocess(F.col("text_b"), **opts).alias("text_b_clean"),
        F.coalesce(F.col("label").cast("string"), F.lit("1")).alias("label"),
    )
    rows = _with_tokens(rows, "text", "_a", config, vocabularies)
    none = F.array().cast("array<array<string>>")
    return _with_tokens(rows, "text_b", "_b", config, vocabularies) if config.output.paired else rows.withColumn("_b", none)


def parse_pairs(pairs: DataFrame, config: Config = Config(), vocabularies: list[set[str]] | None = None) -> DataFrame:
    """(group_id, text, text_clean, text_b, text_b_clean, label, trees, trees_b): trees as node arrays.

    Without a pair_id the group gets an id made of its contents. A null text
    has no sentences. ``vocabularies`` are those of the tokenizer ``vocab``.
    """
    rows = token_rows(pairs, config, vocabularies)
    loaders, p = flat_loaders(config), config.parser
    if loaders:
        rows = with_parsed(rows, {"trees": "_a", "trees_b": "_b"}, loaders, p.sources, p.min_nodes, p.max_nodes, graphs=False)
    else:
        rows = _trees(_trees(rows, "_a", "trees", config), "_b", "trees_b", config)
    return rows.select("group_id", "text", "text_clean", "text_b", "text_b_clean", "label", "trees", "trees_b")


def kept_groups(rows: DataFrame, config: Config) -> DataFrame:
    """The groups that meet the keep rule, with labels mapped if the config says so."""
    kept = rows.where(keep_group(F.col("trees"), F.col("trees_b"), config.output.paired, config.output.self_paired))
    kept = kept.select("group_id", "text", "trees", "label", "text_b", "trees_b")
    o = config.output
    return map_labels(kept, "label", o.label_map, o.normalize) if o.label_map else kept


def to_groups(parsed: DataFrame, config: Config = Config()) -> DataFrame:
    """Groups of graphs, from trees as node arrays, that meet the keep rule; the label stays as it was given."""
    graphs = lambda c: F.transform(c, lambda t: to_graph(t["nodes"], t["text"])).cast(f"array<{GRAPH}>")
    return kept_groups(parsed.withColumns({"trees": graphs(F.col("trees")), "trees_b": graphs(F.col("trees_b"))}), config)


def build_dataset(
    pairs: DataFrame, config: Config = Config(), processed: DataFrame | None = None, vocabularies: list[set[str]] | None = None
) -> DataFrame:
    """Pairs to groups of graphs; pairs whose pair_id is in ``processed`` are left out."""
    if processed is not None:
        pairs = without_processed(pairs, processed, "pair_id")
    loaders = flat_loaders(config)
    if loaders is None:
        return to_groups(parse_pairs(pairs, config, vocabularies), config)
    p = config.parser
    rows = with_parsed(token_rows(pairs, config, vocabularies), {"trees": "_a", "trees_b": "_b"}, loaders, p.sources, p.min_nodes, p.max_nodes, graphs=True)
    return kept_groups(rows, config)


def dataset_from_files(spark: SparkSession, dataset_type: str, path: str, config: Config = Config(), **options) -> DataFrame:
    return build_dataset(read_pairs(spark, dataset_type, path, **options), config)


def sentence_stats(docs: DataFrame, config: Config = Config()) -> DataFrame:
    """Per document: sentences, valid and kept ones, kept tokens and the first kept sentence. One scan, no shuffle."""
    p = config.parser
    sents = docs.select("doc_id", F.coalesce(clean_sentences(F.col("text"), **config.preprocessing.options()), F.array().cast("array<string>")).alias("s"))
    tokens = sents.select("doc_id", "s", F.transform("s", lambda s: tokenize(s, config)).alias("t"))
    valid = tokens.select(
        "doc_id",
        "s",
        F.size(F.filter("t", lambda t: F.size(t).between(p.min_tokens, p.max_tokens))).alias("v"),
        keep_valid(F.col("t"), p.min_tokens, p.max_tokens, p.max_trees).alias("k"),
    )
    first = F.get("k", F.lit(0))["sent_idx"]
    return valid.select(
        "doc_id",
        F.size("s").cast("long").alias("n_sentences"),
        F.col("v").cast("long").alias("n_valid"),
        F.size("k").cast("long").alias("n_kept"),
        F.aggregate("k", F.lit(0), lambda acc, x: acc + F.size(x["tokens"])).cast("long").alias("kept_tokens"),
        F.get("s", first).alias("first_kept"),
    )
