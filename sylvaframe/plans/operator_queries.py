"""Registered queries of single operators: tokens and vocabularies, checks, JSON of trees, batch parsers, dimensions."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import tree as R
from ..functions.features import DEPENDENCIES, MORPH, POS, feature_dims
from ..functions.subword import keep_word, needs_split, segment_words, with_known_tokens
from ..operators.flat import with_parsed
from ..operators.parse import BACKENDS, Backend, check_sources
from ..runtime import map_rows, materialize, once
from . import sql as S
from .dataset import valid_sentences
from .registry import CONFIG, documents, joined, query, table


@query("word_punct_tokens", r"SELECT doc_id, array_to_string(regexp_extract_all(text, '[\p{L}\p{N}_]+(?:[''’][\p{L}\p{N}_]+)?|[^\s\p{L}\p{N}_]'), ' ') AS tokens FROM documents")
def word_punct_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", joined(T.word_punct_tokens(F.col("text"))).alias("tokens"))


@query(
    "short_words",
    f"""WITH l AS (SELECT chr((97 + i)::INTEGER) AS c FROM range(26) t(i)), w AS (SELECT a.c || b.c AS word FROM l a, l b UNION ALL SELECT c FROM l UNION ALL SELECT c || 'og' FROM l)
SELECT n_nationkey, word FROM nation, w WHERE n_nationkey = 0 AND (length(word) > 2 OR word IN ('am', 'an', 'as', 'at', 'ax', 'be', 'by', 'do', 'go', 'he', 'hi', 'if', 'in', 'is', 'it', 'me', 'my', 'no', 'of', 'oh', 'ok', 'on', 'or', 'ox', 'pi', 'so', 'to', 'up', 'us', 'we', 'i', 'a'))""",
)
def short_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of one and two letters, and some longer ones, against the filter."""
    letters = [chr(97 + i) for i in range(26)]
    words = [a + b for a in letters for b in letters] + letters + [a + "og" for a in letters]
    rows = table(spark, sf_dir, "nation").where("n_nationkey = 0").select("n_nationkey", F.explode(F.array(*map(F.lit, words))).alias("word"))
    return rows.where(keep_word(F.col("word")))


# -- splitting words ----------------------------------------------------------------------

#: Words of both vocabularies and how many of them hold each; distinct tokens of documents that are to be split.
_WORDS = f"""voc AS (SELECT word, count(*) AS weight FROM (SELECT DISTINCT 1 AS v, unnest({S.tokens("lower(p_name)", 1, 30)}) AS word FROM part UNION ALL
  SELECT DISTINCT 2, unnest({S.tokens("lower(text)", 1, 30)}) FROM benchmark) WHERE length(word) > 2 OR word IN ({S.SHORT_WORDS}) GROUP BY word),
toks AS (SELECT DISTINCT unnest({S.tokens(S.basic("text"))}) AS token FROM documents),
unknown AS (SELECT token FROM toks WHERE length(token) >= 5 AND NOT regexp_matches(regexp_replace(token, '^([^.]*)\\.', '\\1'), '^\\p{{Nd}}+$') AND token NOT IN (SELECT word FROM voc)),
longest AS (SELECT max(length(word)) AS m FROM voc)"""
#: The best full split of each string of ``wanted``.
_SPLIT = """seg AS (SELECT s, 0 AS done, []::VARCHAR[] AS parts, []::BIGINT[] AS weights, []::BIGINT[] AS sizes FROM wanted
  UNION ALL SELECT s, done + length(word), list_append(parts, word), list_append(weights, -weight), list_append(sizes, -length(word)) FROM seg, longest, LATERAL (SELECT unnest(range(1, m + 1)) AS n) l JOIN voc ON word = substr(s, done + 1, n) WHERE done + n <= length(s)),
split AS (SELECT s, arg_min(parts, (len(parts), weights, sizes)) AS parts FROM seg WHERE done = length(s) AND done > 0 GROUP BY s)"""
#: The longest known piece of each unknown token, with its remainders.
_GREEDY = """spots AS (SELECT token, i, n, weight, row_number() OVER (PARTITION BY token ORDER BY n DESC, weight DESC, i) AS r FROM unknown, longest, LATERAL (SELECT unnest(range(0, length(token))) AS i) a, LATERAL (SELECT unnest(range(1, m + 1)) AS n) b
  JOIN voc ON word = substr(token, i + 1, n) WHERE i + n <= length(token)),
greedy AS (SELECT u.token, CASE WHEN n IS NULL THEN [] WHEN length(u.token) > 8 AND length(u.token) - n > 5 AND n > 3 THEN [u.token]
  ELSE CASE WHEN i BETWEEN 1 AND 3 THEN [substr(u.token, 1, i)] ELSE [] END || [substr(u.token, i + 1, n)] || CASE WHEN length(u.token) - i - n BETWEEN 1 AND 3 THEN [substr(u.token, i + n + 1)] ELSE [] END END AS parts
  FROM unknown u LEFT JOIN (SELECT * FROM spots WHERE r = 1) s ON s.token = u.token)"""
_SEGMENTED = f"""RECURSIVE {_WORDS}, wanted AS (SELECT token AS s FROM unknown UNION SELECT regexp_replace(token, '\\p{{Nd}}+', '', 'g') FROM unknown),
{_SPLIT}, {_GREEDY}, segmented AS (SELECT u.token, coalesce(a.parts, b.parts, g.parts) AS parts FROM unknown u LEFT JOIN split a ON a.s = u.token
LEFT JOIN split b ON b.s = regexp_replace(u.token, '\\p{{Nd}}+', '', 'g') AND b.s <> u.token LEFT JOIN greedy g ON g.token = u.token)"""


def _vocabulary_frames(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    found = []
    for name, column in (("part", "p_name"), ("benchmark", "text")):
        words = table(spark, sf_dir, name).select(F.explode(T.regex_tokens(F.lower(F.col(column)), 1, 30)).alias("word"))
        found.append(words.where(keep_word(F.col("word"))).distinct())
    return found


def _vocabularies(spark: SparkSession, sf_dir: str) -> list[set[str]]:
    """The words of the names of parts and of the benchmark; these tables don't grow with the corpus."""
    return [{r["word"] for r in words.collect()} for words in _vocabulary_frames(spark, sf_dir)]


def _unknown(spark: SparkSession, sf_dir: str, vocabularies: list[set[str]]) -> DataFrame:
    tokens = documents(spark, sf_dir).select(F.explode(T.regex_tokens(T.basic(F.col("text")))).alias("token")).distinct()
    known = _vocabulary_frames(spark, sf_dir)
    words = known[0].unionByName(known[1]).distinct()
    return tokens.where(needs_split(F.col("token"), F.lit(False))).join(words, F.col("token") == F.col("word"), "left_anti")


@query("subword_dp", f"WITH {_SEGMENTED} SELECT token, array_to_string(parts, ' ') AS parts FROM segmented")
def subword_dp(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabularies = _vocabularies(spark, sf_dir)
    out = segment_words(_unknown(spark, sf_dir, vocabularies), vocabularies)
    return out.select("token", joined(F.col("parts")).alias("parts"))


@query("subword_greedy", f"WITH {_WORDS}, {_GREEDY} SELECT token, array_to_string(parts, ' ') AS parts FROM greedy")
def subword_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabularies = _vocabularies(spark, sf_dir)
    out = segment_words(_unknown(spark, sf_dir, vocabularies), vocabularies, greedy_only=True)
    return out.select("token", joined(F.col("parts")).alias("parts"))


@query(
    "vocabulary_tokenizer",
    f"""WITH {_SEGMENTED}, words AS (SELECT doc_id, unnest({S.tokens(S.basic("text"))}) AS token, generate_subscripts({S.tokens(S.basic("text"))}, 1) AS place FROM documents),
parts AS (SELECT doc_id, place, coalesce(s.parts, [w.token]) AS p FROM words w LEFT JOIN segmented s USING (token))
SELECT d.doc_id, coalesce(t, '') AS tokens FROM documents d LEFT JOIN (SELECT doc_id, string_agg(array_to_string(p, ' '), ' ' ORDER BY place) AS t FROM parts WHERE len(p) > 0 GROUP BY doc_id) USING (doc_id)""",
)
def vocabulary_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's tokens, unknown long ones split, those that can't be split left out."""
    rows = documents(spark, sf_dir).select("doc_id", F.array(T.regex_tokens(T.basic(F.col("text")))).alias("t"))
    return with_known_tokens(rows, "t", _vocabularies(spark, sf_dir)).select("doc_id", joined(F.flatten("t")).alias("tokens"))


@query("vocabulary_hits", f"WITH {_WORDS} SELECT count(*) AS n_tokens, count(word) AS n_hits, (SELECT max(length(word)) FROM voc)::INTEGER AS longest FROM toks LEFT JOIN voc ON token = word")
def vocabulary_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = documents(spark, sf_dir).select(F.explode(T.regex_tokens(T.basic(F.col("text")))).alias("token")).distinct()
    known = _vocabulary_frames(spark, sf_dir)
    words = known[0].unionByName(known[1]).distinct()
    hits = tokens.join(words, F.col("token") == F.col("word"), "left").agg(F.count(F.lit(1)).alias("n_tokens"), F.count("word").alias("n_hits"))
    return hits.crossJoin(F.broadcast(words.agg(F.max(F.length("word")).alias("longest"))))  # one row each


def _numbered_through():
    """Whether the lines of an order are numbered 1, 2, ... without gap or repeat."""
    return (F.size("x") == F.col("m")) & (F.size(F.array_distinct(F.transform("x", lambda n: n["l_linenumber"]))) == F.col("m"))


# -- trees -------------------------------------------------------------------------------------


@query("tree_contents", "SELECT l_orderkey, bool_and(l_returnflag <> 'N' AND (l_linenumber = 1 OR l_linestatus <> 'O')) AS ok FROM lineitem GROUP BY l_orderkey HAVING count(*) = max(l_linenumber) AND count(DISTINCT l_linenumber) = max(l_linenumber)")
def tree_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees that lack a part of speech (``_``) or a relation (empty) are told."""
    pos = F.when(F.col("l_returnflag") == "N", "_").otherwise(F.col("l_returnflag"))
    rel = F.when(F.col("l_linestatus") == "O", "").otherwise(F.col("l_linestatus"))
    lines = F.array_sort(F.collect_list(F.struct("l_linenumber", pos.alias("p"), rel.alias("r"))))
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(lines.alias("x"), F.max("l_linenumber").alias("m")).where(_numbered_through())
    nodes = F.transform("x", lambda n, i: R.node(i + 1, n["p"], n["p"], n["p"], i, n["r"]))
    return rows.select("l_orderkey", R.contents_ok(nodes).alias("ok"))


@query(
    "zero_based_documents",
    "SELECT l_orderkey, l_linenumber::INTEGER AS idx, (l_linenumber - 1)::INTEGER AS head, CASE l_linenumber WHEN 1 THEN 'root' ELSE l_linestatus END AS rel, l_returnflag AS word FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) = max(l_linenumber) AND count(DISTINCT l_linenumber) = max(l_linenumber))",
)
def zero_based_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag", "l_linestatus")))
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(lines.alias("x"), F.max("l_linenumber").alias("m")).where(_numbered_through())

    def token(t):
        dep = F.when(t["l_linenumber"] == 1, "ROOT").otherwise(t["l_linestatus"])
        fields = {"idx": t["l_linenumber"] - 1, "text": t["l_returnflag"], "lemma": t["l_returnflag"], "pos": t["l_returnflag"], "dep": dep, "head_idx": t["l_linenumber"] - 2, "morph": F.create_map().cast("map<string,string>")}
        return F.struct(*[c.alias(k) for k, c in fields.items()])

    nodes = R.build_tree(R.from_zero_based(F.transform("x", token)))
    return rows.select("l_orderkey", F.inline(nodes)).select("l_orderkey", "idx", "head", "rel", "word")


@query(
    "tree_json",
    f"WITH {S.SENTENCES}, {S.RULE_NODES} SELECT doc_id, sent_idx::INTEGER AS sent_idx, idx::INTEGER AS idx, head::INTEGER AS head, pos, rel, word, CASE pos WHEN 'NOUN' THEN 1 WHEN 'VERB' THEN 2 ELSE 0 END AS n_morph FROM headed",
)
def tree_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees to JSON and back, and each node once more."""
    rows = documents(spark, sf_dir).select("doc_id", valid_sentences(F.col("text"), CONFIG).alias("k"))
    rows = rows.select("doc_id", F.transform("k", lambda x: x["sent_idx"]).alias("at"), F.transform("k", lambda x: x["tokens"]).alias("tokens"))
    p = CONFIG.parser
    rows = with_parsed(rows, {"trees": "tokens"}, {"rules": BACKENDS["rules"].flat_loader()}, p.sources, p.min_nodes, p.max_nodes, graphs=False)
    rows = rows.select("doc_id", F.inline(F.arrays_zip(F.col("at").alias("sent_idx"), F.col("trees").alias("tree"))))
    rows = materialize(rows.select("doc_id", "sent_idx", R.tree_to_json(F.col("tree.nodes")).alias("json")), "trees")
    nodes = rows.select("doc_id", "sent_idx", F.explode(R.tree_from_json(F.col("json"))).alias("n"))
    again = nodes.select("doc_id", "sent_idx", R.node_from_json(R.node_to_json(F.col("n"))).alias("n"))
    return again.select("doc_id", "sent_idx", "n.idx", "n.head", "n.pos", "n.rel", "n.word", F.size("n.morph").alias("n_morph"))


def chain_lists():
    """A batch backend as a model's adapter would be: loaded once a task, lists of tokens to lists of node mappings."""

    def run(lists: list[list[str]]) -> list:
        return [[{"idx": i, "word": w, "lemma": w.lower(), "pos": "NOUN", "head": i - 1, "rel": "root" if i == 1 else "dep", "morph": {"Place": str(i)}} for i, w in enumerate(ts, 1)] for ts in lists]

    return run


@query(
    "batch_parser_merge",
    f"""WITH {S.SENTENCES}, {S.RULE_NODES} SELECT doc_id, sent_idx::INTEGER AS sent_idx, idx::INTEGER AS idx, head::INTEGER AS head, 'NOUN' AS pos, rel, idx::VARCHAR AS place FROM headed""",
)
def batch_parser_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch backend beside the rules: tags and morphology come from it, the tree from the rules."""
    lists = Backend("lists", frozenset({"tree_structure", "dependency_labels", "pos_tags", "lemmas", "morph"}), batch=chain_lists)
    sources = {"tree": "rules", "deps": "rules", "pos_tags": "lists", "lemmas": "rules", "morph": "lists"}
    rows = documents(spark, sf_dir).select("doc_id", valid_sentences(F.col("text"), CONFIG).alias("k"))
    rows = rows.select("doc_id", F.transform("k", lambda x: x["sent_idx"]).alias("at"), F.transform("k", lambda x: x["tokens"]).alias("tokens"))
    rows = with_parsed(rows, {"trees": "tokens"}, {"rules": BACKENDS["rules"].flat_loader(), "lists": lists.flat_loader()}, sources, CONFIG.parser.min_nodes, CONFIG.parser.max_nodes, graphs=False)
    rows = rows.select("doc_id", F.inline(F.arrays_zip(F.col("at").alias("sent_idx"), F.col("trees").alias("tree"))))
    nodes = rows.select("doc_id", "sent_idx", F.inline("tree.nodes"))
    return nodes.select("doc_id", "sent_idx", "idx", "head", "pos", "rel", F.col("morph")["Place"].alias("place"))


# -- settings and plumbing --------------------------------------------------------------------------


@query(
    "feature_sources",
    "SELECT feature, parser, NOT (feature = 'morph' AND parser = 'chain') AND parser <> 'none' AS ok FROM (VALUES ('tree'), ('deps'), ('pos_tags'), ('lemmas'), ('morph')) f(feature), (VALUES ('rules'), ('chain'), ('none')) p(parser)",
)
def feature_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which parser may give which feature; a fixed table, as the check runs before any data is read."""

    def ok(feature: str, parser: str) -> bool:
        try:
            check_sources({feature: parser}, ["rules", "chain"])
        except ValueError:
            return False
        return True

    rows = [(f, p, ok(f, p)) for f in ("tree", "deps", "pos_tags", "lemmas", "morph") for p in ("rules", "chain", "none")]
    return spark.createDataFrame(rows, "feature string, parser string, ok boolean")


@query("feature_widths", f"SELECT e AS embedding, (e + {len(POS) + 1} + {2 * len(MORPH)})::INTEGER AS node, {len(DEPENDENCIES) + 1} AS edge FROM (VALUES (0), (8), (768)) v(e)")
def feature_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(e, feature_dims(e)["node"], feature_dims(e)["edge"]) for e in (0, 8, 768)]
    return spark.createDataFrame(rows, "embedding int, node int, edge int")


@query("batch_map", "SELECT doc_id, length(text)::BIGINT + length(lang) AS n FROM documents")
def batch_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any function of a row's values, mapped in batches."""
    rows = map_rows(documents(spark, sf_dir, "doc_id", "text", "lang"), "n", "bigint", lambda: lambda text, lang: len(text) + len(lang), "text", "lang")
    return rows.select("doc_id", "n")


@query("first_valid_sentences", f"WITH {S.SENTENCES} SELECT doc_id, count(*)::INTEGER AS n FROM ranked WHERE rn <= 3 GROUP BY doc_id")
def first_valid_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many valid sentences as are asked for, three here; the limit is the feature."""
    config = replace(CONFIG, parser=replace(CONFIG.parser, max_trees=3))
    return documents(spark, sf_dir).select("doc_id", once(F.size(valid_sentences(F.col("text"), config))).alias("n")).where("n > 0")
