"""The registered queries over the driver's tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import load_config
from ..functions import text as T
from ..functions import tree as R
from ..functions.features import DEPENDENCIES, MORPH, POS, edge_features, morph_vector, one_hot
from ..functions.subword import keep_word
from ..functions.viz import tree_dot, with_pair_text, with_tree_text
from ..operators import contrast, embed, sharding
from ..operators.flat import with_parsed
from ..operators.parse import BACKENDS, chain_nodes
from ..operators.prepare import clean_sentences, filter_groups, in_vocabulary, keep_valid, map_labels, project_pairs, skip_rate, without_processed
from ..operators.ranking import ranked
from ..runtime import GROUPS_AT_ONCE, materialize, once, scratch_path
from ..schemas import GROUP
from ..sources.readers import question_fields, read_group_documents, read_pairs
from ..sources.writers import document_of, merge_documents, write_part_documents
from ..streaming.ingest import ingest
from . import file_queries, operator_queries  # noqa: F401  (they register theirs)
from . import sql as S
from .dataset import build_dataset, sentence_stats, valid_sentences
from .registry import CONFIG, ORACLES, QUERIES, documents, joined, query, table  # noqa: F401

# -- text --------------------------------------------------------------------------


@query(
    "flagship_sentence_stats",
    f"""WITH {S.SENTENCES}
SELECT d.doc_id, coalesce(a.n, 0)::BIGINT AS n_sentences, coalesce(v.n, 0)::BIGINT AS n_valid, coalesce(k.n, 0)::BIGINT AS n_kept, coalesce(k.toks, 0)::BIGINT AS kept_tokens, k.first_kept
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM rows GROUP BY doc_id) a USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM ranked GROUP BY doc_id) v USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n, sum(len(t)) AS toks, arg_min(s, sent_idx) AS first_kept FROM kept GROUP BY doc_id) k USING (doc_id)""",
)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_stats(documents(spark, sf_dir), CONFIG)


def _preprocess(name: str, oracle: str, **options) -> None:
    @query(name, f"SELECT doc_id, {oracle} AS clean FROM documents")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return documents(spark, sf_dir).select("doc_id", T.preprocess(F.col("text"), **options).alias("clean"))


_preprocess("preprocess_l0", "text", strictness=0)
_preprocess("preprocess_l1", S.basic("text"), strictness=1)
_preprocess("preprocess_l1_nopunct", S.basic("text", no_punct=True), strictness=1, remove_punctuation=True)
_preprocess("preprocess_l1_keepcase", S.basic("text", keep_case=True), strictness=1, preserve_case=True)
_preprocess("preprocess_l2", S.level2("text"), strictness=2)
_preprocess("preprocess_l3", f"lower({S.level2('text')})", strictness=3)

_ABBREVIATED = "concat('see fig.', doc_id, ' i.e.', doc_id, ' i e the e g x etc.', doc_id, ' ', text)"


@query("abbreviation_cleanup", f"SELECT doc_id, {S.level2(_ABBREVIATED)} AS clean FROM documents")
def abbreviation_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("doc_id", F.expr(_ABBREVIATED).alias("t"))
    return rows.select("doc_id", T.preprocess(F.col("t")).alias("clean"))


@query(
    "sentence_split",
    f"""WITH p AS (SELECT doc_id, {S.pieces("text")} AS p FROM documents), r AS (SELECT doc_id, {S.sentences_of("p")} AS r FROM p)
SELECT doc_id, (generate_subscripts(r, 1) - 1)::INTEGER AS sent_idx, unnest(r) AS sentence FROM r""",
)
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("sent_idx", "sentence"))


@query(
    "sentence_count",
    f"""WITH p AS (SELECT conv_id, turn, {S.pieces("text")} AS p FROM conversations)
SELECT conv_id, turn, len({S.sentences_of("p")})::INTEGER AS n_sentences FROM p""",
)
def sentence_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.size(T.sentences(F.col("text"))).alias("n_sentences"))


@query("regex_tokens", f"SELECT doc_id, len({S.tokens('text', 0, 10**6)})::INTEGER AS n_tokens, array_to_string({S.tokens('text', 0, 10**6)}, ' ') AS tokens FROM documents")
def regex_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("doc_id", T.regex_tokens(F.col("text"), 0, 10**6).alias("t"))
    return rows.select("doc_id", F.size("t").alias("n_tokens"), joined(F.col("t")).alias("tokens"))


@query("token_len_filter", f"SELECT doc_id, len({S.tokens('text', 3, 8)})::INTEGER AS n_tokens, len({S.tokens('text')})::INTEGER AS n_all FROM documents")
def token_len_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.size(T.regex_tokens(text, 3, 8)).alias("n_tokens"), F.size(T.regex_tokens(text)).alias("n_all"))


@query("token_freq", f"SELECT token, count(*) AS n FROM (SELECT unnest({S.tokens(S.basic('text'))}) AS token FROM documents) GROUP BY token")
def token_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select(F.explode(T.regex_tokens(T.basic(F.col("text")))).alias("token"))
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


_NUMERIC = r"regexp_matches(regexp_replace(props, '^([^.]*)\.', '\1'), '^[0-9]+$')"


@query(
    "number_tokens",
    r"""SELECT event_id, regexp_matches(regexp_replace(value::DECIMAL(18,2)::VARCHAR, '^([^.]*)\.', '\1'), '^[0-9]+$') AS is_number, regexp_matches(regexp_replace(props, '^([^.]*)\.', '\1'), '^[0-9]+$') AS json_is_number,
regexp_replace(props, '[0-9]+', '', 'g') AS bare FROM events""",
)
def number_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value").cast("decimal(18,2)").cast("string")
    return table(spark, sf_dir, "events").select("event_id", T.is_number(value).alias("is_number"), T.is_number(F.col("props")).alias("json_is_number"), T.without_digits(F.col("props")).alias("bare"))


@query("valid_sentences_top10", f"WITH {S.SENTENCES} SELECT doc_id, sent_idx::INTEGER AS sent_idx, len(t)::INTEGER AS n_tokens, array_to_string(t, ' ') AS tokens FROM kept")
def valid_sentences_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("doc_id", F.inline(valid_sentences(F.col("text"), CONFIG)))
    return rows.select("doc_id", "sent_idx", F.size("tokens").alias("n_tokens"), joined(F.col("tokens")).alias("tokens"))


@query("morph_parse", "SELECT DISTINCT l_returnflag, l_linestatus, l_returnflag AS flag, l_linestatus AS status FROM lineitem")
def morph_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").distinct()
    parsed = T.morph_map(F.concat(F.lit("Flag="), F.col("l_returnflag"), F.lit("|Status="), F.col("l_linestatus")))
    return rows.select("l_returnflag", "l_linestatus", parsed["Flag"].alias("flag"), parsed["Status"].alias("status"))


# -- questions and answers -----------------------------------------------------------

_ENDS = r"regexp_matches(rtrim(text, E' \n\t\r'), '[.!?]$')"
_REPAIRED = rf"CASE WHEN {_ENDS} THEN text ELSE rtrim(text, E' \n\t\r') || CASE WHEN contains(text, '?') THEN '?' ELSE '.' END END"


@query(
    "question_end_punct",
    f"SELECT conv_id, turn, {_ENDS.replace('text', 'q')} AS ends, {_REPAIRED.replace('text', 'q')} AS repaired FROM (SELECT *, CASE WHEN turn % 2 = 0 THEN text ELSE rtrim(text, '.') || ' ' END AS q FROM conversations)",
)
def question_end_punct(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.when(F.col("turn") % 2 == 0, F.col("text")).otherwise(F.concat(F.rtrim(F.col("text"), F.lit(".")), F.lit(" ")))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", q.alias("q"))
    return rows.select("conv_id", "turn", T.ends_sentence(F.col("q")).alias("ends"), T.repair_question(F.col("q")).alias("repaired"))


def _by_role(role: str) -> Column:
    turns = F.array_sort(F.collect_list(F.when(F.col("role") == role, F.struct("turn", "text"))))
    return F.transform(turns, lambda x: x["text"])


@query(
    "qa_groups",
    f"""WITH r AS (SELECT conv_id, role, turn, {_REPAIRED} AS q, CASE WHEN {_ENDS} THEN text ELSE rtrim(text, E' \\n\\t\\r') || '.' END AS a, text FROM conversations),
g AS (SELECT conv_id, string_agg(q, ' ' ORDER BY turn, text) FILTER (role = 'user') AS qs, string_agg(a, ' ' ORDER BY turn, text) FILTER (role = 'assistant') AS "as",
  coalesce(bool_or(text <> '') FILTER (role = 'assistant'), false) AS has_answer FROM r GROUP BY conv_id)
SELECT conv_id, 'group_' || (row_number() OVER (ORDER BY conv_id) - 1) AS group_id, qs || ' ' || "as" AS text FROM g WHERE has_answer AND qs IS NOT NULL""",
)
def qa_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").where(F.col("role").isin("user", "assistant") & F.col("text").isNotNull())
    gathered = turns.groupBy("conv_id").agg(_by_role("user").alias("q"), _by_role("assistant").alias("a"))
    kept = gathered.where((F.size("q") > 0) & F.exists("a", lambda x: x != ""))
    texts = F.concat(F.transform("q", T.repair_question), F.transform("a", T.repair_answer))
    numbered = ranked(kept.select("conv_id", joined(texts).alias("text")), [], "conv_id", [])
    return numbered.select("conv_id", F.concat(F.lit("group_"), (F.col("rank") - 1).cast("string")).alias("group_id"), "text")


@query(
    "question_groups",
    """WITH g AS (SELECT conv_id, string_agg(substr(role || ':' || regexp_replace(text, '\\s+', ' ', 'g'), 1), chr(9) ORDER BY turn) AS n, count(*) FILTER (role IN ('user', 'assistant')) AS k,
string_agg(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ' ORDER BY turn, text) FILTER (role IN ('user', 'assistant')) AS text FROM conversations GROUP BY conv_id)
SELECT conv_id, k::INTEGER AS n_fields, text FROM g WHERE k >= 2""",
)
def question_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = F.when(F.col("role") == "user", "q:").when(F.col("role") == "assistant", "a:").otherwise("s:")
    field = F.concat(mark, F.regexp_replace("text", r"\s+", " "))
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", "text", field.alias("f")).alias("x"))
    lines = turns.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["f"]), "\t").alias("line"))
    fields = lines.select("conv_id", question_fields(F.col("line")).alias("f")).where(F.size("f") >= 2)
    return fields.select("conv_id", F.size("f").alias("n_fields"), F.array_join(F.transform("f", lambda x: F.trim(x)), " ").alias("text"))


# -- pairs, labels, joins --------------------------------------------------------------


@query("pairs_labelled", "SELECT doc_id::VARCHAR AS pair_id, text, '' AS text_b, coalesce(quality::VARCHAR, '1') AS label FROM documents LEFT JOIN labels USING (doc_id)")
def pairs_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return project_pairs(docs.join(table(spark, sf_dir, "labels"), "doc_id", "left"), "doc_id", "text", None, "quality")


@query("label_map_normalize", "SELECT doc_id, lab AS label, ((CASE lab WHEN 'good' THEN 1.0 ELSE 0.0 END)::DOUBLE + 2.5::DOUBLE) / 2.5::DOUBLE AS mapped FROM (SELECT doc_id, CASE WHEN toxic = 1 THEN '-' WHEN quality = 1 THEN 'good' ELSE 'bad' END AS lab FROM labels) WHERE lab <> '-'")
def label_map_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_labels(_named_labels(spark, sf_dir), "label", {"good": 1.0, "bad": 0.0}, (-2.5, 2.5)).select("doc_id", "label", "mapped")


def _named_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("toxic") == 1, "-").when(F.col("quality") == 1, "good").otherwise("bad")
    return table(spark, sf_dir, "labels").select("doc_id", name.alias("label"))


@query("label_skip_rate", "SELECT count(*) AS n_rows, count(*) FILTER (toxic = 1) AS n_skipped, (count(*) FILTER (toxic = 1))::DOUBLE * 100.0::DOUBLE / count(*)::DOUBLE AS percent FROM labels")
def label_skip_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skip_rate(_named_labels(spark, sf_dir), "label").withColumn("percent", F.col("percent").cast("double"))


@query("processed_anti", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def processed_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_processed(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


@query(
    "vocab_semi",
    f"""WITH t AS (SELECT unnest({S.tokens(S.basic('text'))}) AS token FROM documents), v AS (SELECT DISTINCT unnest({S.tokens(S.basic('text'))}) AS word FROM benchmark)
SELECT token, count(*) AS n FROM t WHERE token IN (SELECT word FROM v WHERE length(word) > 2 OR word IN ({S.SHORT_WORDS})) GROUP BY token""",
)
def vocab_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "benchmark").select(F.explode(T.regex_tokens(T.basic(F.col("text")))).alias("word"))
    words = words.where(keep_word(F.col("word")))
    # counted first: what meets the vocabulary is one row a distinct token
    return in_vocabulary(token_freq(spark, sf_dir), words)


@query("union_partitions", "SELECT doc_id, lang, source FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, lang, source FROM documents WHERE doc_id % 2 = 1")
def union_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merge_documents([docs.where(F.col("doc_id") % 2 == k).select("doc_id", "lang", "source") for k in (0, 1)])


@query("dedupe_ids", "SELECT DISTINCT conv_id FROM conversations")
def dedupe_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id").dropDuplicates(["conv_id"])


@query("triplets", "SELECT a.n_nationkey AS anchor, p.n_nationkey AS positive, n.n_nationkey AS negative FROM nation a JOIN nation p ON a.n_regionkey = p.n_regionkey AND a.n_nationkey <> p.n_nationkey JOIN nation n ON n.n_regionkey <> a.n_regionkey")
def triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contrast.organize(table(spark, sf_dir, "nation"), "triplet", "n_nationkey", "n_regionkey")


@query("contrast_pools", "SELECT doc_id AS anchor, count(*) OVER (PARTITION BY quality) - 1 AS n_positive, (SELECT count(*) FROM labels) - count(*) OVER (PARTITION BY quality) AS n_negative FROM labels")
def contrast_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contrast.organize(table(spark, sf_dir, "labels"), "infonce", "doc_id", "quality")


# -- features ----------------------------------------------------------------------------


def _bits(vector: Column) -> Column:
    return F.array_join(F.transform(vector, lambda x: x.cast("int").cast("string")), "")


def _slots(name: str, kind: str, names: tuple[str, ...]) -> None:
    listed = "[" + ", ".join(f"'{n}'" for n in names) + "]"
    n = len(names)

    @query(name, f"""SELECT o_orderkey, v AS value, repeat('0', s) || '1' || repeat('0', {n} - s) AS bits FROM (SELECT o_orderkey, v, coalesce(nullif(list_position({listed}, v), 0) - 1, {n}) AS s
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % {n + 3} < {n} THEN {listed}[(o_orderkey % {n + 3})::INTEGER + 1] ELSE o_orderpriority END AS v FROM orders))""")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        at = F.col("o_orderkey") % (n + 3)
        value = F.when(at < n, F.get(F.array(*map(F.lit, names)), at.cast("int"))).otherwise(F.col("o_orderpriority"))
        rows = table(spark, sf_dir, "orders").select("o_orderkey", value.alias("value"))
        return rows.select("o_orderkey", "value", _bits(one_hot(F.col("value"), kind)).alias("bits"))


_slots("pos_onehot", "pos_tags", POS)
_slots("dep_onehot", "dep_types", DEPENDENCIES)


@query("morph_vec", "SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN '000000000000000000' ELSE (CASE WHEN p_size % 2 = 0 THEN '10' ELSE '01' END) || '0101' || '01' || (CASE WHEN p_size % 3 = 0 THEN '10' ELSE '01' END) || '01010101' END AS bits FROM part")
def morph_vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    given = F.map_filter(F.create_map(F.lit(MORPH[0]), size % 2, F.lit(MORPH[4]), size % 3), lambda _, v: v == 0)
    return table(spark, sf_dir, "part").select("p_partkey", _bits(morph_vector(F.when(size % 7 != 0, given))).alias("bits"))


@query("embedding_lookup", "SELECT event_id, 'w' || user_id AS word, embedding IS NOT NULL AS hit, coalesce(embedding[1], 0)::DOUBLE AS first FROM events LEFT JOIN embeddings ON 'w' || user_id = 'w' || (vec_id * 2)")
def embedding_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = table(spark, sf_dir, "embeddings").select(F.concat(F.lit("w"), (F.col("vec_id") * 2).cast("string")).alias("word"), "embedding")
    words = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("w"), F.col("user_id").cast("string")).alias("word"))
    found = embed.lookup(words, cache)
    return found.select("event_id", "word", F.col("embedding").isNotNull().alias("hit"), F.coalesce(F.get("embedding", F.lit(0)), F.lit(0.0)).cast("double").alias("first"))


@query("embedding_misses", "SELECT DISTINCT 'w' || user_id AS word FROM events WHERE 'w' || user_id NOT IN (SELECT 'w' || (vec_id * 2) FROM embeddings)")
def embedding_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = table(spark, sf_dir, "embeddings").select(F.concat(F.lit("w"), (F.col("vec_id") * 2).cast("string")).alias("word"), "embedding")
    words = table(spark, sf_dir, "events").select(F.concat(F.lit("w"), F.col("user_id").cast("string")).alias("word"))
    return embed.misses(words, cache)


@query("embedding_fill", f"SELECT count(DISTINCT token) AS n_words, count(DISTINCT token) AS n_cached, 64 AS dim FROM (SELECT unnest({S.tokens(S.basic('text'))}) AS token FROM documents)")
def embedding_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = documents(spark, sf_dir).select(F.explode(T.regex_tokens(T.basic(F.col("text")))).alias("word")).distinct()
    words = materialize(words, "words")  # the texts are gone through once, not for each fill and the lookup
    path = scratch_path(spark, "embedding-cache")
    cache = embed.EmbeddingCache(spark, "embedding_cache_" + path.rsplit("-", 1)[-1], path, 4)
    for _ in range(2):  # the second time finds nothing to do
        cache.fill(words, embed.hash_encoder(64))
    found = embed.lookup(words, cache.read())
    return found.agg(F.count(F.lit(1)).alias("n_words"), F.count("embedding").alias("n_cached"), F.max(F.size("embedding")).alias("dim"))


# -- batches, splits, shards -----------------------------------------------------------------

_BATCHES = 100
_PARTS = 7


@query(
    "batch_assign",
    f"""WITH b AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS ordinal, count(*) OVER () AS total FROM orders),
c AS (SELECT o_orderkey, ordinal // {_BATCHES} AS batch_idx, (total + {_BATCHES} - 1) // {_BATCHES} AS n FROM b),
d AS (SELECT batch_idx, ntile({_PARTS}) OVER (ORDER BY batch_idx) - 1 AS part FROM (SELECT DISTINCT batch_idx FROM c))
SELECT o_orderkey, batch_idx, part FROM c JOIN d USING (batch_idx)""",
)
def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    numbered = ranked(orders, [], "o_orderkey", []).select("o_orderkey", (F.col("rank") - 1).alias("ordinal"))
    return sharding.batches(numbered, "ordinal", orders.count(), _BATCHES, _PARTS).select("o_orderkey", "batch_idx", "part")


@query(
    "batch_partition_sizes",
    f"""WITH b AS (SELECT DISTINCT (row_number() OVER (ORDER BY o_orderkey) - 1) // {_BATCHES} AS batch_idx FROM orders), p AS (SELECT batch_idx, ntile({_PARTS}) OVER (ORDER BY batch_idx) - 1 AS part FROM b)
SELECT part, count(*) AS n_batches, min(batch_idx) AS first_batch FROM p GROUP BY part""",
)
def batch_partition_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = batch_assign(spark, sf_dir).select("batch_idx", "part").distinct()
    return rows.groupBy("part").agg(F.count(F.lit(1)).alias("n_batches"), F.min("batch_idx").alias("first_batch"))


_SPLIT_SQL = """
hashed AS (SELECT doc_id, source, (((doc_id % 2147483648) * 2654435761) + 42) % 4294967296 AS h FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id) AS r, count(*) OVER (PARTITION BY source) AS n FROM hashed),
cut AS (SELECT *, floor(n * 0.8::DOUBLE)::BIGINT AS a, floor(n * 0.1::DOUBLE)::BIGINT AS b FROM placed),
named AS (SELECT *, CASE WHEN r <= a THEN 'train' WHEN r <= a + b THEN 'dev' ELSE 'test' END AS split, r - CASE WHEN r <= a THEN 0 WHEN r <= a + b THEN a ELSE a + b END AS k FROM cut)
"""


@query("split_train_dev_test", f"WITH {_SPLIT_SQL} SELECT doc_id, source, split, k - 1 AS ordinal, (k - 1) // 10 AS shard_index FROM named")
def split_train_dev_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return sharding.split_and_shard(docs, "doc_id", ["source"], 10)


@query("split_totals", f"WITH {_SPLIT_SQL} SELECT split, count(*) AS n_groups, count(DISTINCT source || '/' || ((k - 1) // 10)) AS n_shards FROM named GROUP BY split")
def split_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = split_train_dev_test(spark, sf_dir).groupBy("source", "split", "shard_index").agg(F.count(F.lit(1)).alias("n"))
    return shards.groupBy("split").agg(F.sum("n").alias("n_groups"), F.count(F.lit(1)).alias("n_shards"))


@query(
    "shard_groups",
    """SELECT doc_id, s AS shard_index, (n + 499) // 500 AS total_shards, s * 500 AS start_idx, least((s + 1) * 500, n) AS end_idx, 'part_3_shard_' || lpad(s::VARCHAR, 6, '0') || '.txt' AS file_name, s::VARCHAR || '03' AS part_no
FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 500 AS s, count(*) OVER () AS n FROM documents)""",
)
def shard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_in_order(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    shard = F.col("shard_index")
    return out.withColumns({"file_name": sharding.shard_file_name(F.lit(""), shard, part=F.lit(3)), "part_no": sharding.embedded_part(shard, F.lit(3))})


def _sized_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups whose trees are the kept sentences' token lists; only their number matters here."""
    docs = documents(spark, sf_dir, "doc_id", "source", "text").select("doc_id", "source", valid_sentences(F.col("text"), CONFIG).alias("k"))
    return docs.select("doc_id", "source", F.coalesce(F.transform("k", lambda s: s["sent_idx"]), F.array().cast("array<int>")).alias("trees"), F.array().cast("array<int>").alias("trees_b"))


@query(
    "group_filter_min_trees",
    f"WITH {S.SENTENCES}, g AS (SELECT doc_id, count(*) AS n FROM kept GROUP BY doc_id) SELECT doc_id AS group_id, n::INTEGER AS n_trees FROM g WHERE n >= 2",
)
def group_filter_min_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = _sized_groups(spark, sf_dir).withColumn("trees", once(F.col("trees")))
    kept = filter_groups(groups, 2, ["source"], {"doc_id": "group_id"})
    return kept.select("group_id", F.size("trees").alias("n_trees"))


@query(
    "shard_counts",
    f"""WITH {S.SENTENCES}, {_SPLIT_SQL}, g AS (SELECT n2.source, n2.split, n2.k, (n2.k - 1) // 10 AS shard_index, coalesce(c.n, 0) AS n FROM named n2 LEFT JOIN (SELECT doc_id, count(*) AS n FROM kept GROUP BY doc_id) c USING (doc_id))
SELECT source, split, shard_index, count(*) AS n_groups, string_agg(n::VARCHAR, ',' ORDER BY k) AS trees, string_agg('0', ',') AS trees_b FROM g GROUP BY source, split, shard_index""",
)
def shard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.split_and_shard(_sized_groups(spark, sf_dir), "doc_id", ["source"], 10)
    counts = sharding.shard_counts(sharded, "source", "split", "shard_index")
    return counts.select("source", "split", "shard_index", "n_groups", joined(F.col("trees_per_group"), ",").alias("trees"), joined(F.col("trees_b_per_group"), ",").alias("trees_b"))


# -- trees -------------------------------------------------------------------------------------


def _heap_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each part size n a tree of n nodes whose node i hangs on i div 2."""
    sizes = table(spark, sf_dir, "part").select(F.col("p_size").alias("n")).distinct()
    name = lambda i: F.concat(F.lit("w"), i.cast("string"))
    made = F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: R.node(i, name(i), name(i), F.lit("NOUN"), F.floor(i / 2), F.when(i == 1, "root").otherwise("dep")))
    return sizes.select("n", made.alias("nodes"))


_HEAP = """RECURSIVE sizes AS (SELECT DISTINCT p_size AS n FROM part),
walk AS (SELECT n, 1 AS idx, [1] AS path FROM sizes UNION ALL SELECT n, c, list_append(path, c) FROM walk, (VALUES (0), (1)) v(k), LATERAL (SELECT idx * 2 + k AS c) x WHERE c <= n)"""


def _order_query(name: str, order: Callable[[Column], Column], key: str) -> None:
    @query(name, f"WITH {_HEAP} SELECT n, (row_number() OVER (PARTITION BY n ORDER BY {key}) - 1)::INTEGER AS place, idx FROM walk")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _heap_trees(spark, sf_dir).select("n", F.posexplode(order(F.col("nodes"))).alias("place", "idx"))


_order_query("tree_preorder", R.pre_order, "path")
_order_query("tree_postorder", R.post_order, "list_append(path, 2147483647)")
_order_query("tree_levelorder", R.level_order, "len(path), path")


@query(
    "tree_shape",
    f"""WITH {_HEAP}, s AS (SELECT a.n, a.idx, count(*) AS size FROM walk a JOIN walk b ON a.n = b.n AND list_contains(b.path, a.idx) GROUP BY a.n, a.idx)
SELECT s.n, s.idx, s.size::INTEGER AS size, (max(len(w.path)) OVER (PARTITION BY s.n))::INTEGER AS height, true AS is_tree FROM s JOIN walk w ON s.n = w.n AND s.idx = w.idx""",
)
def tree_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = F.col("nodes")
    rows = _heap_trees(spark, sf_dir).select("n", R.height(nodes).alias("height"), R.is_tree(nodes).alias("is_tree"), F.posexplode(R.subtree_sizes(nodes)).alias("i", "size"))
    return rows.select("n", (F.col("i") + 1).alias("idx"), "size", "height", "is_tree")


@query(
    "tree_edits",
    """WITH s AS (SELECT DISTINCT p_size AS n FROM part WHERE p_size >= 5), i AS (SELECT n, unnest(range(1, n + 1)) AS idx FROM s),
m AS (SELECT n, idx::INTEGER AS idx, CASE idx WHEN 2 THEN 3 WHEN 3 THEN 2 ELSE idx END AS o FROM i)
SELECT n, idx, (CASE o // 2 WHEN 2 THEN 3 WHEN 3 THEN 2 ELSE o // 2 END)::INTEGER AS head, CASE WHEN idx % 2 = 0 THEN 'X' ELSE 'NOUN' END AS pos FROM m""",
)
def tree_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    swapped = R.swap_nodes(F.col("nodes"), F.lit(2), F.lit(3))
    even = R.modify(F.col("s"), lambda n: n["idx"] % 2 == 0, lambda n: n.withField("pos", F.lit("X")))
    rows = _heap_trees(spark, sf_dir).where("n >= 5").select("n", swapped.alias("s")).select("n", F.inline(even))
    return rows.select("n", "idx", "head", "pos")


@query(
    "tree_remove_child",
    f"WITH {_HEAP} SELECT n, count(*) FILTER (NOT list_contains(path, 3))::INTEGER AS left_over, (count(*) FILTER (NOT list_contains(path, 3)) + 1)::INTEGER AS replaced FROM walk WHERE n >= 3 GROUP BY n",
)
def tree_remove_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = F.col("nodes")
    new = R.node(F.lit(99), F.lit("w"), F.lit("w"), F.lit("NOUN"), F.lit(0), F.lit(""))
    return _heap_trees(spark, sf_dir).where("n >= 3").select("n", F.size(R.remove_child(nodes, F.lit(3))).alias("left_over"), F.size(R.replace_child(nodes, F.lit(3), new)).alias("replaced"))


def _kept_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", F.inline(valid_sentences(F.col("text"), CONFIG)))


def _parsed_nodes(spark: SparkSession, sf_dir: str, parsers: list[str], sources: dict[str, str]) -> DataFrame:
    """(doc_id, sent_idx, fields of a node) of the kept sentences' trees; a document's are parsed together."""
    rows = documents(spark, sf_dir).select("doc_id", valid_sentences(F.col("text"), CONFIG).alias("k"))
    rows = rows.select("doc_id", F.transform("k", lambda x: x["sent_idx"]).alias("at"), F.transform("k", lambda x: x["tokens"]).alias("tokens"))
    p = CONFIG.parser
    parsed = with_parsed(rows, {"trees": "tokens"}, {n: BACKENDS[n].flat_loader() for n in parsers}, sources, p.min_nodes, p.max_nodes, graphs=False)
    # both built-in parsers make a tree of every sentence that is kept
    trees = parsed.select("doc_id", F.inline(F.arrays_zip(F.col("at").alias("sent_idx"), F.col("trees").alias("tree"))))
    return trees.select("doc_id", "sent_idx", F.inline("tree.nodes"))


@query("rule_tree_edges", f"WITH {S.SENTENCES}, {S.RULE_NODES} SELECT doc_id, sent_idx::INTEGER AS sent_idx, idx::INTEGER AS idx, head::INTEGER AS head, pos, rel FROM headed")
def rule_tree_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _parsed_nodes(spark, sf_dir, ["rules"], CONFIG.parser.sources)
    return rows.select("doc_id", "sent_idx", "idx", "head", "pos", "rel")


@query("chain_tree_edges", f"WITH {S.SENTENCES} SELECT doc_id, sent_idx::INTEGER AS sent_idx, (len(t) - 1)::INTEGER AS n_edges, len(t)::INTEGER AS height FROM kept")
def chain_tree_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _kept_tokens(spark, sf_dir).select("doc_id", "sent_idx", chain_nodes(F.col("tokens")).alias("nodes"))
    return rows.select("doc_id", "sent_idx", F.size(R.edges(F.col("nodes"))).alias("n_edges"), R.height(F.col("nodes")).alias("height"))


@query(
    "multi_parser_merge",
    f"""WITH {S.SENTENCES}, {S.RULE_NODES} SELECT doc_id, sent_idx::INTEGER AS sent_idx, idx::INTEGER AS idx, (idx - 1)::INTEGER AS head, pos, CASE WHEN idx = 1 THEN 'root' ELSE 'dep' END AS rel,
CASE pos WHEN 'NOUN' THEN 1 WHEN 'VERB' THEN 2 ELSE 0 END AS n_morph FROM headed""",
)
def multi_parser_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = {"tree": "chain", "deps": "chain", "pos_tags": "rules", "lemmas": "rules", "morph": "rules"}
    rows = _parsed_nodes(spark, sf_dir, ["chain", "rules"], sources)
    return rows.select("doc_id", "sent_idx", "idx", "head", "pos", "rel", F.size("morph").alias("n_morph"))


@query(
    "conll_columns",
    """SELECT l_orderkey, count(*)::INTEGER AS n, (count(*) - 1)::INTEGER AS n_edges, max(l_linenumber)::INTEGER AS last_idx FROM lineitem GROUP BY l_orderkey HAVING count(*) = max(l_linenumber)""",
)
def conll_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag", "l_linestatus"))).alias("x"), F.max("l_linenumber").alias("m"))
    get = lambda name: F.transform("x", lambda r: r[name])
    heads = F.transform(F.sequence(F.lit(1), F.col("m")), lambda i: i - 1)
    rows = rows.select("l_orderkey", R.from_columns(get("l_returnflag"), get("l_returnflag"), get("l_linestatus"), heads, get("l_linestatus")).alias("nodes")).where("nodes IS NOT NULL")
    return rows.select("l_orderkey", F.size("nodes").alias("n"), F.size(F.filter("nodes", lambda n: n["head"] > 0)).alias("n_edges"), F.array_max(F.transform("nodes", lambda n: n["idx"])).alias("last_idx"))


# -- whole datasets -----------------------------------------------------------------------------


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the labels' quality; every tenth has a benchmark passage as second text, as far as there are any."""
    docs = documents(spark, sf_dir)
    passages = table(spark, sf_dir, "benchmark").select((F.col("item_id") * 10).alias("doc_id"), F.col("text").alias("passage"))
    rows = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left").join(passages, "doc_id", "left")
    return project_pairs(rows, "doc_id", "text", "passage", "quality")


#: As SENTENCES and RULE_NODES, with both texts of _pairs: doc_id is doubled, and one more for the second text.
_BOTH = f"""RECURSIVE texts AS (SELECT doc_id * 2 AS doc_id, text FROM documents UNION ALL SELECT item_id * 20 + 1, b.text FROM benchmark b WHERE item_id * 10 IN (SELECT doc_id FROM documents)),
{S.SENTENCES.replace("FROM documents", "FROM texts")}, {S.RULE_NODES}"""
_GRAPHS = f"""{_BOTH}, walk AS (SELECT doc_id, sent_idx, idx, [idx] AS path FROM headed WHERE head = 0
  UNION ALL SELECT h.doc_id, h.sent_idx, h.idx, list_append(w.path, h.idx) FROM headed h JOIN walk w ON h.doc_id = w.doc_id AND h.sent_idx = w.sent_idx AND h.head = w.idx),
placed AS (SELECT doc_id, sent_idx, idx, row_number() OVER (PARTITION BY doc_id, sent_idx ORDER BY path) - 1 AS place FROM walk),
graph_nodes AS (SELECT h.*, p.place, u.place AS up FROM headed h JOIN placed p USING (doc_id, sent_idx, idx) LEFT JOIN placed u ON u.doc_id = h.doc_id AND u.sent_idx = h.sent_idx AND u.idx = h.head),
features AS (SELECT *, {S.one_hot("pos", POS)} || CASE pos WHEN 'NOUN' THEN '10' || repeat('01', 8) WHEN 'VERB' THEN '01011010' || repeat('01', 5) ELSE repeat('01', 9) END AS bits, {S.one_hot("rel", DEPENDENCIES)} AS edge FROM graph_nodes),
numbered AS (SELECT doc_id, sent_idx, (rn - 1)::INTEGER AS tree FROM kept)"""


def _bits_of(vectors: Column) -> Column:
    return F.array_join(F.transform(vectors, _bits), ",")


@query(
    "dataset_groups",
    f"""WITH {_BOTH}, g AS (SELECT doc_id // 2 AS d, doc_id % 2 AS side, count(*) AS trees, sum(len(t)) AS nodes FROM kept GROUP BY 1, 2)
SELECT a.d::VARCHAR AS group_id, coalesce(quality::VARCHAR, '1') AS label, a.trees::INTEGER AS n_trees, a.nodes::INTEGER AS n_nodes, (a.nodes - a.trees)::INTEGER AS n_edges,
coalesce(b.trees, 0)::INTEGER AS n_trees_b, coalesce(b.nodes, 0)::INTEGER AS n_nodes_b, d.text, coalesce(p.text, '') AS text_b
FROM g a JOIN documents d ON d.doc_id = a.d LEFT JOIN g b ON b.d = a.d AND b.side = 1 LEFT JOIN labels l ON l.doc_id = a.d LEFT JOIN benchmark p ON p.item_id * 10 = a.d WHERE a.side = 0""",
)
def dataset_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = build_dataset(_pairs(spark, sf_dir), CONFIG)
    total = lambda trees, name: F.aggregate(trees, F.lit(0), lambda a, t: a + F.size(t[name]))
    return groups.select(
        "group_id", "label", F.size("trees").alias("n_trees"), total("trees", "node_features").alias("n_nodes"), total("trees", "to_idx").alias("n_edges"),
        F.size("trees_b").alias("n_trees_b"), total("trees_b", "node_features").alias("n_nodes_b"), "text", "text_b",
    )


@query(
    "graph_edges",
    f"""WITH {_GRAPHS} SELECT (f.doc_id // 2)::VARCHAR AS group_id, (f.doc_id % 2)::INTEGER AS side, tree,
string_agg(word, ' ' ORDER BY place) AS words, string_agg(bits, ',' ORDER BY place) AS node_features,
coalesce(string_agg(up::VARCHAR, ',' ORDER BY up, place) FILTER (head > 0), '') AS from_idx, coalesce(string_agg(place::VARCHAR, ',' ORDER BY up, place) FILTER (head > 0), '') AS to_idx,
coalesce(string_agg(edge, ',' ORDER BY up, place) FILTER (head > 0), '') AS edge_features
FROM features f JOIN numbered USING (doc_id, sent_idx) WHERE f.doc_id // 2 IN (SELECT doc_id // 2 FROM kept WHERE doc_id % 2 = 0) GROUP BY f.doc_id, f.sent_idx, tree""",
)
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each graph of both sides in full: words, node features, edges and their features."""
    groups = build_dataset(_pairs(spark, sf_dir), CONFIG).select("group_id", F.posexplode(F.array("trees", "trees_b")).alias("side", "graphs"))
    g = F.col("g")
    return groups.select("group_id", "side", F.posexplode("graphs").alias("tree", "g")).select(
        "group_id", "side", "tree", F.array_join(F.transform(g["node_texts"], lambda t: t["word"]), " ").alias("words"), _bits_of(g["node_features"]).alias("node_features"),
        joined(g["from_idx"], ",").alias("from_idx"), joined(g["to_idx"], ",").alias("to_idx"), _bits_of(g["edge_features"]).alias("edge_features"),
    )


def _letters(words: list[str]) -> list[list[float]]:
    """An encoder that SQL can restate: a word's length, its first and its last character."""
    return [[float(len(w)), float(ord(w[0])), float(ord(w[-1]))] for w in words]


def _document_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dataset(project_pairs(documents(spark, sf_dir), "doc_id", "text"), CONFIG)


@query(
    "embedded_graphs",
    f"""WITH {S.SENTENCES}, w AS (SELECT doc_id, unnest(t) AS word FROM kept)
SELECT doc_id::VARCHAR AS group_id, count(*)::INTEGER AS n_nodes, 39 AS dim, sum(length(word))::BIGINT AS lengths, sum(unicode(word))::BIGINT AS firsts, sum(unicode(right(word, 1)))::BIGINT AS lasts FROM w GROUP BY doc_id""",
)
def embedded_graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors in front of the features of each word's own node; the sums show that none went astray."""
    groups = materialize(_document_groups(spark, sf_dir), "groups", GROUPS_AT_ONCE)
    words = groups.select(F.explode("trees.node_texts").alias("t")).select(F.explode("t").alias("n")).select("n.word").distinct()
    cache = materialize(embed.encode(words, _letters), "cache")
    features = F.flatten(F.transform("trees", lambda t: t["node_features"]))
    out = embed.prepend_embeddings(groups, cache).select("group_id", features.alias("f"))
    total = lambda k: F.aggregate("f", F.lit(0).cast("bigint"), lambda a, v: a + v[k].cast("bigint"))
    return out.select("group_id", F.size("f").alias("n_nodes"), F.size(F.get("f", F.lit(0))).alias("dim"), total(0).alias("lengths"), total(1).alias("firsts"), total(2).alias("lasts"))


@query(
    "group_documents",
    f"""WITH {S.SENTENCES} SELECT (doc_id % 16)::BIGINT AS part, k.doc_id::VARCHAR AS group_id, d.text, '1' AS label, count(*)::INTEGER AS n_trees, sum(len(t))::BIGINT AS n_nodes, arg_min(array_to_string(t, ' '), sent_idx) AS first_tree
FROM kept k JOIN documents d USING (doc_id) GROUP BY k.doc_id, d.text""",
)
def group_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as JSON documents with header, as many a part as bound their size, and read back."""
    path = scratch_path(spark, "documents")
    ordinal = F.col("group_id").cast("long")
    document = document_of(ordinal, table(spark, sf_dir, "documents").count(), 16)
    groups = _document_groups(spark, sf_dir).withColumns({"ordinal": ordinal, "part": ordinal % 16, "document": document})
    write_part_documents(groups, path, "part", "document", "ordinal", compression="gzip")
    rows, _ = read_group_documents(spark, path, GROUP)
    part = F.regexp_extract("src_file", r"part=(\d+)", 1).cast("long")
    nodes = F.aggregate("trees", F.lit(0).cast("bigint"), lambda a, t: a + F.size(t["node_features"]))
    return rows.select(part.alias("part"), "group_id", "text", "label", F.size("trees").alias("n_trees"), nodes.alias("n_nodes"), F.get("trees", F.lit(0))["text"].alias("first_tree"))


@query("streaming_ingest", f"WITH {S.SENTENCES} SELECT d.doc_id::VARCHAR AS group_id, coalesce(quality::VARCHAR, '1') AS label, n::INTEGER AS n_trees FROM (SELECT doc_id, count(*) AS n FROM kept GROUP BY doc_id) d LEFT JOIN labels USING (doc_id)")
def streaming_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files taken up as a stream, twice; the second run adds nothing."""
    rows = documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    base = scratch_path(spark, "ingest")
    project_pairs(rows, "doc_id", "text", None, "quality").write.parquet(f"{base}/in")
    for _ in range(2):
        ingest(spark, f"{base}/in", f"{base}/out", CONFIG, f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("group_id", "label", F.size("trees.n_graphs").alias("n_trees"))  # of the trees one number each is read


# -- files ------------------------------------------------------------------------------------------

_LINE = r"regexp_replace(text, '\s+', ' ', 'g')"


def _one_line() -> Column:
    return F.regexp_replace("text", r"\s+", " ")


@query("source_jsonl", "SELECT doc_id::VARCHAR AS pair_id, text, lang AS text_b, source AS label FROM documents")
def source_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "jsonl")
    docs = table(spark, sf_dir, "documents")
    docs.select(F.col("text").alias("sentence1"), F.col("lang").alias("sentence2"), F.col("doc_id").cast("string").alias("pairID"), F.col("source").alias("gold_label")).write.json(path)
    return read_pairs(spark, "snli", path + "/*.json").select("pair_id", "text", "text_b", "label")


@query("source_tsv", f"SELECT doc_id::VARCHAR AS pair_id, trim({_LINE}) AS text, lang AS text_b, source AS label FROM documents")
def source_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tsv")
    filler = F.lit("x")
    fields = F.concat_ws("\t", filler, F.col("doc_id").cast("string"), filler, filler, filler, F.trim(_one_line()), "lang", "source")
    table(spark, sf_dir, "documents").select(fields.alias("value")).write.text(path)
    return read_pairs(spark, "patentmatch", path).select("pair_id", "text", "text_b", "label")


@query("source_question_groups", f"SELECT trim({_LINE}) || ' ' || lang AS text, '' AS text_b, '1' AS label FROM documents")
def source_question_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "questions")
    fields = F.concat(F.lit("q:"), F.trim(_one_line()), F.lit("\tx:skip\ta:"), F.col("lang"))
    table(spark, sf_dir, "documents").select(fields.alias("value")).write.text(path)
    return read_pairs(spark, "wiki_qs", path).select("text", "text_b", "label")


@query("source_literals", f"SELECT text FROM (SELECT rtrim({_LINE}) || CASE WHEN regexp_matches(rtrim({_LINE}), '[.!?]$') THEN '' WHEN contains(text, '?') THEN '?' ELSE '.' END || ' ' || lang || '.' AS text FROM documents)")
def source_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzipped Python literals."""
    path = scratch_path(spark, "literals")
    quoted = lambda c: F.concat(F.lit("'"), F.regexp_replace(c, r"(['\\])", r"\\$1"), F.lit("'"))
    line = F.concat(F.lit("{'question': "), quoted(F.rtrim(_one_line())), F.lit(", 'questionType': 'open-ended', 'answer': "), quoted(F.col("lang")), F.lit(", 'asin': None}"))
    documents(spark, sf_dir, "text", "lang").select(line.alias("value")).write.option("compression", "gzip").text(path)  # a file of this kind is one task's
    return read_pairs(spark, "amazon_qa", path).select("text")


# -- without SQL -----------------------------------------------------------------------------------------


@query("tree_text_viz")
def tree_text_viz(spark: SparkSession, sf_dir: str) -> DataFrame:
    trees = _heap_trees(spark, sf_dir)
    both = with_pair_text(trees.withColumn("label", F.lit("same")), "nodes", "nodes", "label", "pair")
    return with_tree_text(both, "nodes", "drawing").select("n", "drawing", "pair", tree_dot(F.col("nodes")).alias("dot"))
