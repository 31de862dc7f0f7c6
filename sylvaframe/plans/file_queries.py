"""Registered queries that go through files: readers, discovery, writers, shards, runs over directories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import load_config
from ..functions.subword import VOCAB_LIMIT, vocabulary_words, word_weights
from ..operators import sharding
from ..operators.prepare import reshape, text_lines
from ..operators.ranking import partition_of
from ..runtime import even_parts, scratch_path
from ..sources import readers as files
from ..sources.writers import merge_documents, reshard, shard_documents, write_documents, write_groups, write_lines, write_named, write_text_shards
from ..streaming.ingest import resume_parts
from .directory import process_directory
from .registry import documents, query, table
from .sql import SENTENCES


def _line(c: str = "text") -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


_LINE = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"


def _snli(rows: DataFrame, path: str, name: str = "doc_id") -> None:
    rows.select(F.col("text").alias("sentence1"), F.lit("b").alias("sentence2"), F.col(name).cast("string").alias("pairID"), F.lit("x").alias("gold_label")).write.json(path)


def _by_language(rows: DataFrame, value: Column, path: str) -> None:
    """A file for each language, in the order of doc_id."""
    file = F.concat(F.lit("lang="), F.coalesce("lang", F.lit("__HIVE_DEFAULT_PARTITION__")), F.lit("/part-00000.txt"))
    write_lines(rows.select(file.alias("file"), F.col("doc_id").alias("order"), value.alias("value")), path, even_parts(rows))


@query("source_semeval", "SELECT conv_id::VARCHAR || '-' || turn::VARCHAR AS pair_id, text, role AS text_b, 'x' AS label FROM conversations")
def source_semeval(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "semeval")
    rows = table(spark, sf_dir, "conversations")
    name = F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    rows.select(F.col("text").alias("sentence1"), F.col("role").alias("sentence2"), name.alias("pairID"), F.lit("x").alias("gold_label")).write.json(path)
    return files.read_pairs(spark, "semeval", path + "/*.json").select("pair_id", "text", "text_b", "label")


@query("source_question_folder", f"SELECT 'lang=' || lang AS folder, true AS named, {_LINE} || ' ' || source AS text FROM documents")
def source_question_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "question-folder")
    fields = F.concat(F.lit("q:"), _line(), F.lit("\ta:"), F.col("source"))
    table(spark, sf_dir, "documents").select("lang", fields.alias("value")).write.partitionBy("lang").text(path)
    rows = files.read_pairs(spark, "wiki_qs_folder", f"{path}/*")
    return rows.select(F.element_at(F.split("src_file", "/"), -2).alias("folder"), F.regexp_like("pair_id", F.lit("^part-.+/group_[0-9]+$")).alias("named"), "text")


@query("source_first_lines", "SELECT doc_id::VARCHAR AS pair_id, text, n AS ordinal FROM (SELECT doc_id, text, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS n FROM documents) WHERE n < 25")
def source_first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 25 lines of each file, one for each language; the limit is the feature."""
    path = scratch_path(spark, "first-lines")
    record = F.to_json(F.struct(F.col("text").alias("sentence1"), F.col("doc_id").cast("string").alias("pairID")))
    _by_language(table(spark, sf_dir, "documents").select("lang", "doc_id", "text"), record, path)
    return files.read_snli(spark, f"{path}/*", max_lines=25).select("pair_id", "text", "ordinal")


@query("source_broken_lines", "SELECT doc_id::VARCHAR AS pair_id, text FROM documents WHERE doc_id % 3 <> 0")
def source_broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third line isn't JSON and is left out."""
    path = scratch_path(spark, "broken-lines")
    record = F.to_json(F.struct(F.col("text").alias("sentence1"), F.col("doc_id").cast("string").alias("pairID")))
    table(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 3 == 0, "{broken").otherwise(record).alias("value")).write.text(path)
    return files.read_pairs(spark, "snli", path + "/*.txt").select("pair_id", "text")


@query("source_lines_over_files", "SELECT doc_id, row_number() OVER (ORDER BY lang, doc_id) - 1 AS place FROM documents")
def source_lines_over_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines numbered on from file to file."""
    path = scratch_path(spark, "numbered")
    _by_language(table(spark, sf_dir, "documents").select("lang", "doc_id"), F.col("doc_id").cast("string"), path)
    return files.number_lines(files.raw_lines(spark, f"{path}/*"), "place", across_files=True).select(F.col("value").cast("long").alias("doc_id"), "place")


@query(
    "qa_question_types",
    """SELECT conv_id, string_agg(CASE WHEN regexp_matches(rtrim(text, E' \\n\\t\\r'), '[.!?]$') THEN text ELSE rtrim(text, E' \\n\\t\\r') || CASE WHEN contains(text, '?') THEN '?' ELSE '.' END END, ' ' ORDER BY turn, text)
  || ' ' || string_agg(CASE WHEN turn % 4 = 0 THEN '.' ELSE 'reply ' || turn || '.' END, ' ' ORDER BY turn, text) AS text
FROM conversations WHERE turn % 2 = 0 AND text IS NOT NULL GROUP BY conv_id HAVING bool_or(turn % 4 <> 0)""",
)
def qa_question_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the even turns' questions are of a kind that is asked for; of those every other has an empty answer."""
    kind = F.when(F.col("turn") % 2 == 0, "open").otherwise("closed")
    answer = F.when(F.col("turn") % 4 == 0, "").otherwise(F.concat(F.lit("reply "), F.col("turn").cast("string")))
    item = F.struct(F.col("text").alias("questionText"), kind.alias("questionType"), F.array(F.struct(answer.alias("answerText"))).alias("answers"))
    turns = table(spark, sf_dir, "conversations").where("text IS NOT NULL").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text", item.alias("item")))).alias("t"))
    none = F.lit(None).cast("string")
    record = F.struct(F.transform("t", lambda x: x["item"]).alias("questions"), none.alias("question"), none.alias("questionType"), none.alias("answer"))
    return turns.select("conv_id", files.qa_text(record, ["open"]).alias("text")).where("text IS NOT NULL")


# -- files by name -------------------------------------------------------------------

_NAME = "CASE doc_id % 6 WHEN 0 THEN 'part-00' || doc_id || '.txt' WHEN 1 THEN 'part_' || doc_id || '.json' WHEN 2 THEN 'part_' || doc_id || '_counts.json' WHEN 3 THEN 'x' || doc_id || '.json' WHEN 4 THEN 'part-7' ELSE 'other' END"


@query(
    "file_name_rules",
    f"""WITH f AS (SELECT doc_id, {_NAME} AS name FROM documents) SELECT doc_id, name, regexp_matches(name, '^part-[0-9]+') AS is_text, regexp_matches(name, '^part_.*\\.json$') AND NOT contains(name, '_counts') AS is_json,
coalesce(nullif(regexp_extract(name, 'part-([0-9]+)', 1), ''), nullif(regexp_extract(name, '([0-9]+)', 1), ''), '0')::INTEGER AS number, regexp_matches(name, '_counts\\.json$') OR name = 'other' AS excluded FROM f""",
)
def file_name_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.expr(_NAME).alias("name"))
    name = F.col("name")
    return rows.select(
        "doc_id", "name", files.is_input_file(name, "text").alias("is_text"), files.is_input_file(name, "json").alias("is_json"), files.file_number(name).alias("number"),
        files.excluded(F.concat(F.lit("/a/b/"), name), ["*_counts.json", "other"]).alias("excluded"),
    )


@query("nested_files", "SELECT DISTINCT 'lang=' || lang AS category, 0 AS file_number, NULL::INTEGER AS part_number, true AS is_text FROM documents WHERE lang <> 'de'")
def nested_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files below a folder, by their parent folder's name; one folder is excluded."""
    path = scratch_path(spark, "nested")
    rows = table(spark, sf_dir, "documents").select("lang", F.col("doc_id").cast("string").alias("value"))
    rows.write.partitionBy("lang").text(path)
    found = files.list_files(spark, path, "text", nested=True, exclude=["*lang=de*"])
    return found.select("category", F.lit(0).alias("file_number"), "part_number", F.endswith("name", F.lit(".txt")).alias("is_text")).distinct()


@query("nested_part_files", "SELECT DISTINCT 'part-0' || (doc_id % 7) AS category, (doc_id % 7)::INTEGER AS file_number FROM documents")
def nested_part_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in folders named by their part take that number."""
    path = scratch_path(spark, "nested-parts")
    part = F.concat(F.lit("part-0"), (F.col("doc_id") % 7).cast("string"))
    rows = table(spark, sf_dir, "documents").select(F.concat(F.lit(path + "/"), part, F.lit("/part-00000.txt")).alias("path"), F.col("doc_id").cast("string").alias("value"))
    written = rows.groupBy("path").agg(F.array_join(F.array_sort(F.collect_list("value")), "\n").alias("value"))
    write_named(written).count()
    return files.list_files(spark, path, "text", nested=True).select("category", "file_number")


@query("text_lines", f"SELECT doc_id, unnest(list_filter(string_split(text, chr(10)), lambda x: trim(x, E' \\n\\t\\r') <> '')) AS value FROM documents")
def text_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_lines(documents(spark, sf_dir).select("doc_id", F.explode(F.split("text", "\n")).alias("value")))


# -- vocabularies ------------------------------------------------------------------------


@query(
    "vocabulary_files",
    """WITH a AS (SELECT DISTINCT lower(w) AS word FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part)), b AS (SELECT DISTINCT lower(c_mktsegment) AS word FROM customer UNION SELECT 'ok' UNION SELECT 'zz' UNION SELECT 'green')
SELECT word, count(*) AS weight FROM (SELECT word FROM a UNION ALL SELECT word FROM b) WHERE length(word) > 2 OR word IN ('ok') GROUP BY word""",
)
def vocabulary_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vector file and a word list: each word's weight is the number of them that hold it."""
    base = scratch_path(spark, "vocabulary")
    words = table(spark, sf_dir, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("w")).distinct()
    lines = words.agg(F.array_join(F.array_sort(F.collect_list(F.concat("w", F.lit(" 0.5 0.25")))), "\n").alias("v"))
    write_named(lines.select(F.lit(f"{base}/a.vec").alias("path"), F.concat(F.lit("9 2\n"), "v").alias("value"))).count()
    segments = table(spark, sf_dir, "customer").select(F.lower("c_mktsegment").alias("w")).distinct()
    extra = spark.createDataFrame([("ok",), ("zz",), ("green",)], "w string")
    lines = segments.unionByName(extra).agg(F.array_join(F.array_sort(F.collect_set("w")), "\n").alias("v"))
    write_named(lines.select(F.lit(f"{base}/b.txt").alias("path"), F.col("v").alias("value"))).count()
    read = lambda name: files.number_lines(files.raw_lines(spark, f"{base}/{name}"))
    return word_weights([vocabulary_words(read("a.vec"), True, VOCAB_LIMIT), vocabulary_words(read("b.txt"), False, VOCAB_LIMIT)])


# -- writers and shards --------------------------------------------------------------------


def _counted_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups with as many trees as their id's last digit."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return rows.select(F.col("doc_id").cast("string").alias("group_id"), "source", F.array_repeat("lang", (F.col("doc_id") % 10).cast("int")).alias("trees"), F.array("source").alias("trees_b"), "doc_id")


@query("partition_merge", "SELECT group_id, part, 'x' AS label FROM (SELECT doc_id::VARCHAR AS group_id, ntile(5) OVER (ORDER BY doc_id) - 1 AS part FROM documents)")
def partition_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as folders, of sizes that differ by one at most, then read as one table."""
    path = scratch_path(spark, "parts")
    rows = table(spark, sf_dir, "documents").select("doc_id")
    placed = sharding.one_split(rows, "doc_id").select(F.col("doc_id").cast("string").alias("group_id"), partition_of(F.col("ordinal"), F.lit(rows.count()), 5).alias("part"), F.lit("x").alias("label"))
    write_groups(placed, path, "part")
    return merge_documents([spark.read.parquet(f"{path}/part={k}").withColumn("part", F.lit(k).cast("long")) for k in range(5)])


@query("pairs_and_labels", "SELECT name AS pair, label FROM (SELECT 'r' || n_regionkey || '-' || n_nationkey AS name, n_nationkey::VARCHAR AS label FROM nation)")
def pairs_and_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old shape: a list of pairs with a list of labels beside it."""
    pair = F.concat(F.lit("r"), F.col("n_regionkey").cast("string"), F.lit("-"), F.col("n_nationkey").cast("string"))
    rows = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", pair.alias("p")))).alias("x"))
    old = rows.select(F.transform("x", lambda x: x["p"]).alias("graph_pairs"), F.transform("x", lambda x: x["n_nationkey"]).alias("labels"))
    return merge_documents([old])


@query("groups_reshaped", "SELECT doc_id::VARCHAR AS name, (doc_id % 10)::INTEGER AS n_trees FROM documents")
def groups_reshaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reshape(_counted_groups(spark, sf_dir), ["source", "trees_b", "doc_id"], {"group_id": "name"})
    return out.select("name", F.size("trees").alias("n_trees"))


_CUT = """h AS (SELECT doc_id, source, (('0x' || substr(md5('42|' || doc_id::VARCHAR), 1, 8))::BIGINT) AS h FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id::VARCHAR) AS r, count(*) OVER (PARTITION BY source) AS n FROM h),
c AS (SELECT *, floor(n * 0.8::DOUBLE)::BIGINT AS a, floor(n * 0.1::DOUBLE)::BIGINT AS b FROM p),
s AS (SELECT *, CASE WHEN r <= a THEN 'train' WHEN r <= a + b THEN 'dev' ELSE 'test' END AS split, r - CASE WHEN r <= a THEN 0 WHEN r <= a + b THEN a ELSE a + b END - 1 AS k FROM c)"""


@query("split_by_name", f"WITH {_CUT} SELECT doc_id::VARCHAR AS group_id, source, split, k AS ordinal, k // 20 AS shard_index FROM s")
def split_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact splits by string ids, for each source on its own."""
    rows = _counted_groups(spark, sf_dir).select("group_id", "source")
    return sharding.STRATEGIES["random"](rows, "group_id", ["source"], 20)


@query(
    "shard_documents",
    f"""WITH {_CUT} SELECT split || '/' || source || '_shard_' || lpad((k // 20)::VARCHAR, 6, '0') || '.json' AS file, 'documents' AS source_name, source || '.json' AS source_file, (k // 20)::BIGINT AS shard_index, count(*)::BIGINT AS groups_in_shard,
string_agg(doc_id::VARCHAR, ',' ORDER BY k) AS group_ids, string_agg((doc_id % 10)::VARCHAR, ',' ORDER BY k) AS trees_per_group, string_agg('1', ',') AS trees_b_per_group, count(*)::BIGINT AS n_groups FROM s GROUP BY split, source, k // 20""",
)
def shard_document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named JSON shards with header, shard_info and a counts file each, read back."""
    path = scratch_path(spark, "shard-documents")
    groups = _counted_groups(spark, sf_dir).drop("doc_id").withColumn("stem", F.col("source"))
    sharded = sharding.split_and_shard(groups, "group_id", ["source"], 20)
    write_named(shard_documents(sharded, path, "documents")).count()
    info = "shard_info struct<shard_index:bigint,groups_in_shard:bigint,source_name:string,source_file:string>"
    read = lambda schema, wanted: spark.read.schema(schema).option("pathGlobFilter", wanted).option("recursiveFileLookup", True).json(path)
    file = F.concat_ws("/", F.slice(F.split(F.col("_metadata.file_path"), "/"), -2, 2)).alias("file")
    whole = read(f"version string, groups array<struct<group_id:string>>, {info}", "*.json").select(file, "groups", "shard_info").where("shard_info IS NOT NULL")
    counts = read("n_groups bigint, trees_per_group array<int>, trees_b_per_group array<int>", "*_counts.json").select(file, "n_groups", "trees_per_group", "trees_b_per_group")
    counts = counts.withColumn("file", F.regexp_replace("file", r"_counts\.json$", ".json"))
    listed = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return whole.join(counts, "file").select("file", "shard_info.source_name", "shard_info.source_file", "shard_info.shard_index", "shard_info.groups_in_shard", F.array_join(F.transform("groups", lambda g: g["group_id"]), ",").alias("group_ids"), listed("trees_per_group"), listed("trees_b_per_group"), "n_groups")


@query("text_shard_lines", "SELECT doc_id::VARCHAR AS value, 'train' AS split, ((row_number() OVER (ORDER BY doc_id) - 1) // 30)::INTEGER AS shard_index FROM documents")
def text_shard_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "text-shards")
    rows = sharding.STRATEGIES["single"](table(spark, sf_dir, "documents").select("doc_id"), "doc_id", None, 30)
    write_text_shards(rows.withColumn("value", F.col("doc_id").cast("string")), path)
    return spark.read.text(path).select("value", "split", F.col("shard_index").cast("int").alias("shard_index"))


@query(
    "resharded_files",
    """WITH f AS (SELECT doc_id, doc_id % 5 AS part, row_number() OVER (PARTITION BY doc_id % 5 ORDER BY doc_id) - 1 AS k FROM documents), n AS (SELECT part, (max(k) + 1 + 16) // 17 AS shards FROM f GROUP BY part),
st AS (SELECT part, coalesce(sum(shards) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM n)
SELECT 'part=' || part AS folder, (s + k // 17)::BIGINT AS shard_index, count(*) AS n_groups, min(doc_id) AS first FROM f JOIN st USING (part) GROUP BY part, s + k // 17""",
)
def resharded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many files of groups to shards whose numbers go on from file to file."""
    path = scratch_path(spark, "to-reshard")
    groups = _counted_groups(spark, sf_dir).select("group_id", "trees", F.col("doc_id").alias("ordinal"), (F.col("doc_id") % 5).alias("part"))
    write_documents(groups, path, "part", "ordinal")
    rows, _ = files.read_group_documents(spark, path, "group_id string, trees array<string>")
    out = reshard(rows, 17)
    return out.groupBy(F.element_at(F.split("src_file", "/"), -2).alias("folder"), "shard_index").agg(F.count(F.lit(1)).alias("n_groups"), F.min(F.col("group_id").cast("long")).alias("first"))


@query(
    "output_folders",
    """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'dev' ELSE 'test' END || '/' || lang || '/part-' || lpad((doc_id % 100)::VARCHAR, 5, '0') AS nested, CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'dev' ELSE 'test' END AS flat FROM documents""",
)
def output_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = F.when(F.col("doc_id") % 3 == 0, "train").when(F.col("doc_id") % 3 == 1, "dev").otherwise("test")
    number = (F.col("doc_id") % 100).cast("int")
    return table(spark, sf_dir, "documents").select("doc_id", sharding.output_folder(split, "json", F.col("lang"), number).alias("nested"), sharding.output_folder(split, "text", None, number).alias("flat"))


# -- runs that are taken up again ------------------------------------------------------------


@query("resume_parts", "SELECT DISTINCT doc_id % 9 AS part, doc_id // 100 AS batch_idx FROM documents EXCEPT SELECT doc_id % 9, doc_id // 100 FROM labels")
def resumed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = [(F.col("doc_id") % 9).alias("part"), F.floor(F.col("doc_id") / 100).cast("long").alias("batch_idx")]
    return resume_parts(table(spark, sf_dir, "documents").select(*place).distinct(), table(spark, sf_dir, "labels").select(*place))


@query(
    "directory_runs",
    f"""WITH {SENTENCES}, g AS (SELECT doc_id % 3 AS f, count(DISTINCT doc_id) AS n FROM kept GROUP BY doc_id % 3)
SELECT 'f' || f || '.jsonl' AS file, 'skipped' AS status, n AS n_groups FROM g UNION ALL SELECT 'z.jsonl', 'failed', 0""",
)
def directory_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of files of which one can't be read, run twice: what was done is left alone, the error stays apart."""
    base = scratch_path(spark, "directory")
    record = F.to_json(F.struct(F.col("text").alias("sentence1"), F.col("doc_id").cast("string").alias("pairID"), F.lit("x").alias("gold_label")))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    file = F.concat(F.lit("f"), (F.col("doc_id") % 3).cast("string"), F.lit(".jsonl"))
    write_lines(docs.select(file.alias("file"), F.col("doc_id").alias("order"), record.alias("value")), f"{base}/in", even_parts(docs))
    # a label that the map lacks is an error
    odd = spark.createDataFrame([(f"{base}/in/z.jsonl", '{"sentence1": "One two three four.", "pairID": "1", "gold_label": "y"}')], "path string, value string")
    write_named(odd).count()
    config = load_config({"output": {"label_map": {"x": 1.0}}})
    for _ in range(2):
        report = process_directory(spark, "snli", f"{base}/in", f"{base}/out", config)
    done = spark.read.parquet(f"{base}/out/*").select(F.regexp_extract(F.col("_metadata.file_path"), "file=([^/]+)", 1).alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n_groups"))
    return report.join(done, "file", "left").select("file", "status", F.coalesce("n_groups", F.lit(0).cast("long")).alias("n_groups"))
