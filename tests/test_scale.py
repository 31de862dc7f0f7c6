"""What must hold at any size: even partitions, no work done twice, bounded documents, batches and tasks."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sylvaframe import runtime
from sylvaframe.config import Config
from sylvaframe.functions import subword
from sylvaframe.functions import text as T
from sylvaframe.operators import embed
from sylvaframe.operators.prepare import clean_sentences
from sylvaframe.plans.dataset import build_dataset
from sylvaframe.plans.queries import QUERIES
from sylvaframe.schemas import GROUP, PAIR
from sylvaframe.sources import readers
from sylvaframe.sources.readers import read_group_documents
from sylvaframe.sources.writers import document_of, write_groups, write_lines, write_part_documents, write_shards, write_text_shards
from sylvaframe.streaming.ingest import write_batch

SF = "/root/testdata/sf0.001"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_one_large_row_group_is_dealt_out(spark, tmp_path, monkeypatch):
    spark.range(50_000).coalesce(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    monkeypatch.setattr(runtime, "BYTES_PER_TASK", size // 19)  # beyond what once was left as it is
    assert runtime.spread(df).rdd.getNumPartitions() in (19, 20)


def test_filters_on_sentences_neither_repeat_them_nor_go_below_the_shuffle(spark):
    for name in ("group_filter_min_trees", "first_valid_sentences"):
        plan = optimized(QUERIES[name](spark, SF))
        assert plan.count("regexp_extract_all") == 1, name
        assert plan.index("regexp_extract_all") < plan.index("Repartition"), name


def test_fast_expressions_give_what_the_plain_ones_do(spark):
    rng = random.Random(3)
    signs = ["a", "B", "7", "Z", ",", ".", "!", "?", ":", ";", "@", " ", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u3000", "\u00e9", "\u00a8", "\u00bd", "\ufb01", "i e ", "e.g.", "etc.", "fig."]
    rows = [(i, "".join(rng.choice(signs) for _ in range(rng.randint(0, 30)))) for i in range(3000)]
    df = spark.createDataFrame(rows, "i int, t string").repartition(4)
    t = F.col("t")
    squeezed = F.trim(F.regexp_replace(t, f"{T.SPACE}+", " "))
    spaces = df.select(T.squeeze(t).alias("got"), squeezed.alias("want"))
    assert spaces.where("got != want").collect() == []
    odd = F.regexp_like(t, F.lit("[A-Z]|[^ -~]|^ | $|  |[,A-Za-z][0-9A-Z]")) | T._may_abbreviate(t)
    assert df.where(T.settled(t) == odd).collect() == []
    for level in (1, 2, 3):
        clean = lambda x: T.preprocess(x, level)  # noqa: B023, E731
        plain = F.transform(T.sentences(clean(t)), clean)
        assert df.where(clean_sentences(t, level) != plain).collect() == [], level


def test_clean_texts_have_no_white_space_but_the_space():
    one, more = T._ascii_images()
    assert {c for image in [*one.values(), *more.values()] for c in image if c.isspace()} == {" "}


def groups_of(spark, n):
    rows = [(str(i), f"The dog number {i} barked loudly. It ran home fast.", "", "x") for i in range(n)]
    return build_dataset(spark.createDataFrame(rows, "pair_id string, text string, text_b string, label string"))


def test_parts_are_written_as_bounded_documents(spark, tmp_path):
    ordinal = F.col("group_id").cast("long")
    groups = groups_of(spark, 90).withColumns({"ordinal": ordinal, "part": ordinal % 2, "document": document_of(ordinal, 90, 2, 9)})
    write_part_documents(groups, str(tmp_path / "d"), "part", "document", "ordinal", compression="gzip")
    rows, headers = read_group_documents(spark, str(tmp_path / "d"), GROUP)
    assert 8 <= headers.count() <= 10 and {tuple(r) for r in headers.select("version", "format", "requires_word_embeddings").collect()} == {("1.0", "infonce", True)}
    names = groups.drop("ordinal", "part", "document").columns
    key = lambda r: r["group_id"]
    assert sorted(rows.select(*names).collect(), key=key) == sorted(groups.select(*names).collect(), key=key)
    found = rows.select("src_file", "ordinal", F.col("group_id").cast("int").alias("g")).orderBy("src_file", "ordinal").collect()
    by_file = {r["src_file"]: [x["g"] for x in found if x["src_file"] == r["src_file"]] for r in found}
    assert all(f"part={gs[0] % 2}/" in f and gs == sorted(gs) and len({g % 2 for g in gs}) == 1 for f, gs in by_file.items())


def test_no_query_gathers_a_part_in_one_row(spark):
    """A document of group_documents is bounded by its number of groups, whatever the corpus."""
    docs = spark.range(64_000)
    numbered = docs.select((F.col("id") % 16).alias("p"), document_of(F.col("id"), 64_000, 16).alias("d")).groupBy("p", "d").count()
    assert numbered.agg(F.max("count")).first()[0] < 300


def row_groups(folder):
    files = [f for f in folder.rglob("*.parquet") if not f.name.startswith((".", "_"))]
    return [pq.ParquetFile(f).metadata.row_group(k).num_rows for f in files for k in range(pq.ParquetFile(f).metadata.num_row_groups)]


def test_graphs_are_written_in_short_row_groups(spark, tmp_path):
    groups = groups_of(spark, 1200).coalesce(1)
    write_groups(groups, str(tmp_path / "w"))
    write_batch(spark.createDataFrame([(str(i), "The dog barked loudly.", "", "x") for i in range(1200)], PAIR).coalesce(1), 0, str(tmp_path / "s"), Config())
    for folder in ("w", "s"):
        assert sum(row_groups(tmp_path / folder)) == 1200 and max(row_groups(tmp_path / folder)) <= 250


def test_sizes_are_read_without_the_graphs(spark, tmp_path):
    write_groups(groups_of(spark, 3), str(tmp_path / "w"))
    plan = spark.read.parquet(str(tmp_path / "w")).select(F.size("trees.n_graphs"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<trees:array<struct<n_graphs:int>>>" in plan
    out = QUERIES["streaming_ingest"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "node_features" not in out.split("ReadSchema")[-1]


def test_words_are_made_from_the_texts_once(spark, monkeypatch):
    """embedding_fill goes through the texts for one table of words, not for each of two fills and a lookup."""
    seen = []
    monkeypatch.setattr("sylvaframe.operators.embed.misses", lambda words, cache, word="word", real=embed.misses: seen.append(optimized(words)) or real(words, cache, word))
    QUERIES["embedding_fill"](spark, SF).collect()
    assert len(seen) == 2 and not any("regexp_extract_all" in plan for plan in seen)


def test_split_tokens_take_the_place_of_their_token():
    kind = pa.list_(pa.list_(pa.string()))
    column = pa.array([[["a", "bcd"], []], None, [], [["zz", "bcd", "a"]], [None, ["a"]]], kind)
    asked = []
    parts = lambda t: asked.append(t) or {"a": ["a"], "bcd": ["b", "cd"], "zz": []}[t]
    assert subword.replaced(column, parts).to_pylist() == [[["a", "b", "cd"], []], None, [], [["b", "cd", "a"]], [[], ["a"]]]
    assert sorted(asked) == ["a", "bcd", "zz"]
    assert subword.replaced(column.slice(1, 3), parts).to_pylist() == [None, [], [["b", "cd", "a"]]] and len(subword.replaced(column.slice(0, 0), parts)) == 0


def test_literals_are_few_objects_at_once():
    made = list(readers._literals(iter([pa.array(["{'a': 1}", "no", None] * 1000)])))
    assert max(map(len, made)) <= 500 and sum(map(len, made)) == 3000
    assert made[0].to_pylist()[:3] == ['{"a": 1}', None, None]


def test_files_of_any_size_are_joined_from_ordered_pieces(spark, tmp_path):
    lines = spark.range(1000).select(F.concat(F.lit("k=a b/f"), (F.col("id") % 2).cast("string"), F.lit(".txt")).alias("file"), (-F.col("id")).alias("order"), F.col("id").cast("string").alias("value"))
    write_lines(lines.repartition(5), f"file://{tmp_path}/out", 7)
    for k in (0, 1):
        assert (tmp_path / "out" / "k=a b" / f"f{k}.txt").read_text() == "".join(f"{i}\n" for i in range(998 + k, -1, -2))
    assert len(list((tmp_path / "out").rglob("*"))) == 3


def test_no_task_takes_a_whole_file(spark):
    """source_first_lines and directory_runs brought a language's or a folder's texts to one task; the files' pieces are cut by order."""
    import inspect

    for name in ("source_first_lines", "source_lines_over_files", "directory_runs", "nested_files"):
        code = inspect.getsource(QUERIES[name])
        assert 'repartition("lang")' not in code and "collect_list" not in code, name


def test_small_shards_are_written_by_many_tasks(spark, tmp_path):
    sharded = spark.range(200).select(F.lit("train").alias("split"), (F.col("id") % 50).alias("shard_index"), F.col("id").alias("ordinal"), F.col("id").cast("string").alias("value"))
    for write, name in ((write_text_shards, "t"), (write_shards, "j")):
        write(sharded, str(tmp_path / name))
        files = [f.name for f in (tmp_path / name).rglob("part-*")]
        assert len(files) == 50 and len({f[:10] for f in files}) >= 4
