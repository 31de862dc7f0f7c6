import gzip
import json

import pytest
from pyspark.sql import functions as F

from sylvaframe.operators.sharding import split_and_shard
from sylvaframe.plans.dataset import build_dataset, dataset_from_files
from sylvaframe.schemas import GROUP
from sylvaframe.sources.readers import excluded, file_number, list_files, number_lines, raw_lines, read_group_documents, read_pairs
from sylvaframe.sources.writers import merge_documents, write_documents, write_groups, write_shards, write_text_shards
from sylvaframe.streaming.ingest import distinct_stream, ingest, processed_ids, resume_parts


def lines(df):
    return [tuple(r) for r in df.orderBy("ordinal").select("pair_id", "text", "text_b", "label").collect()]


def test_lines_are_numbered_over_splits(spark, tmp_path):
    path = tmp_path / "big.txt"
    path.write_text("".join(f"line {i} {'x' * (i % 90)}\n" for i in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    rows = number_lines(raw_lines(spark, str(path)))
    parts = rows.rdd.getNumPartitions()
    wrong = rows.where(F.split("value", " ")[1].cast("long") != F.col("ordinal")).count()
    kept = number_lines(raw_lines(spark, str(path)).where("value LIKE '%7 %'")).select("value", "ordinal").orderBy("ordinal").collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert parts > 4 and wrong == 0
    numbers = [int(r["value"].split()[1]) for r in kept]
    assert numbers == sorted(numbers) and [r["ordinal"] for r in kept] == list(range(len(kept)))


def test_json_lines(spark, tmp_path):
    rows = [{"sentence1": f"a{i}", "sentence2": "b", "pairID": str(i), "gold_label": "x" if i else None} for i in range(4)]
    (tmp_path / "in.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\nnot json\n")
    path = str(tmp_path / "in.jsonl")
    assert lines(read_pairs(spark, "snli", path)) == [(str(i), f"a{i}", "b", "x" if i else "1") for i in range(4)]
    assert [p for p, *_ in lines(read_pairs(spark, "semeval", path, compat=True))] == ["1", "2", "3"]
    assert [p for p, *_ in lines(read_pairs(spark, "snli", path, max_lines=2))] == ["0", "1"]
    assert [p for p, *_ in lines(read_pairs(spark, "snli", path, max_lines=2, compat=True))] == ["1", "2"]
    with pytest.raises(ValueError):
        read_pairs(spark, "other", path)


def test_question_groups(spark, tmp_path):
    (tmp_path / "part-00001").write_text("q:one\tx:skip\ta:two\nq:only\n\na: three \tq:four\n")
    path = str(tmp_path / "part-00001")
    assert lines(read_pairs(spark, "wiki_qs", path)) == [("group_0", "one two", "", "1"), ("group_3", " three four", "", "1")]
    assert len(lines(read_pairs(spark, "wiki_qs", path, max_lines=3))) == 1
    (tmp_path / "part-00002").write_text("q:x\ta:y\n")
    ids = [r["pair_id"] for r in read_pairs(spark, "wiki_qs_folder", str(tmp_path)).collect()]
    assert sorted(ids) == ["part-00001/group_0", "part-00001/group_3", "part-00002/group_0"]


def test_literals(spark, tmp_path):
    multi = {"questions": [{"questionText": "Is it? yes", "questionType": "yes/no", "answers": [{"answerText": "it is"}, {"answerText": "no!"}]}, {"questionText": "tell me", "questionType": "open-ended", "answers": []}]}
    single = {"question": "why", "questionType": "open-ended", "answer": "don't know", "flag": True, "none": None}
    silent = {"questions": [{"questionText": "q", "questionType": "x", "answers": [{"answerText": ""}]}]}
    with gzip.open(tmp_path / "qa.json.gz", "wt", encoding="utf-8") as f:
        f.write("\n".join(map(repr, [multi, silent, single, {"question": "q", "questionType": "t"}])) + "\nnot a literal(\n")
    path = str(tmp_path / "qa.json.gz")
    assert lines(read_pairs(spark, "amazon_qa", path)) == [("group_0", "Is it? yes? tell me. it is. no!", "", "1"), ("group_1", "why. don't know.", "", "1")]
    assert lines(read_pairs(spark, "amazon_qa", path, question_types=["open-ended"])) == [("group_0", "why. don't know.", "", "1")]
    assert len(lines(read_pairs(spark, "amazon_qa", path, max_lines=2))) == 1


def test_patents(spark, tmp_path):
    row = lambda i: f"x\tp{i}\t\t\t\ta{i}\tb{i}\tlab"
    (tmp_path / "with.tsv").write_text("index\ta\tb\n" + "\n".join(row(i) for i in range(3)) + "\nshort\tline\n")
    (tmp_path / "without.tsv").write_text("\n".join(row(i) for i in range(3)))
    want = [(f"p{i}", f"a{i}", f"b{i}", "lab") for i in range(3)]
    assert lines(read_pairs(spark, "patentmatch", str(tmp_path / "with.tsv"))) == want == lines(read_pairs(spark, "patentmatch", str(tmp_path / "without.tsv")))
    for name in ("with", "without"):
        assert lines(read_pairs(spark, "patentmatch", str(tmp_path / f"{name}.tsv"), max_lines=2)) == want[:2]


def test_file_names(spark, tmp_path):
    for name in ("part-00012", "part_3.json", "part_3_counts.json", "other.txt"):
        (tmp_path / name).write_text("{}")
    (tmp_path / "part-00007").mkdir() or (tmp_path / "part-00007" / "part_2.json").write_text("{}")
    assert [r["name"] for r in list_files(spark, str(tmp_path), "text").collect()] == ["part-00012"]
    assert [r["name"] for r in list_files(spark, str(tmp_path), "json", exclude=["*_9*"]).collect()] == ["part_3.json"]
    nested = {r["name"]: r for r in list_files(spark, str(tmp_path), "json", nested=True).collect()}
    assert (nested["part_2.json"]["category"], nested["part_2.json"]["file_number"], nested["part_2.json"]["part_number"]) == ("part-00007", 7, 2)
    names = spark.createDataFrame([("part-00012",), ("a7b8",), ("none",)], "n string")
    assert [r[0] for r in names.select(file_number(F.col("n"))).collect()] == [12, 7, 0]
    assert [r[0] for r in names.select(excluded(F.col("n"), ["part-*", "n?ne"])).collect()] == [True, False, True]


def pairs(spark, n=12):
    return spark.createDataFrame([(str(i), f"The dog number {i} barked loudly. It ran home fast.", "", "x") for i in range(n)], "pair_id string, text string, text_b string, label string")


def test_documents_round_trip(spark, tmp_path):
    groups = build_dataset(pairs(spark)).withColumn("ordinal", F.col("group_id").cast("long")).withColumn("part", F.col("ordinal") % 3)
    write_documents(groups, str(tmp_path / "docs"), "part", "ordinal")
    rows, headers = read_group_documents(spark, str(tmp_path / "docs"), GROUP)
    assert headers.count() == 3 and {tuple(r) for r in headers.select("version", "format", "requires_word_embeddings").collect()} == {("1.0", "infonce", True)}
    first = rows.where("group_id = '4'").drop("src_file", "ordinal").first()
    assert first == groups.where("group_id = '4'").select(*first.__fields__).first()
    order = [r["group_id"] for r in rows.where("src_file LIKE '%part=1%'").orderBy("ordinal").collect()]
    assert order == ["1", "4", "7", "10"]
    write_groups(groups, str(tmp_path / "groups"), "part")
    assert spark.read.parquet(str(tmp_path / "groups")).where("part = 1").count() == 4


def test_merging_old_and_new_shapes(spark):
    old = spark.createDataFrame([(["p", "q"], [1, 0])], "graph_pairs array<string>, labels array<int>")
    new = spark.createDataFrame([("g", "x")], "group_id string, label string")
    assert sorted(tuple(r) for r in merge_documents([old, old]).collect()) == [("p", "1"), ("p", "1"), ("q", "0"), ("q", "0")]
    assert merge_documents([old, new]).count() == 3


def test_shards_on_disk(spark, tmp_path):
    sharded = split_and_shard(spark.range(25).select("id", F.concat(F.lit("v"), F.col("id").cast("string")).alias("value")), "id", [], 4)
    write_shards(sharded, str(tmp_path / "json"))
    back = spark.read.json(str(tmp_path / "json"))
    assert back.count() == 25 and back.groupBy("split", "shard_index").count().agg(F.max("count")).first()[0] == 4
    assert {r["split"]: r["count"] for r in back.groupBy("split").count().collect()} == {"train": 20, "dev": 2, "test": 3}
    write_text_shards(sharded, str(tmp_path / "text"))
    assert spark.read.text(str(tmp_path / "text")).count() == 25


def test_files_to_groups(spark, tmp_path):
    (tmp_path / "q.txt").write_text("q:the dog barked loudly.\ta:it ran home fast.\n")
    out = dataset_from_files(spark, "wiki_qs", str(tmp_path / "q.txt")).collect()
    assert len(out) == 1 and len(out[0]["trees"]) == 2


def test_streams_resume_and_add_nothing_twice(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    pairs(spark).where("pair_id < '5'").write.parquet(folder)
    run = lambda: ingest(spark, folder, out, checkpoint=checkpoint).awaitTermination()
    run()
    first = spark.read.parquet(out).count()
    run()
    assert spark.read.parquet(out).count() == first > 0
    pairs(spark).write.mode("append").parquet(folder)  # the old ids once more, and new ones
    run()
    ids = [r["group_id"] for r in spark.read.parquet(out).collect()]
    assert sorted(ids) == sorted(str(i) for i in range(12)) and processed_ids(spark, out).count() == 12
    assert processed_ids(spark, str(tmp_path / "none")) is None


def test_stateful_dedup_and_parts(spark, tmp_path):
    folder = str(tmp_path / "events")
    spark.sql("SELECT id % 5 AS k, timestamp_seconds(1700000000 + id) AS t FROM range(50)").write.parquet(folder)
    stream = distinct_stream(spark.readStream.schema("k long, t timestamp").parquet(folder), "k", "t", "1 hour")
    query = stream.writeStream.format("memory").queryName("seen").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination()
    assert spark.table("seen").count() == 5
    b = spark.createDataFrame([(0, 0), (0, 1), (1, 2)], "part long, batch_idx long")
    assert [tuple(r) for r in resume_parts(b, b.where("batch_idx < 2")).collect()] == [(1, 2)]
