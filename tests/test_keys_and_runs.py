"""Keys that are null, sparse or strings; runs of the command line that must not lose rows."""

import json

import pytest
from pyspark.sql import functions as F

import sylvaframe
from sylvaframe.__main__ import main
from sylvaframe.functions import tree
from sylvaframe.operators import sharding
from sylvaframe.operators.parse import gpu_profile
from sylvaframe.operators.ranking import ranked


def test_rows_without_a_key_take_part(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (None, "b")], "id long, t string")
    for out in (sharding.split_and_shard(df, "id"), sharding.shard_in_order(df, "id"), ranked(df, [], "id", [])):
        assert sorted(map(str, (r["t"] for r in out.collect()))) == ["a", "b", "b", "c"]
    assert sorted((r["rank"], r["of"]) for r in ranked(df, ["t"], "id", []).collect()) == [(1, 1), (1, 1), (1, 2), (2, 2)]
    assert ranked(df.limit(0), [], "id", []).count() == 0 and sharding.split_and_shard(df.limit(0), "id").count() == 0


def test_sparse_and_string_keys(spark):
    keys = [2**40 * k - 7 for k in range(50)]
    df = spark.createDataFrame([(k, f"group_{k}") for k in keys], "id long, name string").repartition(3)
    assert [r["id"] for r in ranked(df, [], "id", [], None, 4).orderBy("rank").collect()] == keys
    out = sharding.split_and_shard(df, "name", None, 10).collect()
    assert sorted(r["split"] for r in out) == ["dev"] * 5 + ["test"] * 5 + ["train"] * 40 and len({(r["split"], r["ordinal"]) for r in out}) == 50
    assert {r["name"]: r["ordinal"] for r in out} == {r["name"]: r["ordinal"] for r in sharding.split_and_shard(df.repartition(7), "name", None, 10, rows_per_bucket=5).collect()}


def test_partitions_keep_pairs_without_an_id(spark, tmp_path):
    rows = [{"sentence1": f"The dog number {i} barked loudly.", "sentence2": "", **({"pairID": str(i)} if i % 2 else {})} for i in range(10)]
    (tmp_path / "in.jsonl").write_text("\n".join(map(json.dumps, rows)))
    for extra, out in (([], "plain"), (["--partitions", "2"], "parts")):
        main(["process", "--dataset-type", "snli", "--input", str(tmp_path / "in.jsonl"), "--out", str(tmp_path / out), *extra], spark)
    got = spark.read.parquet(str(tmp_path / "parts"))
    assert spark.read.parquet(str(tmp_path / "plain")).count() == got.count() == 10
    assert sorted(r["count"] for r in got.groupBy("part").count().collect()) == [5, 5]


def test_a_directory_with_a_broken_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, label in (("a", "x"), ("b", "y"), ("c", "x")):
        (tmp_path / "in" / f"{name}.jsonl").write_text(json.dumps({"sentence1": "The dog barked loudly.", "pairID": name, "gold_label": label}))
    (tmp_path / "c.json").write_text('{"output": {"label_map": {"x": 1}}}')
    run = lambda: main(["process", "--dataset-type", "snli", "--input", str(tmp_path / "in"), "--out", str(tmp_path / "out"), "--each-file", "--config", str(tmp_path / "c.json"), "--verbosity", "quiet"], spark)
    run()
    run()
    report = [(r["file"], r["status"]) for r in spark.read.json(str(tmp_path / "out" / "_report" / "*.json")).collect()]
    assert sorted(report) == sorted([("a.jsonl", "done"), ("b.jsonl", "failed"), ("c.jsonl", "done"), ("a.jsonl", "skipped"), ("b.jsonl", "failed"), ("c.jsonl", "skipped")])
    assert sorted(r["group_id"] for r in spark.read.parquet(str(tmp_path / "out" / "file=*")).collect()) == ["a", "c"] and not (tmp_path / "out" / "file=b.jsonl").exists()


def test_shard_documents_and_resharding(spark, tmp_path):
    df = spark.range(25).select(F.col("id").cast("string").alias("group_id"), F.array_repeat(F.lit(1), 2).alias("trees"), F.array(F.lit(1)).alias("trees_b"), F.concat(F.lit("f"), (F.col("id") % 2).cast("string"), F.lit(".json")).alias("src"))
    df.write.parquet(str(tmp_path / "groups"))
    main(["shard", "--input", str(tmp_path / "groups"), "--out", str(tmp_path / "s"), "--shard-size", "4", "--documents", "--per-file", "src", "--source", "corpus"], spark)
    names = sorted(p.name for p in (tmp_path / "s" / "train").iterdir() if p.name.startswith("f0") and "counts" not in p.name)
    assert names == ["f0_shard_000000.json", "f0_shard_000001.json", "f0_shard_000002.json"]
    doc, counts = (json.loads((tmp_path / "s" / "train" / n).read_text()) for n in ("f0_shard_000002.json", "f0_shard_000002_counts.json"))
    assert doc["version"] == "1.0" and doc["shard_info"] == {"shard_index": 2, "groups_in_shard": 2, "source_name": "corpus", "source_file": "f0.json"}
    assert counts == {"n_groups": 2, "trees_per_group": [2, 2], "trees_b_per_group": [1, 1]} and len(doc["groups"]) == 2
    main(["reshard", "--input", str(tmp_path / "s" / "train" / "f*[0-9].json"), "--out", str(tmp_path / "r"), "--shard-size", "3"], spark)
    again = [json.loads(p.read_text()) for p in (tmp_path / "r" / "train").iterdir() if p.suffix == ".json" and "counts" not in p.name]
    assert sum(len(d["groups"]) for d in again) == 19 and sorted(d["shard_info"]["shard_index"] for d in again) == list(range(len(again)))


def test_json_of_trees_that_are_none(spark):
    node = tree.node(F.lit(1), F.lit("a"), F.lit("a"), F.lit("X"), F.lit(0), F.lit("root"))
    row = spark.range(1).select(
        tree.tree_from_json(tree.tree_to_json(F.array(node))).alias("one"), tree.tree_from_json(tree.tree_to_json(F.array(node, node))).alias("two"),
        tree.tree_from_json(F.lit("{oops")).alias("bad"), tree.node_from_json(F.lit("oops")).alias("bad_node"), tree.node_from_json(tree.node_to_json(node)).alias("node"),
    ).first()
    assert row["one"][0]["word"] == "a" and row["two"] is None and row["bad"] is None and row["bad_node"] is None and row["node"]["rel"] == "root"


def test_public_names_strategies_and_profile(spark):
    assert all(getattr(sylvaframe, name) is not None for name in sylvaframe.__all__)
    with pytest.raises(AttributeError):
        sylvaframe.no_such_name
    assert set(sharding.STRATEGIES) == {"random", "single"}
    assert gpu_profile(1, 4).taskResources["gpu"].amount == 0.25
