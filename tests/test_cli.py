import json

import pytest

from sylvaframe.__main__ import main


def test_process_merge_and_shard(spark, tmp_path):
    rows = [{"sentence1": f"The dog number {i} barked loudly. It ran home fast.", "sentence2": "The cat sat down there.", "pairID": str(i), "gold_label": "x"} for i in range(20)]
    (tmp_path / "in.jsonl").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "c.json").write_text('{"sharding": {"seed": 7}}')
    process = ["process", "--dataset-type", "snli", "--input", str(tmp_path / "in.jsonl")]
    main([*process, "--out", str(tmp_path / "a"), "--partitions", "3", "--max-lines", "10"], spark)
    sizes = {r["part"]: r["count"] for r in spark.read.parquet(str(tmp_path / "a")).groupBy("part").count().collect()}
    assert sizes == {0: 4, 1: 3, 2: 3}
    main([*process, "--out", str(tmp_path / "b"), "--max-lines", "5"], spark)
    main([*process, "--out", str(tmp_path / "b"), "--resume"], spark)
    main([*process, "--out", str(tmp_path / "b"), "--resume"], spark)
    assert spark.read.parquet(str(tmp_path / "b")).count() == 20
    main(["merge", "--inputs", str(tmp_path / "a"), str(tmp_path / "b"), "--out", str(tmp_path / "m")], spark)
    assert spark.read.parquet(str(tmp_path / "m")).count() == 30
    main(["shard", "--input", str(tmp_path / "b"), "--out", str(tmp_path / "s"), "--shard-size", "4", "--config", str(tmp_path / "c.json"), "--drop", "text_b", "--rename", "label=gold"], spark)
    shards, counts = (spark.read.parquet(str(tmp_path / "s" / n)) for n in ("shards", "counts"))
    assert shards.count() == 20 and "gold" in shards.columns and "text_b" not in shards.columns
    assert sorted((r["split"], r["n_groups"]) for r in counts.collect()) == [("dev", 2), ("test", 2), *[("train", 4)] * 4]
    (tmp_path / "lines").write_text("a\n\nb\nc\n")
    main(["shard", "--input", str(tmp_path / "lines"), "--out", str(tmp_path / "t"), "--mode", "text"], spark)
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "t")).select("value").collect()) == ["a", "b", "c"]
    with pytest.raises(SystemExit):
        main(["process", "--dataset-type", "none", "--input", "x", "--out", "y"], spark)
