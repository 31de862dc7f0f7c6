import itertools
import random

import pytest
from pyspark.sql import functions as F

from sylvaframe.config import Config, deep_merge, load_config
from sylvaframe.functions.subword import SHORT_WORDS, Segmenter, keep_word, read_vocabularies, segment_words, with_known_tokens
from sylvaframe.operators import contrast, embed, sharding
from sylvaframe.operators.parse import BACKENDS, FEATURE_SOURCES, Backend, check_sources, chain_nodes, parse_sentence, register, rule_nodes
from sylvaframe.operators.prepare import filter_groups, keep_group, keep_valid, map_labels, project_pairs, skip_rate, stable_id, text_lines, without_processed
from sylvaframe.operators.ranking import partition_of, ranked, split_name
from sylvaframe.plans.dataset import build_dataset, parse_pairs
from sylvaframe.runtime import scratch_path


# -- subwords --------------------------------------------------------------------------


def brute_split(token, weight):
    best = None
    for cuts in itertools.product([0, 1], repeat=max(0, len(token) - 1)):
        parts, start = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(token[start:i])
                start = i
        parts.append(token[start:])
        if all(p in weight for p in parts):
            key = (len(parts), tuple(-weight[p] for p in parts), tuple(-len(p) for p in parts))
            best = min(best or (key, parts), (key, parts))
    return best and best[1]


def test_best_split_is_that_of_all_splits():
    rng = random.Random(0)
    for _ in range(60):
        words = ["".join(rng.choices("ab", k=rng.randint(1, 4))) for _ in range(8)]
        s = Segmenter([set(words[:5]), set(words[3:])])
        for _ in range(15):
            t = "".join(rng.choices("ab", k=rng.randint(1, 9)))
            assert s.best_split(t) == brute_split(t, s.weight), (t, words)


def test_segmenting():
    s = Segmenter([{"data", "base", "database", "cat"}, {"cat"}])
    assert s.segment("database") == ["database"] and s.segment("catdata") == ["cat", "data"] and s.segment("cat2data") == ["cat", "data"]
    assert s.longest_known("catxy") == ["cat", "xy"] and s.longest_known("xycat") == ["xy", "cat"] and s.longest_known("zzzzcat") == ["cat"]
    assert s.longest_known("zz") == ["zz"] and s.longest_known("zzzz") == [] and s.longest_known("qqqdataqqq") == ["qqqdataqqq"]
    assert s.longest_known("datacat") == ["data"] + ["cat"] and Segmenter([]).segment("abcd") == []
    assert len(SHORT_WORDS) == 32 and {"am", "we", "i", "a", "ox", "ok"} <= SHORT_WORDS


def test_segmenting_tables(spark):
    vocab = [{"data", "base"}, {"base"}]
    df = spark.createDataFrame([("database",), ("database",), ("qqqqq",), (None,)], "token string")
    assert sorted(map(tuple, segment_words(df, vocab).collect())) == [("database", ["data", "base"]), ("qqqqq", [])]
    rows = spark.createDataFrame([([["database", "1.5", "qqqqq", "zzz"], []],), (None,), ([],)], "t array<array<string>>")
    assert [r[0] for r in with_known_tokens(rows, "t", vocab).collect()] == [[["data", "base", "1.5", "zzz"], []], None, []]
    words = spark.createDataFrame([("am",), ("zz",), ("dog",), ("a",), ("b",)], "w string")
    assert sorted(r[0] for r in words.where(keep_word(F.col("w"))).collect()) == ["a", "am", "dog"]


def test_vocabulary_tokenizer(spark, tmp_path):
    (tmp_path / "words.txt").write_text("big\ndog\nzz\nbarked\nlate\n")
    vocab = read_vocabularies(spark, [str(tmp_path / "words.txt")], 4)
    assert vocab == [{"big", "dog", "barked"}]
    pairs = spark.createDataFrame([("1", "the bigdog barked.", "", "x"), ("2", None, None, None)], "pair_id string, text string, text_b string, label string")
    config = load_config({"preprocessing": {"tokenizer": "vocab"}})
    out = {r["group_id"]: r["trees"] for r in parse_pairs(pairs, config, vocab).collect()}
    assert [n["word"] for n in out["1"][0]["nodes"]] == ["the", "big", "dog", "barked", "."] and out["2"] == []


# -- ranking, shards, splits --------------------------------------------------------------


@pytest.mark.parametrize("per_bucket, parts", [(3, 1), (10, 4), (10**6, 17)])
def test_ranks_do_not_depend_on_buckets_or_partitions(spark, per_bucket, parts):
    rng = random.Random(2)
    rows = [(i, rng.choice(["x", "x", "x", "y", None])) for i in rng.sample(range(500), 200)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    df = spark.createDataFrame(rows, "id long, g string").repartition(parts)
    got = {(r["g"], r["id"]): (r["rank"], r["of"]) for r in ranked(df, ["g"], "id", [], None, per_bucket).collect()}
    split = {r["id"]: (r["split"], r["ordinal"], r["shard_index"]) for r in sharding.split_and_shard(df, "id", ["g"], 7, rows_per_bucket=per_bucket).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", old)
    for g in ("x", "y", None):
        ids = sorted(i for i, k in rows if k == g)
        assert [got[g, i] for i in ids] == [(k, len(ids)) for k in range(1, len(ids) + 1)]
        names = [split[i][0] for i in ids]
        n = len(ids)
        assert (names.count("train"), names.count("dev")) == (int(n * 0.8), int(n * 0.1))
        for s in set(names):
            places = sorted(split[i][1] for i in ids if split[i][0] == s)
            assert places == list(range(len(places)))
    assert all(k // 7 == shard for _, k, shard in split.values())


def test_split_sizes(spark):
    names = [r[0] for r in spark.range(1, 10).select(split_name(F.col("id"), F.lit(9))).collect()]
    assert names == ["train"] * 7 + ["test"] * 2


@pytest.mark.parametrize("total, parts, sizes", [(10, 4, [3, 3, 2, 2]), (3, 5, [1, 1, 1]), (6, None, [6]), (6, 3, [2, 2, 2])])
def test_partition_sizes(spark, total, parts, sizes):
    got = [r[0] for r in spark.range(total).select(partition_of(F.col("id"), F.lit(total), parts)).collect()]
    assert [got.count(p) for p in range(len(sizes))] == sizes and got == sorted(got)


def test_shards_in_order_and_counts(spark):
    df = spark.range(23).select("id", F.array_repeat(F.lit(1), (F.col("id") % 3).cast("int")).alias("trees"), F.array(F.lit(1)).alias("trees_b"))
    out = sharding.shard_in_order(df, "id", shard_size=10, rows_per_bucket=4)
    assert [tuple(r) for r in out.select("shard_index", "total_shards", "start_idx", "end_idx").distinct().orderBy("shard_index").collect()] == [(0, 3, 0, 10), (1, 3, 10, 20), (2, 3, 20, 23)]
    counts = {r["shard_index"]: r for r in sharding.shard_counts(out.withColumn("ordinal", F.col("id")), "shard_index").collect()}
    assert counts[2]["n_groups"] == 3 and counts[2]["trees_per_group"] == [2, 0, 1] and counts[2]["trees_b_per_group"] == [1, 1, 1]
    names = spark.range(1).select(
        sharding.shard_file_name(F.lit("part_1"), F.lit(7)), sharding.shard_file_name(F.lit("part_1"), F.lit(7), True), sharding.shard_file_name(F.lit(""), F.lit(7), part=F.lit(2)),
        sharding.embedded_part(F.lit(1), F.lit(2)), sharding.output_folder(F.lit("train"), "json", F.lit("cat"), F.lit(3)), sharding.output_folder(F.lit("dev"), "text"),
    ).first()
    assert list(names) == ["part_1_shard_000007.json", "part_1_shard_000007_counts.json", "part_2_shard_000007.txt", "102", "train/cat/part-00003", "dev"]


# -- rows -----------------------------------------------------------------------------------


def test_projection_ids_and_labels(spark):
    df = spark.createDataFrame([(1, "a", None, None), (2, None, "b", "x")], "id long, t string, u string, l string")
    assert sorted(map(tuple, project_pairs(df, "id", "t", "u", "l").collect()), key=repr) == [("1", "a", "", "1"), ("2", None, "b", "x")]
    ids = [r[0] for r in df.select(stable_id(F.col("id"), F.col("t"))).collect()]
    assert len(set(ids)) == 2 and [len(p) for p in ids[0].split("-")] == [8, 4, 4, 4, 12]
    assert [r[0] for r in without_processed(df, df.where("id = 1"), "id").select("id").collect()] == [2]
    labels = spark.createDataFrame([("a",), ("-",), ("b",)], "label string")
    assert sorted(r["mapped"] for r in map_labels(labels, "label", {"a": 1, "b": -1}, (-2.5, 2.5)).collect()) == [0.6, 1.4]
    with pytest.raises(Exception, match="unknown label: b"):
        map_labels(labels, "label", {"a": 1}).collect()
    assert tuple(skip_rate(labels, "label").first()) == (3, 1, pytest.approx(100 / 3)) and skip_rate(labels.limit(0), "label").first()["percent"] == 0
    lines = spark.createDataFrame([("a\r\n",), ("  ",), ("",)], "value string")
    assert [r[0] for r in text_lines(lines).collect()] == ["a"]


@pytest.mark.parametrize("paired, self_paired, a, b, kept", [(0, 0, 1, 0, 1), (1, 0, 1, 0, 0), (1, 0, 1, 1, 1), (1, 1, 1, 0, 1), (1, 1, 0, 1, 0), (0, 0, 0, 0, 0)])
def test_keep_rule(spark, paired, self_paired, a, b, kept):
    arrays = [F.array_repeat(F.lit(1), n) for n in (a, b)]
    assert spark.range(1).select(keep_group(*arrays, bool(paired), bool(self_paired))).first()[0] == bool(kept)


def test_only_the_first_ten_valid_sentences_are_kept(spark):
    lists = [["w"] * (2 if i % 3 == 0 else 5) for i in range(30)]
    got = spark.createDataFrame([(lists,)], "t array<array<string>>").select(keep_valid(F.col("t"))).first()[0]
    assert [x["sent_idx"] for x in got] == [i for i in range(30) if i % 3][:10]


def test_group_filter(spark):
    df = spark.createDataFrame([("a", [1], [1], "x"), ("b", [1], [], "y"), ("c", None, [1, 2], "z")], "g string, trees array<int>, trees_b array<int>, junk string")
    out = filter_groups(df, 2, ["junk"], {"g": "group_id"})
    assert out.columns == ["group_id", "trees", "trees_b"] and sorted(r[0] for r in out.collect()) == ["a", "c"]


# -- parsers ----------------------------------------------------------------------------------


def test_rule_parser_makes_trees_of_anything(spark):
    rng = random.Random(3)
    words = ["the", "of", "dog", "barked", "quickly", "12", "!", "and", "it", "visible"]
    lists = [rng.choices(words, k=rng.randint(1, 12)) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in lists], "t array<string>")
    for backend in (rule_nodes, chain_nodes):
        for r in df.select("t", backend(F.col("t")).alias("n")).collect():
            heads = [n["head"] for n in r["n"]]
            assert heads.count(0) == 1 and [n["word"] for n in r["n"]] == r["t"]
            for i in range(1, len(heads) + 1):
                seen = 0
                while i:
                    i, seen = heads[i - 1], seen + 1
                    assert seen <= len(heads)


def test_merging_parsers(spark):
    df = spark.createDataFrame([(["the", "dogs", "barked"],)], "t array<string>")
    sources = {"tree": "chain", "deps": "rules", "pos_tags": "rules", "lemmas": "rules", "morph": "rules"}
    n = df.select(parse_sentence(F.col("t"), ["chain", "rules"], sources)).first()[0]
    assert [(x["head"], x["rel"], x["pos"], x["morph"]) for x in n] == [(0, "det", "DET", {}), (1, "nsubj", "NOUN", {"Number": "Plur"}), (2, "root", "VERB", {"Tense": "Past", "VerbForm": "Fin"})]
    register(Backend("broken", frozenset({"tree_structure", "morph"}), lambda t: F.filter(chain_nodes(t), lambda n: n["idx"] > 1)))
    try:
        assert df.select(parse_sentence(F.col("t"), ["chain", "broken"], {"tree": "chain", "morph": "broken"})).first()[0] is None
    finally:
        del BACKENDS["broken"]
    assert df.select(parse_sentence(F.col("t"), ["rules"], FEATURE_SOURCES, 4)).first()[0] is None
    with pytest.raises(ValueError):
        check_sources({"tree": "nobody"}, ["rules"])
    with pytest.raises(ValueError):
        check_sources({"morph": "chain"}, ["chain"])


def test_batch_backends_give_what_expressions_do(spark):
    def load():
        def run(lists):
            return [[{"idx": i, "word": w, "lemma": w.lower(), "pos": "NOUN", "head": i - 1, "rel": "root" if i == 1 else "dep", "morph": {}} for i, w in enumerate(ts, 1)] for ts in lists]

        return run

    register(Backend("batched", frozenset({"tree_structure", "dependency_labels", "pos_tags", "lemmas", "morph"}), batch=load))
    try:
        config = load_config({"parser": {"parsers": ["batched"], "sources": {k: "batched" for k in FEATURE_SOURCES}}})
        pairs = spark.createDataFrame([("1", "one two three. four five six.", "", "x"), ("2", None, None, None)], "pair_id string, text string, text_b string, label string")
        out = {r["group_id"]: r for r in parse_pairs(pairs, config).collect()}
        assert [[n["head"] for n in t["nodes"]] for t in out["1"]["trees"]] == [[0, 1, 2]] * 2 and out["2"]["trees"] == []
    finally:
        del BACKENDS["batched"]


def test_dataset_of_sample_pairs(spark):
    rows = [
        ("1", "The cat chases the mouse.", "The mouse is being chased by the cat.", "entailment"), ("2", "The café is nice!", "It is a coffee shop.", "neutral"),
        ("3", "こんにちは世界", "Hello world", "x"), (None, None, None, None), ("5", "", "", ""),
    ]
    pairs = spark.createDataFrame(rows, "pair_id string, text string, text_b string, label string")
    out = {r["group_id"]: r for r in build_dataset(pairs).collect()}
    assert set(out) == {"1", "2"} and out["1"]["label"] == "entailment"
    assert len(out["1"]["trees"][0]["node_features"]) == 5 and len(out["1"]["trees_b"]) == 1
    assert [r["group_id"] for r in build_dataset(pairs, processed=pairs.where("pair_id = '1'")).collect()] == ["2"]
    plan = build_dataset(pairs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython [") == 1
    mapped = build_dataset(pairs, load_config({"output": {"label_map": {"entailment": 1, "neutral": 0, "1": 0, "x": 0, "": 0}}}))
    assert {r["group_id"]: r["mapped"] for r in mapped.collect()} == {"1": 1.0, "2": 0.0}


# -- embeddings and layouts ---------------------------------------------------------------------


def test_cache_fills_once_and_prepends(spark):
    path = scratch_path(spark, "cache")
    cache = embed.EmbeddingCache(spark, "cache_test", path, 2)
    words = spark.createDataFrame([("test",), ("test",), ("こんにちは",), ("file",), (None,)], "word string")
    calls = embed.hash_encoder(8)
    cache.fill(words, calls)
    cache.fill(words, calls)
    assert cache.read().count() == 3 and embed.misses(words, cache.read()).count() == 0
    assert embed.lookup(words, cache.read()).where("embedding IS NULL").count() == 1
    changed = spark.createDataFrame([("file", [1.0] * 8), ("added", [2.0] * 8)], "word string, embedding array<float>")
    cache.update(changed)
    assert {r["word"]: r["embedding"][0] for r in cache.read().where("word IN ('file', 'added')").collect()} == {"file": 1.0, "added": 2.0} and cache.read().count() == 4
    pairs = spark.createDataFrame([("1", "test file test unknownword", "", "x")], "pair_id string, text string, text_b string, label string")
    tree = embed.prepend_embeddings(build_dataset(pairs), cache.read()).first()["trees"][0]
    vectors = {r["word"]: r["embedding"] for r in cache.read().collect()}
    for features, text in zip(tree["node_features"], tree["node_texts"]):
        assert len(features) == 44 and features[:8] == (vectors.get(text["word"]) or [0.0] * 8)
    assert tree["node_features_need_word_embs_prepended"] is False
    spark.sql("DROP TABLE cache_test")


def test_layouts(spark):
    rows = [(1, "a"), (2, "a"), (3, "b"), (4, None)]
    df = spark.createDataFrame(rows, "id long, label string")
    brute = [(a, p, n) for a, la in rows for p, lp in rows for n, ln in rows if None not in (la, lp, ln) and a != p and la == lp and la != ln]
    assert sorted(map(tuple, contrast.organize(df, "triplet").collect())) == sorted(brute)
    assert sorted(map(tuple, contrast.organize(df, "infonce").collect())) == [(1, 1, 1), (2, 1, 1), (3, 0, 2)]
    assert contrast.organize(df, "supervised").count() == 4
    with pytest.raises(ValueError):
        contrast.organize(df, "other")


def test_config(tmp_path):
    assert deep_merge({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    (tmp_path / "c.json").write_text('{"parser": {"max_trees": 3}}')
    (tmp_path / "c.yaml").write_text("parser:\n  min_tokens: 2\n")
    config = load_config(tmp_path / "c.json", str(tmp_path / "c.yaml"), {"preprocessing": {"strictness": 1}})
    assert (config.parser.max_trees, config.parser.min_tokens, config.parser.max_tokens, config.preprocessing.strictness) == (3, 2, 50, 1)
    assert load_config() == Config()
    for bad in ({"parser": {"x": 1}}, {"x": {}}, {"sharding": {"train": 0.5}}, {"parser": {"sources": {"tree": "none"}}}, {"preprocessing": {"tokenizer": "none"}}, {"sharding": {"shard_size": 0}}):
        with pytest.raises(ValueError):
            load_config(bad)
