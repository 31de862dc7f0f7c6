import hashlib

from sylvaframe.llm.digest_index import DigestIndex, digest_of, drop_copies, sorted_scans
from sylvaframe.runtime import scratch_path
from pyspark.sql import functions as F

from .oddities import clashing, empty, odd, rows_of


def index(spark, **options):
    return DigestIndex(spark, scratch_path(spark, "index"), **options)


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_second_batch_meets_the_first(spark):
    ix = index(spark, buckets=4)
    first = drop_copies(ix, docs(spark, [(5, "a"), (3, "a"), (9, "b")]))
    assert rows_of(first) == [(3, "a"), (9, "b")]
    second = drop_copies(DigestIndex(spark, ix.path, 4), docs(spark, [(1, "a"), (2, "c"), (4, "c"), (6, "b")]))
    assert rows_of(second) == [(2, "c")]
    assert ix.read().count() == 3
    third = drop_copies(ix, docs(spark, [(1, "a"), (2, "c")]))
    assert rows_of(third) == [] and ix.read().count() == 3


def test_index_side_is_neither_shuffled_nor_unsorted(spark):
    ix = index(spark, buckets=4)
    drop_copies(ix, docs(spark, [(i, f"t{i}") for i in range(100)]))
    heads = docs(spark, [(1, "t1")]).select(digest_of(F.col("text")).alias("digest"), "doc_id")
    drop_copies(ix, docs(spark, [(200 + i, f"u{i}") for i in range(50)]))
    with sorted_scans(spark):
        plan = ix.unseen(heads)._jdf.queryExecution().executedPlan().toString()
    # two runs: the heads are shuffled and sorted once, the runs neither
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_digest(spark):
    got = docs(spark, [(1, "é")]).select(F.lower(F.hex(digest_of(F.col("text"))))).first()[0]
    assert got == hashlib.sha256("é".encode()).hexdigest()[:32]


def test_oddities(spark):
    out = rows_of(drop_copies(index(spark), odd(spark)).select("doc_id", "text"))
    ids = [i for i, _ in out]
    assert ids.count(1) == 1 and ids.count(2) == 0 and ids.count(3) == 1 and ids.count(4) == 0
    assert ids.count(5) == 2 and ids.count(None) == 2
    df, _ = clashing(spark)
    kept = drop_copies(index(spark), df)
    assert kept.columns == df.columns and kept.count() == len(out)
    ix = index(spark)
    assert drop_copies(ix, empty(spark)).count() == 0 and ix.read().count() == 0


def test_repeated_rows_leave_one(spark):
    assert rows_of(drop_copies(index(spark), docs(spark, [(1, "a")] * 3 + [(None, "a"), (None, "z"), (None, "z")]))) == [(1, "a"), (None, "z")]
