import pytest

from sylvaframe.llm import digest_index
from sylvaframe.llm.digest_index import DigestIndex, drop_copies, exact_query
from sylvaframe.runtime import scratch_path

from .oddities import empty, odd, rows_of


def test_the_query_meets_a_filled_index(spark, tmp_path, monkeypatch):
    met = []
    unseen = DigestIndex.unseen
    monkeypatch.setattr(DigestIndex, "unseen", lambda self, heads, batch=None: met.append(self.read().count()) or unseen(self, heads, batch))
    rows = [(1, "a"), (9, "a"), (8, "a"), (2, "b"), (7, "c"), (10, "c"), (None, "c"), (None, "d"), (3, None)]
    for name, docs in (("few", spark.createDataFrame(rows, "doc_id long, text string")), ("odd", odd(spark)), ("empty", empty(spark))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = {(r["digest"], r["doc_id"], r["n_copies"]) for r in exact_query(spark, f"{tmp_path}/{name}").collect()}
        docs.createOrReplaceTempView("documents")
        sql = digest_index.EXACT_SQL.replace("sha256(text)", "sha2(text, 256)")
        assert got == {(r["digest"], r["doc_id"], r["n_copies"]) for r in spark.sql(sql).collect()}
    assert met[:2] == [0, 2]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_a_batch_can_be_run_again(spark):
    """Its digests were stored, its documents were lost: the next run keeps what the first did, and so does one after a later batch."""
    index = DigestIndex(spark, scratch_path(spark, "index"), 4)
    first, second = docs_of(spark, [(1, "a"), (2, "b"), (3, "a"), (4, None)]), docs_of(spark, [(5, "b"), (6, "c")])
    kept = rows_of(drop_copies(index, first, "one"))
    again = DigestIndex(spark, index.path, 4)
    assert rows_of(drop_copies(again, first, "one")) == kept == [(1, "a"), (2, "b"), (4, None)]
    assert rows_of(drop_copies(again, second, "two")) == [(6, "c")]
    assert rows_of(drop_copies(again, first, "one")) == kept and again.read().count() == 3


def test_an_unfinished_run_does_not_count(spark, tmp_path):
    index = DigestIndex(spark, f"file://{tmp_path}/ix", 2)
    drop_copies(index, docs_of(spark, [(1, "a")]), "one")
    (tmp_path / "ix" / "run-1-2" / "_SUCCESS").unlink()
    assert index.read().count() == 0 and rows_of(drop_copies(index, docs_of(spark, [(1, "a")]), "one")) == [(1, "a")]
    assert [n for n, _ in index.runs()] == [2]


def test_buckets_are_those_it_was_made_with(spark):
    path = scratch_path(spark, "index")
    DigestIndex(spark, path, 4)
    with pytest.raises(ValueError, match="4 buckets"):
        DigestIndex(spark, path, 8)


def test_many_batches_are_merged_and_none_is_lost(spark, monkeypatch):
    monkeypatch.setattr(digest_index, "MAX_RUNS", 3)
    index = DigestIndex(spark, scratch_path(spark, "index"), 2)
    for k in range(7):
        rows = [(100 * k + i, f"text {i + 5 * k}") for i in range(10)]
        kept = rows_of(drop_copies(index, docs_of(spark, rows), f"batch {k}"))
        assert kept == rows[5 if k else 0 :]
    assert index.read().count() == 10 + 6 * 5 and len(index.runs()) < 3
    assert rows_of(drop_copies(index, docs_of(spark, rows), "batch 6")) == kept
