import random

import duckdb
import pytest

from sylvaframe.llm import capture_index
from sylvaframe.llm.capture_index import CAPTURE_SQL, LoserTree, RunReader, capture_query, capture_runs, merge_runs, read_cdx, url_key, write_runs
from pyspark.sql import functions as F


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16])
def test_loser_tree_merges_like_sorting(k):
    rng = random.Random(k)
    runs = [sorted((rng.randint(0, 20), rng.random()) for _ in range(rng.choice([0, 1, 50]))) for _ in range(k)]
    merged = [(runs[r][i], r) for r, i in LoserTree(runs)]
    assert merged == sorted((x, r) for r, run in enumerate(runs) for x in run)


def test_equal_keys_keep_the_order_of_runs():
    assert list(LoserTree([[1, 1], [1], [0, 1]])) == [(2, 0), (0, 0), (0, 1), (1, 0), (2, 1)]


@pytest.mark.parametrize(
    "url, key",
    [
        ("http://www.Example.com/a?b=1#x", "com,example)/a?b=1"), ("https://user:pw@a.b.org:443", "org,b,a)/"), ("http://x.net:8080/p?utm_source=q&z=1", "net,x:8080)/p?z=1"),
        ("http://x.net/?ref=1", "net,x)/"), ("x.net", "net,x)/"), ("", ""), (None, ""), ("http://x.net/?utm_a=1&utm_b=2", "net,x)/"),
        ("http://x.net/p?a=1&utm_a=1&ref=2&b=2&", "net,x)/p?a=1&b=2"), ("http://x.net/p?&&a", "net,x)/p?a"), ("http://x.net/a&ref=1?ref", "net,x)/a&ref=1?ref"), ("x.net?q=1", "net,x)/?q=1"),
    ],
)
def test_url_keys(spark, url, key):
    assert spark.createDataFrame([(url,)], "u string").select(url_key(F.col("u"))).first()[0] == key


def pages(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 40), f"http://h{rng.randint(0, 3)}.example.org/{rng.choice(['', 'a', 'b?ref=1'])}", "<p>x</p>") for _ in range(400)]
    rows += [(None, None, None), (None, "", ""), (5, None, "é"), (5, None, "é"), (-7, "http://z/é", "y" * 500_000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.mark.parametrize("per_range, fan_in", [(7, 64), (50, 2), (50, 3), (10**6, 2), (10**6, 64)])
def test_index_is_that_of_one_sort(spark, per_range, fan_in, monkeypatch):
    monkeypatch.setattr(capture_index, "GROUP_ROWS", 10)
    df = pages(spark)
    frame = df.toPandas()
    frame["page_id"] = frame["page_id"].astype("Int64")
    con = duckdb.connect()
    con.register("pages", frame)
    con.execute("SET TimeZone = 'UTC'")
    want = con.execute(CAPTURE_SQL).df()
    got = merge_runs(capture_runs(df.repartition(6)), per_range, fan_in).toPandas()
    assert sorted(got["pos"]) == list(range(1, len(frame) + 1))
    cols = ["pos", "url_key", "ts", "seq", "page_id", "url", "digest", "n_bytes"]
    assert list(got.columns) == cols
    # of equal captures SQL may number the two columns in different orders
    for some in (["pos", "url_key", "ts"], ["url_key", "ts", "seq"], ["url_key", "ts", "n_bytes"]):
        assert sorted(got[some].itertuples(index=False)) == sorted(want[some].itertuples(index=False))
    assert sorted(got["digest"].dropna()) == sorted(want["digest"].dropna()) and got["page_id"].isna().sum() == 2
    ordered = got.sort_values("pos")
    assert (ordered.groupby("url_key", sort=False).cumcount() + 1 == ordered["seq"]).all()


def test_empty_and_clashing(spark):
    df = pages(spark)
    assert merge_runs(capture_runs(df.limit(0))).count() == 0
    more = df.withColumns({"run": F.lit(1), "ts": F.lit("x"), "pos": F.lit(2)})
    assert merge_runs(capture_runs(more)).count() == df.count()
    assert capture_query(spark, "/root/testdata/sf0.001").count() == 50


def test_a_reader_begins_and_ends_in_the_right_row_groups(spark, monkeypatch):
    monkeypatch.setattr(capture_index, "GROUP_ROWS", 5)
    df = spark.range(100).selectExpr("id AS page_id", "concat('http://h/', lpad(id, 3, '0')) AS url", "'x' AS html").coalesce(1)
    (run,) = capture_runs(df).collect()
    key = lambda i: (f"h)/{i:03d}".encode(), "", -(2**63))
    seen = []
    reader = RunReader([run["file"]], key(23), key(61))
    while reader.rows is not None:
        seen += [k[0] for k in reader.keys]
        assert len(reader.keys) <= 5
        reader.next_batch()
    assert seen == [key(i)[0] for i in range(23, 61)]


def test_records_of_an_index_file(spark, tmp_path):
    lines = ["com,example)/ 20240102000000 http://www.example.com/ text/html 200 SHA1AAA - - 512 0 a.warc.gz", "CDX header", "com,example)/ 20230101000000 http://example.com/ text/html 200 SHA1BBB - - 77 9 b.warc.gz", ""]
    (tmp_path / "x.cdx").write_text("\n".join(lines))
    got = merge_runs(write_runs(read_cdx(spark, str(tmp_path)))).orderBy("pos").collect()
    assert [(r["url_key"], r["ts"], r["seq"], r["digest"], r["n_bytes"]) for r in got] == [("com,example)/", "20230101000000", 1, "sha1bbb", 77), ("com,example)/", "20240102000000", 2, "sha1aaa", 512)]
