import os

import pyarrow.orc as orc
import pytest

from sylvaframe.llm.token_orc import TOKENIZER, load_encoding, lookup, read_by_stripe, read_tokens, write_tokens
from sylvaframe.runtime import scratch_path

from .oddities import LONG, ROWS, clashing, empty, odd, rows_of

pytestmark = pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no vocabulary files")


def test_round_trip_of_whole_texts(spark):
    path = scratch_path(spark, "orc")
    write_tokens(odd(spark), path)
    with open(TOKENIZER, "rb") as f:
        encoding = load_encoding(f.read())
    rows = read_tokens(spark, path).collect()
    back = sorted(((r["doc_id"], None if r["token_ids"] is None else encoding.decode(r["token_ids"])) for r in rows), key=repr)
    assert back == sorted(((i, t) for i, t, *_ in ROWS), key=repr)
    assert all((r["n_tokens"] is None) == (r["token_ids"] is None) and (r["n_tokens"] or 0) == len(r["token_ids"] or []) for r in rows)
    assert any(t == LONG for _, t in back)
    assert sorted(r["doc_id"] for r in lookup(spark, path, [2, 7, 99]).collect()) == [2, 2, 7]


def test_stripes_and_indexes(spark):
    path = scratch_path(spark, "orc")
    docs = spark.range(30_000).selectExpr("id AS doc_id", "concat(repeat(cast(id * 7919 AS string), 20), ' text ', id) AS text").coalesce(1)
    write_tokens(docs, path, stripe_bytes=256 * 1024, row_group=1000)
    assert rows_of(read_by_stripe(spark, path)) == rows_of(read_tokens(spark, path))
    files = [p for p in os.listdir(path.removeprefix("file://")) if p.endswith(".orc")]
    f = orc.ORCFile(os.path.join(path.removeprefix("file://"), files[0]))
    assert f.nstripes > 1 and f.row_index_stride == 1000
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    r = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(f"{path}/{files[0]}"), jvm.org.apache.orc.OrcFile.readerOptions(conf))
    rows = r.rows()
    footer = rows.readStripeFooter(r.getStripes().get(0))
    kinds = [(s.getColumn(), str(s.getKind())) for s in footer.getStreamsList()]
    assert (1, "BLOOM_FILTER_UTF8") in kinds and (1, "ROW_INDEX") in kinds
    assert {str(c.getKind()) for c in footer.getColumnsList()} >= {"DIRECT_V2"}


def test_empty_and_clashing(spark):
    path = scratch_path(spark, "orc")
    write_tokens(empty(spark), path)
    assert read_tokens(spark, path).count() == 0
    path = scratch_path(spark, "orc")
    write_tokens(clashing(spark)[0], path)
    assert read_tokens(spark, path).count() == len(ROWS)
