"""That looking ids up reads few row groups, and that stripes are read each by itself."""

from pyspark.sql import functions as F

from sylvaframe.llm.token_orc import lookup, read_by_stripe, read_tokens, stripes, write_tokens

from .oddities import odd, rows_of


def scanned_rows(df):
    """Rows that the scan itself gave, after row groups were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().apply(0)
    return int(plan.metrics().apply("numOutputRows").value())


def test_a_lookup_skips_row_groups(spark, tmp_path):
    docs = spark.range(40_000).select((F.col("id") * 3).alias("doc_id"), F.concat(F.lit("text number "), F.col("id").cast("string")).alias("text")).repartition(2)
    path = f"file://{tmp_path}/orc"
    write_tokens(docs, path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # between the ids that are there: within every range, so that only the Bloom filter can tell
        inside, absent = lookup(spark, path, [3 * 777]), lookup(spark, path, [3 * 777 + 1])
        assert scanned_rows(read_tokens(spark, path)) == 40_000
        assert scanned_rows(inside) <= 2_000 and inside.count() == 1
        assert scanned_rows(absent) <= 1_000 and absent.count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_stripes_are_read_apart(spark, tmp_path):
    path = f"file://{tmp_path}/orc"
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    write_tokens(docs.coalesce(1), path, stripe_bytes=256 * 1024)
    assert stripes(spark, path).count() > 1
    assert sorted(r[0] for r in read_by_stripe(spark, path).select("doc_id").collect()) == list(range(30_000))
    again = f"file://{tmp_path}/odd"
    write_tokens(odd(spark), again)
    assert rows_of(read_by_stripe(spark, again)) == rows_of(read_tokens(spark, again))
