"""Mixing sources to target weights by systematic sampling.

Each document has an expected number of copies: its source's share of the token
budget over the tokens the source has, or what a column of the caller's says.
Within a source, documents stand in the order of a hash of their id and text;
the prefix sums of their expected copies, shifted by one random offset for the
source, are laid along the integers, and a document is emitted once for each
integer boundary its own stretch crosses. Counts are thus exact to within one
copy of the target for each source.

Expected copies are fractions of whole numbers, and sums are taken over their
numerators (decimals of 38 digits), so that no rate is rounded, however small,
and sums don't depend on the order of addition. A source, however hot, is cut
into buckets by the leading bits of the hash: bucket totals are prefix-summed in
a small table, documents within their bucket only. What is sorted holds ids and
hashes; equal rows are counted together first, so that repeats don't meet in a
bucket. A text moves only where the list of documents that don't get their
source's usual number of copies is too long to be broadcast.

Defined results: a null source is a source of its own, with weight 1 as any
source without a given one; a null or empty text, or a very long one, has its
length and the same expected copies as its source's others; a source without
any tokens keeps each document once. Null ids come first among equal hashes;
repeated rows each count, and share the copies of all of them evenly; other ties
in the order are broken by a hash of the whole row. An empty table gives no
rows. Extra columns pass through unchanged, clashing names too. An expected
number that is null or negative counts as 0.
"""

from __future__ import annotations

from fractions import Fraction
from math import lcm

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import Shield, materialize, pick, small_side

SEED = 17
ROWS_PER_BUCKET = 50_000
#: Weights of the sources; one that isn't named weighs 1.
WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 0.5}
#: Expected copies that a column gives are taken to so many digits after the point.
DIGITS = 9
WHOLE = "decimal(38,0)"
#: Nulls are told from every string by a column of their own, so that plain equality serves as key.
_SOURCE = ["no_source", "source_key"]


def hash_of(value: Column) -> Column:
    """The leading 32 bits of an MD5, which other SQL engines compute alike."""
    return F.conv(F.substring(F.md5(value.cast("string").cast("binary")), 1, 8), 16, 10).cast("long")


def whole_weights(weights: dict[str, float]) -> tuple[dict[str, int], int]:
    """The weights times a common whole number, and that number, which is the weight of any other source."""
    exact = {k: Fraction(str(w)) for k, w in weights.items()}
    unit = lcm(*[w.denominator for w in exact.values()]) if exact else 1
    out = {k: int(w * unit) for k, w in exact.items()}
    if max([unit, *out.values()]) > 10**12 or min([0, *out.values()]) < 0:
        raise ValueError("weights must not be negative, and must be multiples of a common 1/n with n and all multiples up to 10**12")
    return out, unit


def rates(totals: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(no_source, source_key, tokens) to each source's step and span: step / span copies are expected of a document."""
    named, unit = whole_weights(weights)
    weight = F.lit(unit)
    for name, w in named.items():
        weight = F.when(~F.col("no_source") & (F.col("source_key") == F.lit(name)), F.lit(w)).otherwise(weight)
    weighed = totals.withColumn("weight", weight.cast(WHOLE))
    live = F.when(F.col("tokens") > 0, F.col("weight")).otherwise(F.lit(0)).cast(WHOLE)
    whole = weighed.crossJoin(
        F.broadcast(weighed.agg(F.sum("tokens").cast(WHOLE).alias("budget"), F.sum(live).cast(WHOLE).alias("all_weight")))  # one row
    )
    some = (F.col("tokens") > 0) & (F.col("all_weight") > 0)
    return whole.select(
        *_SOURCE,
        F.when(some, F.col("budget") * F.col("weight")).otherwise(F.lit(1)).cast(WHOLE).alias("step"),
        F.when(some, F.col("all_weight") * F.col("tokens")).otherwise(F.lit(1)).cast(WHOLE).alias("span"),
    )


def with_offset(rated: DataFrame) -> DataFrame:
    """Adds each source's offset, a number of [0, span)."""
    name = F.when(F.col("no_source"), F.lit("\\N")).otherwise(F.col("source_key"))
    drawn = hash_of(F.concat(F.lit(f"{SEED}|"), name)).cast(WHOLE)
    product = (drawn * F.col("span")).cast(WHOLE)
    # exact: what is divided is a multiple of the divisor
    return rated.withColumn("offset", ((product - F.pmod(product, F.lit(2**32).cast(WHOLE))) / F.lit(2**32).cast(WHOLE)).cast(WHOLE))


def _div(a: Column, b: Column) -> Column:
    """Whole part of a quotient that fits in a long."""
    return F.call_function("div", a, b)


def copies(docs: DataFrame, weights: dict[str, float] | None = None, rows_per_bucket: int = ROWS_PER_BUCKET, size: str = "text", expected: str | None = None) -> tuple[DataFrame, DataFrame, int]:
    """(table of copies, table of the sources' usual number, number of sources).

    The table has a line for each distinct row: no_source, source_key, doc_id,
    row_hash, size, ``rows`` (how often it occurs) and ``copies`` of all of them
    together.
    """
    shield = Shield(docs, "doc_id", "source", size, *([expected] if expected else []))
    kind = shield.df.schema[shield.alias(size)].dataType.typeName()
    tokens = F.length(shield[size]) if kind == "string" else shield[size]
    source = shield["source"].cast("string")
    given = F.greatest(F.coalesce(shield[expected].cast(f"decimal(38,{DIGITS})"), F.lit(0)), F.lit(0)) * F.lit(10**DIGITS) if expected else F.lit(0)
    text = F.concat_ws("|", *[F.coalesce(shield[c].cast("string"), F.lit("\\N")) for c in ("doc_id", size)])
    rows = shield.df.select(
        source.isNull().alias("no_source"),
        F.coalesce(source, F.lit("")).alias("source_key"),
        hash_of(text).alias("key"),
        shield["doc_id"].alias("doc_id"),
        F.xxhash64(*shield.aliases).alias("row_hash"),
        F.coalesce(tokens, F.lit(0)).cast("long").alias("size"),
        given.cast(WHOLE).alias("given"),
    )
    distinct = materialize(rows.groupBy(*_SOURCE, "key", "doc_id", "row_hash", "size", "given").agg(F.count(F.lit(1)).alias("rows")), "mixed-rows")
    totals = materialize(distinct.groupBy(*_SOURCE).agg(F.sum(F.col("size").cast(WHOLE) * F.col("rows")).cast(WHOLE).alias("tokens"), F.count(F.lit(1)).alias("lines")), "mixed-sources")
    if expected:
        rated = totals.select(*_SOURCE, F.lit(0).cast(WHOLE).alias("step"), F.lit(10**DIGITS).cast(WHOLE).alias("span"))
    else:
        rated = rates(totals, WEIGHTS if weights is None else weights)
    rated = with_offset(rated)
    sources, most = totals.agg(F.count(F.lit(1)), F.coalesce(F.max("lines"), F.lit(0))).first()
    # a power of two, so that a bucket is a run of leading bits
    bits = min(31, (most // rows_per_bucket).bit_length())
    parts = [*_SOURCE, "bucket"]
    step = F.col("given") if expected else F.col("step")
    work = distinct.withColumn("bucket", F.shiftright("key", 32 - bits).cast("int")).join(small_side(rated, sources, 128), _SOURCE)
    work = work.withColumn("length", (step * F.col("rows")).cast(WHOLE))
    counted = work.groupBy(*parts).agg(F.sum("length").cast(WHOLE).alias("all"))
    before = Window.partitionBy(*_SOURCE).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counted.select(*parts, F.coalesce(F.sum("all").over(before), F.lit(0)).cast(WHOLE).alias("ahead"))
    order = Window.partitionBy(*parts).orderBy(F.col("key"), F.col("doc_id").asc_nulls_first(), "row_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # beyond the broadcast limit the join reuses the window's partitioning
    summed = work.withColumn("within", F.sum("length").over(order).cast(WHOLE)).join(small_side(ahead, sources * 2**bits, 64), parts)
    upto = (F.col("offset") + F.col("ahead") + F.col("within")).cast(WHOLE)
    crossed = _div(upto, F.col("span")) - _div((upto - F.col("length")).cast(WHOLE), F.col("span"))
    table = summed.select(*_SOURCE, "doc_id", "row_hash", "size", "rows", crossed.alias("copies"))
    usual = rated.select(*_SOURCE, _div(F.col("step"), F.col("span")).alias("usual"))
    return table, usual, sources


def mix(docs: DataFrame, weights: dict[str, float] | None = None, rows_per_bucket: int = ROWS_PER_BUCKET, size: str = "text", expected: str | None = None) -> DataFrame:
    """Documents, each as often as its copies say; all columns unchanged.

    ``size``: the column whose length (a string) or value (a number) is summed.
    ``expected``: a column of each document's own expected copies; weights and
    sizes then play no part.
    """
    table, usual, sources = copies(docs, weights, rows_per_bucket, size, expected)
    shield = Shield(docs, "doc_id", "source", size)
    source = shield["source"].cast("string")
    work = shield.df.withColumns({"no_source": source.isNull(), "source_key": F.coalesce(source, F.lit("")), "id": shield["doc_id"], "hash": F.xxhash64(*shield.aliases)})
    each, rest = _div(F.col("copies"), F.col("rows")), F.col("copies") % F.col("rows")
    odd = table.join(small_side(usual, sources, 64), _SOURCE).withColumns({"each": each, "rest": rest}).where("each <> usual OR rest > 0")
    odd = materialize(odd.select(F.col("doc_id").alias("odd_id"), F.col("row_hash").alias("odd_hash"), "each", "rest"), "copies")
    lines, shared = odd.agg(F.count(F.lit(1)), F.count_if(F.col("rest") > 0)).first()
    match = F.col("id").eqNullSafe(F.col("odd_id")) & (F.col("hash") == F.col("odd_hash"))
    placed = work.join(small_side(odd, lines, 48), match, "left").join(small_side(usual, sources, 64), _SOURCE)
    n = F.coalesce(F.col("each"), F.col("usual")).cast("int")
    out = placed.where(n > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), n))).select(*shield.aliases)
    if shared:
        # copies that don't go evenly into repeated rows: one of the equal rows stands for all
        left = work.join(small_side(odd.where("rest > 0"), shared, 48), match)
        once = left.groupBy("id", "hash").agg(F.any_value(F.struct(*shield.aliases)).alias("row"), F.max("rest").alias("rest"))
        out = out.unionByName(once.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rest").cast("int")))).select("row.*"))
    return shield.restore(out)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: source shares by characters brought to WEIGHTS."""
    return mix(docs)


def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_chars) once for each copy of the document in the mix."""
    docs = pick(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "source", "text")
    table, _, _ = copies(docs)
    rows = table.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.select("doc_id", F.when(~F.col("no_source"), F.col("source_key")).alias("source"), F.col("size").cast("int").alias("n_chars"))


_NAMED, _UNIT = whole_weights(WEIGHTS)
_WEIGHT_SQL = "CASE source " + " ".join(f"WHEN '{k}' THEN {w}" for k, w in _NAMED.items()) + f" ELSE {_UNIT} END::HUGEINT"
MIXING_SQL = f"""
WITH totals AS (
  SELECT source, sum(coalesce(length(text), 0))::HUGEINT AS tokens, {_WEIGHT_SQL} AS weight FROM documents GROUP BY source
), whole AS (
  SELECT sum(tokens)::HUGEINT AS budget, sum(CASE WHEN tokens > 0 THEN weight ELSE 0 END)::HUGEINT AS all_weight FROM totals
), rated AS (
  SELECT source, CASE WHEN tokens > 0 THEN budget * weight ELSE 1 END AS step, CASE WHEN tokens > 0 THEN all_weight * tokens ELSE 1 END AS span FROM totals, whole
), shifted AS (
  SELECT *, (('0x' || substr(md5('{SEED}|' || coalesce(source, '\\N')), 1, 8))::BIGINT::HUGEINT * span) // 4294967296::HUGEINT AS off FROM rated
), placed AS (
  SELECT d.doc_id, d.source, coalesce(length(d.text), 0)::INTEGER AS n_chars, step, span, off,
    row_number() OVER (PARTITION BY d.source ORDER BY ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '\\N') || '|' || coalesce(d.text, '\\N')), 1, 8))::BIGINT, d.doc_id NULLS FIRST) AS k
  FROM documents d JOIN shifted r ON d.source IS NOT DISTINCT FROM r.source
), counted AS (
  SELECT doc_id, source, n_chars, ((off + k * step) // span - (off + (k - 1) * step) // span)::BIGINT AS copies FROM placed
)
SELECT doc_id, source, n_chars FROM (SELECT *, unnest(range(copies)) AS i FROM counted) WHERE copies > 0
"""
