"""Exact dedup against a persistent digest index.

The index is a set of runs, each a Parquet table bucketed and sorted by digest
with one file a bucket. A batch is reduced to one head per digest, which is
shuffled and sorted once and then sort-merge anti-joined with each run in turn;
the runs' side needs neither shuffle nor sort, as their files' order is used.
The new heads are appended as a run. Runs of like size are merged into one when
there are MAX_RUNS, so each digest is sorted anew a logarithmic number of times
only. 16-byte digests and ids are all that is shuffled for that; texts move only
where a document may have to go, see ``drop_copies``.

A digest is stored with the name of the batch that brought it, and a batch never
meets its own. So a batch that was indexed before its documents were written can
be run again, after a crash, with the same result.

The digest is the first 128 bits of SHA-256 over the text's bytes.

Defined results: of equal texts the least doc_id stays, null ids last; rows
repeated in full leave one. A null text equals no other, so its rows all stay
and are not indexed; the empty text is a text like any other, as is a very long
one. An empty table leaves the index as it was. Extra columns pass through
unchanged, clashing names too; of repeated rows that differ in extra columns
only, one is picked by a hash of the row.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import Shield, materialize, pick, scratch_path, small_side

#: Buckets of a new index for up to BUCKET_ROWS digests each; a merge of runs takes more if there are more.
BUCKETS = 32
BUCKET_ROWS = 10_000_000
#: So many runs are merged, those of the last ones that are of like size.
MAX_RUNS = 8
SCHEMA = "digest BINARY, doc_id BIGINT, batch STRING"
#: Lets a scan of one sorted file a bucket count as sorted.
_ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def digest_of(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32))


@contextmanager
def sorted_scans(spark: SparkSession) -> Iterator[None]:
    """Plans made within use the order of the runs' files."""
    was = spark.conf.get(_ORDERED, "false")
    spark.conf.set(_ORDERED, "true")
    try:
        yield
    finally:
        spark.conf.set(_ORDERED, was)


class DigestIndex:
    """The index at ``path``; created on first use, reopened afterwards.

    A run lies in a folder ``run-<number>-<buckets>``; one without ``_SUCCESS``
    was not finished and is left aside. ``merged-<numbers>`` in a run's ``_of``
    file names the runs it replaces, which are passed over from then on.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self._fs().mkdirs(self._p(self.path))
        known = self._read_json("index.json")
        if known is None:
            self._write_json("index.json", {"buckets": buckets})
        elif known["buckets"] != buckets:
            raise ValueError(f"the index at {path} was made with {known['buckets']} buckets, not {buckets}")

    # -- files ---------------------------------------------------------------------

    def _p(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._p(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _read_json(self, name: str) -> dict | None:
        if not self._fs().exists(self._p(f"{self.path}/{name}")):
            return None
        rows = self.spark.read.text(f"{self.path}/{name}", wholetext=True).collect()
        return json.loads(rows[0][0])

    def _write_json(self, name: str, value: dict) -> None:
        out = self._fs().create(self._p(f"{self.path}/{name}"), True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()

    def runs(self) -> list[tuple[int, int]]:
        """(number, buckets) of the runs that count, oldest first."""
        found, gone = [], set()
        for status in self._fs().listStatus(self._p(self.path)):
            name = status.getPath().getName()
            if name.startswith("run-") and self._fs().exists(self._p(f"{self.path}/{name}/_SUCCESS")):
                number, buckets = map(int, name.split("-")[1:])
                replaced = self._read_json(f"of-{number}.json")
                if replaced is not None:
                    gone.update(replaced["runs"])
                found.append((number, buckets))
        return sorted(r for r in found if r[0] not in gone)

    def _table(self, number: int, buckets: int) -> str:
        name = f"digest_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}_{number}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({SCHEMA}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}/run-{number}-{buckets}'"
        )
        return name

    # -- reading and writing ----------------------------------------------------------

    def read(self) -> DataFrame:
        """(digest, doc_id, batch) of all runs."""
        out = self.spark.createDataFrame([], SCHEMA)
        for run in self.runs():
            out = out.unionByName(self.spark.table(self._table(*run)))
        return out

    def unseen(self, heads: DataFrame, batch: str | None = None) -> DataFrame:
        """Heads whose digest the index lacks, other batches' that is; by sort-merge anti-joins, run after run."""
        out = heads
        for run in self.runs():
            theirs = self.spark.table(self._table(*run))
            if batch is not None:
                theirs = theirs.where(F.col("batch") != F.lit(batch))
            out = out.join(theirs.select("digest").hint("merge"), "digest", "left_anti")
        return out

    def has(self, batch: str) -> bool:
        return any(not self.spark.table(self._table(*run)).where(F.col("batch") == F.lit(batch)).isEmpty() for run in self.runs())

    def append(self, heads: DataFrame, batch: str | None = None) -> None:
        """Adds (digest, doc_id) rows as a run; nothing for a batch that is there."""
        batch = uuid.uuid4().hex if batch is None else batch
        if not self.has(batch):
            self._write(heads.select("digest", "doc_id", F.lit(batch).alias("batch")), self.buckets)
        if len(self.runs()) >= MAX_RUNS:
            self.merge()

    def _write(self, rows: DataFrame, buckets: int, replaced: list[int] | None = None) -> None:
        number = 1 + max([n for n, _ in self._numbers()], default=0)
        if replaced:
            self._write_json(f"of-{number}.json", {"runs": replaced})
        name = f"digest_{uuid.uuid4().hex}"
        out = rows.repartition(buckets, "digest").write.format("parquet").mode("overwrite").option("path", f"{self.path}/run-{number}-{buckets}")
        out.bucketBy(buckets, "digest").sortBy("digest").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")

    def _numbers(self) -> list[tuple[int, int]]:
        names = [s.getPath().getName() for s in self._fs().listStatus(self._p(self.path))]
        return [tuple(map(int, n.split("-")[1:])) for n in names if n.startswith("run-")]

    def merge(self) -> None:
        """The newest runs that are together as large as the one before them become one run, of more buckets if need be."""
        runs = self.runs()
        sizes = [self.spark.table(self._table(*r)).count() for r in runs]
        first = len(runs) - 1
        while first and sizes[first - 1] <= 2 * sum(sizes[first:]):
            first -= 1
        taken = runs[first:] if first < len(runs) - 1 else runs[-2:]
        rows, total = None, sum(sizes[-len(taken) :])
        for r in taken:
            part = self.spark.table(self._table(*r))
            rows = part if rows is None else rows.unionByName(part)
        self._write(rows, max(self.buckets, 2 ** math.ceil(math.log2(max(1, total / BUCKET_ROWS)))), [n for n, _ in taken])


def admit(index: DigestIndex, keyed: DataFrame, batch: str | None = None) -> DataFrame:
    """Index the new digests of (digest, doc_id) rows.

    Returns the admitted heads (digest, doc_id, n_copies), read from a written
    table so that what was admitted does not change when the index has grown.
    ``batch``: a name; run again under the same one, a batch gives the same heads.
    """
    return admit_heads(index, heads_of(keyed), batch)


def heads_of(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n_copies"))


def admit_heads(index: DigestIndex, heads: DataFrame, batch: str | None = None) -> DataFrame:
    with sorted_scans(index.spark):
        admitted = materialize(index.unseen(heads, batch), "heads")
    index.append(admitted, batch)
    return admitted


def admit_in_two(index: DigestIndex, keyed: DataFrame) -> DataFrame:
    """As admit, in two batches: the lower half of the range of ids, then the rest and the null ids.

    Copies of the second batch that the first has indexed are added to its counts.
    """
    least, most = keyed.agg(F.min("doc_id"), F.max("doc_id")).first()
    lower = F.coalesce(F.col("doc_id") <= F.lit(None if least is None else (least + most) // 2), F.lit(False))
    first = admit(index, keyed.where(lower), "lower")
    heads = materialize(heads_of(keyed.where(~lower)), "batch")
    second = admit_heads(index, heads, "upper")
    again = heads.join(second, "digest", "left_anti").select("digest", F.col("n_copies").alias("more"))
    n_copies = (F.col("n_copies") + F.coalesce("more", F.lit(0))).alias("n_copies")
    return first.join(again, "digest", "left").select("digest", "doc_id", n_copies).unionByName(second)


def drop_copies(index: DigestIndex, docs: DataFrame, batch: str | None = None) -> DataFrame:
    """The documents that stay, all columns unchanged.

    With a ``batch`` name the call may be repeated, should its result be lost.

    The rows to remove are gathered as (digest, id) pairs. Few of them are
    broadcast, so that no text is shuffled; many are joined by shuffle.
    """
    shield = Shield(docs, "doc_id", "text")
    doc_id, digest = shield["doc_id"], digest_of(shield["text"])
    work = shield.df.withColumns({"digest": digest, "key_id": doc_id})
    pairs = materialize(
        work.where(F.col("digest").isNotNull()).groupBy("digest", "key_id").agg(F.count(F.lit(1)).alias("rows")), "pairs"
    )
    admitted = admit(index, pairs.select("digest", F.col("key_id").alias("doc_id")), batch)
    verdict = pairs.join(admitted.select("digest", F.col("doc_id").alias("head")).withColumn("new", F.lit(True)), "digest", "left")
    stays = F.col("new") & F.col("key_id").eqNullSafe(F.col("head"))
    special = materialize(
        verdict.withColumn("stays", F.coalesce(stays, F.lit(False))).where(~F.col("stays") | (F.col("rows") > 1)).select(
            F.col("digest").alias("gone_digest"), F.col("key_id").alias("gone_id"), "stays"
        ),
        "gone",
    )
    counts = special.agg(F.count(F.lit(1)), F.count_if(F.col("stays"))).first()
    match = F.col("digest").eqNullSafe(F.col("gone_digest")) & F.col("key_id").eqNullSafe(F.col("gone_id"))
    kept = work.join(small_side(special, counts[0], 48), match, "left_anti")
    if counts[1]:
        repeated = work.join(small_side(special.where("stays"), counts[1], 48), match, "left_semi")
        cols = F.struct(*shield.aliases)
        once = repeated.groupBy("digest", "key_id").agg(F.min_by(cols, F.xxhash64(*shield.aliases)).alias("row"))
        kept = kept.select(*shield.aliases).unionByName(once.select("row.*"))
    return shield.restore(kept)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: exact dedup against an index of this run's own."""
    return drop_copies(DigestIndex(spark, scratch_path(spark, "digest-index")), docs)


def exact_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, digest, n_copies) of each admitted document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    keyed = pick(docs, "doc_id", "text").select(digest_of(F.col("text")).alias("digest"), "doc_id").where(F.col("digest").isNotNull())
    admitted = admit_in_two(DigestIndex(spark, scratch_path(spark, "digest-index")), keyed)
    return admitted.select("doc_id", F.lower(F.hex("digest")).alias("digest"), "n_copies")


EXACT_SQL = """
SELECT min(doc_id) AS doc_id, substr(sha256(text), 1, 32) AS digest, count(*) AS n_copies
FROM documents WHERE text IS NOT NULL GROUP BY substr(sha256(text), 1, 32)
"""
