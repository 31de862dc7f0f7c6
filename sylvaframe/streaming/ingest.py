"""Incremental dataset building with Structured Streaming.

New files are taken up by a file stream, each batch is turned into groups and
appended; the checkpoint remembers the files, so a restart goes on where it
stopped. A batch's rows go to a folder of its own that a replay overwrites, so
a batch counts once. Ids already written are left out by an anti-join.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Config
from ..operators.prepare import without_processed
from ..plans.dataset import build_dataset
from ..runtime import shared_dir, short_row_groups
from ..schemas import PAIR


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def processed_ids(spark: SparkSession, out: str, before_batch: int | None = None) -> DataFrame | None:
    """(pair_id) of the written groups; null if nothing was written."""
    if not _exists(spark, out):
        return None
    done = spark.read.parquet(out)
    if before_batch is not None:
        done = done.where(F.col("batch_id") != before_batch)
    return done.select(F.col("group_id").alias("pair_id"))


def write_batch(pairs: DataFrame, batch_id: int, out: str, config: Config) -> None:
    """One batch: unseen ids only, each id once; replaying it gives the same folder."""
    spark = pairs.sparkSession
    fresh = pairs.dropDuplicates(["pair_id"])
    done = processed_ids(spark, out, batch_id)
    if done is not None:
        fresh = without_processed(fresh, done, "pair_id")
    groups = build_dataset(fresh, config)
    short_row_groups(groups.write).mode("overwrite").parquet(f"{out}/batch_id={batch_id}")


def ingest(
    spark: SparkSession, folder: str, out: str, config: Config = Config(), checkpoint: str | None = None, files_per_batch: int | None = None
) -> StreamingQuery:
    """Takes up all files (Parquet in PAIR's schema) that are there and stops.

    ``checkpoint``: by default a folder beside ``out`` in the session's shared folder.
    """
    stream = spark.readStream.schema(PAIR)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    where = checkpoint or f"{shared_dir(spark)}/stream-{uuid.uuid5(uuid.NAMESPACE_URL, out).hex}"
    writer = stream.parquet(folder).writeStream.foreachBatch(lambda df, k: write_batch(df, k, out, config))
    return writer.option("checkpointLocation", where).trigger(availableNow=True).start()


def distinct_stream(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Each key once, with state kept for as long as ``delay`` only."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def resume_parts(batches: DataFrame, done: DataFrame) -> DataFrame:
    """The (part, batch_idx) rows still to do: parts not written in full."""
    return batches.join(done.select(F.col("part").alias("_p"), F.col("batch_idx").alias("_b")), (F.col("part") == F.col("_p")) & (F.col("batch_idx") == F.col("_b")), "left_anti")
