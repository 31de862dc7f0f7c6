"""Token-ID output: ORC files with run-length encoded ids, row indexes and Bloom filters.

Texts are tokenized with the ranks of a public byte-level BPE (a path, read on
the driver and broadcast: its size is that of the vocabulary file) and written
through Spark's ORC writer: list elements are integers, which ORC stores with
its run-length encoding, doc_id gets a row index and a Bloom filter for each
row group. Rows are sorted by doc_id within each file, with no shuffle, so the
indexes' ranges are narrow.

Reading: ``read_tokens`` is a plain scan, whose doc_id predicates ORC prunes by
stripe and row-group metadata; ``lookup`` uses that for a set of ids;
``read_by_stripe`` reads each stripe as a task of its own.

Defined results: a null text has null ids and a null count, an empty one an
empty list; repeated rows are all written; null ids sort first. An empty table
gives an empty one. Columns other than doc_id and text are left out. Text that
looks like a special token is encoded as ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import pick, scratch_path

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's own texts were cut into words.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
STRIPE_BYTES = 64 * 1024 * 1024
ROW_GROUP = 1000
SCHEMA = "doc_id long, n_tokens int, token_ids array<int>"


def load_encoding(ranks_file: bytes):
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks_file.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ranks_of(spark: SparkSession, tokenizer: str):
    """The vocabulary file, broadcast; its size doesn't depend on the corpus."""
    with open(tokenizer, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that texts and ids of few rows are held as Python objects."""
    for batch in batches:
        for at in range(0, max(1, len(batch)), rows):
            yield batch.slice(at, rows)


def encoded(encoding, texts: list, end: bool = False) -> tuple[pa.Array, np.ndarray]:
    """(token ids of each text as a list array, null for null; counts). With ``end`` the id after the last rank closes each text, null ones too."""
    last = np.array([encoding.max_token_value + 1], np.uint32)
    ids = [np.empty(0, np.uint32) if t is None else encoding.encode_to_numpy(t, disallowed_special=()) for t in texts]
    if end:
        ids = [np.concatenate([x, last]) for x in ids]
    counts = np.array([len(x) for x in ids], np.int64)
    offsets = np.r_[0, counts.cumsum()].astype(np.int32)
    flat = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
    mask = None if end else pa.array([t is None for t in texts], pa.bool_())
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=mask) if len(ids) else pa.array([], pa.list_(pa.int32()))
    return lists, counts


def tokenize(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens, token_ids), sorted by doc_id within each partition."""
    ranks_file = ranks_of(docs.sparkSession, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(ranks_file.value)
        for batch in sliced(batches):
            texts = batch.column(1).to_pylist()
            lists, counts = encoded(encoding, texts)
            null = np.array([t is None for t in texts], bool)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts.astype(np.int32), mask=null), lists], ["doc_id", "n_tokens", "token_ids"])

    return pick(docs, "doc_id", "text").sortWithinPartitions("doc_id").mapInArrow(run, SCHEMA)


def write_tokens(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, stripe_bytes: int = STRIPE_BYTES, row_group: int = ROW_GROUP) -> None:
    (
        tokenize(docs, tokenizer)
        .write.format("orc")
        .option("compression", "zstd")
        .option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", row_group)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", 0.01)
        .save(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(path)


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of the given ids; ORC skips row groups by range and Bloom filter."""
    return read_tokens(spark, path).where(F.col("doc_id").isin([int(i) for i in doc_ids]))


def _open(uri: str):
    from pyarrow import fs, orc

    system, name = fs.FileSystem.from_uri(uri)
    return orc.ORCFile(system.open_input_file(name))


def stripes(spark: SparkSession, path: str) -> DataFrame:
    """(file, stripe) of every stripe, from the files' footers."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for rows in batches:
            for uri in rows["file"]:
                yield pd.DataFrame({"file": uri, "stripe": np.arange(_open(uri).nstripes, dtype=np.int32)})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.orc").load(path).select(F.regexp_replace("path", "^file:/+", "file:///").alias("file"))
    return files.mapInPandas(run, "file string, stripe int")


def read_by_stripe(spark: SparkSession, path: str) -> DataFrame:
    """All rows, with one unit of work for each stripe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, stripe in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = pa.Table.from_batches([_open(uri).read_stripe(stripe)])
                yield from got.cast(pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int32()), ("token_ids", pa.list_(pa.int32()))])).to_batches(2000)

    index = stripes(spark, path)
    # one task for some stripes, as many as the cluster has room for; none moves but the names
    return index.repartition(spark.sparkContext.defaultParallelism * 4, "file", "stripe").mapInArrow(run, SCHEMA)


def token_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids, written as ORC and read back stripe by stripe."""
    path = scratch_path(spark, "token-orc")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_by_stripe(spark, path)
