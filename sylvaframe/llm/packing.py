"""Packing: sum-of-squares online packing of documents into token windows.

Csirik et al.'s rule: with N(h) the number of partially filled windows at level
h, an item goes where the sum of N(h)^2 after placing it is least. N is the
level array; full windows leave it. Ties go to the fullest level, a new window
last. A document longer than the window is cut into full windows and one rest,
so no token is dropped. Items are the token ids of a public byte-level BPE, with
one end-of-document id after each document; the result are the windows with
their ids.

Documents are dealt to shards by a hash of their id and text, and each shard is
packed on its own in arrival order (doc_id, then length, then text hash). A row
that is repeated so often that it would fill a shard is dealt out evenly. The
number of shards follows the documents and characters there are, so that a shard
is one task's work at any size; windows are the same at any partitioning.

Defined results: a null or empty text still has its end token and so takes one
slot of length 1; null ids come first in the order; a very long text fills
windows of its own; ties and repeated rows are packed as often as they occur; an
empty table gives no rows; columns other than doc_id and text are ignored,
whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import materialize, pick, small_side
from .token_orc import TOKENIZER, encoded, load_encoding, ranks_of, sliced

WINDOW = 2048
DOCS_PER_SHARD = 20_000
#: A task holds a shard's token ids a few times over.
CHARS_PER_SHARD = 12_000_000
#: Windows that leave a task together.
CHUNK = 500

WINDOWS = "shard long, window long, n_tokens int, doc_ids array<long>, pieces array<struct<doc_id:long,piece:long,start:int,n_tokens:int>>, token_ids array<int>"
_PIECE = pa.struct([("doc_id", pa.int64()), ("piece", pa.int64()), ("start", pa.int32()), ("n_tokens", pa.int32())])


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and start of each item, in order of arrival."""
    level = np.zeros(capacity + 1, dtype=np.int64)
    stacks: dict[int, list[int]] = {}
    window, start = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = 0
    for i, size in enumerate(lengths.tolist()):
        if size >= capacity:
            window[i], start[i] = opened, 0
            opened += 1
            continue
        # Half the change of the sum of squares less a half: moving h to h+size
        # gives N(h+size) - N(h) + 1/2, filling a window up -N(h), opening N(size).
        top = capacity - size
        change = 2 * (level[size + 1 : capacity + 1] - level[1 : top + 1]) + 1
        change[-1] = -2 * level[top]
        change[level[1 : top + 1] == 0] = np.iinfo(np.int64).max
        reverse = int(change[::-1].argmin())
        h = top - reverse
        if change[h - 1] <= 2 * level[size]:
            w = stacks[h].pop()
            level[h] -= 1
        else:
            h, w = 0, opened
            opened += 1
        window[i], start[i] = w, h
        if h + size < capacity:
            level[h + size] += 1
            stacks.setdefault(h + size, []).append(w)
    return window, start


def with_shards(docs: DataFrame, docs_per_shard: int, chars_per_shard: int) -> tuple[DataFrame, int]:
    """(doc_id, text, text_hash, shard) and the number of shards."""
    rows = pick(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    counted = rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"), F.max(F.coalesce(F.length("text"), F.lit(0))).alias("chars"))
    counted = materialize(counted, "packed-rows")
    n, chars = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("n") * F.col("chars")), F.lit(0))).first()
    shards = max(1, -(-n // docs_per_shard), -(-chars // chars_per_shard))
    hot = counted.where((F.col("n") * 4 > docs_per_shard) | (F.col("n") * F.col("chars") * 4 > chars_per_shard) & (F.col("n") > 1))
    hot = hot.select(F.col("doc_id").alias("hot_id"), F.col("text_hash").alias("hot_hash"), F.lit(True).alias("hot"))
    match = F.col("doc_id").eqNullSafe(F.col("hot_id")) & (F.col("text_hash") == F.col("hot_hash"))
    marked = rows.join(small_side(hot, hot.count(), 32), match, "left")
    # equal rows in turn; which of them goes where makes no difference
    turn = F.when(F.col("hot"), F.monotonically_increasing_id()).otherwise(0)
    return marked.select("doc_id", "text", "text_hash", F.pmod(F.xxhash64("doc_id", "text_hash") + turn, F.lit(shards)).alias("shard")), shards


def tokens_of(dealt: DataFrame, tokenizer: str) -> DataFrame:
    """(shard, doc_id, text_hash, ids): token ids with the end of the document."""
    ranks_file = ranks_of(dealt.sparkSession, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(ranks_file.value)
        for batch in sliced(batches):
            ids, _ = encoded(encoding, batch.column(1).to_pylist(), end=True)
            yield pa.RecordBatch.from_arrays([batch.column(3), batch.column(0), batch.column(2), ids], ["shard", "doc_id", "text_hash", "ids"])

    return dealt.select("doc_id", "text", "text_hash", "shard").mapInArrow(run, "shard long, doc_id long, text_hash long, ids array<int>")


def fill(shard: int, doc_id: np.ndarray, null_id: np.ndarray, text_hash: np.ndarray, offsets: np.ndarray, flat: np.ndarray, window: int) -> Iterator[pa.RecordBatch]:
    """The windows of one shard, some at a time; ``flat`` holds the documents' token ids end to end."""
    total = np.diff(offsets)
    order = np.lexsort((text_hash, total, doc_id, ~null_id))
    pieces = -(-total[order] // window)
    at = np.repeat(order, pieces)
    piece = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    length = np.minimum(window, total[at] - piece * window)
    where, start = place(length, window)
    by = np.lexsort((start, where))
    at, piece, length, where, start = at[by], piece[by], length[by], where[by], start[by]
    windows = int(where[-1]) + 1 if len(where) else 0
    lists = lambda c, values: pa.ListArray.from_arrays(pa.array(c, pa.int32()), values)
    for w in range(0, windows, CHUNK):
        upto = min(windows, w + CHUNK)
        cuts = np.searchsorted(where, np.arange(w, upto + 1))
        a, b = cuts[0], cuts[-1]
        ends = np.cumsum(length[a:b])
        source = np.repeat(offsets[at[a:b]] + piece[a:b] * window - (ends - length[a:b]), length[a:b]) + np.arange(int(ends[-1]))
        token_cuts = np.r_[0, ends][cuts - a]
        ids = pa.array(doc_id[at[a:b]], pa.int64(), mask=null_id[at[a:b]])
        parts = pa.StructArray.from_arrays([ids, pa.array(piece[a:b], pa.int64()), pa.array(start[a:b], pa.int32()), pa.array(length[a:b], pa.int32())], fields=list(_PIECE))
        columns = {
            "shard": pa.array(np.full(upto - w, shard)), "window": pa.array(np.arange(w, upto)), "n_tokens": pa.array(np.diff(token_cuts), pa.int32()),
            "doc_ids": lists(cuts - a, ids), "pieces": lists(cuts - a, parts), "token_ids": lists(token_cuts, pa.array(flat[source], pa.int32())),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def pack(docs: DataFrame, window: int = WINDOW, docs_per_shard: int = DOCS_PER_SHARD, chars_per_shard: int = CHARS_PER_SHARD, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row for each window: its shard, its pieces in order with the documents they are of, its token ids."""
    dealt, shards = with_shards(docs, docs_per_shard, chars_per_shard)

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_id, null_id, text_hash, counts, values = [], [], [], [], []
        for batch in batches:
            ids, lists = batch.column("doc_id"), batch.column("ids")
            doc_id.append(ids.fill_null(0).to_numpy(zero_copy_only=False))
            null_id.append(ids.is_null().to_numpy(zero_copy_only=False))
            text_hash.append(batch.column("text_hash").fill_null(0).to_numpy(zero_copy_only=False))
            counts.append(np.diff(lists.offsets.to_numpy()))
            values.append(lists.flatten().to_numpy(zero_copy_only=False).copy())  # a batch's other memory goes
        offsets = np.r_[0, np.cumsum(np.concatenate(counts))].astype(np.int64)
        flat = np.concatenate(values)
        values.clear()
        yield from fill(key[0].as_py(), np.concatenate(doc_id), np.concatenate(null_id), np.concatenate(text_hash), offsets, flat, window)

    # a given number of partitions: by bytes alone the planner would join many shards into one task
    return tokens_of(dealt, tokenizer).repartition(shards, "shard").groupBy("shard").applyInArrow(run, WINDOWS)


def pieces_of(windows: DataFrame) -> DataFrame:
    """(shard, window, start, doc_id, piece, n_tokens): one row for each piece of each document."""
    return windows.select("shard", "window", F.inline("pieces")).select("shard", "window", "start", "doc_id", "piece", "n_tokens")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the training windows."""
    return pack(docs)


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
