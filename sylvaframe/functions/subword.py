"""Splitting run-together words with the help of vocabularies.

A vocabulary set is a list of word sets; a word's weight is the number of sets
that hold it. The sets are broadcast: their size is bounded by
``vocab_limit`` words each, whatever the corpus. Texts stay in the JVM; only the
distinct tokens that are neither known, nor a number, nor short reach Python.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import number_lines, raw_lines
from .text import is_number

#: Words of one and two letters that count as words.
SHORT_WORDS = frozenset("a i am an as at ax be by do go he hi if in is it me my no of oh ok on or ox pi so to up us we".split())
VOCAB_LIMIT = 500_000


def keep_word(word: Column) -> Column:
    """Longer than two characters, or a known short word."""
    return (F.length(word) > 2) | word.isin(sorted(SHORT_WORDS))


class Segmenter:
    def __init__(self, vocabularies: list[set[str]]):
        self.weight: dict[str, int] = {}
        for words in vocabularies:
            for w in words:
                if w:
                    self.weight[w] = self.weight.get(w, 0) + 1
        self.longest = max(map(len, self.weight), default=0)

    def best_split(self, token: str) -> list[str] | None:
        """The full split with fewest parts, then the highest weights, then the longest parts, from left to right."""
        best: list[tuple | None] = [((0, (), ()), [])] + [None] * len(token)
        for end in range(1, len(token) + 1):
            for start in range(max(0, end - self.longest), end):
                piece = token[start:end]
                if best[start] is None or piece not in self.weight:
                    continue
                (n, weights, sizes), parts = best[start]
                rank = (n + 1, weights + (-self.weight[piece],), sizes + (start - end,))
                if best[end] is None or rank < best[end][0]:
                    best[end] = (rank, parts + [piece])
        return best[-1][1] if best[-1] else None

    def longest_known(self, token: str) -> list[str]:
        """The longest known piece, by weight then position, with remainders of up to three characters."""
        for size in range(min(len(token), self.longest), 0, -1):
            at = [i for i in range(len(token) - size + 1) if token[i : i + size] in self.weight]
            if not at:
                continue
            i = min(at, key=lambda k: (-self.weight[token[k : k + size]], k))
            before, piece, after = token[:i], token[i : i + size], token[i + size :]
            rest = len(before) + len(after)
            if len(token) > 8 and rest > 5 and size > 3:
                return [token]
            return [p for p in (before, piece, after) if p is piece or 0 < len(p) < 4]
        return [token] if len(token) < 4 else []

    def segment(self, token: str) -> list[str]:
        split = self.best_split(token)
        if split is None and (bare := re.sub(r"\d+", "", token)) != token:
            split = self.best_split(bare)
        return self.longest_known(token) if split is None else split


def needs_split(token: Column, known: Column) -> Column:
    return ~(known | is_number(token) | (F.length(token) < 5))


def segment_words(words: DataFrame, vocabularies: list[set[str]], greedy_only: bool = False) -> DataFrame:
    """(token) to (token, parts), each distinct token split once."""
    shared = words.sparkSession.sparkContext.broadcast(vocabularies)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        segmenter = Segmenter(shared.value)
        split = segmenter.longest_known if greedy_only else segmenter.segment
        for rows in batches:
            yield pd.DataFrame({"token": rows["token"], "parts": [split(t) for t in rows["token"]]})

    return words.select("token").where(F.col("token").isNotNull()).distinct().mapInPandas(run, "token string, parts array<string>")


#: Rows of token lists that a task has at once, and words whose split it keeps; both bound a worker's memory.
ROWS_AT_ONCE, KNOWN_WORDS = 500, 100_000


def replaced(column: pa.Array, parts_of: Callable[[str], list[str]]) -> pa.Array:
    """``column`` (arrays of token arrays) with each token's parts in its place; a distinct token is looked up once."""
    inner = column.flatten()
    found = pc.dictionary_encode(inner.flatten())
    pieces = [parts_of(t) for t in found.dictionary.to_pylist()]
    sizes = np.array([len(p) for p in pieces], np.int64)
    codes = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n = sizes[codes]
    first = np.r_[0, np.cumsum(n)]
    # place in the flat list of pieces: where a token's begin, and on from there
    at = np.repeat((np.cumsum(sizes) - sizes)[codes] - first[:-1], n) + np.arange(first[-1])
    words = pa.array([p for ps in pieces for p in ps], pa.string()).take(pa.array(at))
    lengths = lambda a: pc.fill_null(pc.list_value_length(a), 0).to_numpy(zero_copy_only=False)
    lists = pa.ListArray.from_arrays(pa.array(first[np.r_[0, np.cumsum(lengths(inner))]], pa.int32()), words)
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths(column))], pa.int32()), lists, mask=column.is_null())


def with_known_tokens(df: DataFrame, column: str, vocabularies: list[set[str]]) -> DataFrame:
    """``column`` (an array of token arrays) with unknown long tokens split; those that can't be split go.

    Tokens stay Arrow arrays; as Python objects there are the distinct ones of a few rows only.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabularies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(shared.value)
        known: dict[str, list[str]] = {}

        def parts(t: str) -> list[str]:
            found = known.get(t)
            if found is None:
                if len(known) > KNOWN_WORDS:  # as a cache may be emptied
                    known.clear()
                plain = t in segmenter.weight or len(t) < 5 or t.replace(".", "", 1).isdigit()
                found = known[t] = [t] if plain else segmenter.segment(t)
            return found

        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                rows = batch.slice(at, ROWS_AT_ONCE)
                yield pa.RecordBatch.from_arrays([replaced(c, parts) if k == place else c for k, c in enumerate(rows.columns)], names=rows.schema.names)

    place = df.columns.index(column)
    return df.mapInArrow(run, df.schema)


def vocabulary_words(lines: DataFrame, vectors: bool = False, limit: int = VOCAB_LIMIT) -> DataFrame:
    """(word) of numbered lines, the first ``limit`` of each file, short words filtered.

    A line is a word, or with ``vectors`` a word and its numbers, the first line
    of such a file being its size.
    """
    first = F.element_at(F.split(F.trim("value"), " "), 1)
    rows = lines.where((F.col("ordinal") > 0) & (F.col("ordinal") <= limit)) if vectors else lines.where(F.col("ordinal") < limit)
    return rows.select((first if vectors else F.trim("value")).alias("word")).where(keep_word(F.col("word")) & (F.col("word") != ""))


def word_weights(vocabularies: list[DataFrame]) -> DataFrame:
    """(word, weight): in how many of the vocabularies, each a frame of words, a word stands."""
    out = vocabularies[0].select("word").distinct()
    for v in vocabularies[1:]:
        out = out.unionByName(v.select("word").distinct())
    return out.groupBy("word").agg(F.count(F.lit(1)).alias("weight"))


def read_vocabularies(spark: SparkSession, paths: list[str], limit: int = VOCAB_LIMIT) -> list[set[str]]:
    """One set for each word list (a word a line) or vector file (``.vec``): its first ``limit`` words, short ones filtered."""
    found = []
    for path in paths:
        words = vocabulary_words(number_lines(raw_lines(spark, path)), path.endswith(".vec"), limit)
        found.append({r[0] for r in words.collect()})
    return found
