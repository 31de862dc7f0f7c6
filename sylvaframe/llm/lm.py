"""LM scoring: a gated recurrent language model in numpy.

A GRU over words with a class-factored output: p(word) = p(class) p(word|class),
each a softmax over about the square root of the vocabulary. Training is
truncated backpropagation through windows of STEPS words, the state being
carried from window to window; scoring carries it over the whole document, so a
log-likelihood covers every word of it and its end.

Every counted word has a probability of its own. The network's vocabulary is the
most frequent words, about GROWTH² times the square root of the corpus's length of
them and VOCAB at least; the others share buckets named by a hash of their ending,
and of a bucket's probability a word has its share of the bucket's count:
p(word) = p(bucket) n(word) / n(bucket).

Over the corpus this takes three passes, each over all documents:
1. words are counted, by part of the corpus and in all;
2. each partition trains from the same start on all its documents, and the
   parameters are averaged by words seen, piece by piece, in as many levels as it
   takes for no task to read more than FAN_IN pieces of them;
3. each document is scored; a task reads the counts of its own part's rare words.
Only the averaged model, which grows as the vocabulary, comes to the driver.

Defined results: a null or empty text has its end as the only word; repeated rows
get equal scores; an empty table trains nothing and gives no rows; columns other
than doc_id and text are left out, whatever they are called. Ties in word counts
go by the word. A very long text is scored whole, in a lane of its own; its words
are ids once they are read, a slice at a time. The model depends on how the
documents lie in partitions, as each trains on its own.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import materialize, pick, scratch_path

#: Ids at least; the classes at least are its square root.
VOCAB = 1024
UNKNOWN = 127
HIDDEN = 16
CLASSES = 32
#: Classes, and words in each, by the fourth root of the corpus's words.
GROWTH = 0.5
STEPS = 32
LANES = 256
RATE = 0.01
#: Words that a task buffers before it works on them.
BUFFER_WORDS = 6_000_000
#: Characters of a text that are cut into words together.
SLICE = 1_000_000
FAN_IN = 256
#: Parameters that are averaged together.
PIECE = 1 << 16
SEED = 29
#: The last id of the least vocabulary.
END = VOCAB - 1
NAMES = ("ex", "wh", "wc", "bc", "ww", "bw")


def classes_for(n_words: int) -> int:
    """Classes of a vocabulary of so many words, of which each class holds as many."""
    return max(CLASSES, math.isqrt(n_words + UNKNOWN) + 1)


def id_kind(end: int) -> type:
    return np.int16 if end < 1 << 15 else np.int32


def bucket_of(ending: str) -> int:
    return xxhash.xxh32_intdigest(ending) % UNKNOWN


_SPACE = re.compile(r"\s")


def words_of(text: str | None) -> Iterator[list[str]]:
    """The text's words, some at a time: a very long text's are never all held as strings."""
    if not text:
        return
    if len(text) <= SLICE:
        yield text.split()
        return
    at = 0
    while at < len(text):
        space = _SPACE.search(text, at + SLICE)
        end = space.start() if space else len(text)
        yield text[at:end].split()
        at = end


class _Buckets(dict):
    """Word ending to the id of its bucket of unknown words."""

    def __init__(self, first: int):
        super().__init__()
        self.first = first

    def __missing__(self, ending: str) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[ending] = self.first + bucket_of(ending)
        return value


class WordIds(dict):
    """Word to id; words beyond the vocabulary get a bucket, by their ending, and aren't remembered."""

    def __init__(self, words: list[str]):
        super().__init__((w, i) for i, w in enumerate(words))
        self.end = classes_for(len(words)) ** 2 - 1
        self.kind = id_kind(self.end)
        self.buckets = _Buckets(self.end - UNKNOWN)

    def __missing__(self, word: str) -> int:
        return self.buckets[word[-3:]]

    def encode(self, text: str | None) -> np.ndarray:
        parts = [np.fromiter(map(self.__getitem__, words), self.kind, len(words)) for words in words_of(text)]
        return np.concatenate([*parts, np.array([self.end], self.kind)])


class Shares(dict):
    """Word to id, and log p(word | id), for the words of one part of the corpus."""

    def __init__(self, ids: WordIds, rare: list[str], n: np.ndarray, counts: np.ndarray):
        known = len(ids)
        super().__init__(ids)
        self.update(zip(rare, range(known, known + len(rare))))  # a word that comes twice has the same count
        self.end, self.kind = ids.end, ids.kind
        self.ids = np.arange(known + len(rare)).astype(ids.kind)
        self.ids[known:] = [ids.buckets[w[-3:]] for w in rare]
        self.share = np.zeros(known + len(rare))
        self.share[known:] = np.log(n / counts[self.ids[known:]])

    def encode(self, text: str | None) -> tuple[np.ndarray, float]:
        parts, share = [], 0.0
        for words in words_of(text):
            at = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
            parts.append(self.ids.take(at))
            share += float(self.share.take(at).sum())
        return np.concatenate([*parts, np.array([self.end], self.kind)]), share


def start_parameters(counts: np.ndarray, seed: int = SEED) -> dict[str, np.ndarray]:
    """Random weights; output biases give the corpus's unigram probabilities."""
    rng = np.random.default_rng(seed)
    small = lambda *shape, by=0.1: (rng.standard_normal(shape) * by).astype(np.float32)
    p = (counts + 0.5) / (counts + 0.5).sum()
    classes = math.isqrt(len(counts))
    by_class = p.reshape(classes, -1)
    return {
        "ex": small(len(counts), 3 * HIDDEN, by=0.3),
        "wh": small(HIDDEN, 3 * HIDDEN, by=HIDDEN**-0.5),
        "wc": small(HIDDEN, classes),
        "bc": np.log(by_class.sum(1)).astype(np.float32),
        "ww": small(len(counts), HIDDEN),
        "bw": np.log(by_class / by_class.sum(1, keepdims=True)).ravel().astype(np.float32),
    }


@dataclass
class Lanes:
    """Documents laid end to end in lanes; lanes are sorted, longest first."""

    tokens: np.ndarray  # (length, lanes), what is predicted
    source: np.ndarray  # (length, lanes), the document of each word
    first: np.ndarray  # (length, lanes), whether a document starts here
    active: np.ndarray  # (length,), how many lanes still have words


def lay_out_stream(docs: list[np.ndarray], lanes: int) -> Lanes:
    """For training: shuffled documents as one stream, cut into lanes of equal length."""
    order = np.random.default_rng(SEED).permutation(len(docs))
    lengths = np.array([len(docs[i]) for i in order])
    stream = np.concatenate([docs[i] for i in order])
    n = len(stream)
    length = -(-n // max(1, min(lanes, n)))
    lanes = -(-n // length)
    pad = lanes * length - n
    first = np.zeros(n + pad, bool)
    first[np.cumsum(lengths) - lengths] = True
    first[::length] = True  # a document that goes on in the next lane starts afresh there
    shape = lambda flat: flat.reshape(lanes, length).T.copy()
    active = np.full(length, lanes)
    active[length - pad :] = lanes - 1
    source = np.repeat(order.astype(np.int32), lengths)
    return Lanes(shape(np.pad(stream, (0, pad))), shape(np.pad(source, (0, pad))), shape(first), active)


def lay_out(docs: list[np.ndarray], lanes: int) -> Lanes:
    """For scoring: whole documents, longest first, each into the shortest lane."""
    order = sorted(range(len(docs)), key=lambda i: (-len(docs[i]), i))
    lanes = max(1, min(lanes, len(docs)))
    heap = [(0, k) for k in range(lanes)]
    rows: list[list[int]] = [[] for _ in range(lanes)]
    for i in order:
        load, k = heapq.heappop(heap)
        rows[k].append(i)
        heapq.heappush(heap, (load + len(docs[i]), k))
    loads = np.array([sum(len(docs[i]) for i in r) for r in rows])
    ranked = np.argsort(-loads, kind="stable")
    length = int(loads.max())
    tokens = np.zeros((lanes, length), docs[0].dtype)
    source = np.zeros((lanes, length), np.int32)
    first = np.zeros((lanes, length), bool)
    for at, k in enumerate(ranked):
        p = 0
        for i in rows[k]:
            n = len(docs[i])
            tokens[at, p : p + n], source[at, p : p + n], first[at, p] = docs[i], i, True
            p += n
    active = lanes - np.searchsorted(np.sort(loads), np.arange(length), side="right")
    return Lanes(tokens.T.copy(), source.T.copy(), first.T.copy(), active)


def starts_by_step(first: np.ndarray) -> list[np.ndarray]:
    """The lanes in which a document starts, for each step of a window."""
    step, lane = np.nonzero(first)
    cuts = np.searchsorted(step, np.arange(len(first) + 1)).tolist()
    return [lane[a:b] for a, b in zip(cuts, cuts[1:])]


class GRU:
    """Rows are picked by ``take``, which is several times faster than an index in brackets."""

    def __init__(self, parameters: dict[str, np.ndarray]):
        self.p = {k: v.copy() for k, v in parameters.items()}
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.step = 0
        self.vocab, self.classes = len(self.p["ex"]), len(self.p["bc"])
        self.per = self.vocab // self.classes
        self.end = self.vocab - 1
        # add up a row of outputs
        self.ones, self.inner_ones = np.ones(self.classes, np.float32), np.ones(self.per, np.float32)

    # -- recurrence ------------------------------------------------------------

    def gate_weights(self) -> np.ndarray:
        """``wh`` as (gate, from, to): update, reset, candidate."""
        return np.ascontiguousarray(self.p["wh"].reshape(HIDDEN, 3, HIDDEN).transpose(1, 0, 2))

    def forward(self, inputs: np.ndarray, first: np.ndarray, h: np.ndarray, keep: bool):
        """States after each step of a window; with ``keep`` also what backward needs.

        Gates are kept apart, so that every operation runs over contiguous memory.
        """
        steps, lanes = inputs.shape
        H, weights = HIDDEN, self.gate_weights()
        table = np.ascontiguousarray(self.p["ex"].reshape(self.vocab, 3, H).transpose(1, 0, 2))
        # a gate is 1 / (1 + exp(-x)): x comes with its sign turned
        weights[:2] *= np.float32(-1)
        table[:2] *= np.float32(-1)
        gates = np.empty((3, steps, lanes, H), np.float32)
        for part, out in zip(table, gates):
            part.take(inputs, 0, out=out, mode="clip")  # ids are in range; without a mode it would be buffered
        states = np.empty((steps, lanes, H), np.float32)
        # state before, update, reset, candidate, candidate's recurrent part
        saved = np.empty((5, steps, lanes, H), np.float32) if keep else None
        fresh = starts_by_step(first)
        g = np.empty((3, lanes, H), np.float32)
        zr, n = np.empty((2, lanes, H), np.float32), np.empty((lanes, H), np.float32)
        with np.errstate(over="ignore"):  # a gate whose exp is infinite is 0
            for t in range(steps):
                if len(fresh[t]):
                    h = h.copy()
                    h[fresh[t]] = 0
                np.matmul(h, weights, out=g)
                if keep:
                    saved[0, t], saved[4, t] = h, g[2]
                    zr, n = saved[1:3, t], saved[3, t]
                np.add(gates[:2, t], g[:2], out=zr)
                np.exp(zr, out=zr)
                zr += np.float32(1)
                np.reciprocal(zr, out=zr)
                z, r = zr
                np.multiply(r, g[2], out=n)
                n += gates[2, t]
                np.tanh(n, out=n)
                new = states[t]
                np.subtract(h, n, out=new)
                new *= z
                new += n
                h = new
        return states, saved, h.copy()

    def backward(self, inputs, first, states_grad, saved) -> dict[str, np.ndarray]:
        """Gradients of ex and wh; the window's first state is taken as given."""
        steps, lanes = inputs.shape
        H = HIDDEN
        back = np.ascontiguousarray(self.gate_weights().transpose(0, 2, 1))
        before, z, r, n, gn = saved
        # what a gate's gradient is multiplied with, for all steps at once
        to_n = (1 - z) * (1 - n * n)
        to_z = (before - n) * z * (1 - z)
        to_r = gn * r * (1 - r)
        d = np.empty((4, steps, lanes, H), np.float32)  # update, reset, candidate's recurrent part, candidate
        dh = np.zeros((lanes, H), np.float32)
        through = np.empty((3, lanes, H), np.float32)
        fresh = starts_by_step(first)
        for t in range(steps - 1, -1, -1):
            dh += states_grad[t]
            dn = np.multiply(dh, to_n[t], out=d[3, t])
            np.multiply(dh, to_z[t], out=d[0, t])
            np.multiply(dn, to_r[t], out=d[1, t])
            np.multiply(dn, r[t], out=d[2, t])
            np.matmul(d[:3, t], back, out=through)
            dh *= z[t]
            for part in through:
                dh += part
            if len(fresh[t]):
                dh[fresh[t]] = 0
        ex, wh = np.empty((self.vocab, 3, H), np.float32), np.empty_like(self.p["wh"])
        states = before.reshape(-1, H).T
        slots = (inputs.reshape(-1, 1).astype(np.int64) * H + np.arange(H)).ravel()  # of a word's H values
        for k, (own, recurrent) in enumerate(((0, 0), (1, 1), (3, 2))):
            ex[:, k] = np.bincount(slots, d[own].ravel(), self.vocab * H).reshape(-1, H)
            wh[:, k * H : (k + 1) * H] = states @ d[recurrent].reshape(-1, H)
        return {"ex": ex.reshape(self.vocab, 3 * H), "wh": wh}

    # -- output ----------------------------------------------------------------

    def bounded(self) -> bool:
        """Whether no output can reach 60 either way, so that exp needs no maximum taken off. States lie in (-1, 1)."""
        p = self.p
        return max(float((np.abs(p["wc"]).sum(0) + np.abs(p["bc"])).max()), float((np.abs(p["ww"]).sum(1) + np.abs(p["bw"])).max())) < 60

    def log_probs(self, states: np.ndarray, targets: np.ndarray, learn: bool):
        """log p of each target; with ``learn`` also gradients of the mean loss."""
        n = len(targets)
        per, classes = self.per, self.classes
        kind = (targets // per).astype(np.uint8 if classes <= 256 else np.uint16)
        order = np.argsort(kind, kind="stable")
        target, kind = targets.take(order), kind.take(order)
        # a column of ones takes the biases along
        h = np.ones((n, HIDDEN + 1), np.float32)
        h[:, :-1] = states.take(order, 0)
        rows = np.arange(n)
        in_class = rows * classes + kind
        logits = h @ np.vstack([self.p["wc"], self.p["bc"]])
        bounded = self.bounded()
        if not bounded:
            logits -= logits.max(1, keepdims=True)
        chosen = logits.take(in_class)
        np.exp(logits, out=logits)
        total = logits @ self.ones
        logp = chosen - np.log(total)
        cuts = np.searchsorted(kind, np.arange(classes + 1)).tolist()
        inner = np.empty((n, per), np.float32)
        ww = self.p["ww"]
        both = np.column_stack([ww, self.p["bw"]])
        for c in range(classes):
            a, b = cuts[c], cuts[c + 1]
            if a < b:
                at = slice(c * per, (c + 1) * per)
                np.matmul(h[a:b], both[at].T, out=inner[a:b])
        within = rows * per + (target - kind.astype(target.dtype) * target.dtype.type(per))
        if not bounded:
            inner -= inner.max(1, keepdims=True)
        chosen = inner.take(within)
        np.exp(inner, out=inner)
        inner_total = inner @ self.inner_ones
        logp += chosen
        logp -= np.log(inner_total)
        out = np.empty(n, np.float32)
        out[order] = logp
        if not learn:
            return out, None, None
        scale = np.float32(1 / n)
        logits *= (scale / total)[:, None]
        logits.reshape(-1)[in_class] -= scale
        inner *= (scale / inner_total)[:, None]
        inner.reshape(-1)[within] -= scale
        outer, both_grad = h.T @ logits, np.zeros_like(both)
        dh = logits @ self.p["wc"].T
        for c in range(classes):
            a, b = cuts[c], cuts[c + 1]
            if a < b:
                at = slice(c * per, (c + 1) * per)
                dh[a:b] += inner[a:b] @ ww[at]
                both_grad[at] = inner[a:b].T @ h[a:b]
        grads = {"wc": outer[:-1], "bc": outer[-1], "ww": both_grad[:, :-1], "bw": both_grad[:, -1]}
        back = np.empty_like(dh)
        back[order] = dh
        return out, grads, back

    def update(self, grads: dict[str, np.ndarray], rate: float) -> None:
        """One Adam step, gradients clipped to norm 1."""
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        by = np.float32(min(1.0, 1.0 / (norm + 1e-12)))
        self.step += 1
        fix1, fix2 = 1 - 0.9**self.step, 1 - 0.99**self.step
        for k, g in grads.items():
            g = g * by
            m, v = self.m[k], self.v[k]
            by_step = g - m
            by_step *= np.float32(0.1)
            m += by_step
            g *= g
            g -= v
            g *= np.float32(0.01)
            v += g
            np.divide(v, np.float32(fix2), out=g)
            np.sqrt(g, out=g)
            g += np.float32(1e-6)
            np.multiply(m, np.float32(rate / fix1), out=by_step)
            by_step /= g
            self.p[k] -= by_step

    # -- documents -------------------------------------------------------------

    def run(self, docs: list[np.ndarray], lanes: int, learn: bool) -> np.ndarray:
        """Log-likelihood of each document, in windows of STEPS with the state carried."""
        total = np.zeros(len(docs))
        if not docs:
            return total
        laid = lay_out_stream(docs, lanes) if learn else lay_out(docs, lanes)
        length = len(laid.tokens)
        h = np.zeros((laid.tokens.shape[1], HIDDEN), np.float32)
        last = np.full(laid.tokens.shape[1], self.end, laid.tokens.dtype)
        a = 0
        while a < length:
            live = int(laid.active[a])
            # a window ends early where lanes run out, so all its lanes are live
            b = min(length, a + STEPS)
            tail = laid.active[a:b]
            if tail[-1] < live:
                if tail[-1] * 2 > live or b - a <= 8:
                    live = int(tail[-1])  # for a few lanes the rest of the window follows below
                b = a + int(np.searchsorted(-laid.active[a:b], -live, side="right"))
            if live < laid.active[a]:
                self._window(laid, a, b, 0, live, h, last, learn, total)
                dropped = slice(live, int(laid.active[a]))
                for lane in range(dropped.start, dropped.stop):
                    end = a + int(np.searchsorted(-laid.active[a:b], -(lane + 1), side="right"))
                    if end > a:
                        self._window(laid, a, end, lane, lane + 1, h, last, learn, total)
            else:
                self._window(laid, a, b, 0, live, h, last, learn, total)
            a = b
        return total

    def _window(self, laid: Lanes, a: int, b: int, lo: int, hi: int, h, last, learn: bool, total) -> None:
        target, first = laid.tokens[a:b, lo:hi], laid.first[a:b, lo:hi]
        inputs = np.empty_like(target)
        inputs[0], inputs[1:] = last[lo:hi], target[:-1]
        inputs[first] = self.end
        states, saved, h[lo:hi] = self.forward(inputs, first, h[lo:hi], learn)
        last[lo:hi] = target[-1]
        logp, grads, back = self.log_probs(states.reshape(-1, HIDDEN), target.ravel(), learn)
        total += np.bincount(laid.source[a:b, lo:hi].ravel(), logp, len(total))
        if learn:
            grads |= self.backward(inputs, first, back.reshape(states.shape), saved)
            self.update(grads, RATE)


def buffered(encode: Callable[[pd.DataFrame], tuple[pd.DataFrame, list[np.ndarray]]], batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    """Batches joined until they hold BUFFER_WORDS words; ``encode`` gives a batch's other columns and its word ids."""
    rows, docs, n = [], [], 0
    for batch in batches:
        rest, new = encode(batch)
        rows.append(rest)
        docs.extend(new)
        n += sum(map(len, new))
        if n >= BUFFER_WORDS:
            yield pd.concat(rows, ignore_index=True), docs
            rows, docs, n = [], [], 0
    if docs:
        yield pd.concat(rows, ignore_index=True), docs


def by_ids(ids: WordIds) -> Callable[[pd.DataFrame], tuple[pd.DataFrame, list[np.ndarray]]]:
    return lambda batch: (batch.drop(columns=["text"]), [ids.encode(t) for t in batch["text"]])


def in_parts(docs: DataFrame) -> DataFrame:
    """(doc_id, text, part), written, so that a row's part stays what it was."""
    return materialize(pick(docs, "doc_id", "text").withColumn("part", F.spark_partition_id()), "parts")


def count_words(parts: DataFrame) -> DataFrame:
    """(part, word, n, head): n counts all documents, head is true once for each word; a part may have a word twice.

    Tasks send sums of up to half a million words.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        at = -1

        def sums() -> pd.DataFrame:
            return pd.DataFrame({"part": at, "word": list(counts), "n": list(counts.values())})

        for rows in batches:
            for part, text in zip(rows["part"], rows["text"]):
                if counts and (part != at or len(counts) > 500_000):
                    yield sums()
                    counts = Counter()
                at = part
                for words in words_of(text):
                    counts.update(words)
        if counts:
            yield sums()

    local = parts.select("part", "text").mapInPandas(run, "part int, word string, n long")
    same = Window.partitionBy("word").orderBy("part")
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return local.select("part", "word", F.sum("n").over(whole).alias("n"), (F.row_number().over(same) == 1).alias("head"))


def vocabulary(docs: DataFrame, counted: DataFrame | None = None) -> tuple[list[str], np.ndarray]:
    """The most frequent words, and a count for each id. ``counted``: what ``count_words`` gave."""
    if counted is None:
        counted = materialize(count_words(in_parts(docs)), "words")
    once = counted.where("head").select("word", "n")
    total = once.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    classes = max(CLASSES, math.ceil(GROWTH * total**0.25))
    top = once.orderBy(F.desc("n"), "word").limit(classes**2 - 1 - UNKNOWN).collect()
    words = [r["word"] for r in top]
    ids = WordIds(words)
    counts = np.zeros(ids.end + 1)
    counts[: len(words)] = [r["n"] for r in top]
    counts[ids.end - UNKNOWN : ids.end] = bucket_counts(once)
    np.subtract.at(counts, [ids.buckets[w[-3:]] for w in words], counts[: len(words)])
    counts[ids.end] = docs.count()
    return words, counts


def bucket_counts(once: DataFrame) -> np.ndarray:
    """How often each bucket's words occur, those of the vocabulary included."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame({"bucket": [bucket_of(e) for e in rows["ending"]], "n": rows["n"]})

    ending = F.when(F.length("word") > 3, F.substring("word", -3, 3)).otherwise(F.col("word")).alias("ending")
    sums = once.groupBy(ending).agg(F.sum("n").alias("n")).mapInPandas(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(UNKNOWN)
    for r in sums.collect():
        out[r["bucket"]] = r["n"]
    return out


def rare_words(counted: DataFrame) -> str:
    """Folder with the words and counts of each part, in a subfolder each."""
    path = scratch_path(counted.sparkSession, "rare")
    counted.select("part", "word", "n").repartition("part").write.partitionBy("part").parquet(path)
    return path


def read_part(path: str, part: int) -> tuple[list[str], np.ndarray]:
    from pyarrow import dataset, fs

    system, name = fs.FileSystem.from_uri(f"{path}/part={part}")
    if system.get_file_info(name).type == fs.FileType.NotFound:  # it has no words
        return [], np.zeros(0)
    got = dataset.dataset(name, filesystem=system, format="parquet", partitioning=None).to_table(columns=["word", "n"])
    return got["word"].to_pylist(), got["n"].to_numpy().astype(np.float64)


def by_shares(ids: WordIds, path: str, counts: np.ndarray) -> Callable[[pd.DataFrame], tuple[pd.DataFrame, list[np.ndarray]]]:
    """As by_ids, with a column ``share`` of a document's log p(word | bucket)."""
    at, shares = None, None

    def encode(batch: pd.DataFrame) -> tuple[pd.DataFrame, list[np.ndarray]]:
        nonlocal at, shares
        out = []
        for part, text in zip(batch["part"], batch["text"]):
            if part != at:
                shares = None  # two needn't be held
                words, n = read_part(path, part)
                beyond = np.fromiter((w not in ids for w in words), bool, len(words))
                at, shares = part, Shares(ids, list(compress(words, beyond)), n[beyond], counts)
            out.append(shares.encode(text))
        return batch.drop(columns=["text"]).assign(share=[s for _, s in out]), [d for d, _ in out]

    return encode


def train(docs: DataFrame, words: list[str], counts: np.ndarray) -> dict[str, np.ndarray]:
    """Parameters averaged over partitions, each trained on all of its documents."""
    spark = docs.sparkSession
    start = start_parameters(counts)
    shared = spark.sparkContext.broadcast((words, start))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        words, start = shared.value
        model, seen = GRU(start), 0
        for _, docs in buffered(by_ids(WordIds(words)), batches):
            n = sum(map(len, docs))
            model.run(docs, int(np.clip(n // 4096, 8, LANES)), learn=True)
            seen += n
        if seen:
            part = TaskContext.get().partitionId()
            pieces = [(k, at, model.p[k].ravel()[at : at + PIECE]) for k in NAMES for at in range(0, model.p[k].size, PIECE)]
            names, starts, values = zip(*pieces)
            yield pd.DataFrame({"name": names, "at": starts, "part": part, "seen": seen, "values": values})

    def mean(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        seen = rows["seen"].to_numpy(np.float64)
        out = sum(s * np.asarray(v, np.float64) for s, v in zip(seen, rows["values"])) / seen.sum()
        return pd.DataFrame({"name": [key[0]], "at": [key[1]], "part": [int(rows["part"].iloc[0])], "seen": [int(seen.sum())], "values": [out.astype(np.float32)]})

    schema = "name string, at long, part int, seen long, values array<float>"
    local = pick(docs, "text").mapInPandas(run, schema)
    partitions = docs.rdd.getNumPartitions()  # planned, not run
    span = FAN_IN
    while span < partitions:
        local = local.groupBy("name", "at", F.floor(F.col("part") / span)).applyInPandas(mean, schema)
        span *= FAN_IN
    merged = {(r["name"], r["at"]): r["values"] for r in local.groupBy("name", "at").applyInPandas(mean, schema).collect()}
    if not merged:
        return start
    return {k: np.concatenate([np.array(merged[k, at], np.float32) for at in range(0, v.size, PIECE)]).reshape(v.shape) for k, v in start.items()}


def score(docs: DataFrame, words: list[str], parameters: dict[str, np.ndarray], rare: str | None = None, counts: np.ndarray | None = None) -> DataFrame:
    """(doc_id, n_words, log_likelihood, per_word) of each document, its end included.

    With ``rare``, the folder of ``rare_words``, and the counts of ``vocabulary``,
    ``docs`` being the counted parts, each word has its own probability; without,
    a rare word has its bucket's.
    """
    shared = docs.sparkSession.sparkContext.broadcast((words, parameters, counts))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, parameters, counts = shared.value
        model, ids = GRU(parameters), WordIds(words)
        for rows, docs in buffered(by_shares(ids, rare, counts) if rare else by_ids(ids), batches):
            length = np.array([len(d) for d in docs])
            # as many lanes as fill up with the longest text in one: it costs no other lanes' room
            lanes = int(np.clip(1.5 * length.sum() / length.max(), 1, LANES))
            logp = model.run(docs, lanes, learn=False)
            if rare:
                logp += rows["share"].to_numpy()
            yield pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64"), "n_words": length, "log_likelihood": logp, "per_word": logp / length})

    columns = ["doc_id", "text", "part"] if rare else ["doc_id", "text"]
    return pick(docs, *columns).mapInPandas(run, "doc_id long, n_words long, log_likelihood double, per_word double")


def lm_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log-likelihood under a model of the whole corpus."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    parts = in_parts(docs)
    counted = materialize(count_words(parts), "words")
    words, counts = vocabulary(docs, counted)
    return score(parts, words, train(docs, words, counts), rare_words(counted), counts)
