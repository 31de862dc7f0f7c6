"""Exact near-dedup: a chosen-path set similarity join, completed by a prefix join.

After Christiani, Pagh and Sivertsen, "Scalable and Robust Set Similarity Join".
A document is the set of its word trigrams (lower-cased; fewer than three words
make one shingle), represented by SLOTS minwise tokens. A tree starts with all
documents in one node. A node draws 1/threshold slots on average, by its own
hash, and each of its documents goes to one child per drawn slot, named by the
document's token there; two documents of Jaccard similarity s share
s/threshold children in the mean. A node of up to LEAF documents is
compared exhaustively, and so is one of up to BIG that kept most of its parent's,
since its members are alike. TREES independent trees find nearly all links; what
they leave out, an exact join finds, so that no link is lost:

* Only a document of which at least the threshold's share of shingles occurs in
  another row can resemble one. Shingles are counted by 32 bits and their bucket,
  so that one may be taken for shared that isn't, never the reverse. The other
  documents take no part in the trees or in the join.
* The rest are joined by prefixes: with all shingles in one order, frequent ones
  of a sample last, two similar sets share one among the first n - ceil(threshold
  n) + 1 of each. Pairs within one of the trees' groups are settled already, so
  only pairs between different groups are compared.

A larger node of alike documents is never gathered in one task. Its documents are
compared with PIVOTS of them, wherever they lie; each that a pivot reaches is
linked to it and leaves, but for one in STAYING, which goes on in the node's
children for what only it resembles; what no pivot reaches goes on in any case.
So near copies in any number shrink from level to level instead of doubling, and
no task's work grows with a group's size.

Comparison in a node looks only for what connects: from a document, all others
not yet reached are compared at once, and those similar enough are reached and
searched from in turn. That finds exactly the connected groups that all pairs
would give, at near-linear cost in a group of near-copies. In the trees, pairs are
proposed by the share of equal tokens; each link of the trees and of the join is
then judged by the exact Jaccard similarity of the shingle sets.

Documents with equal shingle sets (told by a 64-bit hash) are one item from the
start. Nodes with the same members are compared once.

Defined results: a null text, or one without any word, resembles nothing and is
never grouped. Of a group the least doc_id stays, null ids last; rows repeated
in full leave one. An empty table gives no rows. Extra columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import Shield, materialize, materialize_bucketed, pick, small_side
from .components import components

THRESHOLD = 0.5
SLOTS = 128
TREES = 12
LEAF = 64
#: From this depth on nodes are taken for alike, whatever their parents.
MAX_DEPTH = 12
#: Where branching ends at last. Unlike documents part long before it.
LAST_DEPTH = 40
#: The largest node that one task compares.
BIG = 2_000
PIVOTS = 4
STAYING = 4
CERTAIN = 0.13  # three standard errors of the estimate at similarity 1/2
#: Shingles that a task holds at a time, and those that one bucket counts on average.
CHUNK = 1_000_000
#: Documents of a chunk; their places are 16 bits, of which the last says that no answer is needed.
CHUNK_DOCS = 60_000
#: Documents whose shingles are counted for the join's order, and the frequent shingles it knows.
ORDER_SAMPLE = 4_000
ORDER_KNOWN = 100_000
COHESIVE = 0.9
SEED = 23

_rng = np.random.default_rng(SEED)
_ODD = (_rng.integers(0, 2**31, SLOTS) * 2 + 1).astype(np.uint32)
_WORD = re.compile(r"\w+")


class _WordHashes(dict):
    """Word to 64-bit hash; emptied when large, as a cache may be."""

    def __missing__(self, word: str) -> int:
        if len(self) > 150_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str, cache: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word trigrams."""
    words = _WORD.findall(text.lower())
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    if len(h) < 3:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes())], np.uint64)
    x = h[:-2] * np.uint64(0x9E3779B97F4A7C15)
    x = ((x << np.uint64(23)) | (x >> np.uint64(41))) + h[1:-1]
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    x = ((x << np.uint64(29)) | (x >> np.uint64(35))) + h[2:]
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    return np.unique(x)


def signature(sets: np.ndarray) -> np.ndarray:
    """SLOTS minwise tokens of a shingle set, as 32-bit values."""
    low = np.full(SLOTS, 0xFFFFFFFF, np.uint32)
    short = (sets >> np.uint64(32)).astype(np.uint32)
    for a in range(0, len(short), 512):
        v = short[a : a + 512, None] * _ODD
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x2C1B3C6D)
        np.minimum(low, v.min(0), out=low)
    return low


def halves(tokens: np.ndarray) -> tuple[bytes, bytes]:
    """High and low 16 bits of the tokens.

    Branching goes by both, as half would throw unrelated documents together in
    a large node. Comparing two signatures needs the low one only: it is
    uniform, and two different tokens share it once in 65,536 times.
    """
    return (tokens >> np.uint32(16)).astype("<u2").tobytes(), tokens.astype("<u2").tobytes()


_DOC = np.dtype([("doc_id", "<i8"), ("no_id", "?"), ("text_hash", "<i8"), ("key", "<i8"), ("n", "<i4"), ("shared", "<i4")])
_PARCEL = "batch long, bucket int, tokens binary, places binary, docs binary, parts int"
_ANSWER = "batch long, places binary, docs binary, parts int"
_SIGNED = "doc_id long, text_hash long, key long, live boolean"
_NO_ANSWER = 0xFFFF


def _parcels(buckets: int):
    def pack(docs: list[tuple], sets: list[np.ndarray]) -> pd.DataFrame:
        """A chunk's distinct shingles by bucket, and a line with its documents.

        Shingles that two of its rows have are counted here and sent once.
        """
        head = np.array([(*d, len(x), 0) for d, x in zip(docs, sets)], _DOC)
        token = np.concatenate(sets)
        place = np.repeat(np.arange(len(sets)), head["n"])
        order = np.argsort(token)
        token, place = token[order], place[order]
        starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        count = np.diff(np.r_[starts, len(token)])
        head["shared"] = np.bincount(place[np.repeat(count > 1, count)], minlength=len(sets))
        token, place = token[starts], np.where(count > 1, _NO_ANSWER, place[starts]).astype("<u2")
        bucket = ((token >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)  # ascends as the tokens do
        at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        ends = np.r_[at[1:], len(token)]
        low = token.astype("<u4")
        batch = xxhash.xxh3_64_intdigest(head.tobytes()) - 2**63
        lines = [(batch, int(bucket[a]), low[a:b].tobytes(), place[a:b].tobytes(), None, None) for a, b in zip(at, ends)]
        lines.append((batch, batch % buckets, None, None, head.tobytes(), len(at)))
        return pd.DataFrame(lines, columns=["batch", "bucket", "tokens", "places", "docs", "parts"]).astype({"parts": "Int32"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = _WordHashes()
        docs, sets, held = [], [], 0
        for rows in batches:
            for doc_id, text_hash, text in zip(rows["doc_id"].astype("Int64"), rows["text_hash"], rows["text"]):
                s = shingles(text, cache)
                if not len(s):
                    continue
                none = doc_id is pd.NA
                docs.append((0 if none else doc_id, none, text_hash, xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63))
                sets.append(s)
                held += len(s)
                if held >= CHUNK or len(sets) >= CHUNK_DOCS:
                    yield pack(docs, sets)
                    docs, sets, held = [], [], 0
        if sets:
            yield pack(docs, sets)

    return run


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: to each chunk, the places of its documents, once for each shingle that other chunks or rows have too."""
    heads, rows = rows[rows["docs"].notna()], rows[rows["docs"].isna()]
    found: list[bytes] = []
    if len(rows):
        token = np.frombuffer(b"".join(rows["tokens"]), "<u4")
        place = np.frombuffer(b"".join(rows["places"]), "<u2")
        ends = np.cumsum([len(t) // 4 for t in rows["tokens"]])
        order = np.argsort(token)
        token = token[order]
        starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        times = np.add.reduceat(1 + (place[order] == _NO_ANSWER), starts)
        shared = np.empty(len(token), bool)
        shared[order] = np.repeat(times > 1, np.diff(np.r_[starts, len(token)]))
        shared &= place != _NO_ANSWER
        found = [place[a:b][shared[a:b]].tobytes() for a, b in zip(np.r_[0, ends[:-1]], ends)]
    none = [None] * len(heads), [None] * len(rows)
    return pd.DataFrame(
        {
            "batch": np.r_[heads["batch"].to_numpy(np.int64), rows["batch"].to_numpy(np.int64)],
            "places": pd.Series([*none[0], *found], dtype=object),
            "docs": pd.Series([*heads["docs"], *none[1]], dtype=object),
            "parts": pd.array([*heads["parts"].astype(int), *none[1]], "Int32"),
        }
    )


def _live(threshold: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """A chunk's documents; live: enough of the shingles are shared, or not all buckets have answered."""
        heads, answers = rows[rows["docs"].notna()], rows[rows["docs"].isna()]
        if not len(heads):
            return pd.DataFrame({"doc_id": pd.array([], "Int64"), "text_hash": [], "key": [], "live": []}).astype({"text_hash": "int64", "key": "int64", "live": "bool"})
        chunks = [np.frombuffer(d, _DOC) for d in heads["docs"]]
        head = np.concatenate(chunks)
        shared = head["shared"].copy()
        if len(chunks) == 1 and len(answers) == heads["parts"].iloc[0]:
            shared += np.bincount(np.frombuffer(b"".join(answers["places"]), "<u2"), minlength=len(head)).astype(np.int32)
        else:
            shared = head["n"]
        ids = pd.array(head["doc_id"], "Int64")
        ids[head["no_id"]] = pd.NA
        return pd.DataFrame({"doc_id": ids, "text_hash": head["text_hash"], "key": head["key"], "live": shared >= _least(head["n"], threshold)})

    return run


def _least(n: np.ndarray, threshold: float) -> np.ndarray:
    """The shingles that a set of n shares at least with any that it resembles."""
    return np.maximum(np.ceil(n * threshold - 1e-9), 1).astype(np.int64)


def _with_hash(docs: DataFrame) -> DataFrame:
    return pick(docs, "doc_id", "text").where(F.col("text").isNotNull()).withColumn("text_hash", F.xxhash64("text"))


def sign(docs: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, text_hash, key, live) of each row with at least one word; a row that isn't live resembles no other."""
    rows = _with_hash(docs)
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parcels = rows.mapInPandas(_parcels(int(chars // (6 * CHUNK)) + 1), _PARCEL)
    answers = parcels.groupBy("bucket").applyInPandas(_answer, _ANSWER)
    return answers.groupBy("batch").applyInPandas(_live(threshold), _SIGNED)


_ITEM = "key long, n int, high binary, sig binary, shingles binary"


def _items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cache = _WordHashes()
    for rows in batches:
        for a in range(0, len(rows), 1000):
            sets = [shingles(text, cache) for text in rows["text"].iloc[a : a + 1000]]
            keys = [xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63 for s in sets]
            sigs = [halves(signature(s)) for s in sets]
            yield pd.DataFrame({"key": keys, "n": [len(s) for s in sets], "high": [h for h, _ in sigs], "sig": [low for _, low in sigs], "shingles": [s.tobytes() for s in sets]})


def live_items(docs: DataFrame, signed: DataFrame) -> DataFrame:
    """(key, n, high, sig, shingles) of the live rows' distinct sets; ``sig``: the tokens' low halves."""
    counted = signed.where("live").groupBy("key", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    ids = materialize(counted.groupBy("key").agg(F.min(F.struct("doc_id", "text_hash", "rows")).alias("r")).select("r.*"), "wanted")
    rows = _with_hash(docs)
    match = rows["doc_id"].eqNullSafe(ids["doc_id"]) & (rows["text_hash"] == ids["text_hash"])
    texts = rows.join(small_side(ids, ids.count(), 32), match, "left_semi").select("text")
    items = texts.mapInPandas(_items, _ITEM)
    # a row repeated in full comes more than once
    return items if ids.where("rows > 1").isEmpty() else items.dropDuplicates(["key"])


def _children(rows: DataFrame, threshold: float) -> DataFrame:
    """(parent, parent_n, key, high, sig) to (node, parent_n, key), one row per drawn slot.

    A parent draws floor(1/threshold) slots, and one more with the probability
    of the fraction; both follow from its hash, so all its members agree.
    """
    whole, part = divmod(1 / threshold, 1)
    more = (F.pmod(F.xxhash64("parent", F.lit(-1)), F.lit(1_000_003)) < F.lit(round(part * 1_000_003))).cast("int")
    draws = F.sequence(F.lit(1), F.lit(int(whole)) + more) if part > 1e-9 else F.sequence(F.lit(1), F.lit(int(whole)))
    slot = F.pmod(F.xxhash64("parent", "draw"), F.lit(SLOTS)).cast("int")
    return rows.select("*", F.explode(draws).alias("draw")).select(
        F.xxhash64("parent", "draw", *[F.substring(half, slot * 2 + 1, F.lit(2)) for half in ("high", "sig")]).alias("node"), "parent_n", "key"
    )


def compare_node(keys: np.ndarray, sig: np.ndarray, threshold: float, certain: float) -> list[tuple[int, int, bool]]:
    """Edges (key, key, sure) that connect the node's items as all pairs would.

    Sure edges span the groups that the estimate settles; the others are the
    pairs between different such groups that only the exact sets can settle.
    """
    if len(keys) == 2:
        est = float((sig[0] == sig[1]).mean())
        return [(int(keys[0]), int(keys[1]), est >= threshold + certain)] if est >= threshold - certain else []
    edges, unsure = [], []
    left, group = np.arange(len(keys)), np.full(len(keys), -1)
    while len(left):
        frontier, left = [left[0]], left[1:]
        group[frontier[0]] = frontier[0]
        root = frontier[0]
        while frontier and len(left):
            q = frontier.pop()
            est = (sig[left] == sig[q]).mean(1)
            near = est >= threshold + certain
            hit = left[near]
            group[hit] = root
            frontier.extend(hit)
            edges.extend((int(keys[q]), int(keys[r]), True) for r in hit)
            unsure.extend((q, r) for r in left[~near & (est >= threshold - certain)])
            left = left[~near]
    edges.extend((int(keys[q]), int(keys[r]), False) for q, r in unsure if group[q] != group[r])
    return edges


def _compare(threshold: float, certain: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by node; the last node of a batch waits for the next batch."""

        def solve(node: np.ndarray, keys: np.ndarray, sig: list) -> pd.DataFrame:
            starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            matrix = np.frombuffer(b"".join(sig), "<u2").reshape(-1, SLOTS)
            out: list[tuple[int, int, bool]] = []
            for a, b in zip(starts, np.r_[starts[1:], len(node)]):
                out.extend(compare_node(keys[a:b], matrix[a:b], threshold, certain))
            return pd.DataFrame(out, columns=["a", "b", "sure"]).astype({"a": "int64", "b": "int64", "sure": "bool"})

        held: list[pd.DataFrame] = []
        for rows in batches:
            if not len(rows):
                continue
            if held and rows["node"].iloc[0] == rows["node"].iloc[-1] == held[-1]["node"].iloc[-1]:
                held.append(rows)  # still the same node
                continue
            rows = pd.concat([*held, rows], ignore_index=True) if held else rows
            node = rows["node"].to_numpy()
            cut = int(np.flatnonzero(np.r_[True, node[1:] != node[:-1]])[-1])
            held = [rows.iloc[cut:]]
            if cut:
                yield solve(node[:cut], rows["key"].to_numpy()[:cut], rows["sig"].tolist()[:cut])
        if held:
            rows = pd.concat(held, ignore_index=True)
            yield solve(rows["node"].to_numpy(), rows["key"].to_numpy(), rows["sig"].tolist())

    return run


_JUDGED = "node long, n long, key long, pivot long, sure boolean, stays boolean"


def _judge(threshold: float, certain: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each row against its node's pivots: the likest one it may be linked to, and whether the row goes on."""
        for rows in batches:
            if not len(rows):
                continue
            own = np.frombuffer(b"".join(rows["sig"]), "<u2").reshape(-1, SLOTS)
            keys = rows["key"].to_numpy()
            pivots = np.array([[p["key"] for p in ps] for ps in rows["pivots"]], np.int64)
            sigs = np.frombuffer(b"".join(p["sig"] for ps in rows["pivots"] for p in ps), "<u2").reshape(len(rows), -1, SLOTS)
            est = (sigs == own[:, None, :]).mean(2)
            est[pivots == keys[:, None]] = -1  # itself
            best = est.argmax(1)
            likest = est[np.arange(len(rows)), best]
            linked, sure = likest >= threshold - certain, likest >= threshold + certain
            is_pivot = (pivots == keys[:, None]).any(1)
            to = pd.array(pivots[np.arange(len(rows)), best], "Int64")
            to[~linked] = pd.NA
            stays = ~sure | is_pivot | (rows["drawn"].to_numpy() == 0)
            yield pd.DataFrame({"node": rows["node"], "n": rows["n"], "key": keys, "pivot": to, "sure": sure, "stays": stays})

    return run


def pivot_step(rows: DataFrame, items: DataFrame, threshold: float, certain: float) -> DataFrame:
    """(node, n, key, pivot, sure, stays) for (node, n, key) rows of large nodes."""
    full = rows.join(items.select("key", "sig"), "key")
    least = lambda i: F.min_by(F.struct("key", "sig"), F.xxhash64("node", "key", F.lit(i)))
    pivots = materialize(full.groupBy("node").agg(F.array_distinct(F.array(*[least(i) for i in range(PIVOTS)])).alias("p")).select("node", _padded(F.col("p")).alias("pivots")), "pivots")
    drawn = F.pmod(F.xxhash64("key", "node", F.lit(-2)), F.lit(STAYING)).alias("drawn")
    # the pivots' side has one row a node; a hot node's rows are split by adaptive execution
    met = full.join(small_side(pivots, pivots.count(), 300 * PIVOTS), "node").select("node", "n", "key", "sig", "pivots", drawn)
    return materialize(met.mapInPandas(_judge(threshold, certain), _JUDGED), "judged")


def _padded(pivots: Column) -> Column:
    """PIVOTS of them, the first one repeated where there are fewer."""
    return F.slice(F.concat(pivots, F.array_repeat(F.get(pivots, F.lit(0)), PIVOTS)), 1, PIVOTS)


def similar_items(items: DataFrame, threshold: float, trees: int, leaf: int, certain: float, max_depth: int, big: int = BIG) -> DataFrame:
    """Edges (a, b, sure) between the (key, high, sig) items, over all trees."""
    roots = items.select("key", "high", "sig", F.explode(F.sequence(F.lit(1), F.lit(trees))).alias("tree"))
    level = _children(
        roots.select(F.xxhash64(F.lit(SEED), "tree").alias("parent"), F.lit(None).cast("long").alias("parent_n"), "key", "high", "sig"), threshold
    )
    found: DataFrame | None = None
    for depth in range(1, LAST_DEPTH + 1):
        # a document may come to a child by two draws
        level = materialize(level.distinct() if depth > 1 else level, "level")
        nodes = (
            level.groupBy("node")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.first("parent_n").alias("parent_n"),
                F.bit_xor(F.xxhash64("key")).alias("x"),
                F.bit_xor(F.xxhash64("key", F.lit(1))).alias("y"),
            )
            .where("n > 1")
        )
        alike = F.coalesce(F.col("n") >= F.col("parent_n") * F.lit(COHESIVE * threshold), F.lit(False)) | F.lit(depth >= max_depth)
        stop = (F.col("n") <= leaf) | (alike & (F.col("n") <= big)) | F.lit(depth == LAST_DEPTH)
        nodes = materialize(nodes.withColumns({"alike": alike, "stop": stop}), "nodes")
        chosen = nodes.where("stop").groupBy("n", "x", "y").agg(F.min("node").alias("node")).select("node")
        rows = level.join(chosen, "node").select("node", "key").join(items.select("key", "sig"), "key")
        edges = rows.repartition("node").sortWithinPartitions("node").select("node", "key", "sig").mapInPandas(
            _compare(threshold, certain), "a long, b long, sure boolean"
        )
        edges = materialize(edges, "found")
        found = edges if found is None else found.unionByName(edges)
        large, crowded = nodes.agg(F.count_if(~F.col("stop") & ~F.col("alike")), F.count_if(~F.col("stop") & F.col("alike"))).first()
        if not large and not crowded:
            break
        live = level.select("node", "key").join(nodes.where("NOT stop AND NOT alike").select("node", "n"), "node").select("node", "n", "key")
        if crowded:
            judged = pivot_step(level.select("node", "key").join(nodes.where("NOT stop AND alike").select("node", "n"), "node").select("node", "n", "key"), items, threshold, certain)
            found = found.unionByName(judged.where("pivot IS NOT NULL").select(F.col("pivot").alias("a"), F.col("key").alias("b"), "sure"))
            live = live.unionByName(judged.where("stays").select("node", "n", "key"))
        live = live.join(items, "key")
        level = _children(live.select(F.col("node").alias("parent"), F.col("n").alias("parent_n"), "key", "high", "sig"), threshold)
    return found


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 0.0


def settle(sets: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """Of the (a, b) pairs, those whose exact similarity reaches the threshold."""
    both = pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb")), "b")

    @F.pandas_udf("double")
    def similarity(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([jaccard(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)) for p, q in zip(x, y)], dtype="float64")

    return both.where(similarity("sa", "sb") >= F.lit(threshold)).select("a", "b")


def _tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        for a in range(0, len(rows), 256):
            yield pd.DataFrame({"token": np.frombuffer(b"".join(rows["shingles"].iloc[a : a + 256]), np.int64)})


def _prefixes(threshold: float, known: np.ndarray, times: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The shingles of each set's prefix. Any one order of all shingles is right; this one puts frequent ones last."""

        def flush(held: list[tuple]) -> pd.DataFrame:
            long = [len(p) for p, *_ in held]
            columns = {c: np.repeat([h[i] for h in held], long) for i, c in ((1, "key"), (2, "root"), (3, "n"))}
            place = np.concatenate([np.arange(1, k + 1) for k in long])
            return pd.DataFrame({"token": np.concatenate([p for p, *_ in held]).view(np.int64), **columns, "place": place}).astype({"n": "int32", "place": "int32"})

        held, total = [], 0
        for rows in batches:
            for key, root, n, s in zip(rows["key"], rows["root"], rows["n"], rows["shingles"]):
                s = np.frombuffer(s, np.uint64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    s = s[np.argsort(np.where(known[at] == s, times[at], 0), kind="stable")]
                held.append((s[: n - int(_least(np.int64(n), threshold)) + 1], key, root, n))
                total += len(held[-1][0])
                if total >= CHUNK // 4:
                    yield flush(held)
                    held, total = [], 0
        if held:
            yield flush(held)

    return run


def missed_pairs(sets: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of all sets in different groups that may be similar: each similar pair is among them.

    What two sets share beyond the last shingle that both prefixes have comes after
    it in either, and beyond the prefix in the one whose prefix ends first.
    """
    part = max(1, sets.count() // ORDER_SAMPLE)
    sample = sets.where(F.pmod(F.xxhash64("key", F.lit(-3)), F.lit(part)) == 0).select("shingles")
    counted = sample.mapInPandas(_tokens, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("times")).where("times > 2")
    frequent = counted.orderBy(F.desc("times"), "token").limit(ORDER_KNOWN).toPandas()
    known = frequent["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(known)
    rooted = sets.select("key", "n", "shingles").join(roots.toDF("key", "root"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    rows = rooted.mapInPandas(_prefixes(threshold, known[order], frequent["times"].to_numpy()[order]), "token long, key long, root long, n int, place int")
    same = Window.partitionBy("token")
    mixed = rows.withColumns({"lo": F.min("root").over(same), "hi": F.max("root").over(same)}).where("lo < hi").select("token", "key", "root", "n", "place")
    mixed = materialize(mixed, "mixed")
    a, b = mixed.toDF("token", "a", "ra", "na", "pa"), mixed.toDF("token", "b", "rb", "nb", "pb")
    fits = (F.col("ra") < F.col("rb")) & (F.least("na", "nb") >= F.greatest("na", "nb") * F.lit(threshold) - F.lit(1e-9))
    met = a.join(b, "token").where(fits).groupBy("a", "b").agg(F.count(F.lit(1)).alias("both"), *[F.max(c).alias(c) for c in ("na", "nb", "pa", "pb")])
    beyond = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"), F.ceil(F.greatest("na", "nb") * F.lit(threshold) - F.lit(1e-9)) - 1)
    return met.where(F.col("both") + beyond >= (F.col("na") + F.col("nb")) * F.lit(threshold / (1 + threshold)) - F.lit(1e-6)).select("a", "b")


def groups(docs: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, leaf: int = LEAF, certain: float = CERTAIN, max_depth: int = MAX_DEPTH, big: int = BIG) -> DataFrame:
    """(doc_id, text_hash, rows, kept_id, kept_hash) of every row in a group.

    One line per distinct (doc_id, text); ``rows`` counts how often it occurs,
    the kept pair is the group's document that stays.
    """
    signed = materialize(sign(docs, threshold), "signed")
    sets = materialize_bucketed(live_items(docs, signed), "items", "key")
    items = sets.select("key", "high", "sig")
    edges = materialize(similar_items(items, threshold, trees, leaf, certain, max_depth, big).select("a", "b").distinct(), "pairs")
    linked = materialize(settle(sets, edges, threshold), "linked")
    roots = components(linked)
    missed = materialize(settle(sets, missed_pairs(sets, roots, threshold), threshold), "missed")
    if not missed.isEmpty():
        roots = components(linked.unionByName(missed))
    members = (
        signed.where("live")
        .groupBy("key", "doc_id", "text_hash")
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    members = materialize(members, "members")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    heads = members.groupBy("root").agg(F.sum("rows").alias("size"), F.min(first).alias("head")).where("size > 1")
    return members.join(heads, "root").select(
        "doc_id", "text_hash", "rows", F.col("head.doc_id").alias("kept_id"), F.col("head.text_hash").alias("kept_hash")
    )


def _is_head() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash"))


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The documents with one of each group left, all columns unchanged.

    What goes is listed as (doc_id, text hash). A short list is broadcast, so
    that no text is shuffled; a long one is joined by shuffle.
    """
    shield = Shield(docs, "doc_id", "text")
    listed = materialize(
        groups(docs, **options)
        .withColumn("stays", _is_head())
        .where("NOT stays OR rows > 1")
        .select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"), "stays"),
        "gone",
    )
    total, repeated = listed.agg(F.count(F.lit(1)), F.count_if(F.col("stays"))).first()
    work = shield.df.withColumns({"key_id": shield["doc_id"], "key_hash": F.xxhash64(shield["text"])})
    match = F.col("key_id").eqNullSafe(F.col("gone_id")) & (F.col("key_hash") == F.col("gone_hash"))
    kept = work.join(small_side(listed, total, 32), match, "left_anti")
    if repeated:
        again = work.join(small_side(listed.where("stays"), repeated, 32), match, "left_semi")
        once = again.groupBy("key_id", "key_hash").agg(F.min_by(F.struct(*shield.aliases), F.xxhash64(*shield.aliases)).alias("row"))
        kept = kept.select(*shield.aliases).unionByName(once.select("row.*"))
    return shield.restore(kept)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near copies stays."""
    return drop_near_copies(docs)


def near_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, duplicate_of): each document that resembles the one kept in its group."""
    found = groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.where(~_is_head()).select("doc_id", F.col("kept_id").alias("duplicate_of"))
