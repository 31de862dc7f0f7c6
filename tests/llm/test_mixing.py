import hashlib
from collections import Counter, defaultdict
from fractions import Fraction
from math import floor, lcm

import pytest

from sylvaframe.llm.mixing import SEED, WEIGHTS, mix, whole_weights

from .oddities import ROWS, clashing, empty, odd


def h32(value):
    return int(hashlib.md5(value.encode()).hexdigest()[:8], 16)


def order_of(r):
    name = lambda v: chr(92) + "N" if v is None else str(v)
    return h32(f"{name(r[0])}|{name(r[1])}"), r[0] is not None, r[0] or 0


def brute_mix(rows, weights, size=lambda r: len(r[1] or ""), expected=None):
    """Copies of each row by walking the prefix sums of fractions, in the order of hash, id, row."""
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    tokens = {s: sum(map(size, g)) for s, g in by.items()}
    w = {s: Fraction(str(weights.get(s, 1))) if s is not None else Fraction(1) for s in by}
    budget, total = sum(tokens.values()), sum(w[s] for s in by if tokens[s] > 0)
    out = Counter()
    for s, group in by.items():
        rate = budget * w[s] / (total * tokens[s]) if tokens[s] and total else Fraction(1)
        span = total * lcm(*[x.denominator for x in map(Fraction, map(str, weights.values()))]) * tokens[s] if tokens[s] and total else 1
        drawn = h32(f"{SEED}|{s if s is not None else chr(92) + 'N'}")
        if expected:
            span = 10**9
        at = Fraction(floor(drawn * Fraction(span) / 2**32), 1) / span
        for r in sorted(group, key=order_of):
            step = Fraction(expected(r)) if expected else rate
            out[(r[0], s)] += floor(at + step) - floor(at)
            at += step
    return +out


def many():
    return [(i, "x" * (i % 37 + 1), "en", ["src0", "src1", "src2", "other", None][i % 5 if i % 3 else 0], 0) for i in range(900)]


@pytest.mark.parametrize("per_bucket", [10, 100, 50_000])
def test_copies_are_those_of_the_prefix_walk(spark, per_bucket):
    rows = many()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = Counter((r["doc_id"], r["source"]) for r in mix(df, rows_per_bucket=per_bucket).collect())
    assert got == brute_mix(rows, WEIGHTS)


def test_shares_meet_their_targets(spark):
    rows = many()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = mix(df, {"src0": 1.0, "src1": 3.0, "src2": 0.0}).collect()
    chars = Counter()
    for r in out:
        chars[r["source"]] += len(r["text"])
    assert chars["src2"] == 0
    assert chars["src1"] / chars["src0"] == pytest.approx(3, rel=0.1)


def test_oddities(spark):
    want = brute_mix(ROWS, {})
    got = Counter((r["doc_id"], r["source"]) for r in mix(odd(spark), {}).collect())
    assert got == want
    df, _ = clashing(spark)
    out = mix(df, {})
    assert out.columns == df.columns and Counter((r[0], r[3]) for r in out.collect()) == want
    assert mix(empty(spark)).count() == 0


def test_a_tiny_weight_still_gets_its_copies(spark):
    """Rates below a millionth of a copy aren't rounded away: every source crosses the boundaries that exact fractions cross."""
    rows = [(i, "x", "en", "rare" if i % 2 else "big", 0) for i in range(2000)] + [(10**6 + i, "y" * 5000, "en", "huge", 0) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for weights in ({"rare": 1e-7, "big": 1.0, "huge": 1.0}, {"rare": 1e-5, "big": 0.5, "huge": 3}):
        got = Counter((r["doc_id"], r["source"]) for r in mix(df, weights).collect())
        assert got == brute_mix(rows, weights)
    with pytest.raises(ValueError):
        whole_weights({"a": -1.0})


def test_expected_copies_of_the_documents_themselves(spark):
    rows = [(i, f"text {i}", "en", "ab"[i % 2], i % 7) for i in range(300)] + [(None, "t", "en", "a", None), (5, "neg", "en", "b", -3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "n_chars / 4D AS wanted")
    out = mix(df, expected="wanted")
    got = Counter((r["doc_id"], r["source"]) for r in out.collect())
    assert got == brute_mix(rows, {}, expected=lambda r: Fraction(max(0, r[4] or 0), 4)) and out.columns == df.columns
    assert abs(out.count() - sum(max(0, r[4] or 0) for r in rows) / 4) <= 2


def test_repeats_of_one_row_are_counted_together(spark):
    """A third of all rows are one row: copies are shared evenly, and no bucket holds them one by one."""
    rows = [(1, "the same text", "en", "a", 0)] * 500 + [(i, f"another text {i}", "en", "a", 0) for i in range(2, 900)] + [(None, "no id", "en", "b", 0)] * 100
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    weights = {"a": 1.0, "b": 0.7}
    got = Counter((r["doc_id"], r["source"]) for r in mix(df, weights, rows_per_bucket=50).collect())
    assert got == brute_mix(rows, weights) and len(got) < len(rows)
