"""Personal data: candidate spans judged by boosted trees, then redacted.

High-recall generators (one pattern for each kind) propose spans, which may
overlap. A histogram gradient-boosted model scores each by its format (length,
character classes, checksum, octet ranges, ...) and its context (words before,
characters on either side). For each kind a threshold, calibrated for precision
and recall on held-out examples, selects spans; of overlapping ones the likelier stays, then the
longer, then the earlier.

The model is trained on generated snippets: true instances in running text,
and look-alikes (versions, dates, prices, order numbers, commit hashes, ISBNs,
coordinates) as negatives. Nothing is learned from the corpus.

Texts without a digit of any script, '@', '=', ':' or a known key prefix cannot hold
a candidate and never leave Arrow.

Defined results: a null text stays null with no spans, an empty one empty;
repeated rows get equal results; an empty table gives no rows; columns other
than doc_id and text are left out. Texts are searched whole, however long.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..runtime import pick
from .gbt import BoostedTrees

GENERATORS = {
    # the part before the sign is sought backwards from it, see _emails
    "EMAIL": r"@[\w-]+(?:\.[\w-]+)*",
    "PHONE": r"(?<![\w.])(?:(?:\+?\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{2,4}(?:[ .-]?\d{2,4}){1,3}|\+?(?:\d{1,3}[ .-])?\d{8,15})(?!\w)",
    "IP": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)",
    "CARD": r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?!\w)",
    "SSN": r"(?<![\w-])\d{3}[- ]\d{2}[- ]\d{4}(?![\w-])",
    "IBAN": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?!\w)",
    "KEY": r"(?<![\w/+])[A-Za-z0-9_-]{16,}(?!\w)",
    "SECRET": r"(?i)(?<!\w)(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|commit|sha1|id|ref|build)[\"']?\s{0,3}[:=]\s{0,3}[\"']?[^\s\"'<>]{6,}[\"']?",
}
KINDS = tuple(GENERATORS)
#: What known keys begin with.
_PREFIXES = "AKIA|ASIA|ghp_|gho_|xox[bp]-|sk-|AIza"
#: A KEY has a digit or a known prefix; sought in the span, as a look-ahead from each start would take quadratic time or a limit.
_KEY_SIGN = re.compile(f"(?:{_PREFIXES})|[A-Za-z0-9_-]*?[0-9]")
_LOCAL = re.compile(r"[\w.+%-]")
_PATTERNS = [(k, re.compile(p)) for k, p in GENERATORS.items()]
#: Every candidate has one of these; RE2 takes \d for ASCII only.
_ANCHOR = rf"[\p{{Nd}}@=:]|{_PREFIXES}"
_LETTERS = re.compile(r"[^\W\d_]+")
#: Whole words; parts of words would be heard everywhere.
_CUES = {
    "tel": ("tel", "phone", "call", "fax", "mobile", "contact"),
    "card": ("card", "visa", "credit", "pay"),
    "secret": ("password", "passwd", "pwd", "secret", "token", "api", "key", "auth", "credential"),
    "id": ("order", "id", "invoice", "ref", "isbn", "item", "sku", "serial", "page", "pages", "pp"),
    "version": ("version", "release", "v", "build", "section", "chapter", "license"),
    "hash": ("commit", "sha", "md5", "checksum", "digest"),
}


def _luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _iban_ok(span: str) -> bool:
    s = span.replace(" ", "")
    try:
        return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1
    except ValueError:
        return False


@dataclass(frozen=True)
class Candidate:
    start: int
    end: int
    kind: str


def _emails(text: str, pattern: re.Pattern) -> Iterator[tuple[int, int]]:
    """Addresses of any length in linear time: a match forwards from each place would try a long run of letters again and again."""
    floor = 0
    for m in pattern.finditer(text):
        start = m.start()
        while start > floor and _LOCAL.match(text[start - 1]):
            start -= 1
        if start < m.start():
            yield start, m.end()
            floor = m.end()


def candidates(text: str) -> list[Candidate]:
    found = []
    for kind, p in _PATTERNS:
        spans = _emails(text, p) if kind == "EMAIL" else (m.span() for m in p.finditer(text))
        found.extend(Candidate(a, b, kind) for a, b in spans)
    return [c for c in found if c.kind != "KEY" or _KEY_SIGN.match(text, c.start, c.end)]


def features(text: str, c: Candidate) -> list[float]:
    span = text[c.start : c.end]
    n = len(span)
    digits = [ch for ch in span if "0" <= ch <= "9"]
    letters = [ch for ch in span if ch.isalpha()]
    before, after = text[max(0, c.start - 32) : c.start].lower(), text[c.end : c.end + 2]
    counts = Counter(span)
    entropy = -sum(v / n * math.log2(v / n) for v in counts.values())
    value = re.split(r"[:=]\s*", span, maxsplit=1)[-1].strip("\"'") if c.kind == "SECRET" else span
    name = span.lower()[:12] if c.kind == "SECRET" else ""
    octets = [int(x) for x in span.split(".")] if c.kind == "IP" else []
    row = [float(c.kind == k) for k in KINDS]
    row += [
        n,
        len(digits) / n,
        len(letters) / n,
        sum(ch.isupper() for ch in letters) / n,
        len(set(span)) / n,
        entropy,
        float(12 < len(digits) < 20 and _luhn("".join(digits))) if c.kind == "CARD" else 0.0,
        float(_iban_ok(span)) if c.kind == "IBAN" else 0.0,
        float(bool(octets) and max(octets) < 256),
        float(sum(octets[:2])) if octets else -1.0,
        span.count("."),
        span.count("-"),
        span.count(" "),
        float(span[0] == "+"),
        float(span[0] == "0"),
        float("(" in span),
        len(digits),
        float(c.kind == "EMAIL" and "." in span.rpartition("@")[2]),
        float(re.fullmatch(r"[0-9a-fA-F]+", value) is not None),
        float(re.match(_PREFIXES, value) is not None),
        float(len(value)),
        float(any(w in name for w in ("pass", "pwd", "secret", "token", "key", "auth"))),
        float(re.match(r"(19|20)\d\d[-./ ]", span) is not None),
        float(before[-1:].isspace() or not before),
        float(before[-1:] in "$€£#"),
        float(after[:1].isspace() or not after),
        float(after[:1] in "%$€"),
    ]
    heard = set(_LETTERS.findall(before))
    row += [float(not heard.isdisjoint(words)) for words in _CUES.values()]
    return row


# ---- training examples -------------------------------------------------------

_SYLLABLES = "an er th on re ti ou le la qui en die ung sch keit que os ra do ment eau".split()


def _filler(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]
    return " ".join(words)


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choices("0123456789", k=n))


def _hex(rng: random.Random, n: int) -> str:
    s = "".join(rng.choices("0123456789abcdef", k=n))
    return s.upper() if rng.random() < 0.2 else s


def _iban(rng: random.Random) -> str:
    country, body = rng.choice(["DE", "FR", "ES", "GB"]), _digits(rng, 18)
    check = 98 - int("".join(str(int(ch, 36)) for ch in body + country + "00")) % 97
    s = f"{country}{check:02d}{body}"
    return s if rng.random() < 0.5 else " ".join(s[i : i + 4] for i in range(0, len(s), 4))


def _card(rng: random.Random) -> str:
    n = rng.choice([13, 15, 16, 16, 16, 16])
    body = (rng.choice("3456") if rng.random() < 0.7 else rng.choice("0123456789")) + _digits(rng, n - 1)
    if rng.random() < 0.6:
        body = next(body[:-1] + d for d in "0123456789" if _luhn(body[:-1] + d))
    sep = rng.choice(["", "", "", " ", "-"])
    return sep.join(body[i : i + 4] for i in range(0, n, 4)) if sep else body


def _compact_phones(rng: random.Random, ten: str) -> list[str]:
    """E.164, the same with a blank after the country, and national numbers in one run."""
    return [f"+1{ten}", f"+{rng.randint(1, 99)}{ten[: rng.randint(8, 10)]}", f"+{rng.randint(1, 99)} {ten}", ten, f"0{ten[1:]}"]


def _phone(rng: random.Random) -> str:
    a, b, c = _digits(rng, 3), rng.choice(["555", _digits(rng, 3)]), _digits(rng, 4)
    return rng.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{rng.randint(1, 99)} {a} {b} {c}", f"+1-{a}-{b}-{c}", f"0{a[:2]} {b}{c[:1]} {c}", *_compact_phones(rng, a + b + c)])


def _email(rng: random.Random) -> str:
    user = _filler(rng, 1) + rng.choice(["", f".{rng.randint(1, 99)}", "_" + _filler(rng, 1), f"+{_filler(rng, 1)}"])
    return f"{user}@{rng.choice(['mail', 'post', _filler(rng, 1)])}{rng.choice(['', str(rng.randint(1, 9))])}.{rng.choice(['example.com', 'example.org', 'co.uk', 'de', 'fr', 'net'])}"


def _ssn(rng: random.Random) -> str:
    return f"{rng.randint(1, 899):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}"


def _long_key(rng: random.Random, letters: str) -> str:
    return "".join(rng.choices(letters + "_-", k=int(48 * 2 ** rng.uniform(0, 6)))) + rng.choice("23456789")


def _key(rng: random.Random) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    mixed = upper + upper.lower() + "0189"
    return rng.choice(
        ["AKIA" + "".join(rng.choices(upper, k=16)), "ghp_" + "".join(rng.choices(mixed, k=36)), "sk-" + "".join(rng.choices(mixed, k=40)), "".join(rng.choices(mixed, k=rng.randint(24, 48))), _long_key(rng, mixed)]
    )


def _secret(rng: random.Random) -> str:
    name = rng.choice(["password", "passwd", "pwd", "secret", "token", "api_key", "access_key", "Password", "auth"])
    value = rng.choice([_hex(rng, rng.randint(12, 40)), _key(rng), _filler(rng, 1) + _digits(rng, 4) + "!"])
    return name + rng.choice(["=", " = ", ": ", ":"]) + (f'"{value}"' if rng.random() < 0.5 else value)


_POSITIVE = {"EMAIL": _email, "PHONE": _phone, "IP": lambda r: ".".join(str(r.randint(0, 255)) for _ in range(4)), "CARD": _card, "SSN": _ssn, "IBAN": _iban, "KEY": _key, "SECRET": _secret}


def _look_alike(rng: random.Random) -> str:
    d = lambda n: _digits(rng, n)
    return rng.choice(
        [
            lambda: f"version {rng.randint(0, 20)}.{rng.randint(0, 20)}.{rng.randint(0, 99)}.{rng.randint(0, 9)}",
            lambda: f"release v{rng.randint(0, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 99)}",
            lambda: f"section {rng.randint(1, 9)}.{rng.randint(1, 9)}.{rng.randint(1, 9)}.{rng.randint(1, 9)}",
            lambda: f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d} {rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}",
            lambda: f"{rng.randint(1, 28):02d}.{rng.randint(1, 12):02d}.{rng.randint(1900, 2030)}",
            lambda: f"{rng.randint(1900, 2030)}-{rng.randint(1900, 2030)} {rng.randint(1900, 2030)}",
            lambda: f"order number {d(rng.randint(8, 16))}",
            lambda: f"{rng.choice(['order', 'id', 'ref', 'serial', 'item', 'invoice', 'page'])} {d(rng.randint(8, 15))}",
            lambda: f"{rng.choice(['19', '20'])}{d(2)}{rng.randint(1, 12):02d}{rng.randint(1, 28):02d}",
            lambda: f"invoice no. {d(3)}-{d(4)}-{d(3)}",
            lambda: f"ISBN 978-{d(1)}-{d(4)}-{d(4)}-{d(1)}",
            lambda: f"item {d(3)}-{d(2)}-{d(4)} sku",
            lambda: f"commit {_hex(rng, 40)}",
            lambda: f"sha1: {_hex(rng, 40)}",
            lambda: f"commit: {_hex(rng, rng.randint(7, 40))}",
            lambda: f"md5 checksum {_hex(rng, 32)}",
            lambda: f"build: {rng.randint(1, 9)}.{rng.randint(1, 99)}.{d(4)}",
            lambda: f"id = {_filler(rng, 1)}{d(4)}",
            lambda: f"ref: {_filler(rng, 1)}-{d(6)}",
            lambda: f"auth: {_filler(rng, 1)}or",
            lambda: f"token: {_filler(rng, 1)}nnn",
            lambda: f"{_filler(rng, 1)}@{_filler(rng, 1)} handle",
            lambda: f"${d(1)},{d(3)}.{d(2)} {d(2)}%",
            lambda: f"pages {d(3)}-{d(3)}-{d(3)}",
            lambda: f"{d(2)}.{d(4)} {d(2)}.{d(4)}",
            lambda: f"{_filler(rng, 1)}-{_filler(rng, 1)}-{_filler(rng, 2).replace(' ', '-')}-2024",
            lambda: "-".join(_filler(rng, rng.randint(8, 60)).split()) + f"-{d(4)}",
            lambda: "sk-" + "-".join(_filler(rng, rng.randint(3, 6)).split()),
            lambda: f"{_filler(rng, 1)}_{_filler(rng, 1)}_{_filler(rng, 1)}_v{d(2)}",
            lambda: f"serial AB{d(2)} {_filler(rng, 1).upper()[:4]:X<4} {d(4)} {d(4)}",
            lambda: "1 000 000 000",
        ]
    )()


def training_set(n: int = 16_000, seed: int = 5) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Features, labels and kinds of the candidates in n generated snippets.

    A candidate is true if it lies in a true instance and covers most of it.
    """
    rng = random.Random(seed)
    x, y, kinds = [], [], []
    for _ in range(n):
        true = rng.random() < 0.55
        kind = rng.choice(KINDS) if true else ""
        piece = _POSITIVE[kind](rng) if true else _look_alike(rng)
        left = _filler(rng, rng.randint(0, 8))
        cue = rng.choice(["", "", "", "tel", "phone", "call", "card", "pay", "ip", "contact"]) if true else ""
        if kind == "SSN" and rng.random() < 0.3:
            cue = rng.choice(["ssn", "number", "his number"])
        tail = rng.choice(["", " ", ". ", ", ", "!! ", "%%% ", "*** ", "$$$ "]) + _filler(rng, rng.randint(0, 6))
        head = " ".join(p for p in (left, cue) if p)
        head += " " if head else ""
        text = head + piece + (tail if tail[:1] in "" or tail[:1] in " .,!%*$" else " " + tail)
        a, b = len(head), len(head) + len(piece)
        for c in candidates(text):
            inside = min(b, c.end) - max(a, c.start)
            x.append(features(text, c))
            y.append(float(true and inside >= 0.7 * (b - a) and inside >= 0.7 * (c.end - c.start)))
            kinds.append(c.kind)
    return np.array(x), np.array(y), kinds


def threshold(scores: np.ndarray, true: np.ndarray, beta: float = 2.0) -> float:
    """Where F-beta of the candidates at or above it is greatest; half way to the next score below, of equals the lowest.

    Recall weighs beta times as much as precision. 0.5 if nothing is true.
    """
    if not true.any():
        return 0.5
    order = np.argsort(-scores, kind="stable")
    ranked, hits = scores[order], np.cumsum(true[order])
    last = np.r_[ranked[1:] < ranked[:-1], True]  # a cut can't part equal scores
    taken = np.arange(1, len(ranked) + 1)
    worth = np.where(last, (1 + beta**2) * hits / (beta**2 * true.sum() + taken), -1.0)
    best = int(np.flatnonzero(worth >= worth.max() - 1e-12)[-1])
    below = ranked[best + 1] if best + 1 < len(ranked) else 0.0
    return float((ranked[best] + below) / 2)


def fit(n: int = 16_000, seed: int = 5, beta: float = 2.0) -> tuple[BoostedTrees, dict[str, float]]:
    """The model, and for each kind the threshold that is best by F-beta on other snippets than those it was trained on."""
    x, y, _ = training_set(n, seed)
    model = BoostedTrees(n_trees=80, depth=5, rate=0.2).fit(x, y)
    hx, hy, kinds = training_set(n // 2, seed + 1)
    p = model.predict(hx)
    names = np.array(kinds)
    return model, {kind: threshold(p[names == kind], hy[names == kind] > 0, beta) for kind in KINDS}


def select(spans: list[tuple[Candidate, float]], cuts: dict[str, float]) -> list[tuple[Candidate, float]]:
    """Likely enough spans without overlaps, in order of their start.

    Those taken lie apart from each other, so only a span's neighbours among them can overlap it.
    """
    ranked = sorted((s for s in spans if s[1] >= cuts[s[0].kind]), key=lambda s: (-round(s[1], 9), s[0].start - s[0].end, s[0].start, s[0].kind))
    starts: list[int] = []
    taken: list[tuple[Candidate, float]] = []
    for c, p in ranked:
        k = bisect_left(starts, c.start)
        before = k == 0 or taken[k - 1][0].end <= c.start
        if before and (k == len(taken) or taken[k][0].start >= c.end):
            starts.insert(k, c.start)
            taken.insert(k, (c, p))
    return taken


def redact_texts(texts: list[str], model: BoostedTrees, cuts: dict[str, float]) -> list[tuple[str, list[tuple[Candidate, float]]]]:
    found = [candidates(t) for t in texts]
    rows = [features(t, c) for t, cs in zip(texts, found) for c in cs]
    scores = iter(model.predict(np.array(rows)) if rows else [])
    out = []
    for text, cs in zip(texts, found):
        chosen = select([(c, float(next(scores))) for c in cs], cuts)
        parts, at = [], 0
        for c, _ in chosen:
            parts += [text[at : c.start], f"[{c.kind}]"]
            at = c.end
        out.append(("".join(parts) + text[at:], chosen))
    return out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
SCHEMA = "doc_id long, text string, n_spans int, spans array<struct<kind:string,start:int,end:int,score:double>>"


def redact(docs: DataFrame, model: BoostedTrees, cuts: dict[str, float]) -> DataFrame:
    """(doc_id, redacted text, n_spans, spans); offsets refer to the original text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            hot = np.flatnonzero(pc.fill_null(pc.match_substring_regex(text, _ANCHOR), False).to_numpy(zero_copy_only=False))
            done = redact_texts(text.take(pa.array(hot)).to_pylist(), model, cuts)
            spans: list[list[dict]] = [[] for _ in range(len(batch))]
            for i, (_, chosen) in zip(hot, done):
                spans[i] = [{"kind": c.kind, "start": c.start, "end": c.end, "score": p} for c, p in chosen]
            mask = np.zeros(len(batch), bool)
            mask[hot] = True
            new = pc.replace_with_mask(text, pa.array(mask), pa.array([t for t, _ in done], text.type))
            counts = pa.array([len(s) for s in spans], pa.int32())
            yield pa.RecordBatch.from_arrays([ids, new, counts, pa.array(spans, pa.list_(_SPAN))], ["doc_id", "text", "n_spans", "spans"])

    return pick(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def pii_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, cuts = fit()
    return redact(spark.read.parquet(f"{sf_dir}/documents.parquet"), model, cuts)
