"""Text clean-up, sentence splitting and tokens as built-in Spark expressions.

Everything here takes a Column and gives a Column; no Python worker is needed
but for NFD with ``normalize_unicode`` off (see ``strict``). A null text gives
null (a null array for splits); an empty one an empty string or array.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space but the space itself. ASCII ones singly, which Java looks up in a table; the others behind one comparison.
_BLANKS = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f[\x85-\u3000&&[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
#: White space as Python sees it; Java's Unicode class lacks four separators and is slow.
SPACE = f"[ {_BLANKS}]"
#: Those below 256 only, which Java looks up in one table; unions of ranges are walked predicate by predicate, for each character.
_LOW_BLANKS = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"
#: Letters, digits of any kind and the underscore.
WORD = r"[\p{L}\p{N}_]"
TERMINATOR = "[.!?]"
_OPEN, _NEXT, _SHUT = "\ue000", "\ue001", "\ue002"
_SIGNS = ("fig.", "i.e.", "i e ", "e.g.", "e g ", "etc.")
_LONG_FORMS = ((r"fig\.", "figure"), (r"i\.e\.|i e ", "that is"), (r"e\.g\.|e g ", "for example"), (r"etc\.", "etc"))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, in lambdas too, where common parts aren't shared."""
    return F.element_at(F.transform(F.array(value), body), 1)


def squeeze(text: Column) -> Column:
    """Runs of white space to one space, none at either end. A lone space is no match, as most are."""

    def one_space(t: Column) -> Column:
        runs = lambda blanks: F.regexp_replace(t, f"[{blanks}][ {blanks}]*| [ {blanks}]+", " ")
        return F.when(F.regexp_like(t, F.lit(r"[\u1680-\u3000]")), runs(_BLANKS)).otherwise(runs(_LOW_BLANKS))

    return F.trim(bind(text, one_space))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def basic(text: Column, preserve_case: bool = False, remove_punctuation: bool = False) -> Column:
    """White space squeezed, punctuation to spaces if asked, lower case unless kept."""
    out = text
    if remove_punctuation:
        out = F.regexp_replace(out, rf"[^\p{{L}}\p{{N}}_ {_BLANKS}]", " ")
    if not preserve_case:
        out = F.lower(out)
    # squeezing once, at the end, gives what squeezing before and after would
    return squeeze(out)


@lru_cache(maxsize=1)
def _ascii_images() -> tuple[dict[str, str], dict[str, str]]:
    """What NFKD leaves of each non-ASCII character once non-ASCII is deleted.

    Normal forms reorder combining marks only, none of which is ASCII, so the
    result for a text is that for its characters one by one. Two maps: images
    of one character and of several.
    """
    one, more = {}, {}
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code < 0xE000:
            continue
        ch = chr(code)
        nf = unicodedata.normalize("NFKD", ch)
        if nf is not ch and nf != ch:
            image = "".join(c for c in nf if c < "\x80")
            if image:
                (one if len(image) == 1 else more)[ch] = image
    return one, more


def _ranges(codes: list[int]) -> str:
    """A character class's inside; neighbouring codes are joined."""
    runs: list[list[int]] = []
    for c in codes:
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(rf"\x{{{a:X}}}" if a == b else rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in runs)


def to_ascii(text: Column) -> Column:
    """NFKD without what isn't ASCII, in the JVM.

    One ``translate`` does nearly all texts; only those with a character of a
    longer image (ligatures, fractions, squared units) are taken apart.
    """
    one, more = _ascii_images()
    # the long class is tried for characters that aren't ASCII only
    several = r"[^\x00-\x7F](?<=[" + _ranges(sorted(map(ord, more))) + "])"
    images = F.from_json(F.lit(json.dumps(more)), "map<string,string>")  # one literal, not two for each character

    def plain(t: Column) -> Column:
        apart = F.array_join(F.transform(F.split(t, ""), lambda c: F.coalesce(F.try_element_at(images, c), c)), "")
        whole = F.when(F.regexp_like(t, F.lit(several)), apart).otherwise(t)
        bare = F.regexp_replace(F.translate(whole, "".join(one), "".join(one.values())), r"[^\x00-\x7F]+", "")
        return F.when(F.regexp_like(t, F.lit(r"[^\x00-\x7F]")), bare).otherwise(t)

    return bind(text, plain)


def _may_abbreviate(text: Column) -> Column:
    """False for most texts without an abbreviation, at the cost of searches for fixed strings."""
    low = F.lower(text)
    hit = F.lit(False)
    for sign in _SIGNS:
        hit = hit | F.contains(low, F.lit(sign))
    return hit


def _written_out(text: Column) -> Column:
    """All alternatives are matched in one pass from left to right, which marks
    each match by its kind; the marks are then replaced. A dotted form only
    counts directly before a word character.
    """
    groups = "|".join(f"({p})" for p, _ in _LONG_FORMS)
    marks = _NEXT.join(f"${k}" for k in range(1, len(_LONG_FORMS) + 1))
    out = F.regexp_replace(text, rf"(?i)\b(?:{groups})\b", f"{_OPEN}{marks}{_SHUT}")
    for k, (_, words) in enumerate(_LONG_FORMS):
        before, after = _NEXT * k, _NEXT * (len(_LONG_FORMS) - 1 - k)
        out = F.regexp_replace(out, f"{_OPEN}{before}[^{_OPEN}{_NEXT}{_SHUT}]+{after}{_SHUT}", words)
    return out


def expand_abbreviations(text: Column) -> Column:
    """Abbreviations written out, then a space before a capital or digit that follows a letter or comma."""
    out = bind(text, lambda t: F.when(_may_abbreviate(t), _written_out(t)).otherwise(t))
    # digits and capitals are rare by now, so they are looked for first, and as one range
    return F.regexp_replace(out, "([0-Z])(?<=[,A-Za-z][0-9A-Z])", " $1")


def settled(text: Column, preserve_case: bool = False) -> Column:
    """Whether another pass of ``medium`` would surely leave the text as it is; some texts that it would leave are missed."""
    capital = "" if preserve_case else "[A-Z]|"
    spaced = F.startswith(text, F.lit(" ")) | F.endswith(text, F.lit(" ")) | F.contains(text, F.lit("  "))
    # one range first, of which few characters are; alternatives would be tried at each of them
    odd = F.regexp_like(text, F.lit("[^ -~]")) | F.regexp_like(text, F.lit(f"[0-Z](?<={capital}[,A-Za-z][0-9A-Z])"))
    return ~(spaced | odd | _may_abbreviate(text))


def medium(text: Column, normalize_unicode: bool = True) -> Column:
    return expand_abbreviations(to_ascii(text) if normalize_unicode else text)


@F.pandas_udf(StringType())
def _without_marks(texts: pd.Series) -> pd.Series:
    def bare(t):
        return None if t is None else "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn")

    return texts.map(bare)


def strict(text: Column, normalize_unicode: bool = True) -> Column:
    """NFD without marks, lower case. After ``medium`` texts are ASCII, where only the case can change."""
    return F.lower(text if normalize_unicode else _without_marks(text))


def preprocess(
    text: Column, strictness: int = 2, preserve_case: bool = False, remove_punctuation: bool = False, normalize_unicode: bool = True
) -> Column:
    """Levels 0 (as is) to 3; each does all of the level below."""
    if strictness not in (0, 1, 2, 3):
        raise ValueError(f"strictness {strictness} is not 0, 1, 2 or 3")
    if strictness >= 1:
        text = basic(text, preserve_case, remove_punctuation)
    if strictness >= 2:
        text = medium(text, normalize_unicode)
    return strict(text, normalize_unicode) if strictness == 3 else text


def sentences(text: Column, squeezed: bool = False) -> Column:
    """Array of sentences: a piece ends after a run of ``.!?`` followed by white space.

    A piece with a terminator further inside gives its closing run as a
    sentence of its own, so ``v 3.14 ok. Next`` has three. In a text that is
    ``squeezed`` spaces are the only white space, which is faster.
    """
    space, bare = (" ", F.trim) if squeezed else (SPACE, strip)
    pieces = F.split(bare(text), f"{space}(?<={TERMINATOR}{space}){space}*")

    def cut(all_pieces: Column) -> Column:
        last = F.size(all_pieces) - 1

        def parts(x: Column, i: Column) -> Column:
            body = F.regexp_replace(x, f"{TERMINATOR}+$", "")
            tail = F.regexp_extract(x, f"{TERMINATOR}+$", 0)
            apart = (i < last) & F.regexp_like(body, F.lit(TERMINATOR))
            return F.when(apart, F.array(bare(body), tail)).otherwise(F.array(x))

        return F.filter(F.flatten(F.transform(all_pieces, parts)), lambda s: s != "")

    return bind(pieces, cut)


def regex_tokens(text: Column, min_length: int = 0, max_length: int = 30) -> Column:
    found = F.regexp_extract_all(text, F.lit(WORD + "+"), F.lit(0))
    return F.filter(found, lambda w: F.length(w).between(min_length, max_length))


def word_punct_tokens(text: Column) -> Column:
    """Words and single marks, for the model tokenizer that isn't available offline."""
    return F.regexp_extract_all(text, F.lit(rf"{WORD}+(?:['’]{WORD}+)?|[^\s\p{{L}}\p{{N}}_]"), F.lit(0))


def is_number(token: Column) -> Column:
    """Digits only once the first full stop is gone."""
    return F.regexp_like(F.regexp_replace(token, r"^([^.]*)\.", "$1"), F.lit(r"^\p{Nd}+$"))


def without_digits(token: Column) -> Column:
    return F.regexp_replace(token, r"\p{Nd}+", "")


def ends_sentence(text: Column) -> Column:
    return F.regexp_like(F.regexp_replace(text, SPACE + "+$", ""), F.lit(r"[.!?]\z"))


def repair_question(text: Column) -> Column:
    """A closing mark where there is none: ``?`` if the text has one anywhere, else a full stop."""
    bare = F.regexp_replace(text, SPACE + "+$", "")
    mark = F.when(F.contains(text, F.lit("?")), F.lit("?")).otherwise(F.lit("."))
    return F.when(ends_sentence(text), text).otherwise(F.concat(bare, mark))


def repair_answer(text: Column) -> Column:
    return F.when(ends_sentence(text), text).otherwise(F.concat(F.regexp_replace(text, SPACE + "+$", ""), F.lit(".")))


def morph_map(text: Column) -> Column:
    """``A=b|C=d`` as a map; empty for an empty text."""
    given = F.str_to_map(text, F.lit("[|]"), F.lit("="))
    return F.when(text == "", F.create_map().cast("map<string,string>")).otherwise(given)
