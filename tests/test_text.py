import random
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sylvaframe.functions import text as T


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[1] for r in sorted(df.select("i", expression(F.col("t"))).collect())]


# plain restatements of the rules


def plain_basic(t, keep=False, bare=False):
    t = re.sub(r"\s+", " ", t).strip()
    if bare:
        t = re.sub(r"[^\w\s]", " ", t)
    t = t if keep else t.lower()
    return re.sub(r"\s+", " ", t).strip()


def plain_medium(t):
    t = "".join(c for c in unicodedata.normalize("NFKD", t) if ord(c) < 128)
    spelt = [("figure", "fig."), ("that is", "i.e.|i e "), ("for example", "e.g.|e g "), ("etc", "etc.")]
    long = {short: words for words, shorts in spelt for short in shorts.split("|")}
    t = re.sub(r"(?i)\b(?:" + "|".join(re.escape(k) for k in long) + r")\b", lambda m: long[m[0].lower()], t)
    return re.sub(r"(?<=[,A-Za-z])(?=[0-9A-Z])", " ", t)


def plain_sentences(t):
    out, now = [], ""
    for part in re.split(r"([.!?]+\s+)", t.strip()):
        now += part
        if re.search("[.!?]", part):
            out.append(now.strip())
            now = ""
    return out + ([now.strip()] if now.strip() else [])


FIXED = [
    ("Hello,   World! ", "hello, world!"), ("café", "cafe"), ("see fig.3", "see figure 3"), ("see fig. 3", "see fig. 3"), ("i e the", "that isthe"),
    ("1,000 ab12", "1, 000 ab 12"), ("ﬁne ½ ㎏", "fine 12 kg"), ("", ""), (None, None), ("i e e g x", "that isfor examplex"),
]


def test_fixed_texts(spark):
    assert column(spark, [a for a, _ in FIXED], T.preprocess) == [b for _, b in FIXED]
    assert column(spark, ["Hello,   World! "], lambda t: T.preprocess(t, 1, remove_punctuation=True)) == ["hello world"]
    assert column(spark, [" A "], lambda t: T.preprocess(t, 0)) == [" A "]
    with pytest.raises(ValueError):
        T.preprocess(F.col("t"), 4)


def noise(seed, n=300):
    rng = random.Random(seed)
    parts = ["a", "B", "é", "ß", "ﬁ", "½", "Å", "́", "\xa0", " ", "\n", "\t", "\x1c", " ", "  ", ".", ". ", "! ", "?", ",", "3", "10", "fig.", "i e ", "E.G.", "e.g.x", "etc.", "_", "-", "漢", "가", "①", "Ⅷ", "…", "™", "٣"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(n)]


def test_levels_match_plain_python(spark):
    texts = noise(0)
    same = lambda expression, plain: [(a, b, t) for a, b, t in zip(column(spark, texts, expression), map(plain, texts), texts) if a != b]
    assert same(T.basic, plain_basic) == []
    assert same(lambda t: T.basic(t, True), lambda t: plain_basic(t, True)) == []
    assert same(T.preprocess, lambda t: plain_medium(plain_basic(t))) == []
    assert same(lambda t: T.preprocess(t, 2, preserve_case=True), lambda t: plain_medium(plain_basic(t, True))) == []


def test_strict_without_normal_form(spark):
    plain = lambda t: "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn").lower()
    texts = ["Ünïcode Ñandú", "가나", "é", ""]
    assert column(spark, texts, lambda t: T.strict(t, False)) == [plain(t) for t in texts]


@pytest.mark.parametrize(
    "text, parts",
    [
        ("A b. C d.", ["A b.", "C d."]), ("v 3.14 ok. Next", ["v 3.14 ok", ".", "Next"]), ("", []), ("... foo", ["...", "foo"]), ("a. . b", ["a.", ".", "b"]),
        ("a 1.2 b! c 3.4.", ["a 1.2 b", "!", "c 3.4."]), (None, None), ("  ", []), ("no end", ["no end"]),
    ],
)
def test_sentences(spark, text, parts):
    assert column(spark, [text], T.sentences) == [parts]


def test_sentences_match_plain_python(spark):
    texts = noise(1)
    got = column(spark, texts, T.sentences)
    assert [(a, plain_sentences(t), t) for a, t in zip(got, texts) if a != plain_sentences(t)] == []


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=150, max_size=150))
def test_tokens_of_any_text(spark, texts):
    texts = [t for t in texts if not any(0xD800 <= ord(c) < 0xE000 or c == "\0" for c in t)]
    got = column(spark, texts, lambda t: T.regex_tokens(t, 0, 30))
    word = lambda c: c == "_" or unicodedata.category(c)[0] in "LN"

    def plain(t):
        return [w for w in "".join(c if word(c) else "\0" for c in t).split("\0") if w and len(w) <= 30]

    assert [t for a, t in zip(got, texts) if a != plain(t)] == []


def test_small_functions(spark):
    numbers = {".5": True, "5.": True, "1.5": True, ".": False, "": False, "1.2.3": False, "a1": False, "12": True}
    assert column(spark, list(numbers), T.is_number) == list(numbers.values())
    assert column(spark, ["a1b22", ""], T.without_digits) == ["ab", ""]
    assert column(spark, ["Is it? yes", "tell me", "ok.", "why? ", ""], T.repair_question) == ["Is it? yes?", "tell me.", "ok.", "why? ", "."]
    assert column(spark, ["yes", "no! "], T.repair_answer) == ["yes.", "no! "]
    assert column(spark, ["Number=Sing|Person=3", ""], T.morph_map) == [{"Number": "Sing", "Person": "3"}, {}]
    assert column(spark, ["It's 5% off"], T.word_punct_tokens) == [["It's", "5", "%", "off"]]
