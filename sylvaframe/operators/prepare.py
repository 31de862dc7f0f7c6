"""Row-level preparation of pairs and groups: ids, labels, filters, renames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import preprocess, sentences, settled, strip


def stable_id(*parts: Column) -> Column:
    """An id in UUID form from a SHA-256 of its parts; the same on every run."""
    h = F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts]), 256)
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat_ws("-", cut(1, 8), cut(9, 4), cut(13, 4), cut(17, 4), cut(21, 12))


def project_pairs(df: DataFrame, pair_id: str, text: str, text_b: str | None = None, label: str | None = None) -> DataFrame:
    """Any table as (pair_id, text, text_b, label); text_b is '' and label '1' where missing."""
    return df.select(
        F.col(pair_id).cast("string").alias("pair_id"),
        F.col(text).alias("text"),
        F.coalesce(F.col(text_b), F.lit("")).alias("text_b") if text_b else F.lit("").alias("text_b"),
        F.coalesce(F.col(label).cast("string"), F.lit("1")).alias("label") if label else F.lit("1").alias("label"),
    )


def without_processed(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among those already processed; the planner picks the join by size."""
    return df.join(done.select(F.col(key).alias("_done")).distinct(), F.col(key) == F.col("_done"), "left_anti")


def in_vocabulary(df: DataFrame, vocabulary: DataFrame, token: str = "token", word: str = "word") -> DataFrame:
    return df.join(vocabulary.select(F.col(word).alias("_word")).distinct(), F.col(token) == F.col("_word"), "left_semi")


def clean_sentences(text: Column, strictness: int = 2, preserve_case: bool = False, remove_punctuation: bool = False, normalize_unicode: bool = True) -> Column:
    """Sentences of the cleaned text, each cleaned again, as an array.

    The second pass matters: a word lost with its accents leaves two spaces,
    and an abbreviation may only come free by the split. Most sentences hold
    nothing it could change, which one test tells.
    """
    clean = lambda s: preprocess(s, strictness, preserve_case, remove_punctuation, normalize_unicode)

    def again(s: Column) -> Column:
        if strictness < 2 or remove_punctuation or not normalize_unicode:
            return clean(s)
        return F.when(settled(s, preserve_case), s).otherwise(clean(s))

    return F.transform(sentences(clean(text), squeezed=strictness >= 1), again)


def keep_valid(token_lists: Column, least: int = 3, most: int = 50, max_trees: int = 10) -> Column:
    """The first ``max_trees`` token lists of a length within bounds, with their places.

    A text's sentences lie in one row, so this needs neither window nor shuffle.
    """
    placed = F.transform(token_lists, lambda t, i: F.struct(i.alias("sent_idx"), t.alias("tokens")))
    return F.slice(F.filter(placed, lambda x: F.size(x["tokens"]).between(least, most)), 1, max_trees)


def keep_group(trees: Column, trees_b: Column, paired: bool = True, self_paired: bool = True) -> Column:
    """Unpaired or self-paired groups need trees on the first side, paired ones on both."""
    a, b = F.size(trees) > 0, F.size(trees_b) > 0
    rule = F.lit(False)
    if not paired or self_paired:
        rule = rule | a
    if paired:
        rule = rule | (a & b)
    return F.coalesce(rule, F.lit(False))


def filter_groups(groups: DataFrame, min_trees: int = 2, drop: list[str] | None = None, rename: dict[str, str] | None = None) -> DataFrame:
    """Groups with enough trees on both sides together; then columns dropped and renamed."""
    size = F.coalesce(F.size("trees"), F.lit(0))
    if "trees_b" in groups.columns:
        size = size + F.coalesce(F.size("trees_b"), F.lit(0))
    return reshape(groups.where(size >= min_trees), drop, rename)


def reshape(groups: DataFrame, drop: list[str] | None = None, rename: dict[str, str] | None = None) -> DataFrame:
    return groups.drop(*(drop or [])).withColumnsRenamed(rename or {})


def text_lines(lines: DataFrame) -> DataFrame:
    """Lines with something on them, without line ends."""
    return lines.withColumn("value", F.regexp_replace("value", "[\r\n]+$", "")).where(strip(F.col("value")) != "")


# -- labels ------------------------------------------------------------------------


def map_labels(df: DataFrame, label: str, mapping: dict[str, float] | None, normalize: tuple[float, float] | None = None, skip: str = "-") -> DataFrame:
    """Adds ``mapped``; rows labelled ``skip`` go, an unknown label is an error.

    ``normalize`` = (min, max) gives (x - min) / max, as defined for this format.
    """
    rows = df.where(F.coalesce(F.col(label) != skip, F.lit(True)))
    if mapping is None:
        value = F.col(label).cast("double")
    else:
        table = F.create_map(*[F.lit(x) for k, v in mapping.items() for x in (k, float(v))])
        found = F.try_element_at(table, F.col(label))
        value = F.coalesce(found, F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(F.col(label), F.lit("null")))).cast("double"))
    if normalize:
        value = (value - F.lit(float(normalize[0]))) / F.lit(float(normalize[1]))
    return rows.withColumn("mapped", value)


def skip_rate(df: DataFrame, label: str, skip: str = "-") -> DataFrame:
    """(n_rows, n_skipped, percent)."""
    n, s = F.count(F.lit(1)), F.count_if(F.col(label) == skip)
    return df.agg(n.alias("n_rows"), s.alias("n_skipped")).withColumn("percent", F.when(F.col("n_rows") > 0, F.col("n_skipped") * 100.0 / F.col("n_rows")).otherwise(0.0))
