"""Readers for the supported corpora, one per dataset type.

Each gives ``pair_id, text, text_b, label`` and the line's place: ``src_file``
and ``ordinal``, its number in the file from 0. Numbers come from the order of
lines within a file split plus the lines of the splits before it, so lines are
never shuffled or sorted for them, and a file of any size is read in parallel.
"""

from __future__ import annotations

import ast
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import SPACE, repair_answer, repair_question, strip
from ..schemas import QA, SNLI

READERS: dict[str, Callable[..., DataFrame]] = {}
#: Files that a directory of each type holds.
GLOBS = {"amazon_qa": "*.json.gz", "snli": "*.jsonl", "semeval": "*.jsonl"}


def reader(name: str):
    def register(f):
        READERS[name] = f
        return f

    return register


def raw_lines(spark: SparkSession, path: str, dataset_type: str | None = None) -> DataFrame:
    """(value, src_file, split_start) of every line of a file, a list of files or a directory."""
    source = spark.read.option("recursiveFileLookup", "false")
    if dataset_type in GLOBS:
        source = source.option("pathGlobFilter", GLOBS[dataset_type])
    return source.text(path).select(
        F.regexp_replace("value", "\r$", "").alias("value"), F.col("_metadata.file_path").alias("src_file"), F.col("_metadata.file_block_start").alias("split_start")
    )


def number_lines(rows: DataFrame, name: str = "ordinal", across_files: bool = False) -> DataFrame:
    """Adds the number of each row in its file (or over all files, by path), from 0.

    The id is made after whatever filters ``rows`` has, so numbers are dense.
    """
    marked = rows.withColumn("_mark", F.monotonically_increasing_id())
    splits = marked.groupBy("src_file", "split_start").agg(F.min("_mark").alias("_first"), F.count(F.lit(1)).alias("_n"))
    over = Window.orderBy("src_file", "split_start") if across_files else Window.partitionBy("src_file").orderBy("split_start")
    placed = splits.select(
        F.col("src_file").alias("_file"), F.col("split_start").alias("_split"), "_first", F.coalesce(F.sum("_n").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before")
    )
    match = (F.col("src_file") == F.col("_file")) & (F.col("split_start") == F.col("_split"))
    # one line a split; adaptive execution broadcasts it once its measured size allows
    return marked.join(placed, match).select(*rows.columns, (F.col("_before") + F.col("_mark") - F.col("_first")).alias(name))


def first_lines(rows: DataFrame, max_lines: int | None, skipped: int = 0) -> DataFrame:
    """The first ``max_lines`` lines of each file after ``skipped`` ones; a filter, not an unordered limit."""
    out = rows.where(F.col("ordinal") >= skipped) if skipped else rows
    return out.where(F.col("ordinal") < skipped + max_lines) if max_lines else out


def _pair(rows: DataFrame, pair_id: Column, text: Column, text_b: Column, label: Column) -> DataFrame:
    return rows.select(
        "src_file", "ordinal", pair_id.cast("string").alias("pair_id"), text.alias("text"), F.coalesce(text_b, F.lit("")).alias("text_b"), F.coalesce(label, F.lit("1")).alias("label")
    )


@reader("snli")
def read_snli(spark: SparkSession, path: str, max_lines: int | None = None, compat: bool = False) -> DataFrame:
    """JSON lines. ``compat`` drops each file's first line. Lines that aren't JSON are left out."""
    rows = number_lines(raw_lines(spark, path, "snli" if "*" not in path and "." not in path.rsplit("/", 1)[-1] else None))
    rows = first_lines(rows, max_lines, 1 if compat else 0)
    rows = rows.withColumn("r", F.from_json("value", SNLI)).where("r.sentence1 IS NOT NULL OR r.pairID IS NOT NULL")
    return _pair(rows, F.col("r.pairID"), F.col("r.sentence1"), F.col("r.sentence2"), F.col("r.gold_label"))


READERS["semeval"] = read_snli


def question_fields(line: Column) -> Column:
    """The texts of the fields of a tab-separated line that begin with ``q:`` or ``a:``."""
    marked = F.filter(F.split(line, "\t"), lambda x: F.startswith(x, F.lit("q:")) | F.startswith(x, F.lit("a:")))
    return F.transform(marked, lambda x: F.substring(strip(x), 3, 2**31 - 1))


@reader("wiki_qs")
def read_question_groups(spark: SparkSession, path: str, max_lines: int | None = None, compat: bool = False) -> DataFrame:
    """Groups of at least two questions or answers; a group is named by its line, so names have gaps."""
    rows = first_lines(number_lines(raw_lines(spark, path)), max_lines)
    rows = rows.withColumn("fields", question_fields(F.col("value"))).where(F.size("fields") >= 2)
    name = F.concat(F.lit("group_"), F.col("ordinal").cast("string"))
    return _pair(rows, name, F.array_join("fields", " "), F.lit(""), F.lit("1"))


@reader("wiki_qs_folder")
def read_question_folder(spark: SparkSession, path: str, max_lines: int | None = None, compat: bool = False) -> DataFrame:
    """As read_question_groups over all files of a folder; the file's name goes into the group's, so none collide."""
    rows = read_question_groups(spark, path, max_lines)
    return rows.withColumn("pair_id", F.concat(F.element_at(F.split("src_file", "/"), -1), F.lit("/"), F.col("pair_id")))


#: Lines that Python has as objects at once.
LINES_AT_ONCE = 500


def _literals(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    def one(line):
        try:
            return json.dumps(ast.literal_eval(line.strip()))
        except (ValueError, SyntaxError, AttributeError, TypeError, MemoryError, RecursionError):
            return None

    for lines in batches:
        for at in range(0, len(lines), LINES_AT_ONCE):
            yield pa.array([one(x) for x in lines.slice(at, LINES_AT_ONCE).to_pylist()], pa.string())


def literal_to_json(lines: str) -> Column:
    """A Python literal as JSON; null for what isn't one."""
    return F.arrow_udf(_literals, "string")(F.col(lines))


def qa_text(record: Column, question_types: list[str] | None = None) -> Column:
    """Questions, then answers, with end marks put right; null if either is missing."""
    single = F.array(
        F.struct(
            record["question"].alias("questionText"),
            record["questionType"].alias("questionType"),
            F.array(F.struct(F.coalesce(record["answer"], F.lit("")).alias("answerText"))).alias("answers"),
        )
    )
    items = F.when(record["questions"].isNotNull(), record["questions"]).when(record["question"].isNotNull(), single)
    if question_types is not None:
        items = F.filter(items, lambda q: q["questionType"].isin(question_types))
    questions = F.transform(items, lambda q: repair_question(q["questionText"]))
    answers = F.flatten(F.transform(items, lambda q: F.transform(F.coalesce(q["answers"], F.array().cast("array<struct<answerText:string>>")), lambda a: a["answerText"])))
    some = (F.size(questions) > 0) & F.exists(answers, lambda a: a != "")
    return F.when(some, F.concat_ws(" ", F.concat(questions, F.transform(answers, repair_answer))))


@reader("amazon_qa")
def read_qa(
    spark: SparkSession, path: str, max_lines: int | None = None, compat: bool = False, question_types: list[str] | None = None
) -> DataFrame:
    """Gzipped Python literals, one a line; groups are numbered over the kept lines. Lines that aren't literals are left out."""
    rows = raw_lines(spark, path)
    if max_lines:
        rows = first_lines(number_lines(rows), max_lines).drop("ordinal")
    rows = rows.withColumn("text", qa_text(F.from_json(literal_to_json("value"), QA), question_types)).where(F.col("text").isNotNull())
    rows = number_lines(rows)
    return _pair(rows, F.concat(F.lit("group_"), F.col("ordinal").cast("string")), F.col("text"), F.lit(""), F.lit("1"))


@reader("patentmatch")
def read_patents(spark: SparkSession, path: str, max_lines: int | None = None, compat: bool = False) -> DataFrame:
    """Tab-separated, at least eight fields; a first line that begins with ``index`` is the header."""
    rows = number_lines(raw_lines(spark, path))
    header = (F.col("ordinal") == 0) & F.startswith("value", F.lit("index"))
    rows = rows.where(~header) if not max_lines else _capped(rows, header, max_lines)
    rows = rows.withColumn("f", F.split(strip(F.col("value")), "\t")).where(F.size("f") >= 8)
    return _pair(rows, F.get("f", F.lit(1)), F.get("f", F.lit(5)), F.get("f", F.lit(6)), F.get("f", F.lit(7)))


def _capped(rows: DataFrame, header: Column, max_lines: int) -> DataFrame:
    headed = rows.where(header).select(F.col("src_file").alias("_file")).distinct()
    out = rows.join(headed, F.col("src_file") == F.col("_file"), "left").withColumn("_skip", F.col("_file").isNotNull().cast("int"))
    return out.where((F.col("ordinal") >= F.col("_skip")) & (F.col("ordinal") < F.col("_skip") + max_lines)).drop("_file", "_skip")


def read_pairs(spark: SparkSession, dataset_type: str, path: str, **options) -> DataFrame:
    if dataset_type not in READERS:
        raise ValueError(f"no reader for {dataset_type!r}; there are {sorted(READERS)}")
    return READERS[dataset_type](spark, path, **options)


# -- files by name -----------------------------------------------------------------


def file_number(name: Column) -> Column:
    """The number after ``part-``, else the first number, else 0."""
    first = F.nullif(F.regexp_extract(name, r"part-(\d+)", 1), F.lit(""))
    return F.coalesce(first, F.nullif(F.regexp_extract(name, r"(\d+)", 1), F.lit("")), F.lit("0")).cast("int")


def is_input_file(name: Column, mode: str) -> Column:
    if mode == "text":
        return F.regexp_like(name, F.lit(r"^part-\d+"))
    return F.regexp_like(name, F.lit(r"^part_.*\.json$")) & ~F.contains(name, F.lit("_counts"))


def excluded(path: Column, globs: list[str]) -> Column:
    """Whether any of the shell patterns matches the path's last part or the whole path."""
    import fnmatch

    name = F.element_at(F.split(path, "/"), -1)
    hit = F.lit(False)
    for g in globs:
        regex = fnmatch.translate(g).replace(r"\Z", "$").replace(r"\z", "$")
        hit = hit | F.regexp_like(name, F.lit(regex)) | F.regexp_like(path, F.lit(regex))
    return hit


def list_files(spark: SparkSession, path: str, mode: str, nested: bool = False, exclude: list[str] | None = None) -> DataFrame:
    """(path, name, category, file_number, part_number) of the input files under ``path``; names only are read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", str(nested).lower()).load(path).select("path")
    name = F.element_at(F.split("path", "/"), -1)
    parent = F.element_at(F.split("path", "/"), -2)
    part = F.nullif(F.regexp_extract(name, r"part_(\d+)", 1), F.lit("")).cast("int")
    rows = found.where(is_input_file(name, mode) & ~excluded(F.col("path"), exclude or []))
    return rows.select("path", name.alias("name"), (parent if nested else F.lit("")).alias("category"), file_number(F.when(F.lit(nested) & F.startswith(parent, F.lit("part-")), parent).otherwise(name)).alias("file_number"), part.alias("part_number"))


def read_group_documents(spark: SparkSession, path: str, schema: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents ``{header..., groups: [...]}`` as (groups with src_file, headers).

    ``schema``: of one group; without it Spark infers it by reading the files.
    """
    source = spark.read.option("multiLine", True)
    if schema:
        source = source.schema(f"version string, format string, requires_word_embeddings boolean, groups array<struct<{_colons(schema)}>>")
    docs = source.json(path).withColumn("src_file", F.col("_metadata.file_path"))
    rows = docs.select("src_file", F.posexplode("groups").alias("ordinal", "g")).select("src_file", F.col("ordinal").cast("long").alias("ordinal"), "g.*")
    return rows, docs.drop("groups")


def _colons(schema: str) -> str:
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema).simpleString()[len("struct<") : -1]
