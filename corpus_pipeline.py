"""The corpus pipeline: raw documents to packed training windows.

Each stage gets all rows that its predecessor kept, as a written table, and
returns the rows it keeps with the columns of documents; the last one returns
the training windows: token ids, and the pieces of documents they are made of.
No stage but the mixing drops or repeats a clean document, and that one only to
meet the source weights.

Defined results: a null or empty text goes through every stage as its statistics
and the stages' docstrings say, and ends as one end-of-document token; very long
texts are kept whole; of ties the least id stays; repeated rows leave one; empty
tables give no windows; extra columns pass through all stages but the last,
whatever they are called.

Packing and the learned rules have no SQL, so ORACLE_SQL is None; tests/llm
compares run() with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sylvaframe.llm.cpsjoin import near_stage
from sylvaframe.llm.digest_index import exact_stage
from sylvaframe.llm.mixing import mixing_stage
from sylvaframe.llm.packing import packing_stage
from sylvaframe.llm.rules import quality_stage
from sylvaframe.runtime import materialize

STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("MinHash near-dedup", near_stage),
    ("mixing sources to target weights", mixing_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
