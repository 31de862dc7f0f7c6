"""Where queries over the driver's tables, and their SQL, are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..runtime import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
CONFIG = Config()


def query(name: str, oracle: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The documents, dealt out over the cores where they are few."""
    return spread(table(spark, sf_dir, "documents").select(*(columns or ("doc_id", "text"))))


def joined(values: Column, sep: str = " ") -> Column:
    return F.array_join(values.cast("array<string>"), sep)
