"""Session defaults, the shared scratch folder and column shielding.

Everything here works on a cluster whose executors can vanish: intermediate
tables go to the folder that ``spark.checkpoint.dir`` names, which all
executors share, and never to a machine-local one.
"""

from __future__ import annotations

import atexit
import logging
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_LOCAL_SCRATCH: str | None = None

#: A side of a join is broadcast only when its measured size is below this.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024


def make_session(app: str = "sylvaframe", master: str = "local[8]", **conf: str) -> SparkSession:
    """A session with the settings the library's plans are written for."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can reach.

    The session's ``spark.checkpoint.dir`` decides. Where that is unset a local
    master, which is one machine, gets a temporary folder that goes when Python
    ends; any other master must name one.
    """
    global _LOCAL_SCRATCH
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _LOCAL_SCRATCH is None:
        folder = tempfile.mkdtemp(prefix="sylvaframe-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _LOCAL_SCRATCH = "file://" + folder
    return _LOCAL_SCRATCH


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


#: Groups of graphs in a Parquet row group. A graph's features shrink so much in Parquet that a row group bounded by bytes
#: holds many thousands of groups, and a reader lays out 4,096 rows of all their floats at once, but never beyond a row group.
GROUPS_AT_ONCE = 250


def short_row_groups(writer: DataFrameWriter, rows: int = GROUPS_AT_ONCE) -> DataFrameWriter:
    return writer.option("parquet.block.row.count.limit", rows)


def materialize(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write to the shared folder and read back, which cuts the lineage. ``rows``: of a row group at most, for wide rows."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    (short_row_groups(df.write, rows) if rows else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_bucketed(df: DataFrame, label: str, key: str) -> DataFrame:
    """As materialize, bucketed and sorted by ``key``: joins and groups on it leave this side where it is.

    There are as many buckets as shuffle partitions. The table's name is given
    up at once; its files and the frame stay.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, label)
    table = f"{label}_{uuid.uuid4().hex}".replace("-", "_")
    out = df.repartition(buckets, key).write.format("parquet").option("path", path)
    out.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    back = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return back


#: What a task is given of a table that is scanned for heavy work per byte; bytes as the planner sees them, compressed.
BYTES_PER_TASK = 4 * 1024 * 1024


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out evenly, for plans that are bound by the processor: two partitions a core, and as many more as its size asks for.

    Of a file each row group is read by one task, whatever its size in bytes, so
    a scan's own partitions can be few and large. The shuffle moves the input
    once, which is little beside the work.
    """
    return df.repartition(even_parts(df))


def even_parts(df: DataFrame) -> int:
    """Into how many partitions ``spread`` deals a table out."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(df.sparkSession.sparkContext.defaultParallelism * 2, -(-size // BYTES_PER_TASK))


def once(column: Column) -> Column:
    """``column``, told to the optimizer as not deterministic: a filter on it isn't moved below a shuffle, nor does it make the column twice."""
    return F.when(F.spark_partition_id() >= 0, column)


def small_side(df: DataFrame, rows: int, row_bytes: int, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast when ``rows * row_bytes`` is within ``limit``.

    Beyond it the join is left to the planner, which shuffles both sides.
    """
    return F.broadcast(df) if rows * row_bytes <= limit else df


class Shield:
    """Positional aliases for a frame's columns.

    User columns may clash with each other (``text`` and ``TEXT``), with names
    an operator adds, or hold dots. Inside an operator every column is called
    ``c0, c1, ...``; ``restore`` gives the caller's names back in order.
    A required column is found by exact name first, then ignoring case.
    """

    def __init__(self, df: DataFrame, *required: str):
        self.names = list(df.columns)
        self.aliases = [f"c{i}" for i in range(len(self.names))]
        self.df = df.toDF(*self.aliases)
        self._at = {}
        lowered = [n.lower() for n in self.names]
        for name in required:
            if name in self.names:
                self._at[name] = self.names.index(name)
            elif name.lower() in lowered:
                self._at[name] = lowered.index(name.lower())
            else:
                raise ValueError(f"the input has no column {name!r}; it has {self.names}")

    def __getitem__(self, name: str) -> Column:
        return F.col(self.aliases[self._at[name]])

    def alias(self, name: str) -> str:
        return self.aliases[self._at[name]]

    def restore(self, df: DataFrame) -> DataFrame:
        return df.select(*self.aliases).toDF(*self.names)


def schema_with(df: DataFrame, name: str, kind: str) -> StructType:
    """The frame's schema and one more column; the frame's own isn't touched."""
    return StructType([*df.schema.fields, StructType.fromDDL(f"`{name}` {kind}").fields[0]])


def map_rows(df: DataFrame, out: str, kind: str, make: Callable[[], Callable], *columns: str) -> DataFrame:
    """``df`` with a column made in Python from others, in Arrow batches.

    ``make`` runs once in each task and gives the function of a row's values, so
    that a model or a table is loaded there and not once a row.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        function = make()
        for rows in batches:
            yield rows.assign(**{out: [function(*values) for values in zip(*[rows[c] for c in columns])]})

    return df.mapInPandas(run, schema_with(df, out, kind))


def get_logger(level: str = "normal") -> logging.Logger:
    """The library's logger: ``quiet`` shows warnings, ``normal`` what is done, ``debug`` everything."""
    logger = logging.getLogger("sylvaframe")
    logger.setLevel({"quiet": logging.WARNING, "normal": logging.INFO, "debug": logging.DEBUG}[level])
    return logger


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly the named columns, whatever else the frame holds."""
    shield = Shield(df, *names)
    return shield.df.select(*[shield[n].alias(n) for n in names])
