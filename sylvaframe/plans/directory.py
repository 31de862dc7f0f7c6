"""Runs over the files of a directory, one job a file, errors kept apart.

One job over all files is faster; this is for inputs of which some may be
broken. Several jobs run at once. A file's groups go to a folder of their own;
``_SUCCESS`` there says that it is done, so a run that is taken up again leaves
it alone and writes the unfinished ones anew.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..config import Config
from ..runtime import get_logger
from ..sources.readers import GLOBS, read_pairs
from ..sources.writers import write_groups
from .dataset import build_dataset

REPORT = "file string, status string, error string"


def _system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def input_files(spark: SparkSession, dataset_type: str, folder: str) -> list[str]:
    """The files of a folder that the dataset type reads, by name; their number is that of the jobs, so it is small."""
    pattern, system = _system(spark, f"{folder.rstrip('/')}/{GLOBS.get(dataset_type, '*')}")
    found = system.globStatus(pattern)
    return sorted(s.getPath().toString() for s in found if s.isFile() and not s.getPath().getName().startswith(("_", ".")))


def process_directory(spark: SparkSession, dataset_type: str, folder: str, out: str, config: Config = Config(), at_once: int = 4, **options) -> DataFrame:
    """(file, status, error): done, skipped (done before) or failed. Groups lie in ``out``/file=<name>."""
    logger = get_logger()

    def one(file: str) -> tuple[str, str, str | None]:
        name = file.rsplit("/", 1)[-1]
        target = f"{out}/file={name}"
        mark, system = _system(spark, f"{target}/_SUCCESS")
        if system.exists(mark):
            return name, "skipped", None
        try:
            write_groups(build_dataset(read_pairs(spark, dataset_type, file, **options), config), target, mode="overwrite")
        except Exception as error:  # noqa: BLE001  (one bad file must not stop the others; it is reported)
            logger.error("%s: %s", name, error)
            partial, system = _system(spark, target)
            system.delete(partial, True)
            return name, "failed", str(error).splitlines()[0][:500]
        logger.info("%s: done", name)
        return name, "done", None

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        rows = list(pool.map(one, input_files(spark, dataset_type, folder)))
    return spark.createDataFrame(rows, REPORT)
