"""Sinks: grouped datasets, JSON documents, shards with counts."""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sharding import shard_file_name
from ..runtime import scratch_path, short_row_groups
from ..schemas import DOCUMENT_VERSION


def header(requires_word_embeddings: bool = True) -> dict[str, object]:
    return {"version": DOCUMENT_VERSION, "format": "infonce", "requires_word_embeddings": requires_word_embeddings}


def write_groups(groups: DataFrame, path: str, parts: str | None = None, fmt: str = "parquet", mode: str = "error") -> None:
    """One row a group. With ``parts`` (a column) there is a folder for each part."""
    out = short_row_groups(groups.write).format(fmt).mode(mode)
    (out.partitionBy(parts) if parts else out).save(path)


def write_documents(groups: DataFrame, path: str, part: str, order: str, requires_word_embeddings: bool = True, mode: str = "error") -> None:
    """A JSON document with header for each value of ``part``: a text file with one line each.

    A document is one task's memory, so parts are to be sized accordingly.
    """
    names = [c for c in groups.columns if c not in (part, order)]
    gathered = groups.groupBy(part).agg(F.array_sort(F.collect_list(F.struct(order, *names))).alias("g"))
    head = [F.lit(v).alias(k) for k, v in header(requires_word_embeddings).items()]
    bare = F.transform("g", lambda g: F.struct(*[g[n].alias(n) for n in names]))
    gathered.select(part, F.to_json(F.struct(*head, bare.alias("groups"))).alias("value")).write.mode(mode).partitionBy(part).text(path)


def document_of(key: Column, rows: int, parts: int, size: int = 200) -> Column:
    """The number of the document, within its part, that takes a row: by a hash, of as many as hold ``size`` rows on average."""
    return F.pmod(F.xxhash64(key), F.lit(max(1, -(-rows // (parts * size)))))


def write_part_documents(groups: DataFrame, path: str, part: str, document: str, order: str, requires_word_embeddings: bool = True, mode: str = "error", compression: str = "none") -> None:
    """As write_documents, for parts of any size: several JSON documents a part, each whole with its header, in a folder of its own.

    ``document`` (a column) says which one of its part takes a group; a document
    is one reader's memory. A group is a line of its file, so a task that writes
    sorts and passes on single groups.
    """
    names = [c for c in groups.columns if c not in (part, document, order)]
    lines = groups.select(part, document, order, F.to_json(F.struct(*names)).alias("value")).repartition(part, document)
    ahead = Window.partitionBy(part, document).orderBy(order)
    placed = lines.withColumns({"_first": F.row_number().over(ahead) == 1, "_next": F.lead(F.lit(True)).over(ahead)})
    opened = F.lit(json.dumps(header(requires_word_embeddings))[:-1] + ', "groups": [\n')
    value = F.concat(F.when(F.col("_first"), opened).otherwise(F.lit("")), "value", F.when(F.col("_next"), F.lit(",")).otherwise(F.lit("\n]}")))
    placed.select(part, document, value.alias("value")).write.mode(mode).partitionBy(part, document).option("compression", compression).text(path)


def merge_documents(frames: list[DataFrame]) -> DataFrame:
    """Rows of several groups tables, those of the old shape (``graph_pairs`` with ``labels``) included."""
    out = None
    for df in frames:
        if "graph_pairs" in df.columns:
            pairs = F.arrays_zip(F.col("graph_pairs").alias("p"), F.col("labels").alias("l"))
            df = df.select(F.explode(pairs).alias("x")).select(F.col("x.p").alias("pair"), F.col("x.l").cast("string").alias("label"))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def _by_shard(sharded: DataFrame) -> DataFrame:
    """Each shard in one task, in ``ordinal`` order. The number of tasks is given, as making files takes far longer than their bytes tell adaptive execution."""
    spark = sharded.sparkSession
    parts = max(spark.sparkContext.defaultParallelism * 2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return sharded.repartition(parts, "split", "shard_index").sortWithinPartitions("split", "shard_index", "ordinal")


def write_shards(sharded: DataFrame, path: str, fmt: str = "json", mode: str = "error") -> None:
    """Folders split=/shard_index= below ``path``; every shard's rows are brought to one task, in ``ordinal`` order."""
    rows = _by_shard(sharded)
    rows.write.mode(mode).partitionBy("split", "shard_index").format(fmt).save(path)


def write_text_shards(sharded: DataFrame, path: str, mode: str = "error") -> None:
    rows = _by_shard(sharded)
    rows.select("split", "shard_index", "value").write.mode(mode).partitionBy("split", "shard_index").text(path)


def write_named(files: DataFrame) -> DataFrame:
    """Writes each (path, value) row to a file of that very name, and gives the paths.

    A task that is run again writes the same bytes under the same names. A file
    is moved to its name once it is whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        from pyarrow import fs

        for rows in batches:
            for path, value in zip(rows["path"], rows["value"]):
                system, name = fs.FileSystem.from_uri(path)
                folder, _, last = name.rpartition("/")
                system.create_dir(folder, recursive=True)
                part = f"{folder}/.{last}.{uuid.uuid4().hex}"
                with system.open_output_stream(part) as out:
                    out.write(value.encode())
                system.move(part, name)
            yield rows[["path"]]

    return files.select("path", "value").mapInPandas(run, "path string")


def write_lines(lines: DataFrame, folder: str, parts: int) -> None:
    """Text files of any size: ``lines`` has file (a path below ``folder``), order and value; a file's lines stand in their order.

    Many tasks write pieces, cut by file and order; then one task a file joins
    its pieces, whose bytes it only passes on, so no file is in memory as a whole.
    """
    spark = lines.sparkSession
    pieces = scratch_path(spark, "pieces")
    cut = lines.select(F.col("file").alias("_file"), "order", "value").repartitionByRange(parts, "_file", "order").sortWithinPartitions("_file", "order")
    cut.select("_file", "value").write.partitionBy("_file").option("compression", "none").text(pieces)
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pieces)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rows = []
    for d in system.listStatus(root):
        name = d.getPath().getName()
        if d.isDirectory() and name.startswith("_file="):
            # pieces are named by their task's number, which grows with the order
            found = sorted(_uri(f.getPath().toString()) for f in system.listStatus(d.getPath()))
            rows.append((_uri(f"{folder.rstrip('/')}/{unquote(name[len('_file=') :])}"), found))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for path, found in zip(files["path"], files["pieces"]):
                _joined(path, list(found))
            yield files[["path"]]

    made = spark.createDataFrame(rows, "path string, pieces array<string>").repartition(max(1, len(rows)))
    made.mapInPandas(run, "path string").count()
    system.delete(root, True)


def _uri(path: str) -> str:
    """A Hadoop path, which escapes nothing, as a URI."""
    whole = "file://" + path[len("file:") :] if path.startswith("file:/") and not path.startswith("file://") else path
    return quote(whole, safe="/:@")


def _joined(path: str, pieces: list[str]) -> None:
    """The bytes of ``pieces``, one after the other, as a file, which gets its name once it is whole."""
    import uuid

    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path)
    folder, _, last = name.rpartition("/")
    system.create_dir(folder, recursive=True)
    part = f"{folder}/.{last}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        for piece in pieces:
            source, at = fs.FileSystem.from_uri(piece)
            with source.open_input_stream(at) as given:
                while chunk := given.read(1 << 22):
                    out.write(chunk)
    system.move(part, name)


def _sizes(name: str) -> Column:
    return F.transform("g", lambda g: F.size(g[name]))


def shard_documents(sharded: DataFrame, path: str, source: str, stem: str = "stem", part: str | None = None) -> DataFrame:
    """(path, value) of the JSON document of each shard and of its counts.

    ``sharded`` has split, shard_index, ordinal and ``stem``, the source file's
    name without its ending; the other columns make up a group. A document has
    the header, the groups in order and a shard_info; the counts lie beside it.
    A shard is one task's memory, which its size bounds.
    """
    names = [c for c in sharded.columns if c not in ("split", "shard_index", "ordinal", stem, part)]
    keys = ["split", stem, "shard_index"]
    gathered = sharded.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("ordinal", *names))).alias("g"))
    bare = F.transform("g", lambda g: F.struct(*[g[n].alias(n) for n in names]))
    info = F.struct(F.col("shard_index"), F.size("g").alias("groups_in_shard"), F.lit(source).alias("source_name"), F.concat(F.col(stem), F.lit(".json")).alias("source_file"))
    document = F.struct(*[F.lit(v).alias(k) for k, v in header().items()], bare.alias("groups"), info.alias("shard_info"))
    sizes = [_sizes(n).alias(f"{n}_per_group") for n in ("trees", "trees_b") if n in names]
    counts = F.struct(F.size("g").alias("n_groups"), *sizes)
    file = lambda c: F.concat(F.lit(path.rstrip("/") + "/"), "split", F.lit("/"), shard_file_name(F.col(stem), F.col("shard_index"), c))
    both = F.array(F.struct(file(False).alias("path"), F.to_json(document).alias("value")), F.struct(file(True).alias("path"), F.to_json(counts).alias("value")))
    return gathered.select(F.inline(both))


def reshard(rows: DataFrame, shard_size: int) -> DataFrame:
    """``rows`` of many files (src_file, ordinal in it) with split, stem and a shard_index that goes on from file to file.

    Files stand in the order of their names; none shares a shard with another.
    What moves between tasks for the numbers is one line a file.
    """
    shards = rows.groupBy(F.col("src_file").alias("_file")).agg(F.ceil((F.max("ordinal") + 1) / F.lit(shard_size)).alias("_shards"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.select("_file", F.coalesce(F.sum("_shards").over(before), F.lit(0)).alias("_start"))
    stem = F.regexp_replace(F.element_at(F.split("src_file", "/"), -1), r"\.[^.]*$", "")
    out = rows.join(placed, F.col("src_file") == F.col("_file"))
    return out.withColumns({"stem": stem, "shard_index": (F.col("_start") + F.floor(F.col("ordinal") / F.lit(shard_size))).cast("long")}).drop("_file", "_start")
