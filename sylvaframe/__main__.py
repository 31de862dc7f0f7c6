"""Command line: process raw files into groups, merge groups, shard them.

    python -m sylvaframe process --dataset-type snli --input in.jsonl --out groups
    python -m sylvaframe merge --inputs part1 part2 --out all
    python -m sylvaframe shard --input all --out shards --shard-size 500
    python -m sylvaframe reshard --input documents --out shards
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import load_config
from .operators.prepare import filter_groups
from .operators.ranking import partition_of
from .operators.sharding import shard_counts, split_and_shard
from .plans.dataset import build_dataset, with_group_ids
from .plans.directory import process_directory
from .runtime import get_logger
from .sources.readers import READERS, number_lines, raw_lines, read_group_documents, read_pairs
from .sources.writers import merge_documents, reshard, shard_documents, write_groups, write_named, write_shards, write_text_shards
from .streaming.ingest import processed_ids


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sylvaframe")
    commands = top.add_subparsers(dest="command", required=True)
    p = commands.add_parser("process")
    p.add_argument("--dataset-type", required=True, choices=sorted(READERS))
    p.add_argument("--input", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--config", action="append", default=[])
    p.add_argument("--max-lines", type=int)
    p.add_argument("--partitions", type=int, help="folders part=0..n-1 of nearly equal size")
    p.add_argument("--resume", action="store_true", help="leave out the ids that --out already has and append")
    p.add_argument("--compat", action="store_true", help="drop the first line of each JSON-lines file")
    p.add_argument("--each-file", action="store_true", help="--input is a folder; one job a file, errors kept apart and reported")
    p.add_argument("--at-once", type=int, default=4, help="jobs at once with --each-file")
    p.add_argument("--verbosity", choices=("quiet", "normal", "debug"), default="normal")
    m = commands.add_parser("merge")
    m.add_argument("--inputs", nargs="+", required=True)
    m.add_argument("--out", required=True)
    s = commands.add_parser("shard")
    s.add_argument("--input", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--mode", choices=("groups", "text"), default="groups")
    s.add_argument("--config", action="append", default=[])
    s.add_argument("--shard-size", type=int)
    s.add_argument("--drop", nargs="*", default=[])
    s.add_argument("--rename", nargs="*", default=[], help="old=new")
    s.add_argument("--per-file", metavar="COLUMN", help="split each value of this column (the source file) on its own")
    s.add_argument("--documents", action="store_true", help="named JSON documents with header and counts beside them")
    s.add_argument("--source", default="groups", help="source_name in the documents")
    r = commands.add_parser("reshard", help="JSON documents of groups to shards numbered on from file to file")
    r.add_argument("--input", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--split", default="train")
    r.add_argument("--shard-size", type=int, default=500)
    r.add_argument("--source", default="groups")
    return top


def process(spark: SparkSession, args: argparse.Namespace) -> None:
    logger = get_logger(args.verbosity)
    config = load_config(*args.config)
    if args.each_file:
        report = process_directory(spark, args.dataset_type, args.input, args.out, config, args.at_once, max_lines=args.max_lines, compat=args.compat)
        failed = report.where("status = 'failed'").count()
        logger.info("%d files, %d failed", report.count(), failed)
        report.write.mode("append").json(f"{args.out}/_report")
        return
    pairs = with_group_ids(read_pairs(spark, args.dataset_type, args.input, max_lines=args.max_lines, compat=args.compat))
    done = processed_ids(spark, args.out) if args.resume else None
    groups = build_dataset(pairs, config, done)
    mode = "append" if args.resume else "error"
    if args.partitions:
        order = pairs.select("pair_id", "ordinal").groupBy("pair_id").agg(F.min("ordinal").alias("ordinal"))
        total = pairs.agg(F.coalesce(F.max("ordinal") + 1, F.lit(0)).alias("n")).first()["n"]
        placed = order.select(F.col("pair_id").alias("_id"), partition_of(F.col("ordinal"), F.lit(total), args.partitions).alias("part"))
        # every group has a pair's id, so none is lost
        groups = groups.join(placed, F.col("group_id") == F.col("_id"), "left").withColumn("part", F.coalesce("part", F.lit(0))).drop("_id")
        write_groups(groups, args.out, "part", mode=mode)
    else:
        write_groups(groups, args.out, mode=mode)
    logger.info("%d groups in %s", spark.read.parquet(args.out).count(), args.out)


def merge(spark: SparkSession, args: argparse.Namespace) -> None:
    write_groups(merge_documents([spark.read.parquet(p) for p in args.inputs]), args.out)


def shard(spark: SparkSession, args: argparse.Namespace) -> None:
    config = load_config(*args.config).sharding
    size = args.shard_size or config.shard_size
    if args.mode == "text":
        rows = number_lines(raw_lines(spark, args.input).where("trim(value) <> ''")).withColumnRenamed("ordinal", "line")
        write_text_shards(split_and_shard(rows, "line", ["src_file"], size, config.train, config.dev, config.seed), args.out)
        return
    groups = spark.read.parquet(args.input)
    kept = filter_groups(groups, config.min_trees, args.drop, dict(r.split("=", 1) for r in args.rename))
    key = kept.columns[0] if "group_id" not in kept.columns else "group_id"
    per_file = [args.per_file] if args.per_file else []
    sharded = split_and_shard(kept, key, per_file, size, config.train, config.dev, config.seed)
    if args.documents:
        stem = F.regexp_replace(F.element_at(F.split(F.col(args.per_file).cast("string"), "/"), -1), r"\.[^.]*$", "") if args.per_file else F.lit(args.source)
        write_named(shard_documents(sharded.withColumn("stem", stem), _uri(args.out), args.source)).count()
        return
    write_shards(sharded, f"{args.out}/shards", "parquet")
    if {"trees", "trees_b"} <= set(sharded.columns):
        shard_counts(sharded, *per_file, "split", "shard_index").write.parquet(f"{args.out}/counts")


def _uri(path: str) -> str:
    return path if "://" in path else "file://" + os.path.abspath(path)


def reshard_files(spark: SparkSession, args: argparse.Namespace) -> None:
    rows, _ = read_group_documents(spark, args.input)
    sharded = reshard(rows, args.shard_size).withColumn("split", F.lit(args.split))
    write_named(shard_documents(sharded.drop("src_file"), _uri(args.out), args.source)).count()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("sylvaframe").getOrCreate()
    {"process": process, "merge": merge, "shard": shard, "reshard": reshard_files}[args.command](spark, args)


if __name__ == "__main__":
    main()
