"""Command line: ``python -m twinsift <records|sources|files> ...`` (or the
same module through ``spark-submit``). The session comes from the
environment: spark-submit's settings on a cluster, a local one otherwise.
Each command prints its report as JSON lines."""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

from twinsift.plans.jobs import run_file_job, run_job, run_sources_job
from twinsift.plans.methods import METHODS, PAIR_METHODS, similar_values
from twinsift.sources.tables import read_table


def _session(master: str | None) -> SparkSession:
    """``--master`` when given; under spark-submit its own master; plain
    ``python -m twinsift`` runs locally."""
    builder = SparkSession.builder.appName("twinsift")
    if master:
        builder = builder.master(master)
    elif "PYSPARK_GATEWAY_PORT" not in os.environ:  # not launched by spark-submit
        builder = builder.master("local[*]")
    return builder.getOrCreate()


def _print(df) -> None:
    for row in df.toLocalIterator():
        print(json.dumps(row.asDict(), default=str))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="twinsift", description="Find and remove duplicate data with Spark.")
    parser.add_argument("--master", help="Spark master (default: spark-submit's, else local[*])")
    sub = parser.add_subparsers(dest="command", required=True)

    rec = sub.add_parser("records", help="deduplicate one table and write deduplicated_<name>.parquet")
    rec.add_argument("input")
    rec.add_argument("--output", required=True, help="output folder")
    rec.add_argument("--method", default="exact", choices=METHODS)
    rec.add_argument("--schema", help="DDL schema for CSV input (inferred when absent)")
    rec.add_argument("--tune", action="store_true", help="size shuffle partitions from the input bytes")
    rec.add_argument("--keys", default="name,email", help="key columns (comma-separated)")
    rec.add_argument("--hash-columns", default="name,email,address", help="columns of the hash methods")
    rec.add_argument("--order-by", default="id", help="survivor order for the window method")
    rec.add_argument("--resolve", action="store_true", help="fuzzy methods: merge clusters of similar records")
    rec.add_argument("--similar", type=int, default=0, metavar="N", help="fuzzy methods: also print N similar values")

    src = sub.add_parser("sources", help="per-file duplicate report over many CSV files, in one job")
    src.add_argument("paths", nargs="+")
    src.add_argument("--schema", required=True)
    src.add_argument("--keys", default="name,email")
    src.add_argument("--output", help="write the survivors here, partitioned by source file")
    src.add_argument("--method", default="exact", choices=METHODS)
    src.add_argument("--all-files", action="store_true", help="take files named deduplicated_* too")

    fil = sub.add_parser("files", help="deduplicate files by content hash")
    fil.add_argument("path")
    fil.add_argument("--output", help="write the unique files list here")
    fil.add_argument("--hash", default="md5", choices=["md5", "sha256"])
    fil.add_argument("--glob", help="base-name filter, e.g. '*.{jpg,png}'")

    args = parser.parse_args(argv)
    spark = _session(args.master)
    if args.command == "records":
        keys = args.keys.split(",")
        path, report = run_job(
            spark, args.input, args.output, args.method, schema=args.schema, validate_keys=keys, tune=args.tune,
            keys=keys, hash_columns=args.hash_columns.split(","), order_by=args.order_by.split(","), resolve=args.resolve,
        )
        print(json.dumps({"output": path}))
        if args.similar and args.method in PAIR_METHODS:
            found = similar_values(read_table(spark, args.input, schema=args.schema), args.method, keys)
            _print(found.orderBy("column_name", "representative", "value").limit(args.similar))
        _print(report)
    elif args.command == "sources":
        _print(run_sources_job(
            spark, args.paths, args.schema, keys=args.keys.split(","), output_dir=args.output, method=args.method,
            skip_prefix=None if args.all_files else "deduplicated_",
        ))
    else:
        out = run_file_job(spark, args.path, args.output, hash_type=args.hash, glob=args.glob)
        _print(out["report"])
    return 0


if __name__ == "__main__":
    sys.exit(main())
