"""Command line: ``python -m tasteforge {bronze,compact,worklist,silver,gold,train,recommend} --base-path ...``."""

from __future__ import annotations

import argparse
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from tasteforge.plans.bronze import run_bronze
from tasteforge.plans.gold import run_gold
from tasteforge.plans.serve import run_recommend, run_recommend_batch
from tasteforge.plans.silver import run_compaction, run_rewrite, run_silver
from tasteforge.plans.train import run_training
from tasteforge.plans.worklists import run_worklists
from tasteforge.session import build_session, input_bytes, scoped_intermediates, shuffle_partitions

# What a job shuffles is about as large as the folders it reads.
INPUTS = {
    "bronze": ["payloads"], "compact": ["raw"], "worklist": ["raw", "payloads"], "silver": ["raw"], "gold": ["silver"], "train": ["gold"],
    "recommend": ["gold", "models"],
}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tasteforge")
    parser.add_argument("job", choices=list(INPUTS))
    parser.add_argument("--base-path", required=True, help="storage root: a folder or any Hadoop URI")
    parser.add_argument("--layout", choices=["dated", "hive"], default="dated", help="layout of landed documents")
    parser.add_argument("--day", help="day whose profiles the work lists read (YYYY-MM-DD, UTC; default today), or that is compacted (default all)")
    parser.add_argument("--run-id", help="model bundle to write or to serve from")
    parser.add_argument("--user", action="append", default=[], help="user to recommend for; repeatable")
    parser.add_argument("--users", help="Parquet table of users (steam_id) to recommend for, with --out")
    parser.add_argument("--out", help="folder for the lists of --users, or storage root for the packed documents of compact")
    parser.add_argument("--top", type=int, default=5, help="items per user")
    parser.add_argument("--shuffle-gb", type=float, help="shuffle volume to size partitions for; default: the job's input")
    args = parser.parse_args(argv)
    if args.job == "compact":
        if bool(args.out) != (args.layout == "dated"):
            parser.error("compact packs the dated layout into --out, and rewrites the hive layout in place")
    elif bool(args.users) != bool(args.out):
        parser.error("--users and --out go together")
    return args


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    base = args.base_path
    if args.job == "bronze":
        print("documents:", ", ".join(run_bronze(spark, base)) or "no payloads landed")
    elif args.job == "compact":
        done = run_compaction(spark, base, args.out, args.day) if args.out else run_rewrite(spark, base, args.day)
        print("documents:", ", ".join(done) or "nothing landed")
    elif args.job == "worklist":
        for name, path in run_worklists(spark, base, args.day or f"{datetime.now(UTC):%Y-%m-%d}", args.layout).items():
            print(f"{name}: {path}")
    elif args.job == "silver":
        for table, written in run_silver(spark, base, args.layout).items():
            print(f"{table}: {written or 'no landed documents, skipped'}")
    elif args.job == "gold":
        run_gold(spark, base).matrix.show(10)
    elif args.job == "train":
        bundle = run_training(spark, base, args.run_id)
        print(f"run {bundle.run_id}: hold-out RMSE {bundle.rmse}")
    elif args.users:
        print("\n".join(run_recommend_batch(spark, base, args.users, args.out, args.top, args.run_id)))
    else:
        lists, unserved = run_recommend(spark, base, args.user, args.top, args.run_id)
        lists.show(args.top * max(1, len(args.user)), truncate=False)
        unserved.show(max(1, len(args.user)), truncate=False)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session(f"tasteforge-{args.job}")
    if args.shuffle_gb is not None:
        volume = int(args.shuffle_gb * 2**30)
    else:
        volume = input_bytes(spark, *[f"{args.base_path.rstrip('/')}/{folder}" for folder in INPUTS[args.job]])
    spark.conf.set("spark.sql.shuffle.partitions", shuffle_partitions(volume, spark.sparkContext.defaultParallelism))
    with scoped_intermediates(spark):
        _run(spark, args)


if __name__ == "__main__":
    main()
