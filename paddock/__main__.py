"""Command line for the two jobs.

    python -m paddock full-load --raw RAW --root ROOT [--source NAME] [--top-n 10]
    python -m paddock incremental --raw RAW --root ROOT --dates 2021-03-21 2021-03-28 ...
        [--buckets 8] [--feeds results ...] [--processed-db DB] [--presentation-db DB]

The session comes from ``SparkSession.builder.getOrCreate()``, so cluster
settings (master, shuffle partitions, checkpoint folder) are taken from
spark-submit / spark-defaults.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from paddock.plans.ingest import DEFAULT_BUCKETS


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="paddock")
    sub = ap.add_subparsers(dest="job", required=True)
    for name in ("full-load", "incremental"):
        p = sub.add_parser(name)
        p.add_argument("--raw", required=True, help="raw root (delivery folders for incremental)")
        p.add_argument("--root", required=True, help="output root (processed/, presentation/)")
        p.add_argument("--source", default="", help="data_source value stamped on rows")
        p.add_argument("--top-n", type=int, default=10)
        p.add_argument("--processed-db")
        p.add_argument("--presentation-db")
        if name == "incremental":
            p.add_argument("--dates", nargs="+", required=True)
            p.add_argument("--buckets", type=int, default=DEFAULT_BUCKETS)
            p.add_argument("--feeds", nargs="+", help="feeds to load (default: all eight)")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"paddock-{args.job}").getOrCreate()
    if args.job == "full-load":
        from paddock.plans.presentation import run_full_load
        layers = run_full_load(spark, args.raw, args.root, args.source, top_n=args.top_n,
                               processed_db=args.processed_db,
                               presentation_db=args.presentation_db)
    else:
        from paddock.plans.incremental import run_history
        from paddock.plans.ingest import INGEST_ORDER
        layers = run_history(spark, args.raw, args.root, args.dates, args.source,
                             top_n=args.top_n, feeds=args.feeds or INGEST_ORDER,
                             processed_db=args.processed_db,
                             presentation_db=args.presentation_db, buckets=args.buckets)
    print(json.dumps(layers))


if __name__ == "__main__":
    main()
