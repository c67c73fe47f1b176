"""Command line for scheduled runs (``spark-submit -m`` style):

    python -m ludolake build   --raw <export> --root <warehouse>
    python -m ludolake append  --raw <export> --root <warehouse>
    python -m ludolake refresh --raw <export> --root <warehouse> --lookback 30 [--since 2024-01-20] [--metrics cohort]
    python -m ludolake sync    --raw <export> --root <warehouse> [--max-rejects 1000]
    python -m ludolake vacuum  --raw <export> --root <warehouse>

``build`` overwrites the flat layer and every metric table; ``append`` adds
the days after each table's high-water mark; ``refresh`` recomputes the
last N days of the metric tables in place, counted from ``--since``, the first
day loaded since the last refresh (without it, from each table's latest day).
``sync`` keeps a versioned warehouse (a root of its own): it finds the raw days
that have changed, recomputes what depends on them and publishes all tables
together; ``vacuum`` removes what no version holds any more.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from .plans import refresh as R
from .plans import versions as V
from .session import configure
from .sources.tables import read_raw_table


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="ludolake")
    ap.add_argument("job", choices=["build", "append", "refresh", "sync", "vacuum"])
    ap.add_argument("--bootstrap", action="store_true",
                    help="append: load event kinds and tables that have no rows yet in full")
    ap.add_argument("--raw", required=True, help="raw export path (partitioned by date_par)")
    ap.add_argument("--root", required=True, help="warehouse root (shared file system)")
    ap.add_argument("--metrics", nargs="*", default=None)
    ap.add_argument("--lookback", type=int, default=30)
    ap.add_argument("--since", type=dt.date.fromisoformat, default=None,
                    help="refresh: first day loaded since the last refresh (needed after a gap)")
    ap.add_argument("--lenient", action="store_true",
                    help="take the first of duplicated parameter keys instead of failing")
    ap.add_argument("--max-rejects", type=int, default=0,
                    help="sync: rows with duplicated parameter keys that are set aside before the job fails")
    ap.add_argument("--rows-per-file", type=int, default=None,
                    help="sync: lay files out by ranges of the cluster keys, with this many rows each")
    args = ap.parse_args(argv)

    spark = configure(SparkSession.builder.appName(f"ludolake-{args.job}").getOrCreate())
    raw = read_raw_table(spark, args.raw)
    strict = not args.lenient
    if args.job == "build":
        R.build_flat(spark, raw, args.root, strict=strict)
        R.build_metrics(spark, args.root, args.metrics, raw=raw)
    elif args.job == "append":
        skipped = R.append_flat(spark, raw, args.root, strict=strict, bootstrap=args.bootstrap)
        if skipped:
            print("not loaded before, so not appended (--bootstrap loads them):", ", ".join(skipped))
        R.append_metrics(spark, args.root, args.metrics, raw=raw, bootstrap=args.bootstrap)
    elif args.job == "sync":
        V.sync(spark, raw, args.root, args.metrics, raw_path=args.raw, max_rejects=args.max_rejects,
               rows_per_file=args.rows_per_file)
    elif args.job == "vacuum":
        V.vacuum(spark, args.root)
    else:
        R.refresh_metrics(spark, args.root, args.lookback, args.metrics, raw=raw, since=args.since)


if __name__ == "__main__":
    main()
