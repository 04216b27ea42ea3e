"""Command line: build the tables, run the checks, write the profile.

    python -m dimloom --sources DIR --out DIR [--as-of YYYY-MM-DD]
    python -m dimloom --benchmark-dir DIR --out DIR      (sources mapped from the benchmark tables)
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from .plans.build import build, catalog, check
from .session import ensure_checkpoint_dir, tune
from .sources import load_parquet
from .sources.adapters import sources_from_driver
from .sources.sinks import read_table, write_table


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="dimloom")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--sources", help="folder with one parquet folder per source table")
    src.add_argument("--benchmark-dir", help="folder with the benchmark parquet files")
    ap.add_argument("--out", required=True)
    ap.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    args = ap.parse_args(argv)

    spark = tune(SparkSession.builder.appName("dimloom").getOrCreate())
    ensure_checkpoint_dir(spark)
    T = load_parquet(spark, args.sources) if args.sources else sources_from_driver(spark, args.benchmark_dir)
    models = build(spark, T, args.out, args.as_of)
    checks = check(T, models)
    write_table(checks, f"{args.out.rstrip('/')}/_checks")
    write_table(catalog(T, models), f"{args.out.rstrip('/')}/_catalog")
    failed = read_table(spark, f"{args.out.rstrip('/')}/_checks").where("failures > 0").count()
    print(f"built {len(models)} tables; {failed} of 21 checks failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
