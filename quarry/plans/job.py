"""spark-submit entry: analyse one table, or two and compare them.

    spark-submit quarry/plans/job.py --data a.csv [--data2 b.parquet] [--target y] [--target2 y2]
        [--output out] [--discretize quantile|uniform|median|mean] [--n_bins 3]

CSV input goes through separator / encoding detection and type inference;
``.parquet`` paths (or folders) are read as they are.  Results land in
``<output>/dataset_1``, ``dataset_2`` and ``comparison`` (one Parquet table
per result), and the listing is printed.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402

from quarry.plans.run import RunParams, run_and_write  # noqa: E402
from quarry.session import shared_dir, ship_package  # noqa: E402
from quarry.sources.csv import load_csv, nan_to_null  # noqa: E402


def read_any(spark: SparkSession, path: str):
    """Parquet if Spark's reader finds Parquet there (whatever the file system), else CSV."""
    try:
        df = spark.read.parquet(path)
    except Exception:  # noqa: BLE001 - not Parquet: the CSV reader reports what is wrong
        return load_csv(spark, path)
    return nan_to_null(df)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="Data-mining run of one or two tables")
    ap.add_argument("--data", required=True)
    ap.add_argument("--data2")
    ap.add_argument("--target")
    ap.add_argument("--target2")
    ap.add_argument("--output", default="output")
    ap.add_argument("--discretize", default="quantile", choices=["quantile", "uniform", "median", "mean", "manual"])
    ap.add_argument("--n_bins", type=int, default=3)
    ap.add_argument("--n_init", type=int, default=10, help="K-means starts per k")
    ap.add_argument("--num_trees", type=int, default=200)
    ap.add_argument("--cuts", type=float, nargs="*", help="bin edges for --discretize manual")
    ap.add_argument("--work", help="shared folder that keeps the run's stages; the same command goes on after a loss")
    args = ap.parse_args(argv)

    # checkpoints go when the driver lets go of them
    spark = (SparkSession.builder.appName("quarry").config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
             .getOrCreate())
    shared_dir(spark)
    ship_package(spark)
    tables = [(os.path.splitext(os.path.basename(args.data.rstrip("/")))[0], read_any(spark, args.data), args.target)]
    if args.data2:
        tables.append((os.path.splitext(os.path.basename(args.data2.rstrip("/")))[0],
                       read_any(spark, args.data2), args.target2))
    params = [RunParams(target=t, method=args.discretize, n_bins=args.n_bins, cuts=args.cuts, n_init=args.n_init,
                        num_trees=args.num_trees) for _, _, t in tables]
    listing = run_and_write([(n, d) for n, d, _ in tables], args.output, params, work=args.work)
    listing.show(200, truncate=False)


if __name__ == "__main__":
    main()
