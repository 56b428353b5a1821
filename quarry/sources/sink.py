"""Result sinks: every result table of a run, keyed by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_results(spark: SparkSession, tables: dict[str, DataFrame], out_dir: str,
                  fmt: str = "parquet") -> DataFrame:
    """Write each result table under ``out_dir/<name>`` (overwrite) and list them.

    Result tables are small summaries (metrics, matrices, audits); the
    row-level outputs (split, clusters) are written the same way, partitioned
    by Spark.  Returns ``table, path, rows``.
    """
    listing = []
    for name, df in tables.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        w = df.write.mode("overwrite")
        if fmt == "csv":
            w.option("header", True).csv(path)
        else:
            w.parquet(path)
        n = spark.read.format(fmt).option("header", True).load(path).count()
        listing.append((name, path, int(n)))
    return spark.createDataFrame(listing, "table string, path string, rows bigint")
