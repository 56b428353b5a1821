"""Profiling: shape, nulls, class counts, numeric description, histogram, box plot data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import order_stats
from quarry.operators.distinct import distinct_values
from quarry.operators.schema import q


def shape(df: DataFrame) -> DataFrame:
    """Rows x columns."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("n_rows"),
                  F.lit(len(df.columns)).cast("long").alias("n_cols"))


def null_counts(df: DataFrame) -> DataFrame:
    """Columns that have NULLs, with their count (one aggregate)."""
    cols = df.columns
    row = df.agg(*[F.count_if(q(c).isNull()).alias(f"z{i}") for i, c in enumerate(cols)])
    stack = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("column"),
                               F.col(f"z{i}").cast("long").alias("nulls")) for i, c in enumerate(cols)])
    return row.select(F.explode(stack).alias("s")).select("s.*").where(F.col("nulls") > 0)


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Class counts, NULLs excluded (order for display: ``n`` desc, then ``class``)."""
    counts = df.where(q(target).isNotNull()).groupBy(q(target).alias("class")).agg(
        F.count(F.lit(1)).alias("n"))
    return counts


def long_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value) pairs of the numeric columns, as doubles."""
    stack = F.array(*[F.struct(F.lit(c).alias("column"), q(c).cast("double").alias("value"))
                      for c in cols])
    return df.select(F.explode(stack).alias("s")).select("s.column", "s.value")


def describe_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75% (linear, exact), max per numeric column."""
    long = long_numeric(df, cols)
    basic = long.groupBy("column").agg(
        F.count("value").cast("long").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    qs = order_stats.quantiles(long, "value", [0.25, 0.5, 0.75], ["column"])
    wide = qs.groupBy("column").pivot("p", [0, 1, 2]).agg(F.first("q"))
    wide = wide.select("column", F.col("0").alias("p25"), F.col("1").alias("p50"),
                       F.col("2").alias("p75"))
    return basic.join(wide, "column", "left")


def distinct_counts(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """P5: number of distinct non-null values per column."""
    if not approx:
        names = F.array(*[F.lit(c) for c in cols])
        return distinct_values(df, [q(c) for c in cols]).select(F.get(names, F.col("pos")).alias("column"), "n_distinct")
    row = df.agg(*[F.approx_count_distinct(q(c)).alias(f"d{i}") for i, c in enumerate(cols)])
    stack = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"d{i}").cast("long").alias("n_distinct"))
                      for i, c in enumerate(cols)])
    return row.select(F.explode(stack).alias("s")).select("s.*")


def row_hash(key_cols: list[str], seed: int = 42):
    """md5 of the key columns and the seed: a stable, engine-independent row order."""
    parts = [F.coalesce(q(c).cast("string"), F.lit("\\N")) for c in key_cols] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *parts))


def sample_rows(df: DataFrame, n: int = 10, key_cols: list[str] | None = None,
                seed: int = 42) -> DataFrame:
    """N rows in hash order (deterministic; plans as a top-n, no global sort)."""
    keys = key_cols or df.columns
    return df.withColumn("_h", row_hash(keys, seed)).orderBy("_h").limit(n).drop("_h")


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over min..max; the maximum falls in the last bin."""
    x = q(col).cast("double")
    mn, mx = df.agg(F.min(x), F.max(x)).first()
    if mn is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint")
    width = (mx - mn) / bins
    b = F.least(F.floor((x - F.lit(mn)) / F.lit(width)), F.lit(bins - 1)) if mx > mn else F.lit(0)
    counts = df.where(x.isNotNull()).groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("bin", (F.lit(mn) + F.col("bin") * F.lit(width)).alias("lo"),
                         (F.lit(mn) + (F.col("bin") + 1) * F.lit(width)).alias("hi"), "n")


def boxplot_by_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """Five-number summary per group with 1.5 IQR whiskers at real points and outlier count."""
    base = df.select(q(group).alias("grp"), q(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    qs = order_stats.quantiles(base, "v", [0.25, 0.5, 0.75], ["grp"])
    wide = (qs.groupBy("grp").pivot("p", [0, 1, 2]).agg(F.first("q"))
            .select("grp", F.col("0").alias("q1"), F.col("1").alias("median"), F.col("2").alias("q3")))
    wide = wide.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    # one row per group, frozen: broadcast when its row count allows
    stats = order_stats.join_small(base, order_stats.freeze(wide), ["grp"]).groupBy("grp", "q1", "median", "q3", "iqr").agg(
        F.min(F.when(F.col("v") >= lo_f, F.col("v"))).alias("whisker_lo"),
        F.max(F.when(F.col("v") <= hi_f, F.col("v"))).alias("whisker_hi"),
        F.count_if((F.col("v") < lo_f) | (F.col("v") > hi_f)).cast("long").alias("n_outliers"),
        F.count(F.lit(1)).cast("long").alias("n"))
    return stats


def class_proportion(df: DataFrame, target: str, split_col: str = "split") -> DataFrame:
    """Share of class 1 of a 0/1 target and size per split, plus the whole table ('all')."""
    y = q(target).cast("double")
    per = df.groupBy(q(split_col).alias("split")).agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean_y"))
    total = df.agg(F.lit("all").alias("split"), F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean_y"))
    allrows = per.unionByName(total)
    tot = F.sum(F.when(F.col("split") != "all", F.col("n"))).over(Window.partitionBy())
    return allrows.select("split", F.col("n").cast("long").alias("n"),
                          (F.col("n") * 100.0 / tot).alias("pct"), "mean_y")
