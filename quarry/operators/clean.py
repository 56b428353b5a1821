"""Cleaning: trim, null markers, number text, exact duplicates, and the audit of it all.

The whole cleaning is two passes over the table: one aggregate that decides
everything (marker counts, parse rates), and one projection followed by the
duplicate-dropping aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import clean_text, number_core, number_finish, strip
from quarry.operators.schema import q

def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]


def parsed(df: DataFrame, cols: list[str], keep: bool = True) -> DataFrame:
    """Add ``__num_<i>`` = the parsed number of ``cols[i]``, in two staged projections.

    The first projection computes the cleaned candidate text once per
    column, the second reads the number from it; Catalyst keeps the stages
    apart (the candidate is used several times), so the generated code stays
    small and every regex runs once per value.
    """
    base = [q(c) for c in df.columns] if keep else []
    staged = df.select(*base, *[number_core(q(c)).alias(f"__core_{i}") for i, c in enumerate(cols)])
    return staged.select(*base, *[number_finish(F.col(f"__core_{i}")).alias(f"__num_{i}")
                                  for i in range(len(cols))])


def trim_strings(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Strip every text column."""
    cols = text_columns(df) if cols is None else cols
    return df.select(*[strip(q(c)).alias(c) if c in cols else q(c) for c in df.columns])


def null_markers(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Trimmed text equal to a null marker becomes NULL."""
    cols = text_columns(df) if cols is None else cols
    return df.select(*[clean_text(q(c)).alias(c) if c in cols else q(c) for c in df.columns])


def null_marker_audit(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per text column, NULLs before and after trimming + markers.

    ``nulls_total`` is what the reference reports (its text conversion turns
    real NULLs into a marker first, so they are counted too);
    ``markers_replaced`` counts only the markers.
    """
    cols = text_columns(df) if cols is None else cols
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count_if(q(c).isNull()).alias(f"b{i}"),
                 F.count_if(clean_text(q(c)).isNull()).alias(f"a{i}")]
    row = df.agg(*aggs)
    stack = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("column"),
                               F.col(f"b{i}").alias("nulls_before"), F.col(f"a{i}").alias("nulls_total"))
                      for i, c in enumerate(cols)])
    return (row.select(F.explode(stack).alias("s")).select("s.*")
            .withColumn("markers_replaced", F.col("nulls_total") - F.col("nulls_before")))


def numeric_text_columns(df: DataFrame, cols: list[str] | None = None,
                         threshold: float = 0.8) -> DataFrame:
    """A cleaned text column is numeric when >= threshold of its non-null values parse.

    Computed over all non-null values (a partitioned table has no "first 80").
    All-null columns are skipped (rate NULL, not numeric).
    """
    cols = text_columns(df) if cols is None else cols
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(q(c)).alias(f"n{i}"), F.count(f"__num_{i}").alias(f"p{i}")]
    row = parsed(df.select(*[q(c) for c in cols]), cols).agg(*aggs)
    stack = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("column"),
                               F.col(f"n{i}").alias("n_values"), F.col(f"p{i}").alias("n_parsed"))
                      for i, c in enumerate(cols)])
    rate = F.try_divide(F.col("n_parsed").cast("double"), F.col("n_values"))
    return (row.select(F.explode(stack).alias("s")).select("s.*")
            .withColumn("rate", rate)
            .withColumn("is_numeric", F.coalesce(F.col("rate") >= threshold, F.lit(False))))


def convert_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Parse the given text columns into doubles (failures -> NULL)."""
    conv = [c for c in df.columns if c in cols]
    p = parsed(df, conv)
    return p.select(*[F.col(f"__num_{conv.index(c)}").alias(c) if c in conv else q(c) for c in df.columns])


def drop_exact_duplicates(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct rows (NULLs equal) and the number of dropped copies.

    One aggregate does both: it pre-aggregates map-side, so a row repeated a
    billion times crosses the shuffle once per map task.  Both results are lazy; a
    caller that reads the table often materializes it (a run does).  All columns
    are compared, so the query leaves out the unique key of its table.
    """
    counted = df.groupBy(*[q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    dups = counted.agg((F.sum("_copies") - F.count(F.lit(1))).cast("long").alias("duplicates"),
                       F.sum("_copies").cast("long").alias("rows_before"),
                       F.count(F.lit(1)).cast("long").alias("rows_after"))
    return counted.drop("_copies"), dups


@dataclass
class CleanResult:
    table: DataFrame
    audit: DataFrame
    markers: DataFrame
    numeric: DataFrame
    duplicates: DataFrame
    converted: list[str]


def clean_table(df: DataFrame, threshold: float = 0.8, dedupe: bool = True) -> CleanResult:
    """Trim + markers + number text + duplicates, with the audit."""
    cols = text_columns(df)
    spark = df.sparkSession
    if cols:
        marked = df.select(*[q(c) for c in cols], *[clean_text(q(c)).alias(f"__c_{i}") for i, c in enumerate(cols)])
        marked = parsed(marked, [f"__c_{i}" for i in range(len(cols))])
        aggs = []
        for i, c in enumerate(cols):
            cc = F.col(f"__c_{i}")
            aggs += [F.count_if(q(c).isNull()).alias(f"b{i}"), F.count_if(cc.isNull()).alias(f"a{i}"),
                     F.count(cc).alias(f"n{i}"), F.count(f"__num_{i}").alias(f"p{i}")]
        stats = marked.agg(*aggs).first()
        rows = []
        for i, c in enumerate(cols):
            n, p = stats[f"n{i}"], stats[f"p{i}"]
            rows.append((i, c, int(stats[f"b{i}"]), int(stats[f"a{i}"]), int(n), int(p),
                         (p / n) if n else None))
    else:
        rows = []
    info = spark.createDataFrame(
        rows, "pos int, column string, nulls_before bigint, nulls_total bigint, n_values bigint, "
              "n_parsed bigint, rate double")
    converted = [r[1] for r in rows if r[6] is not None and r[6] >= threshold]
    projected = convert_columns(null_markers(df, cols), converted)
    if dedupe:
        table, dups = drop_exact_duplicates(projected)
    else:
        table = projected
        dups = spark.createDataFrame([(0, None, None)], "duplicates bigint, rows_before bigint, rows_after bigint")
    markers = info.select("pos", "column", "nulls_before", "nulls_total",
                          (F.col("nulls_total") - F.col("nulls_before")).alias("markers_replaced"))
    numeric = info.select("pos", "column", "n_values", "n_parsed", "rate",
                          F.coalesce(F.col("rate") >= threshold, F.lit(False)).alias("is_numeric"))
    audit = cleaning_audit(markers, numeric, dups)
    return CleanResult(table, audit, markers, numeric, dups, converted)


def cleaning_audit(markers: DataFrame, numeric: DataFrame, dups: DataFrame) -> DataFrame:
    """One log of every change: markers -> NULL, text -> number, dropped duplicates."""
    m = markers.where(F.col("nulls_total") > 0).select(
        "column", F.lit("null_markers").alias("change"), F.col("nulls_total").alias("n"),
        F.lit(None).cast("double").alias("rate"))
    c = numeric.where(F.col("is_numeric")).select(
        "column", F.lit("to_numeric").alias("change"), F.col("n_parsed").alias("n"), "rate")
    d = dups.where(F.col("duplicates") > 0).select(
        F.lit("*").alias("column"), F.lit("duplicates").alias("change"),
        F.col("duplicates").alias("n"), F.lit(None).cast("double").alias("rate"))
    return m.unionByName(c).unionByName(d)
