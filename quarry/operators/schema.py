"""Schema operators: target detection, column roles, column summary, filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Lower-case column names taken as the target when none is given.
TARGET_NAMES = ["target", "y", "clase", "class", "label", "respuesta",
                "response", "churn", "objetivo", "etiqueta"]

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def q(c: str):
    return F.col(f"`{c}`")


def detect_target(df: DataFrame, target: str | None = None, strict: bool = True) -> str:
    """User's column if present; else the first column named like a target; else the last column.

    An unknown user name raises unless ``strict=False`` (then it falls through).
    """
    if target:
        if target in df.columns:
            return target
        if strict:
            raise ValueError(f"target column '{target}' not in table")
    for c in df.columns:
        if c.lower() in TARGET_NAMES:
            return c
    return df.columns[-1]


def is_numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC)


def classify_columns(df: DataFrame, target: str | None) -> tuple[list[str], list[str]]:
    """Numeric and categorical feature columns, target excluded.

    Booleans, dates and timestamps are categorical (as text), like any non-number.
    """
    num, cat = [], []
    for f in df.schema.fields:
        if f.name == target:
            continue
        (num if is_numeric_type(f.dataType) else cat).append(f.name)
    return num, cat


def type_name(dt: T.DataType) -> str:
    return dt.simpleString()


def column_summary(df: DataFrame) -> DataFrame:
    """Per column: type, null count and % null (half-even, 1 decimal), in one aggregate."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(q(c).isNull()).alias(f"_z{i}") for i, c in enumerate(cols)])
    stack = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("column"),
                               F.lit(type_name(df.schema[c].dataType)).alias("type"),
                               F.col(f"_z{i}").alias("nulls")) for i, c in enumerate(cols)])
    return (row.select("_n", F.explode(stack).alias("s"))
            .select("s.pos", "s.column", "s.type", F.col("s.nulls").cast("long").alias("nulls"),
                    F.bround(F.coalesce(F.try_divide(F.col("s.nulls") * 100.0, F.col("_n")),
                                        F.lit(0.0)), 1).alias("pct_nulls")))


def dtype_counts(df: DataFrame) -> DataFrame:
    """Number of columns per type."""
    spark = df.sparkSession
    rows = [(type_name(f.dataType),) for f in df.schema.fields]
    return spark.createDataFrame(rows, "type string").groupBy("type").agg(
        F.count(F.lit(1)).alias("n_columns"))


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def exclude_matching(df: DataFrame, col: str = "model", pattern: str = "baseline|dummy") -> DataFrame:
    """Rows whose ``col`` does not match (case-insensitive); by default models that are no baseline."""
    return df.where(~F.lower(q(col)).rlike(pattern))
