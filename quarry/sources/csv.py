"""Delimited-text sources: separator/encoding detection, load-time null tokens, type inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import LOAD_NA_TOKENS
from quarry.sources.csv_records import records

# Fixed values: (separator, encoding) attempts, in order.
ATTEMPTS = [(",", "utf-8"), (";", "utf-8"), (",", "ISO-8859-1"), (";", "ISO-8859-1")]

INT_RE = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_RE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
BOOL_VALUES = ["True", "False", "TRUE", "FALSE", "true", "false"]
REPLACEMENT_CHAR = "�"


def read_csv_text(spark: SparkSession, path: str, sep: str = ",",
                  encoding: str = "utf-8") -> DataFrame:
    """Every column as text; the header row names the columns (S4 with a fixed separator).

    A quote inside quotes is doubled; a quoted text may hold line breaks.  Shorter rows are filled with
    NULL, longer ones raise ``ValueError``.
    """
    df, surplus = _read_csv(spark, path, sep, encoding, _breaks_in_quotes(spark, path))
    if _any_bad(df, surplus, False):
        raise ValueError(f"rows with more fields than the header in {path}")
    return df.drop(surplus)


def _breaks_in_quotes(spark: SparkSession, path: str) -> bool:
    """A line with an odd number of quotes: some quoted text may go on in the next line.  Only then are
    records put together from lines (``csv_records``)."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return spark.read.text(path).where(quotes % 2 == 1).limit(1).count() > 0


def _read_csv(spark: SparkSession, path: str, sep: str, encoding: str, multi_line: bool) -> tuple[DataFrame, str]:
    """All columns as text, and one more that only rows with surplus fields fill."""
    reader = (spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("quote", '"')
              .option("escape", '"').option("multiLine", multi_line).option("mode", "PERMISSIVE"))
    names = reader.option("inferSchema", False).csv(path).columns
    surplus = "__surplus"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, surplus]])
    if not multi_line:
        return reader.schema(schema).csv(path), surplus
    value = F.col("value") if encoding == "utf-8" else F.decode(F.col("value").cast("binary"), encoding)
    fields = ", ".join(f"`{c.replace('`', '``')}` STRING" for c in schema.names)
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    parsed = records(spark, path, sep).select(F.from_csv(F.rtrim(value, F.lit("\r")), fields, options).alias("r"))
    return parsed.select("r.*"), surplus


def _any_bad(df: DataFrame, surplus: str, check_bytes: bool) -> bool:
    """One scan: rows with surplus fields, or with bytes that are not UTF-8."""
    bad = F.col(surplus).isNotNull()
    if check_bytes:
        if any(REPLACEMENT_CHAR in c for c in df.columns):
            return True
        bad |= F.concat_ws("", *[F.col(f"`{c}`") for c in df.columns]).contains(REPLACEMENT_CHAR)
    return df.where(bad).limit(1).count() > 0


def csv_autodetect(spark: SparkSession, path: str) -> tuple[DataFrame, str, str]:
    """Try the attempts in order; the first that yields more than one column wins.

    Spark does not fail on bytes that are not UTF-8 (it yields U+FFFD), so a
    UTF-8 attempt with replacement characters counts as failed, and so does one with rows of more
    fields than the header.
    """
    last_error: Exception | None = None
    multi_line = _breaks_in_quotes(spark, path)
    for sep, enc in ATTEMPTS:
        try:
            df, surplus = _read_csv(spark, path, sep, enc, multi_line)
            if len(df.columns) <= 2 or _any_bad(df, surplus, enc == "utf-8"):
                continue
            return df.drop(surplus), sep, enc
        except Exception as exc:  # noqa: BLE001 - try the next attempt
            last_error = exc
    raise RuntimeError(f"could not read the CSV: {last_error}")


def null_tokens_at_load(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """pandas' default missing-value strings become NULL."""
    cols = cols or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.select(*[(F.when(~F.col(f"`{c}`").isin(LOAD_NA_TOKENS), F.col(f"`{c}`")) if c in cols
                        else F.col(f"`{c}`")).alias(c) for c in df.columns])


def infer_types(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per text column, the narrowest type that takes every non-null value (one aggregate).

    Returns ``column, type`` with type one of bigint, double, boolean, string.
    An all-null column stays string; integers beyond 64 bits make a double column.
    """
    cols = cols or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        aggs += [F.count(x).alias(f"n{i}"),
                 F.count_if(x.rlike(INT_RE) & F.trim(x).try_cast("bigint").isNotNull()).alias(f"i{i}"),
                 F.count_if(x.rlike(FLOAT_RE)).alias(f"f{i}"),
                 F.count_if(x.isin(BOOL_VALUES)).alias(f"b{i}")]
    row = df.agg(*aggs)
    stack = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(i).alias("pos"),
                               F.col(f"n{i}").alias("n"), F.col(f"i{i}").alias("ni"),
                               F.col(f"f{i}").alias("nf"), F.col(f"b{i}").alias("nb"))
                      for i, c in enumerate(cols)])
    long = row.select(F.explode(stack).alias("s")).select("s.*")
    t = (F.when(F.col("n") == 0, "string").when(F.col("ni") == F.col("n"), "bigint")
         .when(F.col("nf") == F.col("n"), "double").when(F.col("nb") == F.col("n"), "boolean")
         .otherwise("string"))
    return long.select("column", "pos", t.alias("type"))


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast text columns to the inferred types (one projection)."""
    out = []
    for c in df.columns:
        x = F.col(f"`{c}`")
        t = types.get(c, "string")
        if t == "bigint":
            out.append(F.trim(x).try_cast("bigint").alias(c))
        elif t == "double":
            out.append(F.trim(x).try_cast("double").alias(c))
        elif t == "boolean":
            out.append(F.lower(x).try_cast("boolean").alias(c))
        else:
            out.append(x.alias(c))
    return df.select(*out)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is missing, in float and double columns."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    return df.select(*[F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if c in floats else F.col(f"`{c}`")
                       for c in df.columns])


def load_csv(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """Read, null tokens, infer and cast: the typed table a CSV reader would give."""
    if sep is None:
        raw, _, _ = csv_autodetect(spark, path)
    else:
        raw = read_csv_text(spark, path, sep)
    raw = null_tokens_at_load(raw)
    types = {r["column"]: r["type"] for r in infer_types(raw).collect()}
    return nan_to_null(apply_types(raw, types))
