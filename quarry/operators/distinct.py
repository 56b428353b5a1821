"""Exact distinct counts of many columns without copying rows.

Spark's ``count(DISTINCT a), count(DISTINCT b), ...`` expands every row once
per column.  Here a first aggregate estimates each column's number of values
and takes the range of whole numbers; then

* columns with few values are counted by one aggregate that holds their
  values (the estimate bounds its buffers);
* whole numbers that fill a good part of their range are counted by
  bitmaps, one per ``BITMAP`` numbers: what crosses the shuffle is the bitmaps;
* each other column is counted by a scan of its own that reads this column
  alone and shuffles its values once, combined before.

All ways are exact; the estimate only picks one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Values a buffer may hold (an estimate), numbers of a bitmap, least share of a range that is filled.
FEW, BITMAP, FILLED = 2000, 32768, 1 / 64
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOAT = (T.FloatType, T.DoubleType)


def _held(c: Column, kind: T.DataType) -> Column:
    if not isinstance(kind, _FLOAT):
        return F.size(F.collect_set(c))
    # a set would hold every NaN
    return F.size(F.collect_set(F.when(~F.isnan(c), c))) + F.coalesce(F.bool_or(F.isnan(c)).cast("int"), F.lit(0))


def distinct_values(df: DataFrame, columns: list[Column]) -> DataFrame:
    """(pos, n_distinct): number of distinct non-null values of each expression, by its position."""
    spark = df.sparkSession
    if not columns:
        return spark.createDataFrame([], "pos int, n_distinct long")
    named = df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)])
    kinds = [f.dataType for f in named.schema.fields]
    # 0.0 and -0.0 are one value, as in a GROUP BY
    named = named.select(*[(F.col(f"c{i}") + F.lit(0).cast(k)).alias(f"c{i}") if isinstance(k, _FLOAT) else f"c{i}"
                           for i, k in enumerate(kinds)])
    probe = []
    for i, kind in enumerate(kinds):
        c = F.col(f"c{i}")
        probe.append(F.approx_count_distinct(c, 0.02).alias(f"n{i}"))
        if isinstance(kind, _WHOLE):
            probe += [F.min(c).cast("long").alias(f"lo{i}"), F.max(c).cast("long").alias(f"hi{i}")]
    found = named.agg(*probe).first()

    few = [i for i in range(len(kinds)) if found[f"n{i}"] <= FEW]
    parts = []
    if few:
        row = named.agg(*[_held(F.col(f"c{i}"), kinds[i]).cast("long").alias(f"d{i}") for i in few])
        stack = F.array(*[F.struct(F.lit(i).alias("pos"), F.col(f"d{i}").alias("n_distinct")) for i in few])
        parts.append(row.select(F.explode(stack).alias("s")).select("s.*"))
    for i, kind in enumerate(kinds):
        if i in few:
            continue
        c = F.col(f"c{i}")
        values = named.select(c.alias("v")).where("v IS NOT NULL")
        if isinstance(kind, _WHOLE) and found[f"n{i}"] >= (found[f"hi{i}"] - found[f"lo{i}"]) * FILLED:
            v = F.col("v").cast("long") - found[f"lo{i}"]
            counted = (values.groupBy(F.floor(v / BITMAP).alias("b"))
                       .agg(F.bitmap_count(F.bitmap_construct_agg(F.pmod(v, F.lit(BITMAP)))).alias("n"))
                       .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_distinct")))
        else:
            counted = values.distinct().agg(F.count(F.lit(1)).alias("n_distinct"))
        parts.append(counted.select(F.lit(i).alias("pos"), "n_distinct"))
    return reduce(DataFrame.unionByName, parts)


def more_values_than(df: DataFrame, column: Column, n: int) -> bool:
    """Whether an expression has more than ``n`` distinct non-null values.  An estimate settles it where
    there are many; else there are few values, and they are counted."""
    values = df.select(column.alias("v")).where("v IS NOT NULL")
    if values.agg(F.approx_count_distinct("v", 0.02)).first()[0] > 4 * n + 50:
        return True
    return values.distinct().limit(n + 1).count() > n
