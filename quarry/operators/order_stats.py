"""Exact order statistics that never put a whole group into one task.

Spark's exact ``percentile`` keeps a map of every distinct value and merges
it in one task per group, and a window ``partitionBy(class)`` sorts a whole
class in one task.  Both break when one key holds a third of 100 TB.  The
helpers here stay exact and keep every task bounded:

* :func:`kth_smallest` and :func:`quantiles` take one sketch pass and one
  exact pass.  A mergeable sketch says between which two values each wanted
  rank should lie.  These values, sorted, are the marks of a group; each row
  finds its place among them by binary search, in one projection, and is
  counted: rows between the two values of a request by their value, all
  others by their place alone.  The counts, added up, hold every wanted rank.
  Where the sketch was wrong, its rank falls into a place known by then, and
  a second exact pass takes that.
* :func:`running_sums` computes exact cumulative sums in a global order:
  value ranges of bounded size from a sketch, totals of each range, prefix
  sums of these, then cumulative sums inside each range.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import materialize

BROADCAST_ROWS = 200_000
FREEZE_ROWS = 10_000
#: Size of the quantile sketch: ranks are off by 0.15 % of the rows or less, 99 times in 100.
SKETCH = 2000
#: Half the width of a request's bracket, as a share of the rows; steps of the grid for free ranks.
NEAR, GRID = 0.0025, 256
#: Sketches of a group are merged in this many tasks before the last.
SPREAD = 32
#: Rows of a value range summed in one task.
RANGE_ROWS = 250_000


def freeze(df: DataFrame) -> DataFrame:
    """Materialize a summary table once.

    Up to ``FREEZE_ROWS`` rows (class counts, cut points, confusion cells) it is
    rebuilt from its rows, which avoids file I/O; anything larger is written as
    a reliable checkpoint and never passes through the driver.
    """
    df = df.persist(StorageLevel.MEMORY_AND_DISK)  # the probe and the checkpoint share one evaluation
    try:
        rows = df.limit(FREEZE_ROWS + 1).toArrow()
        if rows.num_rows <= FREEZE_ROWS:
            # a local relation: its size is known to the planner, which broadcasts it on that evidence
            return df.sparkSession.createDataFrame(rows, df.schema)
        return materialize(df)
    finally:
        df.unpersist()


def join_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join with a broadcast only when the small side's row count is checked."""
    n = small.count()
    if n <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


# --- places among marks ---------------------------------------------------------------------------


def _literal(value, kind: T.DataType) -> Column:
    """A literal; arrays of numbers, booleans or hexadecimal strings as one folded cast."""
    if not isinstance(kind, T.ArrayType):
        return F.lit(value).cast(kind)
    if not value:
        return F.array().cast(kind)
    return F.split(F.lit(",".join(str(v) for v in value)), ",").cast(kind)


def attach(df: DataFrame, table: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """The other columns of ``table``, one row per group, beside each row of ``df``; without groups
    its one row becomes literals and there is no join.  ``table`` is frozen, so the planner knows
    whether it is small enough to broadcast."""
    g = list(group_cols)
    if g:
        return df.join(table, g)
    row = table.first()
    return df.withColumns({f.name: _literal(row[f.name], f.dataType) for f in table.schema.fields})


def place(df: DataFrame, value: str | Column, marks: str, most: int, out: str) -> DataFrame:
    """Number of the ascending ``marks`` (an array column of at most ``most``) up to ``value``, by binary
    search: one narrow projection per halving, all in one generated loop."""
    value = F.col(value) if isinstance(value, str) else value
    df = df.withColumn(out, F.lit(0))
    step = 1 << max(most, 0).bit_length()
    while step := step >> 1:
        here = F.get(F.col(marks), F.col(out) + (step - 1))
        df = df.withColumn(out, F.col(out) + F.when(here <= value, step).otherwise(0))
    return df


def place_in(value: Column, marks: str, most: int) -> Column:
    """``place`` as one expression, for small tables whose rows are then filtered by it."""
    steps = [1 << b for b in reversed(range(max(most, 1).bit_length()))]
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: at + F.when(
        F.get(F.col(marks), at + step - 1) <= value, step).otherwise(0))


def _most(table: DataFrame, *arrays: str) -> int:
    row = table.agg(*[F.max(F.size(a)) for a in arrays]).first()
    return max((n or 0 for n in row), default=0)


# --- k-th values ----------------------------------------------------------------------------------


def _smooth(value: Column) -> Column:
    """What a sketch takes: a double, NaN as infinity."""
    x = value.cast("double")
    return F.when(F.isnan(x), float("inf")).otherwise(x)


def sketched(d: DataFrame, g: Sequence[str], ranks: Sequence[float]) -> DataFrame:
    """Per group of (g, _v): ``_n``, ``_min``, ``_max`` and the estimated values ``_grid`` at ``ranks``."""
    parts = (d.withColumn("_p", F.pmod(F.spark_partition_id(), F.lit(SPREAD))).groupBy(*g, "_p")
             .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
                  F.kll_sketch_agg_double(_smooth(F.col("_v")), F.lit(SKETCH)).alias("_s")))
    whole = parts.groupBy(*g).agg(F.sum("_n").alias("_n"), F.min("_min").alias("_min"), F.max("_max").alias("_max"),
                                  F.kll_merge_agg_double("_s", F.lit(SKETCH)).alias("_s"))
    grid = F.kll_sketch_get_quantile_double("_s", F.lit([float(r) for r in ranks]))
    return freeze(whole.where("_n > 0").select(*g, "_n", "_min", "_max", grid.alias("_grid")))


def ranked(d: DataFrame, g: Sequence[str], brackets: DataFrame, approx=_smooth) -> DataFrame:
    """The values of wanted ranks, exactly: (g, k, kth, equal, before) with the number of rows that
    equal the value and the number below it.

    ``d`` is (g, _v) without nulls; ``brackets`` (g, k, _lo, _hi, _min, _max) says between which values
    each rank k (1-based, within the group's count) should lie, and all values do.  ``approx`` maps a
    value to a double that does not fall where values rise.
    """
    g = list(g)
    ends = F.array("_lo", "_hi", "_min", "_max")
    i = F.sequence(F.lit(0), F.size("_marks"))
    covered = F.transform(i, lambda at: F.coalesce(F.exists("_b", lambda b: (b["_lo"] <= F.get("_marks", at - 1))
                                                            & (b["_hi"] >= F.get("_marks", at))), F.lit(False)))
    table = freeze(brackets.groupBy(*g).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(ends)))).alias("_marks"),
        F.collect_list(F.struct("_lo", "_hi")).alias("_b"), F.array_sort(F.collect_set("k")).alias("_asks"))
        .withColumn("_open", covered).drop("_b"))
    most = _most(table, "_marks", "_asks")

    rows = place(attach(d, table.drop("_asks"), g), "_v", "_marks", most, "_pos")
    at = F.coalesce(F.get("_marks", F.col("_pos") - 1) == F.col("_v"), F.lit(False))
    # places are numbered 0, 2, 4, ... between the marks and 1, 3, 5, ... on them
    counts = freeze(rows.groupBy(*g, (2 * F.col("_pos") - at.cast("int")).alias("_place"),
                                 F.when(at | F.get("_open", F.col("_pos")), F.col("_v")).alias("_v"))
                    .agg(F.count(F.lit(1)).alias("_c")))

    before = Window.partitionBy(*g).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    places = counts.groupBy(*g, "_place").agg(F.sum("_c").alias("_t"))  # a few rows per mark
    below = places.select(*g, "_place", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_below"))
    sums = running_sums(counts, [*g, "_place"], "_v", ["_c"], approx=approx)
    sums = sums.join(freeze(below), [*g, "_place"]).withColumn("_upto", F.col("_below") + F.col("cum__c"))
    sums = attach(sums, table.drop("_open"), g).withColumns({
        "_a": place_in(F.col("_upto"), "_asks", most), "_z": place_in(F.col("_upto") - F.col("_c"), "_asks", most)})
    half = (F.col("_place") / 2).cast("int")
    hits = sums.where("_a > _z").select(
        *g, F.explode(F.slice("_asks", F.col("_z") + 1, F.col("_a") - F.col("_z"))).alias("k"), F.col("_v").alias("kth"),
        F.col("_c").alias("equal"), (F.col("_upto") - F.col("_c")).alias("before"),
        F.get("_marks", half - 1).alias("_lo"), F.get("_marks", half).alias("_hi"))
    hits = freeze(hits)
    missed = hits.where("kth IS NULL")
    if missed.limit(1).count():  # in a place that was counted whole: now by value
        again = missed.select(*g, "k", "_lo", "_hi", F.col("_lo").alias("_min"), F.col("_hi").alias("_max"))
        return hits.drop("_lo", "_hi").where("kth IS NOT NULL").unionByName(ranked(d, g, again, approx))
    return hits.drop("_lo", "_hi")


def _values(data: DataFrame, value: str, g: Sequence[str]) -> DataFrame:
    return data.select(*g, F.col(value).alias("_v")).where(F.col("_v").isNotNull())


def kth_smallest(data: DataFrame, value: str, requests: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """k-th smallest ``value`` (a number; NaN last) per group, exactly.

    ``requests`` has the group columns, ``req`` (any id) and ``k`` (1-based).
    Returns the group columns, ``req`` and ``kth``.  Requests with k outside
    1..n are dropped.
    """
    g = list(group_cols)
    d = _values(data, value, g)
    kind = d.schema["_v"].dataType
    asks = attach(requests.select(*g, "req", F.col("k").cast("long").alias("k")),
                  sketched(d, g, [i / GRID for i in range(GRID + 1)]), g).where("k BETWEEN 1 AND _n")
    step = F.floor((F.col("k") - 0.5) / F.col("_n") * GRID).cast("int")
    lo = F.when(step >= 2, F.get("_grid", step - 1).try_cast(kind))
    hi = F.when(step <= GRID - 3, F.get("_grid", step + 2).try_cast(kind))
    brackets = asks.select(*g, "k", F.coalesce(lo, "_min").alias("_lo"), F.coalesce(hi, "_max").alias("_hi"), "_min", "_max")
    found = ranked(d, g, brackets)
    return requests.select(*g, "req", F.col("k").cast("long").alias("k")).join(found, [*g, "k"]).select(*g, "req", "kth")


def quantiles(data: DataFrame, value: str, probs: Sequence[float],
              group_cols: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles (numpy 'linear', DuckDB ``quantile_cont``).

    Returns group columns, ``p`` (index into ``probs``), ``prob`` and ``q``.
    """
    g = list(group_cols)
    d = _values(data.withColumn(value, F.col(value).cast("double")), value, g)
    ranks = sorted({min(max(p + side, 0.0), 1.0) for p in probs for side in (-NEAR, NEAR)})
    at = {r: i for i, r in enumerate(ranks)}
    lists = {"prob": ([float(p) for p in probs], T.DoubleType()),  # -1: from the smallest, to the largest value
             "_l": ([at[p - NEAR] if p > NEAR else -1 for p in probs], T.IntegerType()),
             "_h": ([at[p + NEAR] if p < 1 - NEAR else -1 for p in probs], T.IntegerType())}
    req = (sketched(d, g, ranks).withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(len(probs) - 1))))
           .withColumns({c: F.get(_literal(v, T.ArrayType(kind)), F.col("p")) for c, (v, kind) in lists.items()})
           .withColumn("_pos", F.col("prob") * (F.col("_n") - 1))
           .withColumn("_k0", F.floor("_pos").cast("long") + 1)
           .withColumn("_k1", F.least(F.col("_k0") + 1, F.col("_n")))
           .withColumn("_frac", F.col("_pos") - F.floor("_pos")))
    brackets = req.select(*g, F.explode(F.array("_k0", "_k1")).alias("k"),
                          F.coalesce(F.get("_grid", F.col("_l")), "_min").alias("_lo"),
                          F.coalesce(F.get("_grid", F.col("_h")), "_max").alias("_hi"), "_min", "_max")
    kth = ranked(d, g, brackets)
    lo = kth.select(*g, F.col("k").alias("_k0"), F.col("kth").alias("_a"))
    hi = kth.select(*g, F.col("k").alias("_k1"), F.col("kth").alias("_b"))
    out = (req.join(lo, [*g, "_k0"]).join(hi, [*g, "_k1"])
           .withColumn("q", F.when(F.col("_frac") == 0, F.col("_a"))
                       .otherwise(F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_frac"))))
    return out.select(*g, "p", "prob", "q")


# --- cumulative sums ------------------------------------------------------------------------------


def running_sums(df: DataFrame, partition_cols: Sequence[str], order_col: str,
                 sum_cols: Sequence[str], descending: bool = False,
                 range_rows: int | None = None, approx=_smooth) -> DataFrame:
    """Inclusive cumulative sums of ``sum_cols`` per ``partition_cols`` in ``order_col`` order.

    ``order_col`` must be unique within a partition key (e.g. a table of
    distinct scores).  Output adds ``cum_<c>`` for each summed column.  ``df``
    is read three times: give a table, not a long computation.
    """
    spark = df.sparkSession
    p = list(partition_cols)
    x = approx(F.col(order_col))
    n, sketch = df.agg(F.count(x), F.kll_sketch_agg_double(x, F.lit(SKETCH))).first()
    ranges = math.ceil(n / (range_rows or RANGE_ROWS))
    marks: list[float] = []
    if ranges > 1:
        at = F.lit([i / ranges for i in range(1, ranges)])
        one = spark.createDataFrame([(bytes(sketch),)], "s binary")
        marks = sorted(set(one.select(F.kll_sketch_get_quantile_double("s", at)).first()[0]))
    ocol = F.col(order_col).desc() if descending else F.col(order_col).asc()
    rows = place(df.withColumn("_marks", _literal(marks, T.ArrayType(T.DoubleType()))), x, "_marks", len(marks), "_range")
    local = Window.partitionBy(*p, "_range").orderBy(ocol).rowsBetween(Window.unboundedPreceding, 0)
    if not marks:  # one range: nothing lies before it
        return rows.select(*df.columns, *[F.sum(c).over(local).alias(f"cum_{c}") for c in sum_cols])
    totals = freeze(rows.groupBy(*p, "_range").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols]))
    order = F.col("_range").desc() if descending else F.col("_range").asc()
    before = Window.partitionBy(*p).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*p, "_range", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sum_cols])
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*p, "_range")]
    joined = (rows.alias("a").join(freeze(offsets).alias("b"), reduce(Column.__and__, same))
              .select("a.*", *[f"b._o_{c}" for c in sum_cols]))
    return joined.select(*df.columns, *[(F.col(f"_o_{c}") + F.sum(c).over(local)).alias(f"cum_{c}") for c in sum_cols])
