"""Target discretization: continuity test, quantile / uniform / binary / manual bins.

Edges are computed with one distributed aggregate (exact order statistics
for quantiles) and come back as a handful of numbers; the binning itself is
a projection with literal edges.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.numeric import bin_labels
from quarry.operators import order_stats
from quarry.operators.distinct import distinct_values, more_values_than
from quarry.operators.schema import is_numeric_type, q

CONTINUOUS_DISTINCT = 15
SMALL_INT_RANGE = 20


def is_continuous(df: DataFrame, cols: list[str] | None = None,
                  min_distinct: int = CONTINUOUS_DISTINCT) -> DataFrame:
    """Numeric, more than ``min_distinct`` distinct values, and not (all integers with range < 20)."""
    cols = cols or df.columns
    num = [c for c in cols if is_numeric_type(df.schema[c].dataType)]
    spark = df.sparkSession
    if not num:
        rows = spark.createDataFrame([], "column string, n_distinct bigint, all_integer boolean, "
                                         "value_range double")
    else:
        xs = [q(c).cast("double") for c in num]
        row = df.agg(*[F.bool_and(x == F.floor(x)).alias(f"i{i}") for i, x in enumerate(xs)],
                     *[(F.max(x) - F.min(x)).alias(f"r{i}") for i, x in enumerate(xs)])
        stack = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("column"), F.col(f"i{i}").alias("all_integer"),
                                   F.col(f"r{i}").alias("value_range")) for i, c in enumerate(num)])
        shapes = row.select(F.explode(stack).alias("s")).select("s.*")
        rows = shapes.join(distinct_values(df, xs), "pos").select("column", "n_distinct", "all_integer", "value_range")
    other = [c for c in cols if c not in num]
    if other:
        rows = rows.unionByName(spark.createDataFrame(
            [(c, None, None, None) for c in other],
            "column string, n_distinct bigint, all_integer boolean, value_range double"))
    cont = ((F.col("n_distinct") > min_distinct)
            & ~(F.coalesce(F.col("all_integer"), F.lit(True)) & (F.col("value_range") < SMALL_INT_RANGE)))
    return rows.withColumn("is_continuous", F.coalesce(cont, F.lit(False)))


def quantile_edges(df: DataFrame, col: str, n: int) -> list[float]:
    """Linear quantiles at i/n, duplicates dropped (D2 edges)."""
    probs = [i / n for i in range(n + 1)]
    qs = order_stats.quantiles(df, col, probs).orderBy("p").collect()
    edges: list[float] = []
    for r in qs:
        if not edges or r["q"] != edges[-1]:
            edges.append(float(r["q"]))
    return edges


def uniform_edges(df: DataFrame, col: str, n: int) -> list[float]:
    """n equal widths over min..max; the first edge moves down by 0.1% of the range (D3)."""
    mn, mx = df.agg(F.min(q(col).cast("double")), F.max(q(col).cast("double"))).first()
    if mn is None:
        return []
    if mn == mx:
        adj = 0.001 * abs(mn) if mn != 0 else 0.001
        mn, mx = mn - adj, mx + adj
        step = (mx - mn) / n
        return [mn + i * step for i in range(n)] + [mx]
    step = (mx - mn) / n
    edges = [i * step + mn for i in range(n)] + [mx]
    edges[0] -= (mx - mn) * 0.001
    return edges


def bin_index(x: Column, edges: list[float]) -> Column:
    """0-based bin of right-closed intervals; the lowest edge is included; outside -> NULL."""
    inner = sum((F.when(x > F.lit(e), 1).otherwise(0) for e in edges[1:-1]), F.lit(0))
    inside = (x >= F.lit(edges[0])) & (x <= F.lit(edges[-1]))
    return F.when(x.isNotNull() & inside, inner).cast("int")


def label_of(idx: Column, labels: list[str]) -> Column:
    """Label of a 0-based bin index."""
    # guarded: element_at with a NULL index does not reliably give NULL in generated code
    return F.when(idx.isNotNull(), F.element_at(F.array(*[F.lit(s) for s in labels]), idx + 1))


@dataclass
class Binned:
    table: DataFrame
    edges: list[float] | None
    threshold: float | None
    labels: list[str] | None


def _labelled(df: DataFrame, col: str, edges: list[float], out: str,
              labels: list[str] | None) -> Binned:
    nb = max(len(edges) - 1, 0)
    labs = labels if labels and len(labels) == nb else bin_labels(nb)
    x = q(col).cast("double")
    idx = bin_index(x, edges) if nb > 0 else F.lit(None).cast("int")
    t = df.withColumn(f"{out}_idx", idx).withColumn(out, label_of(F.col(f"{out}_idx"), labs))
    return Binned(t, edges, None, labs)


def bin_quantile(df: DataFrame, col: str, n: int = 3, out: str | None = None,
                 labels: list[str] | None = None) -> Binned:
    """Equal-count bins from linear quantiles; duplicate edges dropped and the labels redone."""
    return _labelled(df, col, quantile_edges(df, col, n), out or f"{col}_cat", labels)


def bin_uniform(df: DataFrame, col: str, n: int = 3, out: str | None = None,
                labels: list[str] | None = None) -> Binned:
    """D3: equal-width bins, right-closed."""
    return _labelled(df, col, uniform_edges(df, col, n), out or f"{col}_cat", labels)


def bin_manual(df: DataFrame, col: str, cuts: list[float], out: str | None = None,
               labels: list[str] | None = None) -> Binned:
    """User cuts (at least 2), lowest included; values outside -> NULL."""
    if not cuts or len(cuts) < 2:
        raise ValueError("manual binning needs at least two cuts")
    return _labelled(df, col, [float(c) for c in cuts], out or f"{col}_cat", labels)


def median_value(df: DataFrame, col: str) -> float | None:
    r = order_stats.quantiles(df, col, [0.5]).first()
    return None if r is None else float(r["q"])


def bin_binary_median(df: DataFrame, col: str, out: str | None = None) -> Binned:
    """1 when above the exact median, else 0 (NULL stays NULL)."""
    t = median_value(df, col)
    x = q(col).cast("double")
    return Binned(df.withColumn(out or f"{col}_cat", (x > F.lit(t)).cast("int")), None, t, None)


def bin_binary_mean(df: DataFrame, col: str, out: str | None = None) -> Binned:
    """1 when above the mean, else 0 (NULL stays NULL)."""
    t = df.agg(F.avg(q(col).cast("double"))).first()[0]
    x = q(col).cast("double")
    return Binned(df.withColumn(out or f"{col}_cat", (x > F.lit(t)).cast("int")), None, t, None)


def bin_threshold(df: DataFrame, col: str, t: float, out: str | None = None) -> DataFrame:
    """1 when value >= t."""
    return df.withColumn(out or f"{col}_cat", (q(col) >= F.lit(t)).cast("int"))


def edges_table(df: DataFrame, edges: list[float]) -> DataFrame:
    """The edges as rows, rounded to 2 decimals."""
    rows = [(i, float(e)) for i, e in enumerate(edges)]
    return df.sparkSession.createDataFrame(rows, "idx int, edge double").select(
        "idx", F.round("edge", 2).alias("edge"))


def _target_is_continuous(df: DataFrame, target: str, min_distinct: int = CONTINUOUS_DISTINCT) -> bool:
    """D1's decision alone: whether there are more than ``min_distinct`` values, not how many."""
    if not is_numeric_type(df.schema[target].dataType):
        return False
    x = q(target).cast("double")
    r = df.agg(F.bool_and(x == F.floor(x)).alias("whole"), (F.max(x) - F.min(x)).alias("range")).first()
    if (r["whole"] is None or r["whole"]) and (r["range"] is None or r["range"] < SMALL_INT_RANGE):
        return False
    return more_values_than(df, x, min_distinct)


@dataclass
class Discretized:
    table: DataFrame
    target: str
    continuous: bool
    method: str | None
    edges: list[float] | None
    threshold: float | None


def discretize_target(df: DataFrame, target: str, method: str = "quantile", n_bins: int = 3,
                      cuts: list[float] | None = None) -> Discretized:
    """When the target is continuous, add ``<target>_cat`` at the end and drop the target."""
    if not _target_is_continuous(df, target):
        return Discretized(df, target, False, None, None, None)
    out = f"{target}_cat"
    if method == "quantile":
        b = bin_quantile(df, target, n_bins, out)
    elif method == "uniform":
        b = bin_uniform(df, target, n_bins, out)
    elif method == "median":
        b = bin_binary_median(df, target, out)
    elif method == "mean":
        b = bin_binary_mean(df, target, out)
    elif method == "manual":
        b = bin_manual(df, target, cuts or [], out)
    else:
        raise ValueError(f"unknown method '{method}'")
    keep = [c for c in df.columns if c != target]
    t = b.table.select(*[q(c) for c in keep], q(out))
    return Discretized(t, out, True, method, b.edges, b.threshold)
