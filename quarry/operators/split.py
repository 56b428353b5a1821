"""Exact, reproducible, stratified train / validation / test split.

Sizes follow the usual two-step stratified split: test = ceil(0.2 n), then
validation = ceil(0.25 of the rest); per class, the train part of each step
gets its largest-remainder share (ties go to the smaller class label) and
the held-out part the remainder.  Inside a class, rows are ordered by the
md5 of their key and the seed, so the split is the same on every engine
and every run.

No window over a whole class is used.  A first pass counts the classes.  The
md5 is uniform, so from its count each cut of a class is known to lie in a
narrow bracket of hashes; a second pass counts the rows below, between and
above the brackets, and inside them by hash, which gives the cuts exactly
(:func:`quarry.operators.order_stats.ranked`).  The split itself is a
projection against a table of one row per class.  The same counts say how
often the hash of a cut repeats; such rows are numbered (distributed, by
partition), so sizes are exact however often a key repeats.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import order_stats
from quarry.operators.profile import row_hash
from quarry.operators.schema import q
from quarry.session import materialize


def largest_remainder(counts: list[int], n_draws: int) -> list[int]:
    """Largest-remainder allocation of ``n_draws`` proportional to ``counts``.

    Remainder ties go to the earlier entry (``counts`` is in class order).
    """
    total = sum(counts)
    if total == 0:
        return [0 for _ in counts]
    cont = [c / total * n_draws for c in counts]
    floored = [math.floor(x) for x in cont]
    need = int(n_draws - sum(floored))
    order = sorted(range(len(counts)), key=lambda i: (-(cont[i] - floored[i]), i))
    for i in order[:max(need, 0)]:
        floored[i] += 1
    return floored


def split_sizes(counts: list[int], test_size: float = 0.2, val_size: float = 0.25) -> list[tuple[int, int, int]]:
    """Per class (test, val, train) sizes of the two-step stratified split."""
    n = sum(counts)
    n_test = math.ceil(test_size * n)
    temp = largest_remainder(counts, n - n_test)
    m = sum(temp)
    n_val = math.ceil(val_size * m)
    train = largest_remainder(temp, m - n_val)
    return [(c - t, t - tr, tr) for c, t, tr in zip(counts, temp, train)]


def _largest_remainder(table: DataFrame, weight: str, draws: Column, out: str) -> DataFrame:
    """``largest_remainder`` over a table of one row per class; ``draws`` may use the window sums."""
    every = Window.partitionBy()
    share = F.try_divide(F.col(weight), F.sum(weight).over(every)) * draws
    table = table.withColumn("_share", F.coalesce(share, F.lit(0.0))).withColumn("_floor", F.floor("_share"))
    table = table.withColumn("_need", draws - F.sum("_floor").over(every))
    rank = F.row_number().over(Window.orderBy((F.col("_share") - F.col("_floor")).desc(), "_y"))
    table = table.withColumn("_rank", rank)
    return (table.withColumn(out, F.col("_floor") + (F.col("_rank") <= F.col("_need")).cast("long"))
            .drop("_share", "_floor", "_need", "_rank"))


def sizes_table(counts: DataFrame, test_size: float, val_size: float) -> DataFrame:
    """``split_sizes`` for rows (_y, _n): adds n_test, n_val, n_train without passing the driver."""
    every = Window.partitionBy()
    total = F.sum("_n").over(every)
    table = _largest_remainder(counts, "_n", (total - F.ceil(F.lit(test_size) * total)).cast("double"), "_temp")
    total = F.sum("_temp").over(every)
    table = _largest_remainder(table, "_temp", (total - F.ceil(F.lit(val_size) * total)).cast("double"), "n_train")
    return (table.withColumn("n_test", F.col("_n") - F.col("_temp")).withColumn("n_val", F.col("_temp") - F.col("n_train"))
            .drop("_temp"))


@dataclass
class Split:
    table: DataFrame
    sizes: DataFrame
    dropped_null_target: int


#: Half the width of a cut's bracket in standard deviations of a uniform sample's quantile.
DEVIATIONS = 8
#: Hexadecimal digits of a bracket's ends.
DIGITS = 13


def _hash_at(share: Column) -> Column:
    """The first digits of the md5 below which ``share`` (0..1) of all hashes lie."""
    return F.lower(F.lpad(F.hex(F.floor(share * float(16**DIGITS)).cast("long")), DIGITS, "0"))


def _hash_number(h: Column) -> Column:
    return F.conv(F.substring(h, 1, DIGITS), 16, 10).cast("double")


def class_cuts(hashed: DataFrame, asks: DataFrame) -> DataFrame:
    """(_y, k, kth, equal, before): the k-th hash of a class, how many rows have it and how many a lower
    one.  ``hashed`` is (_y, _v); ``asks`` (_y, _n, k) with 1 <= k <= _n = rows of the class."""
    share = (F.col("k") - 0.5) / F.col("_n")
    near = DEVIATIONS * (F.sqrt(share * (1 - share) / F.col("_n")) + 1 / F.col("_n"))
    brackets = asks.select("_y", "k", _hash_at(F.greatest(share - near, F.lit(0.0))).alias("_lo"),
                           F.when(share + near < 1, _hash_at(share + near)).otherwise("g").alias("_hi"),
                           F.lit("").alias("_min"), F.lit("g").alias("_max"))  # before and after every hash
    return order_stats.ranked(hashed, ["_y"], brackets, _hash_number)


def stratified_split(df: DataFrame, target: str, key_cols: list[str] | None = None, seed: int = 42,
                     test_size: float = 0.2, val_size: float = 0.25) -> Split:
    """Add ``split`` in {'train', 'val', 'test'}; rows with a NULL target are left out."""
    keys = key_cols or list(df.columns)
    allcounts = order_stats.freeze(df.groupBy(q(target).alias("_y")).agg(F.count(F.lit(1)).alias("_n")))
    dropped = allcounts.where(F.col("_y").isNull()).agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    sizes = order_stats.freeze(sizes_table(allcounts.where(F.col("_y").isNotNull()), test_size, val_size))
    hashed = df.withColumn("_h", row_hash(keys, seed)).withColumn("_y", q(target)).where(F.col("_y").isNotNull())

    ends = F.array(F.struct(F.lit("t").alias("req"), F.col("n_test").alias("k"), F.col("n_test").alias("n")),
                   F.struct(F.lit("v").alias("req"), (F.col("n_test") + F.col("n_val")).alias("k"), F.col("n_val").alias("n")))
    asks = sizes.select("_y", "_n", F.explode(ends).alias("e")).where("e.n > 0").select("_y", "_n", "e.req", "e.k")
    cuts = class_cuts(hashed.select("_y", F.col("_h").alias("_v")), asks)
    wide = asks.join(cuts, ["_y", "k"]).groupBy("_y").pivot("req", ["t", "v"]).agg(F.first(F.struct("kth", "equal", "before")))
    # one row per class, computed once
    wide = order_stats.freeze(sizes.select("_y", "n_test", "n_val").join(wide.select(
        "_y", F.col("t.kth").alias("_th"), F.col("t.before").alias("_tb"), F.col("v.kth").alias("_vh"),
        F.col("v.before").alias("_vb"), (F.greatest("t.equal", "v.equal") > 1).alias("_r")), "_y", "left"))

    joined = hashed.join(wide, "_y")
    columns = [q(c) for c in df.columns]
    plain = F.when(F.col("_h") <= F.col("_th"), "test").when(F.col("_h") <= F.col("_vh"), "val").otherwise("train")
    out = sizes.select(F.col("_y").alias("class"), F.col("_n").alias("n"), *[F.col(c).cast("long").alias(c) for c in ("n_test", "n_val", "n_train")])
    if not wide.where("_r").limit(1).count():
        return Split(joined.select(*columns, plain.alias("split")), out, int(dropped))

    # keys at a cut point that repeat: number their rows and cut inside
    at_cut = F.coalesce(F.col("_r"), F.lit(False)) & (F.coalesce(F.col("_h") == F.col("_th"), F.lit(False))
                                                      | F.coalesce(F.col("_h") == F.col("_vh"), F.lit(False)))
    rest = joined.where(~at_cut).select(*columns, plain.alias("split"))
    # written, so that the numbers given to the rows stay theirs
    tied = materialize(joined.where(at_cut).withColumn("_p", F.spark_partition_id()))
    group = ["_y", "_h"]
    blocks = order_stats.freeze(tied.groupBy(*group, "_p").agg(F.count(F.lit(1)).alias("_c")))
    earlier = Window.partitionBy(*group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*group, "_p", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*group, "_p").orderBy(F.lit(1)))
    tied = tied.withColumn("_i", inside).join(order_stats.freeze(blocks), [*group, "_p"])
    below = F.when(F.col("_h") == F.col("_th"), F.col("_tb")).otherwise(F.col("_vb"))
    rank = below + F.col("_before") + F.col("_i")
    cut = F.when(rank <= F.col("n_test"), "test").when(rank <= F.col("n_test") + F.col("n_val"), "val").otherwise("train")
    return Split(rest.unionByName(tied.select(*columns, cut.alias("split"))), out, int(dropped))
