"""Mixing sources to target weights (operator 10).

Words are counted once per document and added up per source (partial sums before the shuffle, so a
hot source is only a few rows).  Targets come from the weights by water-filling; each document is then
taken floor(rate) times plus one more by a draw seeded with its id, with the fraction as probability.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import kernels as K
from quarry.llm.shared import stored

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
#: Sources up to this many are broadcast; beyond it the join is left to the planner.
FEW_SOURCES = 100_000


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, buf, offsets in K.slices(batch["text"]):
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"][i:j], batch["source"][i:j], pa.array(K.word_counts(buf, offsets))],
                ["doc_id", "source", "size"])


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size): words of each text, 0 for null."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_sized, "doc_id long, source string, size long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """(source, source_size, target) of rows (source, size).

    Sources by code point, null last, take the weights in turn and divide ``share`` of all words;
    no target passes ``most`` times its source: by ascending limit per weight, a source stays at its
    limit while the level of what is left would pass it, and the others share the rest by weight.
    """
    table = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source from here on
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    table = table.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    table = table.withColumn("most", F.col("source_size") * F.lit(float(most)))
    rising = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onward = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    goal = F.sum("source_size").over(everything) * F.lit(float(share))
    table = table.select("source", "source_size", "weight", "most", goal.alias("goal"),
                         F.coalesce(F.sum("most").over(before), F.lit(0.0)).alias("spent"),
                         F.sum("weight").over(onward).alias("rest"))
    full = F.col("most") * F.col("rest") <= F.col("weight") * (F.col("goal") - F.col("spent"))
    table = table.withColumn("full", full)
    left = F.max("goal").over(everything) - F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("full"), F.col("most")).otherwise(F.col("weight") * left / open_weight)
    return table.select("source", "source_size", target.alias("target"))


def draw(id_column, seed: str):
    """Uniform number of [0, 1) from an id: the first 52 bits of an md5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _with_copies(rows: DataFrame, targets: DataFrame, id_col: str, source_col: str, seed: str) -> DataFrame:
    """``rows`` with __source_size, __target, __copies."""
    targets = targets.select(F.col("source").alias("__s"), F.col("source_size").alias("__source_size"),
                             F.col("target").alias("__target"))
    if targets.count() <= FEW_SOURCES:
        targets = F.broadcast(targets)
    rate = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(0.0)
    once = (draw(F.col(id_col), seed) < rate - F.floor(rate)).cast("long")
    joined = rows.join(targets, F.col(source_col).cast("string").eqNullSafe(F.col("__s")))
    return joined.withColumn("__copies", F.floor(rate) + once).drop("__s")


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
               seed: str = "mix") -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) of every document.

    A null or empty text has size 0 and takes nothing whatever its copies; a null source is a source
    of its own; repeated rows of an id draw alike; a null id draws as the empty id.  An empty table
    gives an empty result.  Reruns agree: draws depend on the id alone.
    """
    sizes = stored(sized(docs, id_col, text_col, source_col), "sizes")
    rows = _with_copies(sizes, stored(source_targets(sizes, weights, share, most), "targets"), "doc_id", "source", seed)
    return rows.select("doc_id", "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
                       F.col("__copies").alias("copies"), (F.col("size") * F.col("__copies")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = "mix") -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it; the columns stay."""
    targets = stored(source_targets(sized(docs, id_col, text_col, source_col), weights, share, most), "targets")
    rows = _with_copies(docs, targets, id_col, source_col, seed)
    rows = rows.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__copies").cast("int"))))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


#: The same rows in DuckDB SQL.
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, source_size * 2.0::DOUBLE AS most,
         ([3.0, 1.0, 2.0]::DOUBLE[])[((row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         sum(source_size) OVER () * 1.5::DOUBLE AS goal
  FROM sources
), levels AS (
  SELECT *, coalesce(sum(most) OVER (ORDER BY most / weight, source COLLATE "C" NULLS LAST
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS spent,
         sum(weight) OVER (ORDER BY most / weight, source COLLATE "C" NULLS LAST
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM weighed
), marked AS (
  SELECT *, most * rest <= weight * (goal - spent) AS stopped FROM levels
), targets AS (
  SELECT source, source_size,
         CASE WHEN stopped THEN most
              ELSE weight * (goal - sum(CASE WHEN stopped THEN most ELSE 0.0 END) OVER ())
                   / sum(CASE WHEN stopped THEN 0.0 ELSE weight END) OVER () END AS target
  FROM marked
), rated AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS draw
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
       (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies,
       (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
"""
