"""Comparison of the results of two tables (A and B).

All inputs are the small result tables of two runs (metrics table with
``model, split, accuracy, f1, auc``; one-row cluster summaries), so these
are plain unions, pivots and joins of a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.schema import exclude_matching

METRICS = ["accuracy", "f1", "auc"]


def compare_clustering(a: DataFrame, b: DataFrame, name_a: str = "A", name_b: str = "B") -> DataFrame:
    """Q1: best k and silhouette (4 decimals) of both tables side by side; skipped -> NULL."""
    def long(s: DataFrame, name: str) -> DataFrame:
        stack = F.array(
            F.struct(F.lit(0).alias("ord"), F.lit("kmeans_k").alias("metric"), F.col("kmeans_k").cast("double").alias("v")),
            F.struct(F.lit(1).alias("ord"), F.lit("kmeans_silhouette").alias("metric"),
                     F.round("kmeans_silhouette", 4).alias("v")),
            F.struct(F.lit(2).alias("ord"), F.lit("ward_k").alias("metric"), F.col("ward_k").cast("double").alias("v")),
            F.struct(F.lit(3).alias("ord"), F.lit("ward_silhouette").alias("metric"),
                     F.round("ward_silhouette", 4).alias("v")))
        return s.select(F.explode(stack).alias("s")).select("s.ord", "s.metric", F.col("s.v").alias(name))
    return long(a, "value_a").join(long(b, "value_b"), ["ord", "metric"]).select(
        "ord", "metric", "value_a", "value_b", F.lit(name_a).alias("dataset_a"), F.lit(name_b).alias("dataset_b"))


def compare_models(ta: DataFrame, tb: DataFrame, name_a: str = "A", name_b: str = "B",
                   split: str = "test") -> DataFrame:
    """Q2: test rows of both tables with a ``dataset`` column."""
    cols = ["model", *(["ord"] if "ord" in ta.columns and "ord" in tb.columns else []), *METRICS]
    a = ta.where(F.col("split") == split).select(F.lit(name_a).alias("dataset"), *cols)
    b = tb.where(F.col("split") == split).select(F.lit(name_b).alias("dataset"), *cols)
    return a.unionByName(b)


def compare_winner(comp: DataFrame, name_a: str = "A", name_b: str = "B") -> DataFrame:
    """Q3: mean test F1 without baselines per table; winner, loser and difference (a tie goes to B)."""
    m = (exclude_matching(comp)
         .groupBy("dataset").agg(F.avg("f1").alias("f1_mean")))
    means = {r["dataset"]: r["f1_mean"] for r in m.collect()}
    va, vb = means.get(name_a), means.get(name_b)
    a_wins = va is not None and vb is not None and va > vb
    diff = None if va is None or vb is None else (va - vb if a_wins else vb - va)
    row = (name_a if a_wins else name_b, name_b if a_wins else name_a, va, vb, diff)
    return comp.sparkSession.createDataFrame(
        [row], "winner string, loser string, f1_a double, f1_b double, diff double")


def compare_silhouette(sa: DataFrame, sb: DataFrame, name_a: str = "A", name_b: str = "B") -> DataFrame:
    """Q4: the table with the larger K-means silhouette (a tie, or a missing value, goes to B)."""
    a = sa.first()["kmeans_silhouette"]
    b = sb.first()["kmeans_silhouette"]
    a_wins = a is not None and b is not None and a > b
    spark = sa.sparkSession
    return spark.createDataFrame([(name_a if a_wins else name_b, a, b)],
                                 "winner string, silhouette_a double, silhouette_b double")


def metric_matrix(comp: DataFrame) -> DataFrame:
    """Q5: metric x model x dataset values, NULL -> 0."""
    stack = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in METRICS])
    return (comp.select("dataset", "model", F.explode(stack).alias("s"))
            .select("s.metric", "model", "dataset", F.coalesce(F.col("s.value"), F.lit(0.0)).alias("value")))


def metric_deltas(comp: DataFrame, name_a: str = "A", name_b: str = "B") -> DataFrame:
    """Q6: best test model of each table (highest F1, no baseline, first in order on a tie);
    B - A for accuracy (in points), F1 and AUC (NULL when either AUC is missing or 0)."""
    c = exclude_matching(comp)
    w = Window.partitionBy("dataset").orderBy(F.col("f1").desc(), F.col("ord").asc())
    best = {r["dataset"]: r for r in c.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).collect()}
    a, b = best.get(name_a), best.get(name_b)
    if a is None or b is None:
        row = (a["model"] if a else None, b["model"] if b else None, None, None, None)
    else:
        auc = b["auc"] - a["auc"] if a["auc"] and b["auc"] else None
        row = (a["model"], b["model"], (b["accuracy"] - a["accuracy"]) * 100, b["f1"] - a["f1"], auc)
    return comp.sparkSession.createDataFrame(
        [row], "model_a string, model_b string, accuracy_pp double, f1_delta double, auc_delta double")
