"""Supervised models: decision tree and random forest (Spark ML), predictions, importances.

The class labels are indexed in their natural sorted order, so "positive
class = larger label" and probability vectors line up with sorted labels.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.schema import q

MAX_CLASSES = 1_000


def class_labels(df: DataFrame, target: str, max_classes: int = MAX_CLASSES) -> list:
    """Sorted distinct non-null target values; more than ``max_classes`` raise: the models keep counts
    per class and node, and the labels pass through the driver."""
    vals = df.where(q(target).isNotNull()).select(q(target)).distinct().limit(max_classes + 1).collect()
    if len(vals) > max_classes:
        raise ValueError(f"more than {max_classes} classes: not a classification target (max_classes raises the limit)")
    return sorted(r[0] for r in vals)


def with_label(df: DataFrame, target: str, classes: list, out: str = "label") -> DataFrame:
    """0-based class index as double (NULL for unknown classes)."""
    arr = F.array(*[F.lit(c) for c in classes])
    pos = F.array_position(arr, q(target))
    return df.withColumn(out, F.when(pos > 0, (pos - 1).cast("double")))


@dataclass
class Trained:
    name: str
    model: object
    classes: list


def train_tree(train: DataFrame, classes: list, max_depth: int = 6, seed: int = 42,
               max_bins: int = 64, features: str = "features", label: str = "label") -> Trained:
    """M1: Gini tree of limited depth."""
    m = DecisionTreeClassifier(maxDepth=max_depth, seed=seed, maxBins=max_bins, impurity="gini",
                               cacheNodeIds=True, maxMemoryInMB=1024,
                               featuresCol=features, labelCol=label).fit(train.where(F.col(label).isNotNull()))
    return Trained("decision_tree", m, classes)


def train_forest(train: DataFrame, classes: list, num_trees: int = 200, max_depth: int = 30,
                 seed: int = 42, max_bins: int = 64, subset: str = "sqrt",
                 features: str = "features", label: str = "label") -> Trained:
    """M2: bootstrap forest with sqrt feature subsets (Spark's deepest tree is 30 levels)."""
    m = RandomForestClassifier(numTrees=num_trees, maxDepth=min(max_depth, 30), seed=seed, maxBins=max_bins,
                               featureSubsetStrategy=subset, bootstrap=True, impurity="gini",
                               cacheNodeIds=True, maxMemoryInMB=1024,
                               featuresCol=features, labelCol=label).fit(train.where(F.col(label).isNotNull()))
    return Trained("random_forest", m, classes)


def predict(t: Trained, data: DataFrame, target: str, keep: list[str] | None = None,
            features: str = "features") -> DataFrame:
    """Predictions with ``model, y, pred, probs`` (+ ``score`` = probability of the larger label)."""
    arr = F.array(*[F.lit(c) for c in t.classes])
    scored = t.model.transform(data.select(*(keep or []), q(target).alias("y"), features))
    probs = vector_to_array("probability")
    out = scored.select(*(keep or []), F.lit(t.name).alias("model"), "y",
                        F.element_at(arr, F.col("prediction").cast("int") + 1).alias("pred"),
                        probs.alias("probs"))
    n = len(t.classes)
    if n >= 2:
        out = out.withColumn("score", F.element_at("probs", n))
    return out


def feature_importance(t: Trained, names: list[str], top: int | None = 15) -> DataFrame:
    """M8: importances of the fitted forest (or tree) with the feature names, largest first."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    imp = t.model.featureImportances.toArray()
    rows = [(names[i] if i < len(names) else f"f{i}", float(v)) for i, v in enumerate(imp)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    df = df.orderBy(F.col("importance").desc(), F.col("feature"))
    return df.limit(top) if top else df


def class_probability(pred: DataFrame, classes: list, keep: list[str]) -> DataFrame:
    """M9: one row per (row, class) with its probability."""
    arr = F.array(*[F.lit(str(c)) for c in classes])
    return pred.select(*keep, "model", F.posexplode("probs").alias("k", "probability")).select(
        *keep, "model", F.element_at(arr, F.col("k") + 1).alias("class"), "probability")
