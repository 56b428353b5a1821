"""Classification metrics and evaluation tables.

Row-level predictions are touched exactly once: one grouped count per
(model, real, predicted) for everything confusion-based, and one grouped
count per (model, score) for ROC / AUC.  All later steps work on those
small tables.  ROC and AUC use exact cumulative counts over distinct
scores (:func:`quarry.operators.order_stats.running_sums`), never a window
over all rows of a model.

Prediction tables have the columns ``y`` (real label), ``pred`` (predicted
label) and, for ROC / AUC, ``score`` (score of the positive class) or
``probs`` (array of class probabilities in sorted label order), plus any
grouping columns such as ``model`` and ``split``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.numeric import EPS, div0
from quarry.operators import order_stats
from quarry.operators.schema import exclude_matching


def confusion(pred: DataFrame, by: Sequence[str] = ("model",), y: str = "y", p: str = "pred") -> DataFrame:
    """Counts real x predicted per group, completed with zero cells.

    The label set of a group is the union of its real and predicted labels.
    """
    by = list(by)
    counts = (pred.where(F.col(y).isNotNull() & F.col(p).isNotNull())
              .groupBy(*by, F.col(y).alias("real"), F.col(p).alias("predicted"))
              .agg(F.count(F.lit(1)).alias("n")))
    # the only pass over the rows; everything after works on this small table
    counts = order_stats.freeze(counts)
    labels = (counts.select(*by, F.col("real").alias("label"))
              .unionByName(counts.select(*by, F.col("predicted").alias("label"))).distinct()
              .groupBy(*by).agg(F.sort_array(F.collect_list("label")).alias("labels")))
    grid = (labels.select(*by, F.explode("labels").alias("real"), "labels")
            .select(*by, "real", F.explode("labels").alias("predicted")))
    return (grid.join(counts, [*by, "real", "predicted"], "left")
            .select(*by, "real", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def class_totals(cm: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Per group and label: tp, real count (support), predicted count, and the group total."""
    by = list(by)
    real = cm.groupBy(*by, F.col("real").alias("label")).agg(F.sum("n").alias("real_n"))
    predn = cm.groupBy(*by, F.col("predicted").alias("label")).agg(F.sum("n").alias("pred_n"))
    tp = cm.where(F.col("real") == F.col("predicted")).select(*by, F.col("real").alias("label"),
                                                             F.col("n").alias("tp"))
    t = real.join(predn, [*by, "label"]).join(tp, [*by, "label"])
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    return t.withColumn("total", F.sum("real_n").over(w))


def per_class(cm: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Precision, recall, F1 per class with 0/0 -> 0 (scikit-learn's zero_division=0)."""
    t = class_totals(cm, by)
    prec = div0(F.col("tp").cast("double"), F.col("pred_n"))
    rec = div0(F.col("tp").cast("double"), F.col("real_n"))
    t = t.withColumn("precision", prec).withColumn("recall", rec)
    f1 = div0(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return t.withColumn("f1", f1)


def summary(cm: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Accuracy, weighted F1, macro F1, balanced accuracy, kappa, MCC per group."""
    by = list(by)
    pc = per_class(cm, by)
    real, predicted = F.col("real_n").cast("double"), F.col("pred_n").cast("double")
    s = pc.groupBy(*by).agg(
        F.sum("tp").alias("c"), F.first("total").alias("s"),
        F.sum(F.col("f1") * F.col("real_n")).alias("_wf1"), F.avg("f1").alias("f1_macro"),
        F.avg(F.when(F.col("real_n") > 0, F.col("recall"))).alias("balanced_accuracy"),
        # products of counts pass 64 bits from 3e9 rows a class on
        F.sum(real * predicted).alias("_tp"), F.sum(predicted * predicted).alias("_pp"), F.sum(real * real).alias("_tt"))
    c, n = F.col("c").cast("double"), F.col("s").cast("double")
    pe = F.col("_tp") / (n * n)
    po = c / n
    mcc_den = F.sqrt((n * n - F.col("_pp")) * (n * n - F.col("_tt")))
    return s.select(
        *by, F.col("s").cast("long").alias("n"), po.alias("accuracy"), (F.col("_wf1") / n).alias("f1"),
        "f1_macro", "balanced_accuracy",
        F.try_divide(po - pe, 1 - pe).alias("kappa"),
        F.coalesce(F.try_divide(c * n - F.col("_tp"), mcc_den), F.lit(0.0)).alias("mcc"))


def _scored(scores: DataFrame, by: list[str], y: str, score: str, positive=None) -> DataFrame:
    if positive is None and not by:
        positive = scores.agg(F.max(y)).first()[0]
    if positive is None:
        # one row per group (models x classes): bounded, broadcast
        pos = scores.groupBy(*by).agg(F.max(y).alias("_pos"))
        s = scores.join(F.broadcast(pos), by)
        is_pos = F.col(y) == F.col("_pos")
    else:
        s = scores
        is_pos = F.col(y) == F.lit(positive)
    agg = (s.where(F.col(y).isNotNull() & F.col(score).isNotNull())
           .groupBy(*by, F.col(score).cast("double").alias("score"))
           .agg(F.count_if(is_pos).alias("p"), F.count_if(~is_pos).alias("q")))
    return order_stats.freeze(agg)


def auc_binary(scores: DataFrame, by: Sequence[str] = ("model",), y: str = "y", score: str = "score",
               positive=None) -> DataFrame:
    """M5: P(score of a positive > score of a negative), ties count 1/2; positive = largest label.

    Uses counts per distinct score and their exact cumulative sums.
    """
    by = list(by)
    agg = _scored(scores, by, y, score, positive)
    cum = order_stats.running_sums(agg, by, "score", ["q"])
    res = cum.groupBy(*by).agg(
        F.sum(F.col("p") * (F.col("cum_q") - F.col("q") + 0.5 * F.col("q"))).alias("_u"),
        F.sum("p").alias("_p"), F.sum("q").alias("_q"))
    return res.select(*by, F.try_divide(F.col("_u"), F.col("_p").cast("double") * F.col("_q")).alias("auc"),
                      F.col("_p").alias("n_pos"), F.col("_q").alias("n_neg"))


def roc_curve(scores: DataFrame, by: Sequence[str] = ("model",), y: str = "y", score: str = "score",
              positive=None) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, highest threshold first."""
    by = list(by)
    agg = _scored(scores, by, y, score, positive)
    cum = order_stats.running_sums(agg, by, "score", ["p", "q"], descending=True)
    if by:
        # totals per group: one small aggregate, joined back (bounded by the number of groups)
        tot = agg.groupBy(*by).agg(F.sum("p").alias("_P"), F.sum("q").alias("_N"))
        cum = cum.join(F.broadcast(tot), by)
    else:
        P, N = agg.agg(F.sum("p"), F.sum("q")).first()
        cum = cum.withColumn("_P", F.lit(P)).withColumn("_N", F.lit(N))
    return cum.select(*by, F.col("score").alias("threshold"),
                      F.try_divide(F.col("cum_q").cast("double"), F.col("_N")).alias("fpr"),
                      F.try_divide(F.col("cum_p").cast("double"), F.col("_P")).alias("tpr"))


def auc_ovr_weighted(probs: DataFrame, classes: list, by: Sequence[str] = ("model",), y: str = "y",
                     prob: str = "probs") -> DataFrame:
    """M6: one-vs-rest AUC per class of its probability, weighted by class prevalence."""
    by = list(by)
    cls = F.array(*[F.lit(c) for c in classes])
    long = (probs.select(*by, y, F.posexplode(prob).alias("k", "score"))
            .withColumn("_cls", F.element_at(cls, F.col("k") + 1))
            .withColumn("_is", (F.col(y) == F.col("_cls")).cast("int")))
    j = auc_binary(long, [*by, "k"], "_is", "score", positive=1).withColumnRenamed("n_pos", "_w")
    return j.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("auc") * F.col("_w")), F.sum(F.when(F.col("auc").isNotNull(), F.col("_w"))))
        .alias("auc"))


def binary_metrics(cm: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """TP TN FP FN and the rates, each denominator + 1e-9; positive = larger label."""
    by = list(by)
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    t = cm.withColumn("_pos", F.max("real").over(w)).withColumn("_pos2", F.max("predicted").over(w))
    pos = F.greatest(F.col("_pos"), F.col("_pos2"))
    real_pos = F.col("real") == pos
    pred_pos = F.col("predicted") == pos
    a = t.groupBy(*by).agg(
        F.sum(F.when(real_pos & pred_pos, F.col("n")).otherwise(0)).alias("TP"),
        F.sum(F.when(~real_pos & ~pred_pos, F.col("n")).otherwise(0)).alias("TN"),
        F.sum(F.when(~real_pos & pred_pos, F.col("n")).otherwise(0)).alias("FP"),
        F.sum(F.when(real_pos & ~pred_pos, F.col("n")).otherwise(0)).alias("FN"))
    tp, tn, fp, fn = [F.col(c).cast("double") for c in ("TP", "TN", "FP", "FN")]
    return a.select(
        *by, *[F.col(c).cast("long").alias(c) for c in ("TP", "TN", "FP", "FN")],
        (tp / (tp + fp + EPS)).alias("precision"), (tp / (tp + fn + EPS)).alias("recall"),
        (tn / (tn + fp + EPS)).alias("specificity"), (tn / (tn + fn + EPS)).alias("npv"),
        (2 * tp / (2 * tp + fp + fn + EPS)).alias("f1"),
        ((tp + tn) / (tp + tn + fp + fn + EPS)).alias("accuracy"),
        (fp / (fp + tn + EPS)).alias("fpr"), (fn / (fn + tp + EPS)).alias("fnr"))


def f1_binary(cm: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """F1 of the positive (larger) label, 0/0 -> 0."""
    by = list(by)
    pc = per_class(cm, by)
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    return (pc.withColumn("_pos", F.max("label").over(w)).where(F.col("label") == F.col("_pos"))
            .select(*by, "f1"))


def confusion_normalized(cm: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """E5: cell / (row sum + 1e-9), half-even to 3 decimals."""
    by = list(by)
    w = Window.partitionBy(*by, "real")
    return cm.select(*by, "real", "predicted",
                     F.bround(F.col("n") / (F.sum("n").over(w) + EPS), 3).alias("share"))


def classification_report(cm: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Per class precision / recall / F1 / support, then accuracy, macro and weighted averages."""
    by = list(by)
    pc = per_class(cm, by)
    rows = pc.select(*by, F.col("label").cast("string").alias("label"), F.lit(0).alias("ord"),
                     "precision", "recall", "f1", F.col("real_n").cast("long").alias("support"))
    agg = pc.groupBy(*by).agg(
        F.sum("tp").alias("_c"), F.first("total").alias("_n"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        F.sum(F.col("precision") * F.col("real_n")).alias("wp"),
        F.sum(F.col("recall") * F.col("real_n")).alias("wr"),
        F.sum(F.col("f1") * F.col("real_n")).alias("wf"))
    n = F.col("_n").cast("double")
    accuracy = agg.select(*by, F.lit("accuracy").alias("label"), F.lit(1).alias("ord"),
                          F.lit(None).cast("double").alias("precision"), F.lit(None).cast("double").alias("recall"),
                          (F.col("_c") / n).alias("f1"), F.col("_n").cast("long").alias("support"))
    macro = agg.select(*by, F.lit("macro avg").alias("label"), F.lit(2).alias("ord"), F.col("mp").alias("precision"),
                       F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("_n").cast("long").alias("support"))
    weighted = agg.select(*by, F.lit("weighted avg").alias("label"), F.lit(3).alias("ord"),
                          (F.col("wp") / n).alias("precision"), (F.col("wr") / n).alias("recall"),
                          (F.col("wf") / n).alias("f1"), F.col("_n").cast("long").alias("support"))
    return rows.unionByName(accuracy).unionByName(macro).unionByName(weighted)


def class_performance(cm: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Per class precision, recall, F1 (each + 1e-9) and cases; best and worst class by recall.

    Ties pick the first class in label order.
    """
    by = list(by)
    t = class_totals(cm, by)
    prec = F.col("tp") / (F.col("pred_n") + EPS)
    rec = F.col("tp") / (F.col("real_n") + EPS)
    t = t.withColumn("precision", prec).withColumn("recall", rec)
    t = t.withColumn("f1", 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + EPS))
    wb = Window.partitionBy(*by).orderBy(F.col("recall").desc(), F.col("label"))
    ww = Window.partitionBy(*by).orderBy(F.col("recall").asc(), F.col("label"))
    return t.select(*by, "label", "precision", "recall", "f1", F.col("real_n").cast("long").alias("cases"),
                    (F.row_number().over(wb) == 1).cast("int").alias("is_best"),
                    (F.row_number().over(ww) == 1).cast("int").alias("is_worst"))


def top_confusions(cm: DataFrame, by: Sequence[str] = ("model",), k: int = 5) -> DataFrame:
    """Off-diagonal cells > 0, ordered by (count, real, predicted) all descending, first k.

    ``pct`` is the share of the real class, half-even to 1 decimal.
    """
    by = list(by)
    w_real = Window.partitionBy(*by, "real")
    t = cm.withColumn("_rt", F.sum("n").over(w_real))
    off = t.where((F.col("real") != F.col("predicted")) & (F.col("n") > 0))
    w = Window.partitionBy(*by).orderBy(F.col("n").desc(), F.col("real").desc(), F.col("predicted").desc())
    return (off.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(*by, "rank", "real", "predicted", "n",
                    F.bround(F.try_divide(100.0 * F.col("n"), F.col("_rt")), 1).alias("pct")))


def binary_recommendations(bm: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """The rule rows that fire on the binary metrics, else 'acceptable'."""
    by = list(by)
    rules = F.array_compact(F.array(
        F.when(F.col("recall") < 0.5, F.lit("low_recall")),
        F.when(F.col("precision") < 0.5, F.lit("low_precision")),
        F.when(F.col("fpr") > 0.3, F.lit("high_false_alarm")),
        F.when(F.abs(F.col("precision") - F.col("recall")) > 0.2, F.lit("precision_recall_gap")),
        F.when((F.col("accuracy") > 0.85) & (F.col("f1") < 0.5), F.lit("accuracy_hides_imbalance"))))
    r = bm.select(*by, F.when(F.size(rules) > 0, rules).otherwise(F.array(F.lit("acceptable"))).alias("_r"))
    return r.select(*by, F.posexplode("_r").alias("idx", "rule"))


def multiclass_recommendations(cp: DataFrame, tc: DataFrame, cm: DataFrame,
                               by: Sequence[str] = ("model",)) -> DataFrame:
    """Worst recall < 0.4; top confusion > 0.3 * total / classes; else 'reasonable'."""
    by = list(by)
    worst = cp.where(F.col("is_worst") == 1).select(*by, F.col("label").cast("string").alias("worst"),
                                                    F.col("recall").alias("worst_recall"))
    top = tc.where(F.col("rank") == 1).select(*by, F.col("n").alias("top_n"),
                                              F.col("real").cast("string").alias("top_real"),
                                              F.col("predicted").cast("string").alias("top_pred"))
    size = cm.groupBy(*by).agg(F.sum("n").alias("_tot"), F.countDistinct("real").alias("_k"))
    j = size.join(worst, by, "left").join(top, by, "left")
    rules = F.array_compact(F.array(
        F.when(F.col("worst_recall") < 0.4, F.concat(F.lit("hard_class:"), F.col("worst"))),
        F.when(F.col("top_n") > 0.3 * F.col("_tot") / F.col("_k"),
               F.concat(F.lit("top_confusion:"), F.col("top_real"), F.lit("->"), F.col("top_pred")))))
    r = j.select(*by, F.when(F.size(rules) > 0, rules).otherwise(F.array(F.lit("reasonable"))).alias("_r"))
    return r.select(*by, F.posexplode("_r").alias("idx", "rule"))


def rates_per_100(bm: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Recall, precision and specificity as whole numbers out of 100 (half-even)."""
    by = list(by)
    return bm.select(*by, *[F.bround(F.col(c) * 100, 0).cast("long").alias(f"{c}_per_100")
                            for c in ("recall", "precision", "specificity")])


def comparison_table(val: DataFrame, test: DataFrame) -> DataFrame:
    """Validation rows then test rows, with their order kept in ``ord``."""
    v = val.withColumn("split", F.lit("val"))
    t = test.withColumn("split", F.lit("test"))
    return v.unionByName(t, allowMissingColumns=True)


def best_model(table: DataFrame, split: str = "test") -> DataFrame:
    """Highest F1 on ``split`` without baseline models; the first in order on a tie."""
    cand = exclude_matching(table.where(F.col("split") == split))
    return cand.orderBy(F.col("f1").desc(), F.col("ord").asc()).limit(1)


def executive_summary(table: DataFrame, split: str = "test") -> DataFrame:
    """Best model with accuracy and F1 in whole percent (half-even), AUC or NULL."""
    b = best_model(table, split)
    return b.select("model", F.bround(F.col("accuracy") * 100, 0).cast("long").alias("accuracy_pct"),
                    F.bround(F.col("f1") * 100, 0).cast("long").alias("f1_pct"), "auc")


def band(metric: Column, value: Column) -> Column:
    """Success / warning / danger (or info) band of one metric."""
    m = F.lower(metric)
    return (F.when(value.isNull(), F.lit(None))
            .when(m == "silhouette", F.when(value > 0.4, "success").otherwise("warning"))
            .when(m == "auc", F.when(value > 0.8, "success").otherwise("info"))
            .when(m == "f1_best", F.when(value > 0.75, "success").when(value > 0.6, "warning").otherwise("danger"))
            .when(m.isin("kappa", "mcc"), F.when(value > 0.6, "success").when(value > 0.3, "warning").otherwise("danger"))
            .when(m.isin("fpr", "fnr"), F.when(value < 0.15, "success").when(value < 0.3, "warning").otherwise("danger"))
            .otherwise(F.when(value > 0.75, "success").when(value > 0.5, "warning").otherwise("danger")))


def kpi_bands(metrics_long: DataFrame) -> DataFrame:
    """E17 over ``(metric, value)`` rows (plus any other columns)."""
    return metrics_long.withColumn("band", band(F.col("metric"), F.col("value")))
