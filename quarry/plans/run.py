"""The whole analysis of one table, and the comparison of two.

``run_analysis`` builds lazy plans and triggers Spark actions only where a
decision needs a number: the cleaning audit, bin edges, split sizes, train
statistics, model fits and the metric tables.  Every result is a DataFrame
in ``RunResult.tables``; ``write_results`` stores them under one folder.
"""

from __future__ import annotations

import os
import sys
import time
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import classify as C
from quarry.operators import cluster as K
from quarry.operators import compare as Q
from quarry.operators import features as X
from quarry.operators import metrics as M
from quarry.operators import profile as P
from quarry.operators.clean import clean_table
from quarry.operators.discretize import discretize_target
from quarry.operators.schema import classify_columns, column_summary, detect_target, dtype_counts, q
from quarry.operators.split import stratified_split
from quarry.session import materialize
from quarry.sources.sink import write_results
from quarry.workspace import Workspace


@dataclass
class RunParams:
    target: str | None = None
    method: str = "quantile"
    n_bins: int = 3
    cuts: list[float] | None = None
    seed: int = 42
    clean: bool = True
    key_cols: list[str] | None = None
    n_init: int = 10
    k_min: int = 2
    k_max: int = 6
    sample: int = 1000
    micro: int = 500
    tree_depth: int = 6
    num_trees: int = 200
    forest_depth: int = 30
    max_bins: int = 64
    max_classes: int = 1000   # more classes raise, before any costly step
    max_slots: int = 10_000   # one-hot slots of a column; more values share them by hash


#: Names the run gives to columns of its own; a user's column of such a name is renamed inside.
RESERVED = {"split", "features", "label", "model", "ord", "y", "pred", "probs", "score", "cluster", "prediction",
            "probability", "rawprediction"}


@dataclass
class RunResult:
    name: str
    target: str
    rows: int
    cols: int
    tables: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def table(self) -> DataFrame:
        return self.tables["comparison_table"]

    @property
    def clustering(self) -> DataFrame:
        return self.tables["cluster_summary"]


@contextmanager
def _phase(name: str):
    """Wall time per phase on stderr when QUARRY_TIMING is set."""
    t0 = time.perf_counter()
    yield
    if os.environ.get("QUARRY_TIMING"):
        print(f"[quarry] {name}: {time.perf_counter() - t0:.2f}s", file=sys.stderr, flush=True)


def _shown(slot: str, shown: dict[str, str]) -> str:
    """A vector slot's name with the user's own column name."""
    for inside, own in shown.items():
        if slot == inside or slot.startswith(f"{inside}_"):
            return own + slot[len(inside):]
    return slot


def _stage(work: Workspace | None, name: str, rows: list[str], build) -> dict[str, DataFrame]:
    """A stage's tables: kept in the run's folder if it has one, else those of many rows checkpointed."""
    if work:
        return work.stage(name, build)
    return {t: materialize(d) if t in rows else d for t, d in build().items()}


def run_analysis(df: DataFrame, name: str = "dataset", params: RunParams | None = None, work: str | None = None) -> RunResult:
    """The whole run.  With a folder ``work`` its stages (cleaned table, features, clustering, predictions) are
    kept there, and a run that ended early goes on after the last whole one when called again with the same
    table and settings; the results read that folder, so it is removed after they are written
    (``run_and_write`` does)."""
    p = params or RunParams()
    spark = df.sparkSession
    work = Workspace(spark, work, [name, asdict(p), df.dtypes]) if work else None
    t: dict[str, DataFrame] = {}

    # 1. cleaning (one audit aggregate, one projection + dedupe)
    with _phase("clean"):
        if p.clean:
            def cleaned():
                cr = clean_table(df)
                return {"table": cr.table, "audit": cr.audit}
            got = _stage(work, "clean", ["table"], cleaned)
            data, t["cleaning_audit"] = got["table"], got["audit"]  # the one copy that all later steps read
        else:
            data = df
    t["column_summary"] = column_summary(data)
    t["dtype_counts"] = dtype_counts(data)

    # 2. target, 3. discretization
    target = detect_target(data, p.target)
    with _phase("discretize"):
        d = discretize_target(data, target, p.method, p.n_bins, p.cuts)
    data, target = d.table, d.target
    if d.edges is not None:
        t["bin_edges"] = spark.createDataFrame([(i, float(e)) for i, e in enumerate(d.edges)], "idx int, edge double")

    # 4. profile
    t["shape"] = P.shape(data)
    t["null_counts"] = P.null_counts(data)
    t["target_distribution"] = P.target_distribution(data, target)

    # 5. split
    classes = C.class_labels(data, target, p.max_classes)
    inside = {c: f"{c}__column" for c in data.columns if c.lower() in RESERVED}
    shown = {v: k for k, v in inside.items()}
    data = data.withColumnsRenamed(inside)
    target_name, target = target, inside.get(target, target)
    keys = [inside.get(c, c) for c in p.key_cols] if p.key_cols else None
    with _phase("split"):
        sp = stratified_split(data, target, keys, p.seed)
    data = sp.table
    t["split_sizes"] = sp.sizes
    t["run_facts"] = spark.createDataFrame(
        [(name, target_name, d.continuous, d.method, d.threshold, sp.dropped_null_target)],
        "dataset string, target string, continuous boolean, method string, threshold double, dropped_null_target bigint")

    # 6. features, fitted on train only, materialized once for all consumers
    num, cat = classify_columns(data.drop("split"), target)
    if not num and not cat:
        raise ValueError("the table has no column beside its target")
    with _phase("features"):
        def featured():
            fm = X.fit_features(data, num, cat, max_slots=p.max_slots)
            fm.names = [_shown(n, shown) for n in fm.names]
            feats = C.with_label(fm.transform(data), target, classes)
            # what later steps read: the numbers for the profiles, not the raw text columns
            kept = dict.fromkeys([target, "split", *num, *(keys or [])])
            return {"rows": feats.select(*[q(c) for c in kept], "features", "label"), "names": X.feature_names(fm),
                    "hashed": spark.createDataFrame([(shown.get(c, c),) for c in fm.hashed], "column string")}
        got = _stage(work, "features", ["rows"], featured)
        feats, t["feature_names"], t["hashed_features"] = got["rows"], got["names"], got["hashed"]
    train = feats.where(F.col("split") == "train")

    # 7. baseline
    base = X.baseline_majority(feats, target).select(F.lit("baseline").alias("model"), F.lit(0).alias("ord"),
                                                     F.lit("val").alias("split"), "y", "pred")

    # 8. clustering on the train rows
    n_train = train.count()

    def clustered():
        if n_train - 1 < p.k_min:
            return {"cluster_summary": K.cluster_summary(spark, None, None)}
        with _phase("kmeans"):
            sweep = K.kmeans_sweep(train, "features", p.k_min, p.k_max, p.n_init, p.seed, keys, p.sample)
        with _phase("ward"):
            ward = K.ward_clusters(train, "features", p.k_min, p.k_max, p.micro, p.seed, keys, p.sample)
        best = sweep.models[sweep.best_k].transform(train).select(*[q(c) for c in num], "cluster")
        return {"kmeans_sweep": sweep.table, "ward_sweep": ward.table, "linkage": ward.linkage, "assigned": best,
                "cluster_summary": K.cluster_summary(spark, sweep, ward)}
    got = _stage(work, "clustering", [], clustered)
    best = got.pop("assigned", None)
    t.update(got)
    if best is not None:
        t["cluster_profile"] = K.cluster_profile(best, "cluster", num).replace(shown, subset=["column"]) if shown else (
            K.cluster_profile(best, "cluster", num))
        t["cluster_profile_norm"] = K.cluster_profile_norm(t["cluster_profile"])
        t["cluster_sizes"] = K.cluster_sizes(best, "cluster")

    # 9. models
    def predicted():
        with _phase("tree"):
            tree = C.train_tree(train, classes, p.tree_depth, p.seed, p.max_bins)
        with _phase("forest"):
            forest = C.train_forest(train, classes, p.num_trees, p.forest_depth, p.seed, p.max_bins)
        evalrows = feats.where(F.col("split") != "train")
        preds = [C.predict(model, evalrows, target, ["split"]).withColumn("ord", F.lit(order))
                 for order, model in ((1, tree), (2, forest))]
        names = [r["feature"] for r in t["feature_names"].orderBy("idx").collect()]
        return {"rows": reduce(DataFrame.unionByName, preds), "importance": C.feature_importance(forest, names, 15)}
    with _phase("models"):
        got = _stage(work, "models", ["rows"], predicted)
    preds, t["feature_importance"] = got["rows"], got["importance"]

    # 10. evaluation
    allp = preds.select("model", "ord", "split", "y", "pred").unionByName(base)
    summ = M.summary(M.confusion(allp, ["model", "ord", "split"]), ["model", "ord", "split"])
    binary = len(classes) == 2
    if binary:
        auc = M.auc_binary(preds, ["model", "split"], "y", "score", positive=classes[-1])
        t["roc_curve"] = M.roc_curve(preds.where(F.col("split") == "test"), ["model"], "y", "score",
                                     positive=classes[-1])
    else:
        auc = M.auc_ovr_weighted(preds, classes, ["model", "split"])
    table = summ.join(auc, ["model", "split"], "left").select("model", "ord", "split", "accuracy", "f1", "auc")
    t["comparison_table"] = table
    t["executive_summary"] = M.executive_summary(table)

    # 11. the best test model in depth
    best_name = M.best_model(table).first()["model"]
    test = preds.where((F.col("split") == "test") & (F.col("model") == best_name))
    cm = M.confusion(test, ["model"])
    t["confusion_matrix"] = cm
    t["confusion_normalized"] = M.confusion_normalized(cm)
    t["classification_report"] = M.classification_report(cm)
    t["metrics_global"] = M.summary(cm)
    if binary:
        bm = M.binary_metrics(cm)
        t["binary_metrics"] = bm
        t["rates_per_100"] = M.rates_per_100(bm)
        t["recommendations"] = M.binary_recommendations(bm)
    else:
        cp = M.class_performance(cm)
        tc = M.top_confusions(cm)
        t["class_performance"] = cp
        t["top_confusions"] = tc
        t["recommendations"] = M.multiclass_recommendations(cp, tc, cm)

    # 12. bands of the headline figures
    best = table.where((F.col("split") == "test") & (F.col("model") == best_name))
    figures = [best.select(F.lit(m).alias("metric"), F.col(c).alias("value")) for m, c in (("auc", "auc"), ("f1_best", "f1"))]
    figures += [t["metrics_global"].select(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("kappa", "mcc")]
    figures += [t["cluster_summary"].select(F.lit("silhouette").alias("metric"), F.col(f"{m}_silhouette").alias("value"))
                for m in ("kmeans", "ward")]
    if binary:
        figures += [bm.select(F.lit(m).alias("metric"), F.col(m).alias("value"))
                    for m in ("accuracy", "precision", "recall", "specificity", "f1", "fpr", "fnr")]
    t["kpi_bands"] = M.kpi_bands(reduce(DataFrame.unionByName, figures))

    rows = t["shape"].first()
    return RunResult(name, target_name, int(rows["n_rows"]), int(rows["n_cols"]), t)


def compare_runs(a: RunResult, b: RunResult) -> dict[str, DataFrame]:
    """Q1..Q6 for two runs."""
    comp = Q.compare_models(a.table, b.table, a.name, b.name)
    return {
        "compare_clustering": Q.compare_clustering(a.clustering, b.clustering, a.name, b.name),
        "compare_models": comp,
        "compare_winner": Q.compare_winner(comp, a.name, b.name),
        "compare_silhouette": Q.compare_silhouette(a.clustering, b.clustering, a.name, b.name),
        "metric_matrix": Q.metric_matrix(comp),
        "metric_deltas": Q.metric_deltas(comp, a.name, b.name),
    }


def run_and_write(dfs: list[tuple[str, DataFrame]], out_dir: str,
                  params: RunParams | list[RunParams] | None = None, fmt: str = "parquet",
                  work: str | None = None) -> DataFrame:
    """S8 + S6: one or two tables, results under ``<out>/dataset_1``, ``dataset_2``, ``comparison``.

    ``params`` is one setting for all tables or one per table (e.g. their own targets).  With a folder
    ``work`` the run can be taken up again after a loss (``run_analysis``); it is removed at the end.
    """
    spark = dfs[0][1].sparkSession
    plist = params if isinstance(params, list) else [params] * len(dfs)
    folders = [f"{work.rstrip('/')}/dataset_{i}" if work else None for i in range(1, len(dfs) + 1)]
    runs = [run_analysis(df, name, p, folder) for (name, df), p, folder in zip(dfs, plist, folders)]
    listing = None
    for i, r in enumerate(runs, start=1):
        part = write_results(spark, r.tables, f"{out_dir.rstrip('/')}/dataset_{i}", fmt)
        part = part.withColumn("dataset", F.lit(r.name))
        listing = part if listing is None else listing.unionByName(part)
    if len(runs) == 2:
        part = write_results(spark, compare_runs(*runs), f"{out_dir.rstrip('/')}/comparison", fmt)
        listing = listing.unionByName(part.withColumn("dataset", F.lit("comparison")))
    if work:
        Workspace(spark, work).remove()
    return listing
