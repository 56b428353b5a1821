"""Edge tables: empty, one row, one class, all-null and constant columns, unseen category, ties."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry.operators import clean, discretize as D, features as X, metrics as M, profile as P
from quarry.operators import order_stats
from quarry.operators.split import stratified_split


def test_empty_table(spark):
    df = spark.createDataFrame([], "a string, b double")
    assert P.shape(df).first()["n_rows"] == 0
    assert P.null_counts(df).count() == 0
    r = clean.clean_table(df)
    assert r.table.count() == 0
    assert order_stats.quantiles(df, "b", [0.5]).count() == 0


def test_one_row_and_one_class(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "id long, y string, v double")
    s = stratified_split(df, "y", ["id"]).table.collect()
    assert len(s) == 1 and s[0]["split"] == "test"
    df2 = spark.createDataFrame([(i, "only", float(i)) for i in range(10)], "id long, y string, v double")
    s2 = stratified_split(df2, "y", ["id"]).table.groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in s2} == {"test": 2, "val": 2, "train": 6}


def test_all_null_and_constant_columns(spark):
    df = spark.createDataFrame([(i, None, 5.0, "a") for i in range(6)], "id long, z double, c double, s string")
    df = df.withColumn("split", F.lit("train"))
    fm = X.fit_features(df, ["z", "c"], ["s"])
    assert fm.numeric == ["c"] and fm.moments["c"] == (5.0, 1.0)
    vals = fm.transform(df).select(vector_to_array("features").alias("f")).collect()
    assert all(r["f"] == [0.0, 1.0] for r in vals)
    e = D.uniform_edges(df, "c", 3)
    assert e[0] < 5.0 < e[-1]


def test_unseen_category_and_tied_modes(spark):
    rows = [(1, "b", "train"), (2, "a", "train"), (3, None, "train"), (4, "new", "test"), (5, None, "test")]
    df = spark.createDataFrame(rows, "id long, s string, split string")
    fm = X.fit_features(df, [], ["s"])
    assert fm.modes == {"s": "a"}
    got = {r["id"]: r["f"] for r in fm.transform(df).select("id", vector_to_array("features").alias("f")).collect()}
    assert got[4] == [0.0, 0.0] and got[5] == [1.0, 0.0] and got[3] == [1.0, 0.0]


def test_null_target_rows_left_out(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i % 2) for i in range(40)], "id long, y int")
    s = stratified_split(df, "y", ["id"])
    assert s.dropped_null_target == 10 and s.table.count() == 30


def test_duplicate_quantile_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 1, 1, 1, 1, 1, 2, 3]], "x double")
    b = D.bin_quantile(df, "x", 3)
    assert b.edges == [1.0, 1.6666666666666665, 3.0] or len(b.edges) < 4
    assert len(b.labels) == len(b.edges) - 1


def test_predicted_class_absent_from_real(spark):
    rows = [("m", "a", "a"), ("m", "a", "c"), ("m", "b", "b")]
    cm = M.confusion(spark.createDataFrame(rows, "model string, y string, pred string"))
    assert cm.count() == 9
    s = M.summary(cm).first()
    assert s["accuracy"] == pytest.approx(2 / 3)
    assert s["balanced_accuracy"] == pytest.approx(0.75)


def test_too_small_for_clustering(spark):
    from quarry.operators import cluster as K
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 0.0])], "id long, v array<double>")
    sw = K.kmeans_sweep(K.embeddings_features(df, "v"), "features", 2, 6, n_init=1, key_cols=["id"])
    assert sw.best_k is None and sw.table.count() == 0


def test_comparison_with_skipped_clustering(spark):
    from quarry.operators import compare as Q
    a = spark.createDataFrame([(0.4431, 2, 0.4428, 2)], "kmeans_silhouette double, kmeans_k int, "
                                                       "ward_silhouette double, ward_k int")
    b = spark.createDataFrame([(None, None, None, None)], "kmeans_silhouette double, kmeans_k int, "
                                                        "ward_silhouette double, ward_k int")
    rows = {r["metric"]: (r["value_a"], r["value_b"]) for r in Q.compare_clustering(a, b).collect()}
    assert rows["kmeans_silhouette"] == (0.4431, None) and rows["ward_k"] == (2.0, None)
    assert Q.compare_silhouette(a, b).first()["winner"] == "B"
    t = spark.createDataFrame([("A", "tree", 1, 0.8, 0.7, None), ("B", "tree", 1, 0.9, 0.6, 0.7)],
                              "dataset string, model string, ord int, accuracy double, f1 double, auc double")
    d = Q.metric_deltas(t).first()
    assert d["auc_delta"] is None and d["accuracy_pp"] == pytest.approx(10.0) and d["f1_delta"] == pytest.approx(-0.1)
    m = {(r["metric"], r["dataset"]): r["value"] for r in Q.metric_matrix(t).collect()}
    assert m[("auc", "A")] == 0.0
