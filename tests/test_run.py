"""End to end: one table, two tables, CSV detection, result sink."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.plans.run import RunParams, compare_runs, run_analysis, run_and_write
from quarry.sources import csv as csvsrc

FAST = RunParams(n_init=1, num_trees=10, forest_depth=5, k_max=4)


def _table(spark, n=240, seed=0, continuous=False):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a = float(rng.normal(50, 10))
        b = int(rng.integers(0, 30))
        city = ["Lima", "Cusco", "Piura"][i % 3]
        spend = a * 3 + b + float(rng.normal(0, 5))
        y = spend if continuous else int(spend > 165)
        rows.append((f"{a:.2f}".replace(".", ","), b, city if i % 17 else " N/A ", y))
    t = "double" if continuous else "int"
    return spark.createDataFrame(rows, f"edad string, visitas long, ciudad string, respuesta {t}")


def test_binary_run(spark):
    res = run_analysis(_table(spark), "a", FAST)
    assert res.target == "respuesta"
    tab = {(r["model"], r["split"]): r for r in res.table.collect()}
    assert set(tab) == {("baseline", "val"), ("decision_tree", "val"), ("decision_tree", "test"),
                        ("random_forest", "val"), ("random_forest", "test")}
    assert tab[("baseline", "val")]["auc"] is None
    assert tab[("decision_tree", "test")]["accuracy"] > 0.6
    audit = {(r["column"], r["change"]) for r in res.tables["cleaning_audit"].collect()}
    assert ("edad", "to_numeric") in audit and ("ciudad", "null_markers") in audit
    assert res.tables["roc_curve"].count() > 0
    cs = res.clustering.first()
    assert 2 <= cs["kmeans_k"] <= 4 and -1 <= cs["kmeans_silhouette"] <= 1
    assert 2 <= cs["ward_k"] <= 4


def test_continuous_target_is_binned(spark):
    res = run_analysis(_table(spark, continuous=True), "c", FAST)
    assert res.target == "respuesta_cat"
    dist = {r["class"]: r["n"] for r in res.tables["target_distribution"].collect()}
    assert set(dist) == {"Bajo", "Medio", "Alto"} and sum(dist.values()) == 240
    assert "top_confusions" in res.tables and "class_performance" in res.tables


def test_two_tables_and_sink(spark):
    a = run_analysis(_table(spark, seed=1), "A", FAST)
    b = run_analysis(_table(spark, seed=2), "B", FAST)
    cmp = compare_runs(a, b)
    assert cmp["compare_models"].count() == 4
    w = cmp["compare_winner"].first()
    assert w["winner"] in ("A", "B") and w["diff"] >= 0
    out = tempfile.mkdtemp(prefix="quarry-sink-")
    listing = run_and_write([("A", _table(spark, seed=1)), ("B", _table(spark, seed=2))], out, FAST)
    names = {(r["dataset"], r["table"]) for r in listing.collect()}
    assert ("comparison", "compare_models") in names and ("A", "comparison_table") in names
    assert os.path.isdir(os.path.join(out, "dataset_2", "confusion_matrix"))


@pytest.mark.parametrize("sep,enc", [(",", "utf-8"), (";", "utf-8"), (";", "latin-1")])
def test_csv_detection(spark, sep, enc):
    d = tempfile.mkdtemp(prefix="quarry-csv-")
    text = sep.join(["edad", "ciudad", "monto"]) + "\n" + "\n".join(
        sep.join([str(20 + i), "Ñuñoa" if i % 2 else "Lima", f"{i}.5"]) for i in range(20)) + "\n"
    with open(os.path.join(d, "t.csv"), "wb") as f:
        f.write(text.encode(enc))
    df, got_sep, got_enc = csvsrc.csv_autodetect(spark, d)
    assert got_sep == sep and got_enc.lower().replace("iso-8859-1", "latin-1") == enc
    typed = csvsrc.load_csv(spark, d)
    assert [f.dataType.simpleString() for f in typed.schema.fields] == ["bigint", "string", "double"]
    assert typed.where(F.col("ciudad") == "Ñuñoa").count() == 10
