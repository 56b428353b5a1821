"""Ordinary input that the fixtures do not hold: huge counts, odd numbers, repeated keys, awkward names, CSV text."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from quarry.operators import metrics as M
from quarry.operators import order_stats, split
from quarry.operators.clean import numeric_text_columns
from quarry.operators.discretize import discretize_target
from quarry.operators.features import fit_features
from quarry.operators.split import split_sizes, stratified_split
from quarry.plans.run import RunParams, run_analysis
from quarry.sources.csv import csv_autodetect, load_csv, nan_to_null

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIGHT = dict(n_init=1, k_max=3, num_trees=5, forest_depth=4, micro=20)


def test_counts_past_64_bits(spark):
    n = 4_000_000_000_000
    cm = spark.createDataFrame([("m", a, b, 3 * n if a == b else n) for a in (0, 1) for b in (0, 1)],
                               "model string, real int, predicted int, n long")
    s = M.summary(cm).first()
    assert s["accuracy"] == pytest.approx(0.75) and s["kappa"] == pytest.approx(0.5) and s["mcc"] == pytest.approx(0.5)


@pytest.mark.parametrize("grid", [order_stats.GRID, 4])
def test_quantiles_with_infinity_and_nan(spark, grid, monkeypatch):
    monkeypatch.setattr(order_stats, "GRID", grid)
    rows = [(float(i),) for i in range(500)] + [(float("inf"),), (float("-inf"),), (float("nan"),), (None,), (1e308,), (-1e308,)]
    df = spark.createDataFrame(rows, "v double")
    asks = spark.createDataFrame([(k, k) for k in (1, 2, 3, 252, 503, 504, 505)], "req int, k int")
    got = {r["req"]: r["kth"] for r in order_stats.kth_smallest(df, "v", asks).collect()}
    assert got[1] == float("-inf") and got[2] == -1e308 and got[3] == 0.0 and got[252] == 249.0
    assert got[503] == 1e308 and got[504] == float("inf") and got[505] != got[505]
    clean = nan_to_null(df).where(F.abs("v") < 1e300)
    assert order_stats.quantiles(clean, "v", [0.5]).first()["q"] == 249.5


@pytest.mark.parametrize("deviations", [split.DEVIATIONS, 0])
def test_split_sizes_with_repeated_keys(spark, deviations, monkeypatch):
    monkeypatch.setattr(split, "DEVIATIONS", deviations)
    for rows in ([(7, 0)] * 100 + [(i, 0) for i in range(100, 200)], [(1, i % 2) for i in range(90)], [(i % 4, i % 3) for i in range(101)]):
        df = spark.createDataFrame(rows, "id int, y int").repartition(5)
        table = stratified_split(df, "y", ["id"]).table
        got = {(r["y"], r["split"]): r["n"] for r in table.groupBy("y", "split").agg(F.count(F.lit(1)).alias("n")).collect()}
        classes = sorted({y for _, y in rows})
        sizes = split_sizes([sum(y == c for _, y in rows) for c in classes])
        for c, (n_test, n_val, n_train) in zip(classes, sizes):
            assert [got.get((c, s), 0) for s in ("test", "val", "train")] == [n_test, n_val, n_train]


@pytest.mark.parametrize("target,others", [("label", ["features", "split"]), ("y", ["score", "model"]), ("clase", ["a.b", "pred"])])
def test_run_with_awkward_names(spark, target, others):
    df = spark.range(120).select(F.col("id").cast("double").alias(others[0]), F.concat(F.lit("v"), F.col("id") % 3).alias(others[1]),
                                 (F.col("id") % 2).cast("int").alias(target))
    res = run_analysis(df, "t", RunParams(target=target, **LIGHT))
    assert res.target == target
    names = {r["feature"] for r in res.tables["feature_names"].collect()}
    assert others[0] in names
    assert {r["metric"] for r in res.tables["kpi_bands"].collect()} >= {"auc", "kappa", "silhouette"}
    assert res.tables["run_facts"].first()["dropped_null_target"] == 0
    assert {r["column"] for r in res.tables["cluster_profile"].collect()} == {others[0]}


def test_run_without_numeric_or_categorical_columns(spark):
    cat = spark.range(80).select(F.concat(F.lit("v"), F.col("id") % 5).alias("a"), F.concat(F.lit("w"), F.col("id") % 7).alias("b"),
                                 (F.col("id") % 2).cast("int").alias("target"))
    assert run_analysis(cat, "c", RunParams(**LIGHT)).tables["cluster_profile"].count() == 0
    num = spark.range(80).select(F.rand(1).alias("a"), F.rand(2).alias("b"),
                                 F.when(F.col("id") % 9 > 0, (F.col("id") % 2).cast("int")).alias("target"))
    res = run_analysis(num, "n", RunParams(clean=False, **LIGHT))
    assert res.tables["run_facts"].first()["dropped_null_target"] == 9


def test_wide_category_is_hashed_not_dropped(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("code"), F.lit("train").alias("split"))
    fm = fit_features(df, [], ["code"], max_slots=32)
    assert fm.hashed == ["code"] and len(fm.names) <= 32
    v = fm.transform(df).select("features").collect()
    assert all(sum(r["features"].toArray()) == 1.0 for r in v)


def test_continuity_decision(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("few"), (F.col("id") / 7).alias("many"), (F.col("id") % 20).alias("small"))
    assert [discretize_target(df, c).continuous for c in ("few", "many", "small")] == [False, True, False]


def test_dotted_column(spark):
    df = spark.createDataFrame([("1,5", "x")], "`a.b` string, c string")
    assert {r["column"]: r["is_numeric"] for r in numeric_text_columns(df).collect()} == {"a.b": True, "c": False}


def test_csv_text(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('a,b,c\n1,"a ""q"" b, c",2\n3,"two\nlines",99999999999999999999\n4,short\n')
    rows = {r["a"]: r for r in load_csv(spark, str(path)).collect()}
    assert rows[1]["b"] == 'a "q" b, c' and rows[3]["b"] == "two\nlines" and rows[4]["c"] is None
    assert rows[3]["c"] == 1e20
    surplus = tmp_path / "s.csv"
    surplus.write_text("a;b\n1;x,y,z\n2;u\n")
    df, sep, _ = csv_autodetect(spark, str(surplus))
    assert sep == ";" and df.count() == 2
    bad = tmp_path / "bad.csv"
    bad.write_text("a,b\n1,2\n2,b,EXTRA\n")
    with pytest.raises(RuntimeError):
        csv_autodetect(spark, str(bad))


def test_job_runs_outside_the_repository(tmp_path):
    for name in ("one",):
        lines = ["x,kind,target", *(f"{i * 1.5},{'ab'[i % 2]},{(i // 3) % 2}" for i in range(60))]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env["PYSPARK_SUBMIT_ARGS"] = "--master local[2] --conf spark.ui.enabled=false --driver-memory 2g pyspark-shell"
    done = subprocess.run([sys.executable, f"{ROOT}/quarry/plans/job.py", "--data", "one.csv", "--output", "out", "--n_init", "1",
                           "--num_trees", "5"],
                          cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1500)
    assert done.returncode == 0, done.stderr[-2000:]
    assert {"dataset_1"} <= set(os.listdir(tmp_path / "out"))
