"""Published figures of the reference, reproduced from class counts and matrices (re-typed inline)."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import clean, compare, metrics as M
from quarry.operators.split import split_sizes


@pytest.mark.parametrize("counts,test,val,train", [
    ([149, 251], [30, 50], [30, 50], [89, 151]),
    ([370, 430], [74, 86], [74, 86], [222, 258]),
    ([131, 186, 78], [26, 37, 16], None, None),
])
def test_split_sizes_per_class(counts, test, val, train):
    sizes = split_sizes(counts)
    assert [s[0] for s in sizes] == test
    if val:
        assert [s[1] for s in sizes] == val
        assert [s[2] for s in sizes] == train


@pytest.mark.parametrize("n,parts", [(500, (300, 100, 100)), (800, (480, 160, 160)), (400, (240, 80, 80)),
                                     (395, (237, 79, 79)), (600, (360, 120, 120))])
def test_split_totals(n, parts):
    counts = [n // 3, n // 3, n - 2 * (n // 3)]
    sizes = split_sizes(counts)
    assert (sum(s[2] for s in sizes), sum(s[1] for s in sizes), sum(s[0] for s in sizes)) == parts


def _preds_from_matrix(spark, labels, matrix, model="m"):
    rows = []
    for i, real in enumerate(labels):
        for j, pred in enumerate(labels):
            rows += [(model, real, pred)] * matrix[i][j]
    return spark.createDataFrame(rows, "model string, y string, pred string")


def test_multiclass_matrix_figures(spark):
    labels = ["Alto", "Bajo", "Medio"]
    p = _preds_from_matrix(spark, labels, [[21, 0, 5], [0, 34, 3], [2, 5, 9]])
    cm = M.confusion(p)
    s = M.summary(cm).first()
    assert s["accuracy"] == pytest.approx(0.810127, abs=1e-6)
    assert s["f1"] == pytest.approx(0.811623, abs=1e-6)
    assert round(s["balanced_accuracy"], 3) == 0.763
    assert round(s["kappa"], 3) == 0.698
    assert round(s["mcc"], 3) == 0.700
    top = [(r["real"], r["predicted"], r["n"], r["pct"]) for r in M.top_confusions(cm).orderBy("rank").collect()]
    assert top == [("Medio", "Bajo", 5, 31.2), ("Alto", "Medio", 5, 19.2), ("Bajo", "Medio", 3, 8.1),
                   ("Medio", "Alto", 2, 12.5)]


def test_multiclass_matrix_figures_2(spark):
    p = _preds_from_matrix(spark, ["a", "b", "c"], [[24, 4, 6], [2, 22, 9], [10, 8, 15]])
    s = M.summary(M.confusion(p)).first()
    assert round(s["accuracy"], 3) == 0.610 and round(s["balanced_accuracy"], 3) == 0.609
    assert round(s["kappa"], 3) == 0.415 and round(s["mcc"], 3) == 0.415
    assert s["f1"] == pytest.approx(0.607002, abs=1e-6)


def test_binary_matrix_figures(spark):
    p = _preds_from_matrix(spark, ["0", "1"], [[64, 10], [11, 75]])
    cm = M.confusion(p)
    s = M.summary(cm).first()
    assert s["accuracy"] == pytest.approx(0.86875)
    assert round(s["balanced_accuracy"], 3) == 0.868 and round(s["kappa"], 3) == 0.736
    assert round(s["mcc"], 3) == 0.736
    b = M.binary_metrics(cm).first()
    assert (round(b["precision"], 3), round(b["specificity"], 3), round(b["npv"], 3)) == (0.882, 0.865, 0.853)
    assert (round(b["fpr"], 3), round(b["fnr"], 3)) == (0.135, 0.128)


@pytest.mark.parametrize("val_counts,acc,f1", [
    ({"0": 30, "1": 50}, 0.625, 0.480769), ({"0": 22, "1": 58}, 0.725, 0.609420),
    ({"0": 74, "1": 86}, 0.5375, 0.375813),
])
def test_majority_baseline(spark, val_counts, acc, f1):
    major = max(val_counts, key=lambda k: (val_counts[k], k))
    rows = [("baseline", y, major) for y, n in val_counts.items() for _ in range(n)]
    s = M.summary(M.confusion(spark.createDataFrame(rows, "model string, y string, pred string"))).first()
    assert s["accuracy"] == pytest.approx(acc, abs=1e-6)
    assert s["f1"] == pytest.approx(f1, abs=1e-6)


def test_three_class_baseline(spark):
    rows = [("b", y, "Bajo") for y, n in (("Alto", 34), ("Bajo", 33), ("Medio", 33)) for _ in range(n)]
    s = M.summary(M.confusion(spark.createDataFrame(rows, "model string, y string, pred string"))).first()
    assert s["accuracy"] == pytest.approx(0.33) and s["f1"] == pytest.approx(0.163759, abs=1e-6)


def test_comparison_f1_difference(spark):
    rows = [("A", "Arbol", 0.85625, 0.856447, 0.884664), ("A", "RF", 0.86875, 0.868807, 0.941546),
            ("B", "Arbol", 0.675, 0.670016, 0.597179), ("B", "RF", 0.725, 0.689534, 0.674678)]
    comp = spark.createDataFrame(rows, "dataset string, model string, accuracy double, f1 double, auc double")
    w = compare.compare_winner(comp).first()
    assert w["winner"] == "A" and round(w["diff"], 4) == 0.1829


def test_dirty_table_cleaning(spark):
    # own rows with the same kinds of dirt; the last two repeat the first two
    rows = [
        (1, "34", "S/. 1,500", "12,5", "10%", " Lima ", "si", 1),
        (2, "N/A", "3,500", "15.0", "5%", "lima", "SI", 0),
        (3, "41", "S/.1.250", "8,75", "0%", "LIMA", "no", 0),
        (4, "?", "na", "20", "15%", "Trujillo  ", "NO", 1),
        (5, "29", "", "11,0", "20%", "Arequipa", "Si", 1),
        (6, "-", "2.100,50", "9.5", "5%", "Cusco", "No", 0),
        (7, "52", "$1,200.75", "14", "10%", "Lima", "si", 1),
        (8, "47", "€ 980", "13,25", "25%", "Piura", "no", 0),
        (9, "38", "1,234,567", "7", "0%", "Lima", "si", 1),
        (10, "61", "USD 2500", "16,5", "30%", "Tacna", "no", 0),
        (11, "23", "S/ 700", "10", "5%", "Ica", "si", 1),
        (12, "45", "900", "12", "10%", "Puno", "no", 0),
        (1, "34", "S/. 1,500", "12,5", "10%", " Lima ", "si", 1),
        (2, "N/A", "3,500", "15.0", "5%", "lima", "SI", 0),
    ]
    df = spark.createDataFrame(rows, "id long, edad string, ingreso string, gasto string, descuento string, "
                                     "ciudad string, fidelidad string, compro long")
    res = clean.clean_table(df)
    d = res.duplicates.first()
    assert (d["rows_before"], d["rows_after"], d["duplicates"]) == (14, 12, 2)
    assert set(res.converted) == {"edad", "ingreso", "gasto", "descuento"}
    t = {r["id"]: r for r in res.table.collect()}
    assert t[3]["ingreso"] == 1.25 and t[1]["ingreso"] == 1500 and t[6]["ingreso"] == 2100.5
    assert t[9]["ingreso"] is None and t[1]["gasto"] == 12.5 and t[8]["descuento"] == 25
    assert {t[i]["ciudad"] for i in (1, 2, 3)} == {"Lima", "lima", "LIMA"}
    assert t[4]["edad"] is None and t[6]["edad"] is None


def test_marker_audit_counts_real_nulls(spark):
    df = spark.createDataFrame([(None,), (None,), ("?",), ("na",), (" ",), ("ok",)], "c string")
    r = clean.null_marker_audit(df).first()
    assert (r["nulls_before"], r["nulls_total"], r["markers_replaced"]) == (2, 5, 3)
