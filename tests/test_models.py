"""Results of fitted models, worked out again from the data: centres, inertia, silhouettes, merge heights, trees."""

import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import classify as C
from quarry.operators import compare as Q
from quarry.operators import features as X
from quarry.operators.split import split_sizes, stratified_split
from quarry.plans import catalog, queries_learn

SF = "/root/testdata/sf0.001"
QUERIES = catalog.queries()


@pytest.fixture(scope="module")
def points():
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY vec_id").fetchall()
    return [r[0] for r in rows], np.array([r[1] for r in rows], float)


@pytest.fixture(scope="module")
def sweep(spark):
    return {r["k"]: r for r in QUERIES["kmeans_sweep"](spark, SF).collect()}


@pytest.fixture(scope="module")
def ward(spark):
    return {r["k"]: r for r in QUERIES["ward_clusters"](spark, SF).collect()}


def within(x, labels):
    return sum(((x[labels == c] - x[labels == c].mean(0)) ** 2).sum() for c in np.unique(labels))


def silhouette(x, labels):
    d = np.sqrt(np.maximum(((x[:, None] - x[None]) ** 2).sum(2), 0))
    total = []
    for i in range(len(x)):
        own = labels == labels[i]
        if own.sum() == 1:
            total.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, labels == c].mean() for c in np.unique(labels) if c != labels[i])
        total.append((b - a) / max(a, b))
    return float(np.mean(total))


def test_assignments_are_the_sweep_s_best_and_a_fixed_point(spark, points, sweep):
    ids, x = points
    found = {r["vec_id"]: r["cluster"] for r in QUERIES["kmeans_assign"](spark, SF).collect()}
    labels = np.array([found[i] for i in ids])
    best = max(sweep.values(), key=lambda r: (r["silhouette"], -r["k"]))
    assert len(found) == len(ids) and len(np.unique(labels)) == best["k"] and best["n_rows"] == len(ids)
    assert within(x, labels) == pytest.approx(best["inertia"], rel=1e-3)
    assert silhouette(x, labels) == pytest.approx(best["silhouette"], abs=1e-3)
    centres = np.array([x[labels == c].mean(0) for c in range(best["k"])])
    nearest = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
    assert (nearest == labels).mean() >= 0.99


def test_inertias_fall_and_beat_random_centres(spark, points, sweep):
    _, x = points
    elbow = {r["k"]: r["inertia"] for r in QUERIES["elbow_table"](spark, SF).collect()}
    assert elbow == {k: r["inertia"] for k, r in sweep.items()} and sorted(elbow) == [2, 3, 4, 5, 6]
    costs = [within(x, np.zeros(len(x)))] + [elbow[k] for k in sorted(elbow)]
    assert all(a > b for a, b in zip(costs, costs[1:]))
    rng = np.random.default_rng(0)
    for k in elbow:  # plain Lloyd steps of a few starts, worked out here, end no lower by much
        lowest = np.inf
        for _ in range(5):
            centres = x[rng.choice(len(x), k, replace=False)]
            for _ in range(50):
                labels = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
                centres = np.array([x[labels == c].mean(0) if (labels == c).any() else centres[c] for c in range(k)])
            lowest = min(lowest, within(x, labels))
        assert elbow[k] <= lowest * 1.03 and elbow[k] >= lowest * 0.9


def merges(x):
    """Ward by the recurrence of Lance and Williams on squared distances: (height, size, members) per step."""
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    size, members, out = np.ones(len(x)), [[i] for i in range(len(x))], []
    for _ in range(len(x) - 1):
        i, j = np.unravel_index(np.argmin(d), d.shape)
        i, j = min(i, j), max(i, j)
        out.append((float(np.sqrt(d[i, j])), size[i] + size[j], [list(members[i]), list(members[j])]))
        new = ((size[i] + size) * d[i] + (size[j] + size) * d[j] - size * d[i, j]) / (size[i] + size[j] + size)
        d[i, :], d[:, i] = new, new
        d[j, :], d[:, j], d[i, i] = np.inf, np.inf, np.inf
        members[i], size[i], size[j] = members[i] + members[j], size[i] + size[j], 0
    return out


def test_ward_heights_sizes_and_cuts(spark, points, ward):
    _, x = points
    true = merges(x)
    got = sorted((r["height"], r["size"]) for r in QUERIES["linkage_table"](spark, SF).collect())
    assert len(got) == 30
    want = sorted((h, n) for h, n, _ in true)[-30:]
    assert [h for h, _ in got] == pytest.approx([h for h, _ in want], rel=1e-6)
    assert [n for _, n in got] == [n for _, n in want]
    for k, row in ward.items():
        labels = np.arange(len(x))
        for _, _, (a, b) in true[: len(x) - k]:
            labels[a + b] = min(labels[a + b])
        assert len(np.unique(labels)) == k and silhouette(x, labels) == pytest.approx(row["silhouette"], abs=1e-6)


def test_summary_takes_the_best_of_both(spark, sweep, ward):
    row = QUERIES["cluster_summary"](spark, SF).first()
    for name, table in (("kmeans", sweep), ("ward", ward)):
        best = max(table.values(), key=lambda r: (round(r["silhouette"], 4), -r["k"]))
        assert row[f"{name}_k"] == best["k"] and row[f"{name}_silhouette"] == pytest.approx(best["silhouette"], abs=1e-4)


def test_comparisons_of_clusterings(spark):
    a, b = (s.first() for s in queries_learn._emb_halves(spark, SF))
    got = {r["metric"]: (r["value_a"], r["value_b"]) for r in QUERIES["compare_clustering"](spark, SF).collect()}
    assert got == {"kmeans_k": (a["kmeans_k"], b["kmeans_k"]), "ward_k": (a["ward_k"], b["ward_k"]),
                   **{f"{m}_silhouette": (round(a[f"{m}_silhouette"], 4), round(b[f"{m}_silhouette"], 4)) for m in ("kmeans", "ward")}}
    row = QUERIES["compare_silhouette"](spark, SF).first()
    assert row["winner"] == ("A" if a["kmeans_silhouette"] > b["kmeans_silhouette"] else "B")
    assert (row["silhouette_a"], row["silhouette_b"]) == pytest.approx((a["kmeans_silhouette"], b["kmeans_silhouette"]))
    kind = "kmeans_silhouette double"
    for x, y, winner in ((0.5, 0.4, "A"), (0.4, 0.5, "B"), (0.5, 0.5, "B"), (None, 0.1, "B"), (0.1, None, "B")):
        assert Q.compare_silhouette(spark.createDataFrame([(x,)], kind), spark.createDataFrame([(y,)], kind)).first()["winner"] == winner


# --- trees ----------------------------------------------------------------------------------------


def test_set():
    """(doc_id, quality) of the test part: per class the lowest md5 of the id and the seed."""
    rows = duckdb.sql(f"""SELECT quality, doc_id FROM '{SF}/labels.parquet' JOIN '{SF}/documents.parquet' USING (doc_id)
                          ORDER BY quality, md5(doc_id::VARCHAR || '|42')""").fetchall()
    classes = sorted({y for y, _ in rows})
    sizes = split_sizes([sum(y == c for y, _ in rows) for c in classes])
    return {i: c for c, (n, _, _) in zip(classes, sizes) for i in [i for y, i in rows if y == c][:n]}


test_set.__test__ = False


@pytest.mark.parametrize("key", ["decision_tree", "random_forest"])
def test_predictions_are_of_the_test_part(spark, key):
    rows = QUERIES[key](spark, SF).collect()
    want = test_set()
    assert {r["doc_id"]: int(r["y"]) for r in rows} == want and len(rows) == len(want)
    assert {r["pred"] for r in rows} <= set(want.values()) and {r["model"] for r in rows} == {key}
    majority = max(list(want.values()).count(c) for c in set(want.values())) / len(want)
    assert sum(r["pred"] == r["y"] for r in rows) / len(rows) >= majority - 0.1


def walk(text, values):
    """The prediction of a printed tree for one feature vector."""
    lines = [(len(x) - len(x.lstrip()), x.strip()) for x in text.split("\n")[1:] if x.strip()]
    at = 0
    while not lines[at][1].startswith("Predict"):
        depth, line = lines[at]
        i, op, bound = re.search(r"feature (\d+) (<=|>|in|not in) (\{.*\}|[-\d.E]+)", line).groups()
        v = values[int(i)]
        inside = v <= float(bound) if op == "<=" else v in [float(n) for n in bound.strip("{}").split(",")]
        at += 1
        if not inside:
            while not (lines[at][0] == depth and lines[at][1].startswith("Else")):
                at += 1
            at += 1
    return float(lines[at][1].split(":")[1])


def test_the_tree_s_own_rules_give_its_predictions(spark):
    _, classes, tree, _, test = queries_learn._doc_models(spark, SF, forest_too=False)
    got = {r["doc_id"]: r["pred"] for r in QUERIES["decision_tree"](spark, SF).collect()}
    model = tree.model
    for r in test.select("doc_id", "features").collect():
        assert classes[int(walk(model.toDebugString, r["features"].toArray()))] == got[r["doc_id"]]


def test_models_learn_what_can_be_learned(spark):
    df = spark.range(1500).select("id", (F.col("id") * 37 % 101).cast("double").alias("x"), (F.col("id") * 53 % 97).cast("double").alias("noise"),
                                  F.when(F.col("id") * 37 % 101 > 40, "high").otherwise("low").alias("y"))
    s = stratified_split(df, "y", ["id"]).table
    fm = X.fit_features(s, ["x", "noise"], [])
    classes = C.class_labels(s, "y")
    feats = C.with_label(fm.transform(s), "y", classes)
    train, test = feats.where("split = 'train'"), feats.where("split = 'test'")
    for model in (C.train_tree(train, classes), C.train_forest(train, classes, 20, 8)):
        rows = C.predict(model, test, "y", ["id"]).collect()
        assert len(rows) == 300 and sum(r["pred"] == r["y"] for r in rows) >= 0.97 * 300
    importance = C.feature_importance(model, fm.names, 15).collect()
    assert importance[0]["feature"] == "x" and importance[0]["importance"] > 0.8
    assert sum(r["importance"] for r in importance) == pytest.approx(1, abs=1e-6)


def test_importances_are_shares_in_falling_order(spark):
    rows = QUERIES["feature_importance"](spark, SF).collect()
    values = [r["importance"] for r in rows]
    assert values == sorted(values, reverse=True) and 0 < len(rows) <= 15 and min(values) >= 0 and 0 < sum(values) <= 1 + 1e-9
    assert len({r["feature"] for r in rows}) == len(rows)
