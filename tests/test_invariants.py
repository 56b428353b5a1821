"""Invariants: split, leakage, one-hot, silhouette, ROC/AUC, Ward."""

import itertools

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry.operators import cluster as K
from quarry.operators import features as X
from quarry.operators import metrics as M
from quarry.operators.split import split_sizes, stratified_split

SF = "/root/testdata/sf0.001"


def test_split_disjoint_complete_and_sized(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderstatus")
    s = stratified_split(o, "o_orderstatus", ["o_orderkey"])
    rows = s.table.collect()
    assert len(rows) == o.count() and len({r["o_orderkey"] for r in rows}) == len(rows)
    counts = {}
    for r in rows:
        counts[(r["o_orderstatus"], r["split"])] = counts.get((r["o_orderstatus"], r["split"]), 0) + 1
    for r in s.sizes.collect():
        assert counts.get((r["class"], "test"), 0) == r["n_test"]
        assert counts.get((r["class"], "val"), 0) == r["n_val"]
        assert counts.get((r["class"], "train"), 0) == r["n_train"]
    again = {r["o_orderkey"]: r["split"] for r in stratified_split(o, "o_orderstatus", ["o_orderkey"]).table.collect()}
    assert again == {r["o_orderkey"]: r["split"] for r in rows}


def test_no_leakage_from_test_rows(spark):
    c = spark.read.parquet(f"{SF}/customer.parquet").select("c_custkey", "c_acctbal", "c_mktsegment")
    s = stratified_split(c, "c_mktsegment", ["c_custkey"]).table
    fm1 = X.fit_features(s, ["c_acctbal"], ["c_mktsegment"])
    noisy = s.withColumn("c_acctbal", F.when(F.col("split") == "test", F.lit(1e9)).otherwise(F.col("c_acctbal")))
    noisy = noisy.withColumn("c_mktsegment", F.when(F.col("split") != "train", F.lit("ZZZ"))
                             .otherwise(F.col("c_mktsegment")))
    fm2 = X.fit_features(noisy, ["c_acctbal"], ["c_mktsegment"])
    assert fm1.medians == fm2.medians and fm1.moments == fm2.moments and fm1.modes == fm2.modes
    assert fm1.names == fm2.names
    v = fm2.transform(noisy).select("split", vector_to_array("features").alias("f")).collect()
    for r in v:
        hot = sum(r["f"][1:])
        assert hot == (0.0 if r["split"] != "train" else 1.0)


def test_silhouette_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    pts = np.vstack([rng.normal(0, 1, (30, 3)), rng.normal(4, 1, (25, 3)), rng.normal((0, 5, 0), 1, (1, 3))])
    lab = [0] * 30 + [1] * 25 + [2]
    df = spark.createDataFrame([(i, [float(x) for x in p], lab[i]) for i, p in enumerate(pts)],
                               "id long, v array<double>, c long")
    df = K.embeddings_features(df, "v")
    got = K.silhouette_euclidean(df, "features", "c", ["id"]).first()["silhouette"]
    D = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    s = []
    for i in range(len(pts)):
        own = [j for j in range(len(pts)) if lab[j] == lab[i] and j != i]
        if not own:
            s.append(0.0)
            continue
        a = D[i, own].mean()
        b = min(D[i, [j for j in range(len(pts)) if lab[j] == c]].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    assert got == pytest.approx(np.mean(s), abs=1e-8)  # dot-product distance form, as in scikit-learn
    assert -1 <= got <= 1


def test_roc_monotone_and_area_equals_auc(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 400)
    score = np.round(rng.normal(y * 0.8, 1.0), 1)
    df = spark.createDataFrame([("m", int(a), float(b)) for a, b in zip(y, score)], "model string, y int, score double")
    roc = M.roc_curve(df).orderBy(F.col("threshold").desc()).collect()
    fpr = [0.0] + [r["fpr"] for r in roc]
    tpr = [0.0] + [r["tpr"] for r in roc]
    assert all(a <= b for a, b in zip(fpr, fpr[1:])) and all(a <= b for a, b in zip(tpr, tpr[1:]))
    area = sum((fpr[i + 1] - fpr[i]) * (tpr[i + 1] + tpr[i]) / 2 for i in range(len(fpr) - 1))
    auc = M.auc_binary(df).first()["auc"]
    assert area == pytest.approx(auc, abs=1e-12)
    pos, neg = score[y == 1], score[y == 0]
    brute = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc == pytest.approx(brute, abs=1e-12)


def test_ward_tree_matches_brute_force():
    rng = np.random.default_rng(2)
    pts = rng.normal(0, 1, (12, 2))
    merges = K.ward_tree(pts, np.ones(12))
    clusters = {i: [i] for i in range(12)}
    nxt = 12
    for a, b, h, size in merges:
        best = None
        for x, y in itertools.combinations(clusters, 2):
            cx, cy = pts[clusters[x]].mean(0), pts[clusters[y]].mean(0)
            nx, ny = len(clusters[x]), len(clusters[y])
            d = np.sqrt(2 * nx * ny / (nx + ny)) * np.linalg.norm(cx - cy)
            if best is None or d < best[0]:
                best = (d, x, y)
        assert {a, b} == {best[1], best[2]} and h == pytest.approx(best[0])
        clusters[nxt] = clusters.pop(a) + clusters.pop(b)
        assert size == len(clusters[nxt])
        nxt += 1
    lab = K.cut_tree(merges, 12, 3)
    assert len(set(lab.tolist())) == 3


def test_split_sizes_sum():
    for counts in ([1], [1, 1], [5, 0, 7], [100, 3, 1], [33, 33, 34]):
        sizes = split_sizes([c for c in counts if c > 0])
        assert [sum(s) for s in sizes] == [c for c in counts if c > 0]


def test_silhouette_sparse_vectors_match_brute_force(spark):
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(9)
    n, d = 120, 40
    dense = np.zeros((n, d))
    rows = []
    for i in range(n):
        cols = rng.choice(d, 3, replace=False)
        dense[i, cols] = rng.normal(0, 1, 3) + (i % 3)
        v = Vectors.sparse(d, sorted(cols.tolist()), dense[i, sorted(cols.tolist())].tolist()) if i % 2 else \
            Vectors.dense(dense[i].tolist())
        rows.append((i, v, int(i % 3)))
    df = spark.createDataFrame(rows, ["id", "features", "c"])
    got = K.silhouette_euclidean(df, "features", "c", ["id"]).first()["silhouette"]
    D = np.sqrt(((dense[:, None, :] - dense[None, :, :]) ** 2).sum(-1))
    lab = np.array([i % 3 for i in range(n)])
    s = []
    for i in range(n):
        own = (lab == lab[i]) & (np.arange(n) != i)
        a = D[i, own].mean()
        b = min(D[i, lab == c].mean() for c in set(lab.tolist()) if c != lab[i])
        s.append((b - a) / max(a, b))
    assert got == pytest.approx(np.mean(s), abs=1e-8)


def _brute_ward_labels(pts, k):
    clusters = {i: [i] for i in range(len(pts))}
    while len(clusters) > k:
        best = None
        for x, y in itertools.combinations(sorted(clusters), 2):
            a, b = pts[clusters[x]], pts[clusters[y]]
            d = len(a) * len(b) / (len(a) + len(b)) * ((a.mean(0) - b.mean(0)) ** 2).sum()
            if best is None or d < best[0] - 1e-12:
                best = (d, x, y)
        _, x, y = best
        clusters[x] = clusters[x] + clusters.pop(y)
    lab = np.zeros(len(pts), dtype=int)
    for c, (_, members) in enumerate(sorted(clusters.items())):
        lab[members] = c
    return lab


def _brute_silhouette(pts, lab):
    D = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    s = []
    for i in range(len(pts)):
        own = (lab == lab[i]) & (np.arange(len(pts)) != i)
        if not own.any():
            s.append(0.0)
            continue
        a = D[i, own].mean()
        b = min(D[i, lab == c].mean() for c in set(lab.tolist()) if c != lab[i])
        s.append((b - a) / max(a, b))
    return float(np.mean(s))


def test_exact_ward_path_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    base = np.vstack([rng.normal(0, 1, (10, 2)), rng.normal(5, 1, (8, 2)), rng.normal((0, 6), 1, (7, 2))])
    pts = np.vstack([base, base[[0, 1, 2, 11, 20]]])          # exact duplicates carry weight
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(pts)], "id long, v array<double>")
    w = K.ward_clusters(K.embeddings_features(df, "v"), "features", 2, 4, key_cols=["id"])
    got = {r["k"]: r["silhouette"] for r in w.table.collect()}
    for k in (2, 3, 4):
        assert got[k] == pytest.approx(_brute_silhouette(pts, _brute_ward_labels(pts, k)), abs=1e-8)
