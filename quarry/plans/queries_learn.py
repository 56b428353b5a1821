"""Queries: clustering (K1..K13), models (M1, M2, M8, M9), two-table comparison (Q1..Q6),
and the end-to-end job with its sources and sinks (S1, S6, S8)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.functions.numeric import r6
from quarry.operators import classify as C
from quarry.operators import cluster as K
from quarry.operators import compare as Q
from quarry.operators import features as X
from quarry.plans import sqltext as S
from quarry.plans.queries_model import doc_features, doc_preds
from quarry.plans.registry import register
from quarry.plans.run import RunParams, run_analysis, run_and_write
from quarry.session import materialize, read_table, shared_dir
from quarry.sources import csv as csvsrc
from quarry.operators import metrics as M
from quarry.operators.split import stratified_split

# --------------------------------------------------------------------------- clustering

EMB_SQL = """
e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"""


def emb(spark, sf):
    return K.embeddings_features(read_table(spark, sf, "embeddings"))


def _sil_sql(group: str) -> str:
    """Silhouette of grouping ``group`` (an expression over e.label): 1000 embeddings in hash order
    against all."""
    return f"""
g AS (SELECT vec_id, {group} AS c, v FROM e),
sample AS (SELECT * FROM g ORDER BY md5(vec_id::VARCHAR || '|42') LIMIT 1000),
d AS (SELECT a.vec_id AS i, a.c AS ci, b.c AS cj, sum(list_distance(a.v, b.v)) AS s, count(*) AS n
      FROM sample a, g b GROUP BY ALL),
own AS (SELECT i, CASE WHEN n > 1 THEN s / (n - 1) END AS a, n FROM d WHERE ci = cj),
oth AS (SELECT i, min(s / n) AS b FROM d WHERE ci <> cj GROUP BY i),
sil AS (SELECT CASE WHEN own.n <= 1 OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END AS s
        FROM own LEFT JOIN oth USING (i))"""


@register("silhouette_euclidean", f"""WITH {EMB_SQL},{_sil_sql('label')}
SELECT count(*) AS n_sample, (SELECT count(*) FROM g) AS n_rows, round(avg(s), 6) AS silhouette FROM sil""")
def q_silhouette(spark, sf):
    # the sample is the operator K1: 1000 rows in hash order, at every size
    s = K.silhouette_euclidean(emb(spark, sf), "features", "label", ["vec_id"], sample=1000)
    return s.select("n_sample", "n_rows", r6(F.col("silhouette")).alias("silhouette"))


def _best_k_sql() -> str:
    parts = []
    for k in range(2, 7):
        parts.append(f"(WITH {EMB_SQL},{_sil_sql(f'label % {k}')} SELECT {k} AS k, round(avg(s), 6) AS silhouette FROM sil)")
    return ("WITH t AS (" + "\nUNION ALL\n".join(f"SELECT * FROM {p}" for p in parts) + ")\n"
            "SELECT k, silhouette, (row_number() OVER (ORDER BY silhouette DESC, k) = 1)::INT AS is_best FROM t")


@register("best_k", _best_k_sql())
def q_best_k(spark, sf):
    e = emb(spark, sf)
    for k in range(2, 7):
        e = e.withColumn(f"g{k}", F.col("label") % k)
    s = K.silhouettes(e, {k: f"g{k}" for k in range(2, 7)}, "features", ["vec_id"], sample=1000)
    t = s.select(F.col("name").cast("int").alias("k"), r6(F.col("silhouette")).alias("silhouette"))
    return K.best_k_table(t)


@register("bounded_sample", """
SELECT o_orderkey FROM orders ORDER BY md5(o_orderkey::VARCHAR || '|42') LIMIT 1000""")
def q_bounded_sample(spark, sf):
    return K.bounded_sample(read_table(spark, sf, "orders").select("o_orderkey"), 1000, ["o_orderkey"], 42)


LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PROFILE_SQL = "WITH p AS (" + "\nUNION ALL\n".join(
    f"SELECT l_returnflag AS cluster, '{c}' AS \"column\", round_even(avg({c}), 2) AS mean FROM lineitem GROUP BY 1"
    for c in LI_NUM) + ")"


@register("cluster_profile", f"{PROFILE_SQL}\nSELECT * FROM p")
def q_profile(spark, sf):
    return K.cluster_profile(read_table(spark, sf, "lineitem"), "l_returnflag", LI_NUM)


@register("cluster_profile_norm", f"""{PROFILE_SQL}
SELECT cluster, "column", round((mean - min(mean) OVER w) / (max(mean) OVER w - min(mean) OVER w + 1e-9), 6) AS norm
FROM p WINDOW w AS (PARTITION BY "column")""")
def q_profile_norm(spark, sf):
    p = K.cluster_profile(read_table(spark, sf, "lineitem"), "l_returnflag", LI_NUM)
    return K.cluster_profile_norm(p).select("cluster", "column", r6(F.col("norm")).alias("norm"))


@register("cluster_sizes", """
SELECT l_returnflag AS cluster, count(*) AS n, round_even(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct
FROM lineitem GROUP BY 1""")
def q_sizes(spark, sf):
    return K.cluster_sizes(read_table(spark, sf, "lineitem"), "l_returnflag")


def _sweep(spark, sf):
    # ten starts a k, as in the reference, and the silhouette of all rows
    return K.kmeans_sweep(emb(spark, sf), "features", 2, 6, n_init=10, key_cols=["vec_id"], sample=None, spark_starts=3)


@register("kmeans_sweep")
def q_kmeans_sweep(spark, sf):
    return _sweep(spark, sf).table.select("k", F.round("inertia", 4).alias("inertia"), "n_sample", "n_rows",
                                          F.round("silhouette", 4).alias("silhouette"))


@register("elbow_table")
def q_elbow(spark, sf):
    return _sweep(spark, sf).table.select("k", F.round("inertia", 4).alias("inertia"))


@register("kmeans_assign")
def q_kmeans_assign(spark, sf):
    sw = _sweep(spark, sf)
    return sw.models[sw.best_k].transform(emb(spark, sf)).select("vec_id", F.col("cluster").cast("long"))


@register("silhouette_squared", f"""WITH {EMB_SQL},
d AS (SELECT a.vec_id AS i, a.label AS ci, b.label AS cj, sum(list_distance(a.v, b.v) ** 2) AS s, count(*) AS n
      FROM e a, e b GROUP BY ALL),
own AS (SELECT i, CASE WHEN n > 1 THEN s / (n - 1) END AS a, n FROM d WHERE ci = cj),
oth AS (SELECT i, min(s / n) AS b FROM d WHERE ci <> cj GROUP BY i),
sil AS (SELECT CASE WHEN own.n <= 1 OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END AS s
        FROM own LEFT JOIN oth USING (i))
SELECT round(avg(s), 6) AS silhouette FROM sil""")
def q_sil_sq(spark, sf):
    v = K.silhouette_squared(emb(spark, sf), "features", "label")
    return spark.createDataFrame([(float(v),)], "silhouette double").select(r6(F.col("silhouette")).alias("silhouette"))


def _ward(spark, sf):
    return K.ward_clusters(emb(spark, sf), "features", 2, 6, key_cols=["vec_id"])


@register("ward_clusters")
def q_ward(spark, sf):
    return _ward(spark, sf).table


@register("linkage_table")
def q_linkage(spark, sf):
    lk = _ward(spark, sf).linkage
    n = lk.count()
    return lk.where(F.col("step") >= n - 30)


@register("cluster_summary")
def q_cluster_summary(spark, sf):
    return K.cluster_summary(spark, _sweep(spark, sf), _ward(spark, sf))


# --------------------------------------------------------------------------- models on documents + labels


def _doc_models(spark, sf, forest_too=True, num_trees=200, depth=30):
    lab = read_table(spark, sf, "labels").select("doc_id", "quality")
    # whole texts are read once: the split, the fits and the models take many passes
    t = materialize(doc_features(spark, sf, ("lang", "source")).join(lab, "doc_id").select(
        "doc_id", "lang", "source", "n_chars", "n_lines", "quality"))
    s = stratified_split(t, "quality", ["doc_id"]).table
    fm = X.fit_features(s, ["n_chars", "n_lines"], ["lang", "source"])
    classes = C.class_labels(s, "quality")
    feats = materialize(C.with_label(fm.transform(s), "quality", classes).select("doc_id", "quality", "split", "features", "label"))
    train = feats.where(F.col("split") == "train")
    tree = C.train_tree(train, classes)
    forest = C.train_forest(train, classes, num_trees, depth) if forest_too else None
    test = feats.where(F.col("split") == "test")
    return fm, classes, tree, forest, test


@register("decision_tree")
def q_tree(spark, sf):
    fm, classes, tree, forest, test = _doc_models(spark, sf, forest_too=False)
    return C.predict(tree, test, "quality", ["doc_id"]).select("doc_id", "model", "y", "pred")


@register("random_forest")
def q_forest(spark, sf):
    fm, classes, tree, forest, test = _doc_models(spark, sf)
    return C.predict(forest, test, "quality", ["doc_id"]).select("doc_id", "model", "y", "pred")


@register("feature_importance")
def q_importance(spark, sf):
    fm, classes, tree, forest, test = _doc_models(spark, sf)
    return C.feature_importance(forest, fm.names, 15)


@register("class_probability")
def q_class_prob(spark, sf):
    fm, classes, tree, forest, test = _doc_models(spark, sf)
    p = C.predict(forest, test, "quality", ["doc_id"])
    return C.class_probability(p, classes, ["doc_id"])


# --------------------------------------------------------------------------- comparison of two tables
# A = English documents, B = the other languages; each table gets its own split and
# its own comparison table of the two rules (+ majority baseline on validation).


def _lang_table(spark, sf, english: bool):
    lab = read_table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y"))
    dl = doc_features(spark, sf, ("lang",)).join(lab, "doc_id")
    dl = dl.where(F.col("lang") == "en") if english else dl.where(F.col("lang") != "en")
    s = stratified_split(dl.select("doc_id", "y", "n_chars", "n_lines"), "y", ["doc_id"]).table
    p = doc_preds(s).where(F.col("split") != "train")
    base = X.baseline_majority(s, "y").select(F.lit("baseline").alias("model"), F.lit(0).alias("ord"),
                                              F.lit("val").alias("split"), "y", "pred")
    allp = p.select("model", "ord", "split", "y", "pred").unionByName(base)
    sm = M.summary(M.confusion(allp, ["model", "ord", "split"]), ["model", "ord", "split"])
    auc = M.auc_binary(p, ["model", "split"])
    return sm.join(auc, ["model", "split"], "left").select(
        "model", "ord", "split", *[r6(F.col(c)).alias(c) for c in ("accuracy", "f1", "auc")])


def _tables(spark, sf):
    return _lang_table(spark, sf, True), _lang_table(spark, sf, False)


def _lang_sql(tag: str, cond: str) -> str:
    return f"""
{tag}dl AS (SELECT d.doc_id, l.quality AS y, d.n_chars,
                 length(d.text) - length(replace(d.text, chr(10), '')) AS n_lines
            FROM documents d JOIN labels l USING (doc_id) WHERE {cond}),{S.split_sql(f'{tag}dl', 'doc_id', 'y', prefix=tag)},
{tag}dls AS (SELECT x.*, s.split FROM {tag}dl x JOIN {tag}split_rows s USING (doc_id)),
{tag}preds AS (SELECT 'rule_length' AS model, 1 AS ord, split, y, (n_chars > 300)::INT AS pred, n_chars::DOUBLE AS score
               FROM {tag}dls WHERE split <> 'train'
               UNION ALL
               SELECT 'rule_lines', 2, split, y, (n_lines >= 3)::INT, n_lines::DOUBLE FROM {tag}dls WHERE split <> 'train'),
{tag}maj AS (SELECT y AS pred FROM {tag}dls WHERE split = 'train' GROUP BY y ORDER BY count(*) DESC, y LIMIT 1),
{tag}allp AS (SELECT model, ord, split, y, pred FROM {tag}preds
              UNION ALL SELECT 'baseline', 0, 'val', y, m.pred FROM {tag}dls, {tag}maj m WHERE split = 'val')"""


def _metric_block(tag: str) -> str:
    by = ["model", "ord", "split"]
    return (S.cm_sql(f"{tag}allp", by, tag) + "," + S.summary_sql(by, tag)
            + "," + S.auc_sql(f"{tag}preds", ["model", "split"], name=f"{tag}auc"))


def _cmp_sql() -> str:
    return ("WITH " + _lang_sql("a_", "d.lang = 'en'") + "," + _lang_sql("b_", "d.lang <> 'en'") + ","
            + _metric_block("a_") + "," + _metric_block("b_") + """,
a_tab AS (SELECT model, ord, split, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, round(auc, 6) AS auc
          FROM a_summ LEFT JOIN a_auc USING (model, split)),
b_tab AS (SELECT model, ord, split, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, round(auc, 6) AS auc
          FROM b_summ LEFT JOIN b_auc USING (model, split)),
comp AS (SELECT 'A' AS dataset, model, ord, accuracy, f1, auc FROM a_tab WHERE split = 'test'
         UNION ALL SELECT 'B', model, ord, accuracy, f1, auc FROM b_tab WHERE split = 'test')""")


CMP = _cmp_sql()


@register("compare_models", f"{CMP}\nSELECT * FROM comp")
def q_compare_models(spark, sf):
    a, b = _tables(spark, sf)
    return Q.compare_models(a, b)


@register("compare_winner", f"""{CMP},
m AS (SELECT dataset, avg(f1) AS f FROM comp WHERE NOT regexp_matches(lower(model), 'baseline|dummy') GROUP BY dataset),
v AS (SELECT (SELECT f FROM m WHERE dataset = 'A') AS fa, (SELECT f FROM m WHERE dataset = 'B') AS fb)
SELECT CASE WHEN fa > fb THEN 'A' ELSE 'B' END AS winner, CASE WHEN fa > fb THEN 'B' ELSE 'A' END AS loser,
       round(fa, 6) AS f1_a, round(fb, 6) AS f1_b, round(abs(fa - fb), 6) AS diff FROM v""")
def q_compare_winner(spark, sf):
    a, b = _tables(spark, sf)
    w = Q.compare_winner(Q.compare_models(a, b))
    return w.select("winner", "loser", *[r6(F.col(c)).alias(c) for c in ("f1_a", "f1_b", "diff")])


@register("metric_matrix", f"""{CMP}
SELECT 'accuracy' AS metric, model, dataset, coalesce(accuracy, 0) AS value FROM comp
UNION ALL SELECT 'f1', model, dataset, coalesce(f1, 0) FROM comp
UNION ALL SELECT 'auc', model, dataset, coalesce(auc, 0) FROM comp""")
def q_metric_matrix(spark, sf):
    a, b = _tables(spark, sf)
    return Q.metric_matrix(Q.compare_models(a, b))


@register("metric_deltas", f"""{CMP},
best AS (SELECT * FROM comp WHERE NOT regexp_matches(lower(model), 'baseline|dummy')
         QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY f1 DESC, ord) = 1),
a AS (SELECT * FROM best WHERE dataset = 'A'), b AS (SELECT * FROM best WHERE dataset = 'B')
SELECT a.model AS model_a, b.model AS model_b, round((b.accuracy - a.accuracy) * 100, 6) AS accuracy_pp,
       round(b.f1 - a.f1, 6) AS f1_delta,
       CASE WHEN a.auc > 0 AND b.auc > 0 THEN round(b.auc - a.auc, 6) END AS auc_delta FROM a, b""")
def q_metric_deltas(spark, sf):
    a, b = _tables(spark, sf)
    d = Q.metric_deltas(Q.compare_models(a, b))
    return d.select("model_a", "model_b", *[r6(F.col(c)).alias(c) for c in ("accuracy_pp", "f1_delta", "auc_delta")])


def _emb_halves(spark, sf):
    e = emb(spark, sf)
    out = []
    for part in (e.where(F.col("label") < 5), e.where(F.col("label") >= 5)):
        sw = K.kmeans_sweep(part, "features", 2, 6, n_init=2, key_cols=["vec_id"])
        wd = K.ward_clusters(part, "features", 2, 6, key_cols=["vec_id"])
        out.append(K.cluster_summary(spark, sw, wd))
    return out


@register("compare_clustering")
def q_compare_clustering(spark, sf):
    a, b = _emb_halves(spark, sf)
    return Q.compare_clustering(a, b)


@register("compare_silhouette")
def q_compare_silhouette(spark, sf):
    a, b = _emb_halves(spark, sf)
    return Q.compare_silhouette(a, b)


# --------------------------------------------------------------------------- end to end, sources, sinks


def doc_table(spark, sf):
    lab = read_table(spark, sf, "labels").select("doc_id", "quality")
    return doc_features(spark, sf, ("lang", "source")).join(lab, "doc_id").select(
        "lang", "source", "n_chars", "n_lines", "quality")


LIGHT = RunParams(target="quality", n_init=2, num_trees=50, forest_depth=12)


@register("full_run")
def q_full_run(spark, sf):
    return run_analysis(doc_table(spark, sf), "documents", LIGHT).table


@register("metrics_sink")
def q_sink(spark, sf):
    out = f"{shared_dir(spark).rstrip('/')}/results/metrics_sink-{uuid.uuid4().hex}"
    return run_and_write([("documents", doc_table(spark, sf))], out, LIGHT)


@register("csv_autodetect", """
SELECT doc_id, text || ' "' || lang || '"; ' || source AS note, lang, source, n_chars FROM documents""")
def q_csv(spark, sf):
    """Texts with quotes, separators and line breaks, through a semicolon file and back."""
    path = f"{shared_dir(spark).rstrip('/')}/sources/documents_semicolon_csv-{uuid.uuid4().hex}"
    note = F.concat("text", F.lit(' "'), "lang", F.lit('"; '), "source").alias("note")
    d = read_table(spark, sf, "documents").select("doc_id", note, "lang", "source", "n_chars")
    (d.write.option("header", True).option("sep", ";").option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return csvsrc.load_csv(spark, path)
