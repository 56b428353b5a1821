"""Queries: split (X1), preprocessing (X2..X7), class proportion (P9), metrics (M3..M7, M10) and
evaluation tables (E1..E17), on rule-based predictions so every figure has an SQL oracle.

Binary task: documents joined with labels, y = quality; two scoring rules
(document length, number of lines).  Multiclass task: lineitem return flag
predicted by two rules (quantity, discount) with class-probability vectors.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry.functions.numeric import r6
from quarry.operators import features as X
from quarry.operators import metrics as M
from quarry.operators import profile
from quarry.operators.split import stratified_split
from quarry.plans import sqltext as S
from quarry.plans.registry import register
from quarry.session import read_table

# --------------------------------------------------------------------------- derived inputs


def doc_features(spark, sf, extra: tuple[str, ...] = ()):
    """Per-document numbers, computed on the scan of ``documents`` (whole texts) before any
    join, so the texts themselves never cross a shuffle."""
    n_lines = F.length("text") - F.length(F.regexp_replace("text", "\n", ""))
    return read_table(spark, sf, "documents").select("doc_id", *extra, "n_chars", n_lines.alias("n_lines"))


def docs_labeled(spark, sf):
    lab = read_table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y"))
    return doc_features(spark, sf).join(lab, "doc_id").select("doc_id", "y", "n_chars", "n_lines")


def docs_split(spark, sf):
    return stratified_split(docs_labeled(spark, sf), "y", ["doc_id"]).table


def _per_model(df, keep: list[str], models: list[tuple]) -> "DataFrame":
    """One scan, one row per (input row, model): ``explode`` of one struct per model."""
    rows = F.array(*[F.struct(F.lit(name).alias("model"), *[c.alias(n) for n, c in cols]) for name, cols in models])
    return df.select(*keep, F.explode(rows).alias("_m")).select(*keep, "_m.*")


def doc_preds(dl):
    return _per_model(dl, ["split", "y"], [
        ("rule_length", [("ord", F.lit(1)), ("pred", (F.col("n_chars") > 300).cast("int")),
                         ("score", F.col("n_chars").cast("double"))]),
        ("rule_lines", [("ord", F.lit(2)), ("pred", (F.col("n_lines") >= 3).cast("int")),
                        ("score", F.col("n_lines").cast("double"))])]).select(
        "model", "ord", "split", "y", "pred", "score")


DOCS_BASE = f"""
dl AS (SELECT d.doc_id, l.quality AS y, d.n_chars,
              length(d.text) - length(replace(d.text, chr(10), '')) AS n_lines
       FROM documents d JOIN labels l USING (doc_id)),{S.split_sql('dl', 'doc_id', 'y')},
dls AS (SELECT dl.*, s.split FROM dl JOIN split_rows s USING (doc_id))"""
DOCS_SQL = DOCS_BASE + """,
preds AS (SELECT 'rule_length' AS model, 1 AS ord, split, y, (n_chars > 300)::INT AS pred, n_chars::DOUBLE AS score
          FROM dls
          UNION ALL
          SELECT 'rule_lines' AS model, 2 AS ord, split, y, (n_lines >= 3)::INT AS pred, n_lines::DOUBLE AS score
          FROM dls)"""

FLAGS = ["A", "N", "R"]


def li_preds(spark, sf):
    li = read_table(spark, sf, "lineitem")
    q, d = F.col("l_quantity"), F.col("l_discount")
    qa, qn, qr = 51 - q, 26 - F.abs(q - 25.5), q
    tq = qa + qn + qr
    da, dn, dr = 0.11 - d, 0.06 - F.abs(d - 0.05), d + 0.01
    td = da + dn + dr
    out = _per_model(li.select(F.col("l_returnflag").alias("y"), "l_quantity", "l_discount"), ["y"], [
        ("rule_qty", [("pred", F.when(q <= 17, "A").when(q <= 34, "N").otherwise("R")),
                      ("probs", F.array(qa / tq, qn / tq, qr / tq))]),
        ("rule_disc", [("pred", F.when(d < 0.03, "A").when(d < 0.07, "N").otherwise("R")),
                       ("probs", F.array(da / td, dn / td, dr / td))])])
    return out.select("model", "y", "pred", "probs")


LI_SQL = """
lp0 AS (SELECT 'rule_qty' AS model, l_returnflag AS y,
               CASE WHEN l_quantity <= 17 THEN 'A' WHEN l_quantity <= 34 THEN 'N' ELSE 'R' END AS pred,
               51 - l_quantity AS a, 26 - abs(l_quantity - 25.5) AS b, l_quantity AS c FROM lineitem
        UNION ALL
        SELECT 'rule_disc' AS model, l_returnflag AS y,
               CASE WHEN l_discount < 0.03 THEN 'A' WHEN l_discount < 0.07 THEN 'N' ELSE 'R' END AS pred,
               0.11 - l_discount AS a, 0.06 - abs(l_discount - 0.05) AS b, l_discount + 0.01 AS c FROM lineitem),
lp AS (SELECT model, y, pred, a / (a + b + c) AS pa, b / (a + b + c) AS pn, c / (a + b + c) AS pr FROM lp0)"""


def _u(parts):
    return "\nUNION ALL\n".join(parts)


# --------------------------------------------------------------------------- split and preprocessing

@register("stratified_split", f"""WITH {S.split_sql('orders', 'o_orderkey', 'o_orderstatus')}
SELECT o_orderkey, split FROM split_rows""")
def q_split(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return stratified_split(o, "o_orderstatus", ["o_orderkey"]).table.select("o_orderkey", "split")


@register("class_proportion", f"""WITH {DOCS_BASE}
SELECT split, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM dls), 6) AS pct,
       round(avg(y), 6) AS mean_y FROM dls GROUP BY split
UNION ALL
SELECT 'all' AS split, count(*) AS n, 100.0 AS pct, round(avg(y), 6) AS mean_y FROM dls""")
def q_class_proportion(spark, sf):
    t = profile.class_proportion(docs_split(spark, sf), "y")
    return t.select("split", "n", r6(F.col("pct")).alias("pct"), r6(F.col("mean_y")).alias("mean_y"))


def customer_features(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    h = F.md5(F.col("c_custkey").cast("string"))
    s = stratified_split(c, "c_mktsegment", ["c_custkey"]).table
    acct = F.when(F.substring(h, 1, 1) == "0", F.lit(None).cast("double")).otherwise(F.col("c_acctbal"))
    seg0 = F.when(F.substring(h, 2, 1) == "1", F.lit(None).cast("string")).otherwise(F.col("c_mktsegment"))
    seg = F.when((F.col("split") != "train") & (F.substring(h, 3, 1) == "2"), F.lit("NEW")).otherwise(seg0)
    return s.select("c_custkey", "c_nationkey", acct.alias("acct"), seg.alias("seg"), "split")


CUST_SQL = f"""{S.split_sql('customer', 'c_custkey', 'c_mktsegment')},
cf AS (SELECT c.c_custkey, c.c_nationkey,
              CASE WHEN substr(md5(c.c_custkey::VARCHAR), 1, 1) = '0' THEN NULL ELSE c.c_acctbal END AS acct,
              CASE WHEN s.split <> 'train' AND substr(md5(c.c_custkey::VARCHAR), 3, 1) = '2' THEN 'NEW'
                   WHEN substr(md5(c.c_custkey::VARCHAR), 2, 1) = '1' THEN NULL ELSE c.c_mktsegment END AS seg,
              s.split
       FROM customer c JOIN split_rows s USING (c_custkey)),
med AS (SELECT quantile_cont(acct, 0.5) AS m FROM cf WHERE split = 'train'),
mom AS (SELECT avg(coalesce(acct, m)) AS mu, stddev_pop(coalesce(acct, m)) AS sd FROM cf, med WHERE split = 'train'),
mode AS (SELECT seg AS md FROM cf WHERE split = 'train' AND seg IS NOT NULL
         GROUP BY seg ORDER BY count(*) DESC, seg LIMIT 1)"""


@register("impute_median", f"""WITH {CUST_SQL}
SELECT c_custkey, round(coalesce(acct, m), 6) AS acct FROM cf, med""")
def q_impute_median(spark, sf):
    cf = customer_features(spark, sf)
    med = X.train_medians(cf.where(F.col("split") == "train"), ["acct"])
    return X.impute_median(cf, ["acct"], med).select("c_custkey", r6(F.col("acct")).alias("acct"))


@register("standardize", f"""WITH {CUST_SQL}
SELECT c_custkey, round((coalesce(acct, m) - mu) / CASE WHEN sd = 0 THEN 1 ELSE sd END, 6) AS z
FROM cf, med, mom""")
def q_standardize(spark, sf):
    cf = customer_features(spark, sf)
    train = cf.where(F.col("split") == "train")
    med = X.train_medians(train, ["acct"])
    mom = X.train_moments(train, ["acct"], med)
    t = X.standardize(X.impute_median(cf, ["acct"], med), ["acct"], mom)
    return t.select("c_custkey", r6(F.col("acct")).alias("z"))


@register("impute_mode", f"""WITH {CUST_SQL}
SELECT c_custkey, coalesce(seg, md) AS seg FROM cf, mode""")
def q_impute_mode(spark, sf):
    cf = customer_features(spark, sf)
    modes = X.train_modes(cf.where(F.col("split") == "train"), ["seg"])
    return X.impute_mode(cf, ["seg"], modes).select("c_custkey", "seg")


@register("one_hot", f"""WITH {CUST_SQL},
cats AS (SELECT DISTINCT coalesce(seg, md) AS category FROM cf, mode WHERE split = 'train')
SELECT c_custkey, category, (coalesce(seg, md) = category)::INT AS value FROM cf, mode, cats""")
def q_one_hot(spark, sf):
    cf = customer_features(spark, sf)
    fm = X.fit_features(cf, [], ["seg"])
    labels = [n[len("seg_"):] for n in fm.names]
    t = fm.transform(cf).select("c_custkey", F.posexplode(vector_to_array("features")).alias("i", "v"))
    lab = F.array(*[F.lit(x) for x in labels])
    return t.select("c_custkey", F.element_at(lab, F.col("i") + 1).alias("category"),
                    F.col("v").cast("int").alias("value"))


@register("feature_pipeline", f"""WITH {CUST_SQL},
nk AS (SELECT quantile_cont(c_nationkey, 0.5) AS m2 FROM cf WHERE split = 'train'),
nkm AS (SELECT avg(coalesce(c_nationkey, m2)) AS mu2, stddev_pop(coalesce(c_nationkey, m2)) AS sd2
        FROM cf, nk WHERE split = 'train'),
cats AS (SELECT list(DISTINCT coalesce(seg, md) ORDER BY coalesce(seg, md)) AS cl FROM cf, mode WHERE split = 'train')
SELECT c_custkey, split,
       list_transform([(coalesce(c_nationkey, m2) - mu2) / CASE WHEN sd2 = 0 THEN 1 ELSE sd2 END,
                       (coalesce(acct, m) - mu) / CASE WHEN sd = 0 THEN 1 ELSE sd END]
                      || list_transform(cl, lambda x: CASE WHEN x = coalesce(seg, md) THEN 1.0 ELSE 0.0 END),
                      lambda v: round(v, 6)) AS features
FROM cf, med, mom, mode, nk, nkm, cats""")
def q_feature_pipeline(spark, sf):
    cf = customer_features(spark, sf)
    fm = X.fit_features(cf, ["c_nationkey", "acct"], ["seg"])
    arr = F.transform(vector_to_array("features"), lambda v: F.round(v, 6))
    return fm.transform(cf).select("c_custkey", "split", arr.alias("features"))


@register("baseline_majority", f"""WITH {S.split_sql('orders', 'o_orderkey', 'o_orderstatus')},
maj AS (SELECT y AS pred FROM split_rows WHERE split = 'train' GROUP BY y ORDER BY count(*) DESC, y LIMIT 1),
preds AS (SELECT 'baseline' AS model, 'val' AS split, y, pred FROM split_rows, maj WHERE split = 'val'),
{S.cm_sql('preds', ['model', 'split'])},{S.summary_sql(['model', 'split'])}
SELECT model, split, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, NULL::DOUBLE AS auc FROM summ""")
def q_baseline(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    s = stratified_split(o, "o_orderstatus", ["o_orderkey"]).table
    p = X.baseline_majority(s, "o_orderstatus").withColumn("model", F.lit("baseline")).withColumn("split", F.lit("val"))
    sm = M.summary(M.confusion(p, ["model", "split"]), ["model", "split"])
    return sm.select("model", "split", r6(F.col("accuracy")).alias("accuracy"), r6(F.col("f1")).alias("f1"),
                     F.lit(None).cast("double").alias("auc"))


# --------------------------------------------------------------------------- binary metrics on documents

BY = ["model", "split"]
EVAL = (f"WITH {DOCS_SQL},\nvpreds AS (SELECT * FROM preds WHERE split <> 'train'),"
        f"{S.cm_sql('vpreds', BY)},{S.summary_sql(BY)},{S.auc_sql('vpreds', BY)}")


def _doc_eval(spark, sf):
    p = doc_preds(docs_split(spark, sf)).where(F.col("split") != "train")
    cm = M.confusion(p, BY)
    return p, cm


@register("accuracy", f"{EVAL}\nSELECT model, split, round(accuracy, 6) AS accuracy FROM summ")
def q_accuracy(spark, sf):
    p, cm = _doc_eval(spark, sf)
    return M.summary(cm, BY).select(*BY, r6(F.col("accuracy")).alias("accuracy"))


@register("f1_weighted", f"{EVAL}\nSELECT model, split, round(f1, 6) AS f1 FROM summ")
def q_f1_weighted(spark, sf):
    p, cm = _doc_eval(spark, sf)
    return M.summary(cm, BY).select(*BY, r6(F.col("f1")).alias("f1"))


@register("auc_binary", f"{EVAL}\nSELECT model, split, round(auc, 6) AS auc FROM auc")
def q_auc(spark, sf):
    p, _ = _doc_eval(spark, sf)
    return M.auc_binary(p, BY).select(*BY, r6(F.col("auc")).alias("auc"))


@register("evaluate_models", f"""{EVAL}
SELECT model, split, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, round(auc, 6) AS auc
FROM summ JOIN auc USING (model, split)""")
def q_evaluate(spark, sf):
    p, cm = _doc_eval(spark, sf)
    sm = M.summary(cm, BY).join(M.auc_binary(p, BY), BY)
    return sm.select(*BY, *[r6(F.col(c)).alias(c) for c in ("accuracy", "f1", "auc")])


@register("f1_binary", f"{EVAL}\nSELECT model, split, round(f1, 6) AS f1_pos FROM pc WHERE label = 1")
def q_f1_binary(spark, sf):
    _, cm = _doc_eval(spark, sf)
    return M.f1_binary(cm, BY).select(*BY, r6(F.col("f1")).alias("f1_pos"))


@register("roc_curve", f"""WITH {DOCS_SQL},
sc AS (SELECT model, score, count_if(y = 1) AS p, count_if(y <> 1) AS q FROM preds WHERE split = 'test' GROUP BY ALL),
cu AS (SELECT *, sum(p) OVER w AS tps, sum(q) OVER w AS fps,
              sum(p) OVER (PARTITION BY model) AS tp_all, sum(q) OVER (PARTITION BY model) AS fp_all
       FROM sc WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
SELECT model, score AS threshold, round(fps / fp_all, 6) AS fpr, round(tps / tp_all, 6) AS tpr FROM cu""")
def q_roc(spark, sf):
    p = doc_preds(docs_split(spark, sf)).where(F.col("split") == "test")
    r = M.roc_curve(p, ["model"])
    return r.select("model", "threshold", r6(F.col("fpr")).alias("fpr"), r6(F.col("tpr")).alias("tpr"))


def _table(spark, sf):
    """Comparison table: baseline + rules on val, rules on test."""
    s = docs_split(spark, sf)
    p = doc_preds(s).where(F.col("split") != "train")
    base = X.baseline_majority(s, "y").select(F.lit("baseline").alias("model"), F.lit(0).alias("ord"),
                                              F.lit("val").alias("split"), "y", "pred")
    allp = p.select("model", "ord", "split", "y", "pred").unionByName(base)
    sm = M.summary(M.confusion(allp, ["model", "ord", "split"]), ["model", "ord", "split"])
    auc = M.auc_binary(p, ["model", "split"])
    return sm.join(auc, ["model", "split"], "left").select(
        "model", "ord", "split", *[r6(F.col(c)).alias(c) for c in ("accuracy", "f1", "auc")])


TABLE_SQL = f"""WITH {DOCS_SQL},
maj AS (SELECT y AS pred FROM dls WHERE split = 'train' GROUP BY y ORDER BY count(*) DESC, y LIMIT 1),
allp AS (SELECT model, ord, split, y, pred FROM preds WHERE split <> 'train'
         UNION ALL SELECT 'baseline', 0, 'val', y, maj.pred FROM dls, maj WHERE split = 'val'),
{S.cm_sql('allp', ['model', 'ord', 'split'])},{S.summary_sql(['model', 'ord', 'split'])},
tpreds AS (SELECT * FROM preds WHERE split <> 'train'),{S.auc_sql('tpreds', ['model', 'split'])},
tab AS (SELECT model, ord, split, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, round(auc, 6) AS auc
        FROM summ LEFT JOIN auc USING (model, split))"""


@register("comparison_table", f"{TABLE_SQL}\nSELECT * FROM tab")
def q_comparison(spark, sf):
    t = _table(spark, sf)
    return M.comparison_table(*[t.where(F.col("split") == s).drop("split") for s in ("val", "test")]).select(*t.columns)


@register("best_model", f"""{TABLE_SQL}
SELECT * FROM tab WHERE split = 'test' AND NOT regexp_matches(lower(model), 'baseline|dummy')
ORDER BY f1 DESC, ord LIMIT 1""")
def q_best_model(spark, sf):
    return M.best_model(_table(spark, sf), "test")


@register("executive_summary", f"""{TABLE_SQL}
SELECT model, round_even(accuracy * 100, 0)::BIGINT AS accuracy_pct, round_even(f1 * 100, 0)::BIGINT AS f1_pct, auc
FROM tab WHERE split = 'test' AND NOT regexp_matches(lower(model), 'baseline|dummy')
ORDER BY f1 DESC, ord LIMIT 1""")
def q_exec_summary(spark, sf):
    return M.executive_summary(_table(spark, sf), "test")


BIN_SQL = f"""WITH {DOCS_SQL},
tpr AS (SELECT * FROM preds WHERE split = 'test'),
b0 AS (SELECT model, count_if(y = 1 AND pred = 1)::DOUBLE AS tp, count_if(y = 0 AND pred = 0)::DOUBLE AS tn,
              count_if(y = 0 AND pred = 1)::DOUBLE AS fp, count_if(y = 1 AND pred = 0)::DOUBLE AS fn FROM tpr GROUP BY model),
bm AS (SELECT model, tp::BIGINT AS "TP", tn::BIGINT AS "TN", fp::BIGINT AS "FP", fn::BIGINT AS "FN",
              tp / (tp + fp + 1e-9) AS precision, tp / (tp + fn + 1e-9) AS recall, tn / (tn + fp + 1e-9) AS specificity,
              tn / (tn + fn + 1e-9) AS npv, 2 * tp / (2 * tp + fp + fn + 1e-9) AS f1,
              (tp + tn) / (tp + tn + fp + fn + 1e-9) AS accuracy, fp / (fp + tn + 1e-9) AS fpr,
              fn / (fn + tp + 1e-9) AS fnr FROM b0)"""
BIN_METRICS = ["precision", "recall", "specificity", "npv", "f1", "accuracy", "fpr", "fnr"]


def _binary(spark, sf):
    p = doc_preds(docs_split(spark, sf)).where(F.col("split") == "test")
    return M.binary_metrics(M.confusion(p, ["model"]), ["model"])


@register("binary_metrics", f"""{BIN_SQL}
SELECT model, "TP", "TN", "FP", "FN", {', '.join(f'round({c}, 6) AS {c}' for c in BIN_METRICS)} FROM bm""")
def q_binary_metrics(spark, sf):
    b = _binary(spark, sf)
    return b.select("model", "TP", "TN", "FP", "FN", *[r6(F.col(c)).alias(c) for c in BIN_METRICS])


@register("binary_recommendations", f"""{BIN_SQL},
r AS (SELECT model, list_filter([
        CASE WHEN recall < 0.5 THEN 'low_recall' END, CASE WHEN precision < 0.5 THEN 'low_precision' END,
        CASE WHEN fpr > 0.3 THEN 'high_false_alarm' END,
        CASE WHEN abs(precision - recall) > 0.2 THEN 'precision_recall_gap' END,
        CASE WHEN accuracy > 0.85 AND f1 < 0.5 THEN 'accuracy_hides_imbalance' END], lambda x: x IS NOT NULL) AS rs FROM bm),
r2 AS (SELECT model, CASE WHEN len(rs) = 0 THEN ['acceptable'] ELSE rs END AS rs FROM r)
SELECT model, (generate_subscripts(rs, 1) - 1)::INT AS idx, unnest(rs) AS rule FROM r2""")
def q_binary_recs(spark, sf):
    return M.binary_recommendations(_binary(spark, sf))


@register("rates_per_100", f"""{BIN_SQL}
SELECT model, round_even(recall * 100, 0)::BIGINT AS recall_per_100,
       round_even(precision * 100, 0)::BIGINT AS precision_per_100,
       round_even(specificity * 100, 0)::BIGINT AS specificity_per_100 FROM bm""")
def q_rates(spark, sf):
    return M.rates_per_100(_binary(spark, sf))


def _band_sql(m: str, v: str) -> str:
    return (f"CASE WHEN {v} IS NULL THEN NULL WHEN {m} = 'auc' THEN CASE WHEN {v} > 0.8 THEN 'success' ELSE 'info' END "
            f"WHEN {m} IN ('fpr', 'fnr') THEN CASE WHEN {v} < 0.15 THEN 'success' WHEN {v} < 0.3 THEN 'warning' ELSE 'danger' END "
            f"ELSE CASE WHEN {v} > 0.75 THEN 'success' WHEN {v} > 0.5 THEN 'warning' ELSE 'danger' END END")


@register("kpi_bands", f"""{BIN_SQL},
tauc AS (SELECT * FROM preds WHERE split = 'test'),{S.auc_sql('tauc', ['model'])},
lng AS ({_u([f"SELECT model, '{c}' AS metric, round({c}, 6) AS value FROM bm" for c in BIN_METRICS]
            + ["SELECT model, 'auc' AS metric, round(auc, 6) AS value FROM auc"])})
SELECT model, metric, value, {_band_sql('metric', 'value')} AS band FROM lng""")
def q_kpi(spark, sf):
    b = _binary(spark, sf)
    p = doc_preds(docs_split(spark, sf)).where(F.col("split") == "test")
    auc = M.auc_binary(p, ["model"])
    stack = F.array(*[F.struct(F.lit(c).alias("metric"), r6(F.col(c)).alias("value")) for c in BIN_METRICS])
    lng = b.select("model", F.explode(stack).alias("s")).select("model", "s.metric", "s.value")
    lng = lng.unionByName(auc.select("model", F.lit("auc").alias("metric"), r6(F.col("auc")).alias("value")))
    return M.kpi_bands(lng)


# --------------------------------------------------------------------------- multiclass metrics on lineitem

LBY = ["model"]
LEVAL = f"WITH {LI_SQL},\n{S.cm_sql('lp', LBY)},{S.summary_sql(LBY)}"


def _li_cm(spark, sf):
    return M.confusion(li_preds(spark, sf), LBY)


@register("confusion_matrix", f"{LEVAL}\nSELECT model, real, predicted, n FROM cm")
def q_confusion(spark, sf):
    return _li_cm(spark, sf)


@register("confusion_normalized", f"""{LEVAL}
SELECT model, real, predicted, round_even(n / (sum(n) OVER (PARTITION BY model, real) + 1e-9), 3) AS share FROM cm""")
def q_confusion_norm(spark, sf):
    return M.confusion_normalized(_li_cm(spark, sf))


@register("balanced_accuracy", f"{LEVAL}\nSELECT model, round(balanced_accuracy, 6) AS balanced_accuracy FROM summ")
def q_balanced(spark, sf):
    return M.summary(_li_cm(spark, sf)).select("model", r6(F.col("balanced_accuracy")).alias("balanced_accuracy"))


@register("cohen_kappa", f"{LEVAL}\nSELECT model, round(kappa, 6) AS kappa FROM summ")
def q_kappa(spark, sf):
    return M.summary(_li_cm(spark, sf)).select("model", r6(F.col("kappa")).alias("kappa"))


@register("mcc", f"{LEVAL}\nSELECT model, round(mcc, 6) AS mcc FROM summ")
def q_mcc(spark, sf):
    return M.summary(_li_cm(spark, sf)).select("model", r6(F.col("mcc")).alias("mcc"))


@register("classification_report", f"""{LEVAL},
agg AS (SELECT model, sum(tp) AS c, first(total) AS n, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
               sum(precision * real_n) AS wp, sum(recall * real_n) AS wr, sum(f1 * real_n) AS wf FROM pc GROUP BY model)
SELECT model, label, 0 AS ord, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       real_n::BIGINT AS support FROM pc
UNION ALL SELECT model, 'accuracy', 1, NULL, NULL, round(c / n, 6), n::BIGINT FROM agg
UNION ALL SELECT model, 'macro avg', 2, round(mp, 6), round(mr, 6), round(mf, 6), n::BIGINT FROM agg
UNION ALL SELECT model, 'weighted avg', 3, round(wp / n, 6), round(wr / n, 6), round(wf / n, 6), n::BIGINT FROM agg""")
def q_report(spark, sf):
    r = M.classification_report(_li_cm(spark, sf))
    return r.select("model", "label", "ord", *[r6(F.col(c)).alias(c) for c in ("precision", "recall", "f1")], "support")


CP_SQL = f"""{LEVAL},
cp0 AS (SELECT model, label, tp / (pred_n + 1e-9) AS precision, tp / (real_n + 1e-9) AS recall, real_n FROM pc),
cp AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-9) AS f1,
              (row_number() OVER (PARTITION BY model ORDER BY recall DESC, label) = 1)::INT AS is_best,
              (row_number() OVER (PARTITION BY model ORDER BY recall ASC, label) = 1)::INT AS is_worst FROM cp0),
tc AS (SELECT model, real, predicted, n,
              row_number() OVER (PARTITION BY model ORDER BY n DESC, real DESC, predicted DESC) AS rank,
              round_even(100.0 * n / sum(n) OVER (PARTITION BY model, real), 1) AS pct FROM cm
       QUALIFY real <> predicted AND n > 0)"""


@register("class_performance", f"""{CP_SQL}
SELECT model, label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       real_n::BIGINT AS cases, is_best, is_worst FROM cp""")
def q_class_perf(spark, sf):
    c = M.class_performance(_li_cm(spark, sf))
    return c.select("model", "label", *[r6(F.col(x)).alias(x) for x in ("precision", "recall", "f1")],
                    "cases", "is_best", "is_worst")


TC_SQL = CP_SQL.replace("""              round_even(100.0 * n / sum(n) OVER (PARTITION BY model, real), 1) AS pct FROM cm
       QUALIFY real <> predicted AND n > 0)""", """              pct FROM (SELECT *, round_even(100.0 * n / sum(n) OVER (PARTITION BY model, real), 1) AS pct
                        FROM cm) WHERE real <> predicted AND n > 0)""")


@register("top_confusions", f"""{TC_SQL}
SELECT model, rank::INT AS rank, real, predicted, n, pct FROM tc WHERE rank <= 5""")
def q_top_conf(spark, sf):
    return M.top_confusions(_li_cm(spark, sf))


@register("multiclass_recommendations", f"""{TC_SQL},
sz AS (SELECT model, sum(n) AS tot, count(DISTINCT real) AS k FROM cm GROUP BY model),
j AS (SELECT sz.model, w.label AS worst, w.recall AS wr, t.n AS top_n, t.real AS tr, t.predicted AS tp2, tot, k
      FROM sz LEFT JOIN (SELECT * FROM cp WHERE is_worst = 1) w USING (model)
      LEFT JOIN (SELECT * FROM tc WHERE rank = 1) t USING (model)),
r AS (SELECT model, list_filter([CASE WHEN wr < 0.4 THEN 'hard_class:' || worst END,
                                 CASE WHEN top_n > 0.3 * tot / k THEN 'top_confusion:' || tr || '->' || tp2 END],
                                lambda x: x IS NOT NULL) AS rs FROM j),
r2 AS (SELECT model, CASE WHEN len(rs) = 0 THEN ['reasonable'] ELSE rs END AS rs FROM r)
SELECT model, (generate_subscripts(rs, 1) - 1)::INT AS idx, unnest(rs) AS rule FROM r2""")
def q_mc_recs(spark, sf):
    cm = _li_cm(spark, sf)
    return M.multiclass_recommendations(M.class_performance(cm), M.top_confusions(cm), cm)


@register("auc_ovr_weighted", f"""WITH {LI_SQL},
lg AS (SELECT model, 'A' AS cls, y, pa AS score FROM lp UNION ALL SELECT model, 'N', y, pn FROM lp
       UNION ALL SELECT model, 'R', y, pr FROM lp),
lb AS (SELECT model, cls, (y = cls)::INT AS y, score FROM lg),{S.auc_sql('lb', ['model', 'cls'])},
w AS (SELECT model, cls, sum(y) AS wt FROM lb GROUP BY ALL)
SELECT model, round(sum(auc * wt) / sum(wt), 6) AS auc FROM auc JOIN w USING (model, cls) GROUP BY model""")
def q_auc_ovr(spark, sf):
    a = M.auc_ovr_weighted(li_preds(spark, sf), FLAGS, LBY)
    return a.select("model", r6(F.col("auc")).alias("auc"))
