"""Queries: target discretization (D1..D10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import discretize as D
from quarry.plans import sqltext as S
from quarry.plans.registry import register
from quarry.session import read_table

LI_COLS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
THIRDS = "[0, 1/3, 2/3, 1]"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _cont_sql() -> str:
    parts = []
    for c in LI_COLS:
        x = f"{c}::DOUBLE"
        parts.append(f"SELECT '{c}' AS \"column\", count(DISTINCT {x}) AS n_distinct, "
                     f"bool_and({x} = floor({x}))::INT AS all_integer, max({x}) - min({x}) AS value_range FROM lineitem")
    return (f"WITH t AS ({_union(parts)})\nSELECT *, (n_distinct > 15 AND NOT (all_integer = 1 AND value_range < 20))::INT "
            f"AS is_continuous FROM t")


@register("is_continuous", _cont_sql())
def q_is_continuous(spark, sf):
    t = D.is_continuous(read_table(spark, sf, "lineitem"), LI_COLS)
    return t.select("column", "n_distinct", F.col("all_integer").cast("int").alias("all_integer"),
                    "value_range", F.col("is_continuous").cast("int").alias("is_continuous"))


def _qbin_sql(n: int) -> str:
    probs = "[" + ", ".join(f"{i}/{n}" for i in range(n + 1)) + "]"
    inner = " + ".join(f"(o_totalprice > e[{i + 1}])::INT" for i in range(1, n))
    return (f"WITH q AS (SELECT quantile_cont(o_totalprice, {probs}) AS e FROM orders),\n"
            f"b AS (SELECT o_orderkey, ({inner}) AS bin FROM orders, q)\n"
            f"SELECT o_orderkey, bin, {S.labels_array(n)}[bin + 1] AS label FROM b")


@register("bin_quantile", _qbin_sql(3))
def q_bin_quantile(spark, sf):
    b = D.bin_quantile(read_table(spark, sf, "orders"), "o_totalprice", 3, out="label")
    return b.table.select("o_orderkey", F.col("label_idx").alias("bin"), "label")


UNIFORM_SQL = """
WITH m AS (SELECT min(value) AS mn, max(value) AS mx FROM events),
e AS (SELECT mn, mx, (mx - mn) / 3 AS st FROM m),
b AS (SELECT event_id, ((value > 1 * st + mn)::INT + (value > 2 * st + mn)::INT) AS bin FROM events, e
      WHERE value IS NOT NULL)
SELECT event_id, bin, ['Bajo', 'Medio', 'Alto'][bin + 1] AS label FROM b"""


@register("bin_uniform", UNIFORM_SQL)
def q_bin_uniform(spark, sf):
    b = D.bin_uniform(read_table(spark, sf, "events"), "value", 3, out="label")
    return b.table.where(F.col("value").isNotNull()).select("event_id", F.col("label_idx").alias("bin"), "label")


@register("bin_binary_median", """
WITH m AS (SELECT median(o_totalprice) AS t FROM orders)
SELECT o_orderkey, (o_totalprice > t)::INT AS bin FROM orders, m""")
def q_bin_median(spark, sf):
    b = D.bin_binary_median(read_table(spark, sf, "orders"), "o_totalprice", out="bin")
    return b.table.select("o_orderkey", "bin")


@register("bin_binary_mean", """
WITH m AS (SELECT avg(o_totalprice) AS t FROM orders)
SELECT o_orderkey, (o_totalprice > t)::INT AS bin FROM orders, m""")
def q_bin_mean(spark, sf):
    b = D.bin_binary_mean(read_table(spark, sf, "orders"), "o_totalprice", out="bin")
    return b.table.select("o_orderkey", "bin")


CUTS = [0.0, 10000.0, 50000.0, 100000.0]


@register("bin_manual", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_extendedprice >= 0 AND l_extendedprice <= 100000
       THEN (l_extendedprice > 10000)::INT + (l_extendedprice > 50000)::INT END AS bin,
  CASE WHEN l_extendedprice >= 0 AND l_extendedprice <= 100000
       THEN ['Bajo', 'Medio', 'Alto'][(l_extendedprice > 10000)::INT + (l_extendedprice > 50000)::INT + 1] END AS label
FROM lineitem""")
def q_bin_manual(spark, sf):
    b = D.bin_manual(read_table(spark, sf, "lineitem"), "l_extendedprice", CUTS, out="label")
    return b.table.select("l_orderkey", "l_linenumber", F.col("label_idx").alias("bin"), "label")


def _labels_sql() -> str:
    parts = []
    for n in (5, 7):
        probs = "[" + ", ".join(f"{i}/{n}" for i in range(n + 1)) + "]"
        inner = " + ".join(f"(o_totalprice > e[{i + 1}])::INT" for i in range(1, n))
        parts.append(f"SELECT {n} AS n_bins, bin, {S.labels_array(n)}[bin + 1] AS label, count(*) AS n "
                     f"FROM (SELECT ({inner}) AS bin FROM orders, "
                     f"(SELECT quantile_cont(o_totalprice, {probs}) AS e FROM orders)) GROUP BY bin")
    return _union(parts)


@register("bin_labels", _labels_sql())
def q_bin_labels(spark, sf):
    o = read_table(spark, sf, "orders")
    out = None
    for n in (5, 7):
        b = D.bin_quantile(o, "o_totalprice", n, out="label")
        t = (b.table.groupBy(F.col("label_idx").alias("bin"), "label").agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(n).alias("n_bins"), "bin", "label", "n"))
        out = t if out is None else out.unionByName(t)
    return out


@register("discretize_target", f"""
WITH q AS (SELECT quantile_cont(o_totalprice, {THIRDS}) AS e FROM orders)
SELECT o_orderkey, o_custkey, o_orderstatus,
       ['Bajo', 'Medio', 'Alto'][(o_totalprice > e[2])::INT + (o_totalprice > e[3])::INT + 1] AS o_totalprice_cat
FROM orders, q""")
def q_discretize_target(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return D.discretize_target(o, "o_totalprice", "quantile", 3).table


@register("bin_threshold", """
SELECT l_orderkey, l_linenumber, (l_quantity >= 25)::INT AS bin FROM lineitem""")
def q_bin_threshold(spark, sf):
    t = D.bin_threshold(read_table(spark, sf, "lineitem"), "l_quantity", 25, out="bin")
    return t.select("l_orderkey", "l_linenumber", "bin")


@register("bin_edges", f"""
WITH q AS (SELECT quantile_cont(o_totalprice, {THIRDS}) AS e FROM orders),
m AS (SELECT min(value) AS mn, max(value) AS mx FROM events)
SELECT 'quantile' AS method, i - 1 AS idx, round(e[i], 2) AS edge FROM q, range(1, 5) r(i)
UNION ALL
SELECT 'uniform' AS method, i AS idx,
  round(CASE WHEN i = 0 THEN mn - (mx - mn) * 0.001 WHEN i = 3 THEN mx ELSE i * ((mx - mn) / 3) + mn END, 2) AS edge
FROM m, range(0, 4) r(i)""")
def q_bin_edges(spark, sf):
    o = read_table(spark, sf, "orders")
    e = read_table(spark, sf, "events")
    qe = D.edges_table(o, D.quantile_edges(o, "o_totalprice", 3)).select(F.lit("quantile").alias("method"), "*")
    ue = D.edges_table(e, D.uniform_edges(e, "value", 3)).select(F.lit("uniform").alias("method"), "*")
    return qe.unionByName(ue).select("method", F.col("idx").cast("long").alias("idx"), "edge")

