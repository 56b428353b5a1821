"""Queries: schema operators (T3, T5, T6) and profiling (P1..P8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.numeric import r6
from quarry.operators import clean, profile, schema
from quarry.plans import sqltext as S
from quarry.plans.derived import DIRTY_COLS, DIRTY_ORDERS_SQL, dirty_orders
from quarry.plans.registry import register
from quarry.session import read_table

W = f"WITH {DIRTY_ORDERS_SQL}"
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ALL_DIRTY = ["o_orderkey", *DIRTY_COLS]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _cleaned(spark, sf):
    return clean.null_markers(dirty_orders(spark, sf), DIRTY_COLS)


def _summary_sql() -> str:
    parts = []
    for i, c in enumerate(ALL_DIRTY):
        x = c if c == "o_orderkey" else S.clean_text(c)
        t = "bigint" if c == "o_orderkey" else "string"
        parts.append(f"SELECT {i} AS pos, '{c}' AS \"column\", '{t}' AS type, count_if({x} IS NULL)::BIGINT AS nulls, "
                     f"round_even(count_if({x} IS NULL) * 100.0 / count(*), 1)::DOUBLE AS pct_nulls FROM dirty_orders")
    return f"{W}\n" + _union(parts)


@register("column_summary", _summary_sql())
def q_column_summary(spark, sf):
    return schema.column_summary(_cleaned(spark, sf))


@register("drop_columns", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""")
def q_drop_columns(spark, sf):
    return schema.drop_columns(read_table(spark, sf, "orders"), ["o_orderdate"])


@register("filters", """
SELECT event_id, user_id FROM events
WHERE value IS NOT NULL AND NOT regexp_matches(lower(event_type), 'view|click')""")
def q_filters(spark, sf):
    e = read_table(spark, sf, "events")
    return (schema.exclude_matching(e.where(F.col("value").isNotNull()), "event_type", "view|click")
            .select("event_id", "user_id"))


@register("shape", "SELECT count(*)::BIGINT AS n_rows, 6::BIGINT AS n_cols FROM orders")
def q_shape(spark, sf):
    return profile.shape(read_table(spark, sf, "orders"))


def _nulls_sql() -> str:
    parts = []
    for i, c in enumerate(ALL_DIRTY):
        x = c if c == "o_orderkey" else S.clean_text(c)
        parts.append(f"SELECT {i} AS pos, '{c}' AS \"column\", count_if({x} IS NULL)::BIGINT AS nulls FROM dirty_orders")
    return f"{W}, t AS ({_union(parts)})\nSELECT * FROM t WHERE nulls > 0"


@register("null_counts", _nulls_sql())
def q_null_counts(spark, sf):
    return profile.null_counts(_cleaned(spark, sf))


@register("target_distribution", """
SELECT o_orderpriority AS class, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1""")
def q_target_distribution(spark, sf):
    return profile.target_distribution(read_table(spark, sf, "orders"), "o_orderpriority")


def _describe_sql() -> str:
    parts = [f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, "
             f"round(stddev_samp({c}), 4) AS std, min({c}) AS min, "
             f"{S.r6(f'quantile_cont({c}, 0.25)')} AS p25, {S.r6(f'quantile_cont({c}, 0.5)')} AS p50, "
             f"{S.r6(f'quantile_cont({c}, 0.75)')} AS p75, max({c}) AS max FROM lineitem" for c in LI_NUM]
    return _union(parts)


@register("describe_numeric", _describe_sql())
def q_describe(spark, sf):
    d = profile.describe_numeric(read_table(spark, sf, "lineitem"), LI_NUM)
    return d.select("column", "count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"),
                    "min", r6(F.col("p25")).alias("p25"), r6(F.col("p50")).alias("p50"),
                    r6(F.col("p75")).alias("p75"), "max")


LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
          "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("distinct_counts", _union([f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM lineitem"
                                     for c in LI_ALL]))
def q_distinct(spark, sf):
    return profile.distinct_counts(read_table(spark, sf, "lineitem"), LI_ALL)


@register("sample_rows", """
SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders
ORDER BY md5(o_orderkey::VARCHAR || '|42') LIMIT 10""")
def q_sample(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return profile.sample_rows(o, 10, ["o_orderkey"], 42)


@register("histogram", """
WITH m AS (SELECT min(o_totalprice) AS mn, max(o_totalprice) AS mx FROM orders),
b AS (SELECT least(floor((o_totalprice - mn) / ((mx - mn) / 20)), 19)::INT AS bin, mn, mx FROM orders, m)
SELECT bin, round(mn + bin * ((mx - mn) / 20), 6) AS lo, round(mn + (bin + 1) * ((mx - mn) / 20), 6) AS hi,
       count(*) AS n FROM b GROUP BY bin, mn, mx""")
def q_histogram(spark, sf):
    h = profile.histogram(read_table(spark, sf, "orders"), "o_totalprice", 20)
    return h.select("bin", r6(F.col("lo")).alias("lo"), r6(F.col("hi")).alias("hi"), "n")


@register("boxplot_by_group", """
WITH q AS (SELECT l_returnflag AS grp, quantile_cont(l_extendedprice, 0.25) AS q1,
                  quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3
           FROM lineitem GROUP BY 1),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
SELECT grp, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
       min(CASE WHEN l_extendedprice >= lo_f THEN l_extendedprice END) AS whisker_lo,
       max(CASE WHEN l_extendedprice <= hi_f THEN l_extendedprice END) AS whisker_hi,
       count_if(l_extendedprice < lo_f OR l_extendedprice > hi_f)::BIGINT AS n_outliers, count(*) AS n
FROM lineitem JOIN f ON l_returnflag = grp GROUP BY grp, q1, median, q3, iqr""")
def q_boxplot(spark, sf):
    b = profile.boxplot_by_group(read_table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice")
    return b.select("grp", *[r6(F.col(c)).alias(c) for c in ["q1", "median", "q3", "iqr"]],
                    "whisker_lo", "whisker_hi", "n_outliers", "n")
