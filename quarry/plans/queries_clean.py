"""Queries: load-time tokens, type inference and cleaning (S2, S3, C1..C9) on dirty orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.numeric import r6
from quarry.operators import clean
from quarry.plans import sqltext as S
from quarry.plans.derived import DIRTY_COLS, DIRTY_ORDERS_SQL, dirty_orders
from quarry.plans.registry import register
from quarry.sources import csv as csvsrc

W = f"WITH {DIRTY_ORDERS_SQL}"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


@register("null_tokens_at_load", f"""{W}
SELECT o_orderkey, {', '.join(f'{S.load_token(c)} AS {c}' for c in DIRTY_COLS)} FROM dirty_orders""")
def q_null_tokens(spark, sf):
    return csvsrc.null_tokens_at_load(dirty_orders(spark, sf), DIRTY_COLS)


def _infer_sql() -> str:
    parts = []
    for i, c in enumerate(DIRTY_COLS):
        x = S.load_token(c)
        parts.append(
            f"SELECT '{c}' AS \"column\", {i} AS pos, CASE WHEN count({x}) = 0 THEN 'string' "
            f"WHEN count_if(regexp_matches({x}, '{csvsrc.INT_RE}')) = count({x}) THEN 'bigint' "
            f"WHEN count_if(regexp_matches({x}, '{csvsrc.FLOAT_RE}')) = count({x}) THEN 'double' "
            f"WHEN count_if({x} IN ({S.lit_list(csvsrc.BOOL_VALUES)})) = count({x}) THEN 'boolean' "
            f"ELSE 'string' END AS type FROM dirty_orders")
    return f"{W}\n" + _union(parts)


@register("infer_types", _infer_sql())
def q_infer_types(spark, sf):
    raw = csvsrc.null_tokens_at_load(dirty_orders(spark, sf), DIRTY_COLS)
    return csvsrc.infer_types(raw, DIRTY_COLS)


@register("trim_strings", f"""{W}
SELECT o_orderkey, {', '.join(f'{S.strip(c)} AS {c}' for c in DIRTY_COLS)} FROM dirty_orders""")
def q_trim(spark, sf):
    return clean.trim_strings(dirty_orders(spark, sf), DIRTY_COLS)


@register("null_markers", f"""{W}
SELECT o_orderkey, {', '.join(f'{S.clean_text(c)} AS {c}' for c in DIRTY_COLS)} FROM dirty_orders""")
def q_null_markers(spark, sf):
    return clean.null_markers(dirty_orders(spark, sf), DIRTY_COLS)


def _audit_sql() -> str:
    parts = [f"SELECT {i} AS pos, '{c}' AS \"column\", count_if({c} IS NULL)::BIGINT AS nulls_before, "
             f"count_if({S.clean_text(c)} IS NULL)::BIGINT AS nulls_total, "
             f"(count_if({S.clean_text(c)} IS NULL) - count_if({c} IS NULL))::BIGINT AS markers_replaced "
             f"FROM dirty_orders" for i, c in enumerate(DIRTY_COLS)]
    return f"{W}\n" + _union(parts)


@register("null_marker_audit", _audit_sql())
def q_marker_audit(spark, sf):
    return clean.null_marker_audit(dirty_orders(spark, sf), DIRTY_COLS)


NUM_COLS = ["price_txt", "pct_txt", "qty_txt", "amount_txt"]


@register("parse_number", f"""{W}
SELECT o_orderkey, {', '.join(f'{S.parse_number(c)} AS {c}' for c in NUM_COLS)} FROM dirty_orders""")
def q_parse_number(spark, sf):
    d = dirty_orders(spark, sf).select("o_orderkey", *NUM_COLS)
    return clean.convert_columns(d, NUM_COLS)


def _rates_sql(cols: list[str]) -> str:
    parts = [f"SELECT {i} AS pos, '{c}' AS \"column\", count({S.clean_text(c)}) AS n_values, "
             f"count({S.parse_number(S.clean_text(c))}) AS n_parsed FROM dirty_orders"
             for i, c in enumerate(cols)]
    return _union(parts)


@register("numeric_text_columns", f"""{W}, r AS ({_rates_sql(DIRTY_COLS)})
SELECT pos, "column", n_values, n_parsed, {S.r6('n_parsed / n_values')} AS rate,
       (coalesce(n_parsed / n_values >= 0.8, false))::INT AS is_numeric FROM r""")
def q_numeric_text(spark, sf):
    d = clean.null_markers(dirty_orders(spark, sf), DIRTY_COLS)
    t = clean.numeric_text_columns(d, DIRTY_COLS)
    return t.select("pos", "column", "n_values", "n_parsed", r6(F.col("rate")).alias("rate"),
                    F.col("is_numeric").cast("int").alias("is_numeric"))


def _long_convert_sql() -> str:
    parts = []
    for c in DIRTY_COLS:
        ok = f"(SELECT n_parsed / n_values >= 0.8 FROM r WHERE \"column\" = '{c}')"
        parts.append(f"SELECT o_orderkey, '{c}' AS \"column\", "
                     f"CASE WHEN {ok} THEN NULL ELSE {S.clean_text(c)} END AS text_value, "
                     f"CASE WHEN {ok} THEN {S.parse_number(S.clean_text(c))} END AS num_value "
                     f"FROM dirty_orders")
    return f"{W}, r AS ({_rates_sql(DIRTY_COLS)})\n" + _union(parts)


@register("convert_columns", _long_convert_sql())
def q_convert(spark, sf):
    d = clean.null_markers(dirty_orders(spark, sf), DIRTY_COLS)
    det = clean.numeric_text_columns(d, DIRTY_COLS).where("is_numeric").select("column").collect()
    numeric = [r["column"] for r in det]
    conv = clean.convert_columns(d, numeric)
    stack = F.array(*[F.struct(F.lit(c).alias("column"),
                               (F.lit(None).cast("string") if c in numeric else F.col(c)).alias("text_value"),
                               (F.col(c) if c in numeric else F.lit(None).cast("double")).alias("num_value"))
                      for c in DIRTY_COLS])
    return conv.select("o_orderkey", F.explode(stack).alias("s")).select("o_orderkey", "s.*")


DEDUP_COLS = ["status_txt", "prio_txt", "pct_txt"]


@register("drop_exact_duplicates", f"""{W}
SELECT DISTINCT {', '.join(f'{S.clean_text(c)} AS {c}' for c in DEDUP_COLS)} FROM dirty_orders""")
def q_dedupe(spark, sf):
    d = clean.null_markers(dirty_orders(spark, sf).select(*DEDUP_COLS), DEDUP_COLS)
    table, _ = clean.drop_exact_duplicates(d)
    return table


AUDIT_COLS = ["status_txt", "prio_txt", "pct_txt", "qty_txt"]


def _key_expr(c: str) -> str:
    ok = f"(SELECT n_parsed / n_values >= 0.8 FROM r WHERE \"column\" = '{c}')"
    return f"CASE WHEN {ok} THEN {S.parse_number(S.clean_text(c))} END"


def _cleaned_sql() -> str:
    # numeric columns of this table are known by their rate; text columns pass cleaned
    return (f"SELECT DISTINCT {S.clean_text('status_txt')} AS status_txt, "
            f"{S.clean_text('prio_txt')} AS prio_txt, {_key_expr('pct_txt')} AS pct_txt, "
            f"{_key_expr('qty_txt')} AS qty_txt FROM dirty_orders")


@register("cleaning_audit", f"""{W}, r AS ({_rates_sql(AUDIT_COLS)}),
m AS ({_union([f"SELECT '{c}' AS \"column\", count_if({S.clean_text(c)} IS NULL)::BIGINT AS n FROM dirty_orders" for c in AUDIT_COLS])}),
d AS (SELECT (SELECT count(*) FROM dirty_orders) - (SELECT count(*) FROM ({_cleaned_sql()})) AS n)
SELECT "column", 'null_markers' AS change, n, NULL::DOUBLE AS rate FROM m WHERE n > 0
UNION ALL
SELECT "column", 'to_numeric' AS change, n_parsed AS n, {S.r6('n_parsed / n_values')} AS rate
FROM r WHERE n_parsed / n_values >= 0.8
UNION ALL
SELECT '*' AS "column", 'duplicates' AS change, n, NULL::DOUBLE AS rate FROM d WHERE n > 0""")
def q_cleaning_audit(spark, sf):
    res = clean.clean_table(dirty_orders(spark, sf).select(*AUDIT_COLS))
    return res.audit.select("column", "change", "n", r6(F.col("rate")).alias("rate"))


@register("clean_table", f"""{W}, r AS ({_rates_sql(AUDIT_COLS)})
{_cleaned_sql()}""")
def q_clean_table(spark, sf):
    return clean.clean_table(dirty_orders(spark, sf).select(*AUDIT_COLS)).table

