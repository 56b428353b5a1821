"""SQL text (DuckDB dialect) for the independent oracle of each query.

These strings only restate the meaning of the Spark operators in plain SQL
so the driver can check the results row for row; nothing here runs on Spark.
"""

from __future__ import annotations

from quarry.functions.numeric import bin_labels
from quarry.functions.text import LOAD_NA_TOKENS, NULL_MARKERS, WHITESPACE


def lit_list(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def strip(x: str) -> str:
    return f"trim({x}, '{WHITESPACE}')"


def clean_text(x: str) -> str:
    s = strip(x)
    return f"(CASE WHEN {s} IN ({lit_list(NULL_MARKERS)}) THEN NULL ELSE {s} END)"


def load_token(x: str) -> str:
    return f"(CASE WHEN {x} IN ({lit_list(LOAD_NA_TOKENS)}) THEN NULL ELSE {x} END)"


def parse_number(x: str) -> str:
    s0 = strip(f"({x})::VARCHAR")
    s1 = strip(f"regexp_replace({s0}, '%$', '')")
    s2 = f"regexp_replace({s1}, '[$€¥£]', '', 'g')"
    s3 = f"regexp_replace({s2}, '(?i)S/\\.?', '', 'g')"
    s = strip(f"regexp_replace({s3}, '(?i)USD|PEN|EUR|GBP', '', 'g')")
    has_c = f"contains({s}, ',')"
    has_p = f"contains({s}, '.')"
    comma_last = f"strpos(reverse({s}), ',') < strpos(reverse({s}), '.')"
    norm = (f"(CASE WHEN {has_c} AND {has_p} AND {comma_last} THEN replace(replace({s}, '.', ''), ',', '.') "
            f"WHEN {has_c} AND {has_p} THEN replace({s}, ',', '') "
            f"WHEN {has_c} AND regexp_matches({s}, '^[^,]*,[0-9]{{3}}$') THEN replace({s}, ',', '') "
            f"WHEN {has_c} THEN replace({s}, ',', '.') ELSE {s} END)")
    num_re = "^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$"
    return (f"(CASE WHEN {s0} IS NULL OR {s0} = '' THEN NULL "
            f"WHEN {s} = '' OR {s} = '-' THEN NULL "
            f"WHEN regexp_matches({norm}, '{num_re}') THEN TRY_CAST({norm} AS DOUBLE) END)")


def labels_array(n: int) -> str:
    return "[" + lit_list(bin_labels(n)) + "]"


def r6(x: str) -> str:
    return f"round(({x})::DOUBLE, 6)"


def split_sql(table: str, key: str, target: str, seed: int = 42, prefix: str = "") -> str:
    """DuckDB text of the stratified split (oracle): CTE ``split_rows(<key>, y, split)``."""
    def alloc(name: str, src: str, cnt: str, size: str) -> str:
        return f"""
{name}_t AS (SELECT sum({cnt}) AS n, ceil({size}::DOUBLE * sum({cnt}))::BIGINT AS n_out FROM {src}),
{name}_a AS (SELECT s.*, {cnt} / t.n * (t.n - t.n_out) AS cont, floor({cnt} / t.n * (t.n - t.n_out)) AS fl,
                    t.n - t.n_out AS draws FROM {src} s, {name}_t t),
{name}_r AS (SELECT *, draws - sum(fl) OVER () AS need,
                    row_number() OVER (ORDER BY cont - fl DESC, y) AS rr FROM {name}_a),
{name} AS (SELECT * EXCLUDE (cont, fl, draws, need, rr),
                  (fl + CASE WHEN rr <= need THEN 1 ELSE 0 END)::BIGINT AS {name}_keep FROM {name}_r)"""
    body = f"""
sp_base AS (SELECT {key}, {target} AS y, md5({key}::VARCHAR || '|{seed}') AS h FROM {table} WHERE {target} IS NOT NULL),
sp_cc AS (SELECT y, count(*) AS c FROM sp_base GROUP BY y),{alloc('sp1', 'sp_cc', 'c', '0.2')},
sp1b AS (SELECT y, c, sp1_keep AS temp FROM sp1),{alloc('sp2', 'sp1b', 'temp', '0.25')},
sp_q AS (SELECT y, c - temp AS n_test, temp - sp2_keep AS n_val FROM sp2),
sp_rank AS (SELECT b.*, row_number() OVER (PARTITION BY y ORDER BY h) AS r FROM sp_base b),
split_rows AS (SELECT {key}, r.y, CASE WHEN r <= n_test THEN 'test' WHEN r <= n_test + n_val THEN 'val'
                      ELSE 'train' END AS split FROM sp_rank r JOIN sp_q USING (y))"""
    if prefix:
        import re
        body = re.sub(r"\b(sp_base|sp_cc|sp1_t|sp1_a|sp1_r|sp1b|sp1|sp2_t|sp2_a|sp2_r|sp2|sp_q|sp_rank|split_rows)\b",
                      lambda m: prefix + m.group(1), body)
    return body


def cm_sql(preds: str, by: list[str], p: str = "") -> str:
    """CTEs ``<p>cm`` (completed confusion counts) and ``<p>pc`` (per-class figures) over ``preds(by.., y, pred)``."""
    b = ", ".join(by)
    on = " AND ".join(f"g.{c} = l.{c}" for c in by)
    return f"""
{p}cm0 AS (SELECT {b}, y AS real, pred AS predicted, count(*) AS n FROM {preds}
        WHERE y IS NOT NULL AND pred IS NOT NULL GROUP BY ALL),
{p}lab AS (SELECT {b}, real AS label FROM {p}cm0 UNION SELECT {b}, predicted AS label FROM {p}cm0),
{p}cm AS (SELECT {', '.join(f'l.{c}' for c in by)}, l.label AS real, g.label AS predicted,
              coalesce(c.n, 0)::BIGINT AS n
       FROM {p}lab l JOIN {p}lab g ON {on}
       LEFT JOIN {p}cm0 c ON {' AND '.join(f'c.{x} = l.{x}' for x in by)} AND c.real = l.label AND c.predicted = g.label),
{p}rn AS (SELECT {b}, real AS label, sum(n) AS real_n FROM {p}cm GROUP BY ALL),
{p}pn AS (SELECT {b}, predicted AS label, sum(n) AS pred_n FROM {p}cm GROUP BY ALL),
{p}tp AS (SELECT {b}, real AS label, sum(n) AS tp FROM {p}cm WHERE real = predicted GROUP BY ALL),
{p}pc0 AS (SELECT {b}, label, tp, real_n, pred_n, sum(real_n) OVER (PARTITION BY {b}) AS total,
               CASE WHEN pred_n = 0 THEN 0 ELSE tp / pred_n END AS precision,
               CASE WHEN real_n = 0 THEN 0 ELSE tp / real_n END AS recall
        FROM {p}rn JOIN {p}pn USING ({b}, label) JOIN {p}tp USING ({b}, label)),
{p}pc AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0
                      ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM {p}pc0)"""


def summary_sql(by: list[str], p: str = "") -> str:
    """CTE ``<p>summ``: accuracy, weighted F1, balanced accuracy, kappa, MCC per group (needs ``<p>pc``)."""
    b = ", ".join(by)
    return f"""
{p}sm0 AS (SELECT {b}, sum(tp)::DOUBLE AS c, first(total)::DOUBLE AS s, sum(f1 * real_n) AS wf1,
               avg(f1) AS f1_macro, avg(CASE WHEN real_n > 0 THEN recall END) AS balanced_accuracy,
               sum(real_n * pred_n)::DOUBLE AS stp, sum(pred_n * pred_n)::DOUBLE AS spp,
               sum(real_n * real_n)::DOUBLE AS stt FROM {p}pc GROUP BY ALL),
{p}summ AS (SELECT {b}, s::BIGINT AS n, c / s AS accuracy, wf1 / s AS f1, f1_macro, balanced_accuracy,
                CASE WHEN 1 - stp / (s * s) = 0 THEN NULL
                     ELSE (c / s - stp / (s * s)) / (1 - stp / (s * s)) END AS kappa,
                CASE WHEN (s * s - spp) * (s * s - stt) = 0 THEN 0
                     ELSE (c * s - stp) / sqrt((s * s - spp) * (s * s - stt)) END AS mcc FROM {p}sm0)"""


def auc_sql(preds: str, by: list[str], name: str = "auc") -> str:
    """CTE ``<name>(by.., auc)``: rank-sum AUC over ``preds(by.., y, score)``; positive = largest label."""
    b = ", ".join(by)
    return f"""
{name}_pos AS (SELECT {b}, max(y) AS pos FROM {preds} GROUP BY ALL),
{name}_sc AS (SELECT {b}, score, count_if(y = pos) AS p, count_if(y <> pos) AS q
              FROM {preds} JOIN {name}_pos USING ({b}) WHERE y IS NOT NULL AND score IS NOT NULL GROUP BY ALL),
{name}_cu AS (SELECT *, sum(q) OVER (PARTITION BY {b} ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum_q
              FROM {name}_sc),
{name} AS (SELECT {b}, sum(p * (cum_q - q + 0.5 * q))::DOUBLE / (sum(p) * sum(q))::DOUBLE AS auc
           FROM {name}_cu GROUP BY ALL)"""
