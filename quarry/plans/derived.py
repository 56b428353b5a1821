"""Tables derived from the driver's tables, built the same way in Spark and in SQL.

``dirty_orders`` turns ``orders`` into the kind of text a spreadsheet export
carries (currency, thousands marks, decimal commas, percent, null markers,
padding).  The variant of each row comes from the md5 of its key, so both
engines derive the same text without any filter or subset: every order
is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import read_table

LOAD = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


def _s(c: Column) -> Column:
    return c.cast("string")


def dirty_orders(spark, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(*[c.strip() for c in LOAD.split(",")])
    h = F.md5(_s(F.col("o_orderkey")))
    o = (o.withColumn("_v1", F.substring(h, 1, 1)).withColumn("_v2", F.substring(h, 2, 1))
         .withColumn("_v3", F.substring(h, 3, 1))
         .withColumn("_cents", F.round(F.col("o_totalprice") * 100).cast("long")))
    o = (o.withColumn("_ip", F.expr("_cents div 100")).withColumn("_fp", F.col("_cents") % 100)
         .withColumn("_th", F.expr("_cents div 100000")))
    fs = F.lpad(_s(F.col("_fp")), 2, "0")
    lo3 = F.lpad(_s(F.col("_ip") % 1000), 3, "0")
    ip = _s(F.col("_ip"))
    th = _s(F.col("_th"))
    big = F.col("_th") > 0
    us = F.when(big, F.concat(th, F.lit(","), lo3, F.lit("."), fs)).otherwise(F.concat(ip, F.lit("."), fs))
    eu = F.when(big, F.concat(th, F.lit("."), lo3, F.lit(","), fs)).otherwise(F.concat(ip, F.lit(","), fs))
    usi = F.when(big, F.concat(th, F.lit(","), lo3)).otherwise(ip)
    v1 = F.col("_v1")
    price = (F.when(v1 == "0", F.concat(F.lit("S/. "), us))
             .when(v1 == "1", F.concat(F.lit("$"), us))
             .when(v1 == "2", eu)
             .when(v1 == "3", F.concat(ip, F.lit("."), fs))
             .when(v1 == "4", F.concat(ip, F.lit(","), fs))
             .when(v1 == "5", F.lit("N/A"))
             .when(v1 == "6", F.concat(F.lit("  "), ip, F.lit("."), fs, F.lit(" ")))
             .when(v1 == "7", F.concat(F.lit("€ "), eu))
             .when(v1 == "8", F.concat(F.lit("USD "), ip))
             .when(v1 == "9", F.concat(us, F.lit(" PEN")))
             .when(v1 == "a", F.lit("?"))
             .when(v1 == "b", F.lit(""))
             .when(v1 == "c", F.concat(F.lit("S/."), usi))
             .when(v1 == "d", F.lit("sin dato"))
             .when(v1 == "e", F.concat(F.lit("~"), ip))
             .otherwise(us))
    v2 = F.col("_v2")
    st = F.col("o_orderstatus")
    status = (F.when(v2 == "0", F.concat(F.lit(" "), st, F.lit(" ")))
              .when(v2 == "1", F.lower(st))
              .when(v2 == "2", F.lit("NULL"))
              .when(v2 == "3", F.lit(None).cast("string"))
              .otherwise(st))
    prio = (F.when(v2 == "4", F.lit("-")).when(v2 == "5", F.lit("desconocido"))
            .otherwise(F.col("o_orderpriority")))
    v3 = F.col("_v3")
    pc = _s(F.col("o_custkey") % 100)
    pct = (F.when(v3 == "0", F.lit(".")).when(v3 == "1", F.lit(None).cast("string"))
           .when(v3 == "2", F.concat(pc, F.lit(" %"))).otherwise(F.concat(pc, F.lit("%"))))
    qty = F.when(v3 == "f", F.lit("n/a")).otherwise(_s(F.col("o_custkey")))
    amount = F.concat(ip, F.lit("."), fs)
    return o.select("o_orderkey", price.alias("price_txt"), status.alias("status_txt"),
                    prio.alias("prio_txt"), pct.alias("pct_txt"), qty.alias("qty_txt"),
                    amount.alias("amount_txt"))


DIRTY_ORDERS_SQL = """
dirty_orders AS (
  WITH b AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
           substr(md5(o_orderkey::VARCHAR), 1, 1) AS v1,
           substr(md5(o_orderkey::VARCHAR), 2, 1) AS v2,
           substr(md5(o_orderkey::VARCHAR), 3, 1) AS v3,
           round(o_totalprice * 100)::BIGINT AS cents
    FROM orders),
  c AS (
    SELECT *, cents // 100 AS ip, cents % 100 AS fp, cents // 100000 AS th FROM b),
  d AS (
    SELECT *, lpad(fp::VARCHAR, 2, '0') AS fs, lpad((ip % 1000)::VARCHAR, 3, '0') AS lo3 FROM c),
  e AS (
    SELECT *,
      CASE WHEN th > 0 THEN th::VARCHAR || ',' || lo3 || '.' || fs ELSE ip::VARCHAR || '.' || fs END AS us,
      CASE WHEN th > 0 THEN th::VARCHAR || '.' || lo3 || ',' || fs ELSE ip::VARCHAR || ',' || fs END AS eu,
      CASE WHEN th > 0 THEN th::VARCHAR || ',' || lo3 ELSE ip::VARCHAR END AS usi
    FROM d)
  SELECT o_orderkey,
    CASE v1 WHEN '0' THEN 'S/. ' || us WHEN '1' THEN '$' || us WHEN '2' THEN eu
            WHEN '3' THEN ip::VARCHAR || '.' || fs WHEN '4' THEN ip::VARCHAR || ',' || fs
            WHEN '5' THEN 'N/A' WHEN '6' THEN '  ' || ip::VARCHAR || '.' || fs || ' '
            WHEN '7' THEN '€ ' || eu WHEN '8' THEN 'USD ' || ip::VARCHAR WHEN '9' THEN us || ' PEN'
            WHEN 'a' THEN '?' WHEN 'b' THEN '' WHEN 'c' THEN 'S/.' || usi WHEN 'd' THEN 'sin dato'
            WHEN 'e' THEN '~' || ip::VARCHAR ELSE us END AS price_txt,
    CASE v2 WHEN '0' THEN ' ' || o_orderstatus || ' ' WHEN '1' THEN lower(o_orderstatus)
            WHEN '2' THEN 'NULL' WHEN '3' THEN NULL ELSE o_orderstatus END AS status_txt,
    CASE v2 WHEN '4' THEN '-' WHEN '5' THEN 'desconocido' ELSE o_orderpriority END AS prio_txt,
    CASE v3 WHEN '0' THEN '.' WHEN '1' THEN NULL WHEN '2' THEN (o_custkey % 100)::VARCHAR || ' %'
            ELSE (o_custkey % 100)::VARCHAR || '%' END AS pct_txt,
    CASE WHEN v3 = 'f' THEN 'n/a' ELSE o_custkey::VARCHAR END AS qty_txt,
    ip::VARCHAR || '.' || fs AS amount_txt
  FROM e)
"""

DIRTY_COLS = ["price_txt", "status_txt", "prio_txt", "pct_txt", "qty_txt", "amount_txt"]
