"""Number text, null markers, trimming, type inference."""

import pytest
from pyspark.sql import functions as F

from quarry.functions.text import clean_text, parse_number
from quarry.operators import clean
from quarry.sources import csv as csvsrc

CASES = [
    ("S/. 1,500", 1500.0), ("S/.1.250", 1.25), ("1.234,56", 1234.56), ("1,234.56", 1234.56),
    ("12,5", 12.5), ("1,234,567", None), ("25%", 25.0), ("$ -", None), ("€ 200", 200.0),
    ("abc", None), ("  42 ", 42.0), ("USD 99.5", 99.5), ("1500 PEN", 1500.0), ("", None),
    ("-", None), ("-3.5", -3.5), ("1e3", 1000.0), ("25 %", 25.0), ("£7", 7.0), ("¥ 1,000", 1000.0),
    ("inf", None), ("nan", None), ("1_000", None), ("1.0d", None), (None, None), ("12,50", 12.5),
    ("0,001", 1.0), ("1.2.3", None), ("s/ 10", 10.0), ("eur 3,25", 3.25),
]


def test_parse_number_table(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string")
    got = {r["i"]: r["v"] for r in df.select("i", parse_number(F.col("t")).alias("v")).collect()}
    for i, (text, want) in enumerate(CASES):
        assert got[i] == pytest.approx(want) if want is not None else got[i] is None, text


def test_staged_parse_equals_single_expression(spark):
    df = spark.createDataFrame([(t,) for t, _ in CASES], "t string")
    a = [r[0] for r in clean.convert_columns(df, ["t"]).collect()]
    b = [r[0] for r in df.select(parse_number(F.col("t"))).collect()]
    assert a == b


def test_markers_after_trim_case_sensitive(spark):
    vals = [" N/A ", "na", "NA", "Na", "sin dato", "SIN DATO", "Sin dato", "?", " - ", "x", "\t.\n", None]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = [r[0] for r in df.select(clean_text(F.col("t"))).collect()]
    assert got == [None, None, None, "Na", None, None, "Sin dato", None, None, "x", None, None]


def test_load_tokens_and_infer_types(spark):
    rows = [("1", "1.5", "True", "a", "NA"), ("2", "2", "false", "b", "N/A"), ("#N/A", "", "TRUE", "NULL", "")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string")
    d2 = csvsrc.null_tokens_at_load(df)
    types = {r["column"]: r["type"] for r in csvsrc.infer_types(d2).collect()}
    assert types == {"a": "bigint", "b": "double", "c": "boolean", "d": "string", "e": "string"}
    typed = csvsrc.apply_types(d2, types)
    assert [f.dataType.simpleString() for f in typed.schema.fields] == ["bigint", "double", "boolean", "string",
                                                                         "string"]
