"""Exact distinct counts by every way, and the plan."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import distinct
from quarry.operators.distinct import distinct_values, more_values_than


@pytest.mark.parametrize("few", [distinct.FEW, 10])
def test_counts_by_every_way(spark, monkeypatch, few):
    monkeypatch.setattr(distinct, "FEW", few)
    rng = random.Random(2)
    rows = [(i % 7, -50_000 + i * 3, rng.choice([-(1 << 63), (1 << 63) - 1, rng.randrange(1 << 60)]), float(i % 900) / 7,
             rng.choice([0.0, -0.0, float("nan"), float("inf"), None]), f"s{i % 1300}", None, i % 2 == 0) for i in range(4000)]
    kind = "a int, b long, c long, d double, e double, f string, g long, h boolean"
    df = spark.createDataFrame(rows, kind).repartition(5)
    got = {r["pos"]: r["n_distinct"] for r in distinct_values(df, [F.col(c) for c in "abcdefgh"]).collect()}
    exact = df.agg(*[F.count_distinct(c) for c in "abcdefgh"]).first()
    assert got == dict(enumerate(exact)) and got[4] == 3 and got[6] == 0
    plan = distinct_values(df, [F.col(c) for c in "abcdefgh"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and ("bitmap_construct_agg" in plan)


def test_empty_tables_and_no_columns(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert {r["pos"]: r["n_distinct"] for r in distinct_values(df, [F.col("a"), F.col("b")]).collect()} == {0: 0, 1: 0}
    assert distinct_values(df, []).count() == 0


@pytest.mark.parametrize("n", [0, 1, 15, 16, 17, 40, 5000])
def test_more_values(spark, n):
    df = spark.createDataFrame([(float(i % n),) for i in range(6000)] if n else [(None,)], "v double")
    assert more_values_than(df, F.col("v"), 15) is (n > 15)
