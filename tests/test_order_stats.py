"""Exact order statistics against numpy, including a hot key holding most rows."""

import numpy as np
import pytest

from quarry.operators import order_stats


def test_quantiles_match_numpy_with_hot_group(spark):
    rng = np.random.default_rng(7)
    hot = rng.normal(100, 30, 6000)
    hot[:2000] = 55.5                      # a third of the group is one value
    cold = rng.exponential(10, 300)
    rows = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in cold]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0, 0.1, 0.25, 1 / 3, 0.5, 0.75, 0.9, 1]
    got = {(r["g"], r["p"]): r["q"] for r in
           order_stats.quantiles(df, "x", probs, ["g"]).collect()}
    for g, vals in (("hot", hot), ("cold", cold)):
        want = np.quantile(vals, probs)
        for i, w in enumerate(want):
            assert got[(g, i)] == pytest.approx(w, rel=1e-12, abs=1e-9)


def test_many_requests_are_met_row_by_row(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(0, 3, 4000), 2)
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(7)
    probs = [i / 1000 for i in range(1001)]
    got = [r["q"] for r in order_stats.quantiles(df, "x", probs).orderBy("p").collect()]
    assert got == pytest.approx(np.quantile(x, probs).tolist(), rel=1e-12, abs=1e-12)


def test_kth_of_wide_integers(spark):
    rng = np.random.default_rng(3)
    vals = rng.integers(-(1 << 63), (1 << 63) - 1, 5000)
    df = spark.createDataFrame([(int(v),) for v in vals], "v long")
    asks = [1, 17, 2500, 4999, 5000, 0, 5001]
    req = spark.createDataFrame(list(enumerate(asks)), "req int, k long")
    got = {r["req"]: r["kth"] for r in order_stats.kth_smallest(df, "v", req).collect()}
    s = np.sort(vals)
    assert got == {i: int(s[k - 1]) for i, k in enumerate(asks) if 1 <= k <= 5000}


def test_infinite_and_missing_numbers_have_their_places(spark):
    x = [float("inf"), float("-inf"), float("nan"), 1.0, 2.0, None, float("nan")]
    df = spark.createDataFrame([("a", v) for v in x] + [("b", float("nan")), ("c", None)], "g string, x double")
    req = spark.createDataFrame([(g, k, k) for g in "abc" for k in range(1, 8)], "g string, req int, k long")
    got = {(r["g"], r["req"]): r["kth"] for r in order_stats.kth_smallest(df, "x", req, ["g"]).collect()}
    assert [got["a", k] for k in range(1, 5)] == [float("-inf"), 1.0, 2.0, float("inf")]
    assert np.isnan([got["a", 5], got["a", 6], got["b", 1]]).all() and len(got) == 7


@pytest.mark.parametrize("near,grid", [(0.0, 4), (0.0025, 256)])
def test_ranks_outside_their_bracket_are_found(spark, monkeypatch, near, grid):
    """Brackets that are far too narrow lose no request: a second pass counts where the rank fell."""
    monkeypatch.setattr(order_stats, "NEAR", near)
    monkeypatch.setattr(order_stats, "GRID", grid)
    x = np.random.default_rng(4).normal(0, 1, 3000)
    df = spark.createDataFrame([(i % 2, float(v)) for i, v in enumerate(x)], "g int, v double")
    got = {(r["g"], r["p"]): r["q"] for r in order_stats.quantiles(df, "v", [0.1, 0.5, 0.77], ["g"]).collect()}
    for g in (0, 1):
        assert [got[g, i] for i in range(3)] == pytest.approx(np.quantile(x[g::2], [0.1, 0.5, 0.77]).tolist(), rel=1e-12)
    d = spark.createDataFrame([(float(v),) for v in x], "_v double")
    wrong = spark.createDataFrame([(k, 9.0, 10.0, float(x.min()), float(x.max())) for k in (1, 1500, 3000)],
                                  "k long, _lo double, _hi double, _min double, _max double")
    assert {r["k"]: r["kth"] for r in order_stats.ranked(d, [], wrong).collect()} == {k: np.sort(x)[k - 1] for k in (1, 1500, 3000)}


def test_running_sums_over_many_ranges(spark):
    rows = [(g, i, (i * 7) % 5) for g in ("a", "b", None) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, o long, c long")
    for size in (40, 250_000):
        out = order_stats.running_sums(df, ["g"], "o", ["c"], range_rows=size).collect()
        assert len(out) == 900
        for r in out:
            assert r["cum_c"] == sum((i * 7) % 5 for i in range(r["o"] + 1))
        desc = order_stats.running_sums(df, ["g"], "o", ["c"], descending=True, range_rows=size).collect()
        for r in desc:
            assert r["cum_c"] == sum((i * 7) % 5 for i in range(r["o"], 300))
    plain = order_stats.running_sums(df.where("g = 'a'"), [], "o", ["c"], range_rows=7).collect()
    assert all(r["cum_c"] == sum((i * 7) % 5 for i in range(r["o"] + 1)) for r in plain) and len(plain) == 300


def test_no_inner_plan_has_a_nested_loop(spark, monkeypatch):
    """Every table an order statistic freezes, and its result, is joined by keys or not at all."""
    plans = []
    frozen = order_stats.freeze

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return frozen(df)
    monkeypatch.setattr(order_stats, "freeze", seen)
    df = spark.range(5000).selectExpr("id % 3 AS g", "cast(id * 17 % 997 AS double) AS x")
    results = [order_stats.quantiles(df, "x", [0.25, 0.5], by) for by in ([], ["g"])]
    results.append(order_stats.kth_smallest(df, "x", spark.createDataFrame([(1, 7)], "req int, k long")))
    plans += [r._jdf.queryExecution().executedPlan().toString() for r in results]
    assert len(plans) > 10
    for plan in plans:
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_split_with_a_hot_class_and_narrow_brackets(spark, monkeypatch):
    from quarry.operators import split

    rows = [(i, "hot" if i % 3 else ("a" if i % 2 else "b")) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, y string")
    want = {r["id"]: r["split"] for r in split.stratified_split(df, "y", ["id"]).table.collect()}
    monkeypatch.setattr(split, "DEVIATIONS", 0)  # all cuts outside their brackets
    got = {r["id"]: r["split"] for r in split.stratified_split(df, "y", ["id"]).table.collect()}
    assert got == want
    sizes = {}
    for i, y in rows:
        sizes[(y, got[i])] = sizes.get((y, got[i]), 0) + 1
    assert sizes[("hot", "test")] == 400 and sizes[("hot", "val")] == 400 and sizes[("hot", "train")] == 1200
