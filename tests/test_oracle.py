"""Every query with an oracle equals its DuckDB SQL on the driver's tables (as the driver checks it)."""

import os

import pytest

import __spark_entry__ as entry_module
from quarry.plans import catalog as E
from tests.oracle_check import check, duck

SF = os.environ.get("QUARRY_ORACLE_SF", "/root/testdata/sf0.01")
ORACLES = E.oracle_sql()
QUERIES = E.queries()


def _sums_to_one(rows, by, value):
    total = {}
    for r in rows:
        total[r[by]] = total.get(r[by], 0.0) + r[value]
    assert all(abs(t - 1) < 1e-6 for t in total.values())


def _sweep(rows):
    assert [r["k"] for r in rows] == sorted(r["k"] for r in rows)
    assert all(-1 <= r["silhouette"] <= 1 and r["n_sample"] <= r["n_rows"] for r in rows)


def _falling(rows):
    cost = [r["inertia"] for r in sorted(rows, key=lambda r: r["k"])]
    assert cost[0] > cost[-1] > 0


def _importances(rows):
    values = [r["importance"] for r in rows]
    assert values == sorted(values, reverse=True) and sum(values) <= 1 + 1e-9


def _linkage(rows):
    assert all(r["size"] >= 2 and r["height"] >= 0 for r in rows)


#: What must hold for results that SQL cannot give; tests/test_models.py works them out again.
CHECKS = {
    "class_probability": lambda rows: _sums_to_one(rows, "doc_id", "probability"),
    "feature_importance": _importances,
    "kmeans_sweep": lambda rows: (_sweep(rows), _falling(rows)),
    "ward_clusters": _sweep,
    "elbow_table": _falling,
    "linkage_table": _linkage,
}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    r = check(spark, SF, key, QUERIES[key], ORACLES[key], con)
    assert r["ok"], r["note"]


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_query_runs(spark, key):
    rows = QUERIES[key](spark, "/root/testdata/sf0.001").collect()
    assert rows
    CHECKS.get(key, lambda rows: None)(rows)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
