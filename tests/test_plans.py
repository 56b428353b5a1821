"""Plan properties of every registered query: no cartesian products or nested-loop joins,
and the scans read only the columns they need."""

import pytest

from quarry.plans import catalog as E

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cross_join(spark, key):
    df = QUERIES[key](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def _read_schemas(df):
    import re
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [{f.split(":")[0] for f in sch.split(",")} for sch in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]


def test_scans_are_pruned(spark):
    from quarry.plans import queries_model as QM

    cases = [
        (QUERIES["bin_quantile"](spark, SF), {"o_orderkey", "o_totalprice"}),
        (QUERIES["filters"](spark, SF), {"event_id", "user_id", "event_type", "value"}),
        (QM.li_preds(spark, SF), {"l_returnflag", "l_quantity", "l_discount"}),
        (QM.docs_labeled(spark, SF), {"doc_id", "text", "n_chars", "quality"}),
    ]
    for df, allowed in cases:
        schemas = _read_schemas(df)
        assert schemas, "no parquet scan in plan"
        for names in schemas:
            assert names <= allowed, (names, allowed)
