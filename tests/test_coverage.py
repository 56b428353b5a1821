"""COVERAGE.md names every registered query, and its check column agrees with the oracles."""

import os

from quarry.plans import catalog as E

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_coverage_lists_every_query():
    text = open(os.path.join(ROOT, "COVERAGE.md")).read()
    oracles = E.oracle_sql()
    for key in E.queries():
        line = next((ln for ln in text.splitlines() if f"`{key}`" in ln), None)
        assert line is not None, key
        assert line.rstrip().endswith("| SQL |") == (key in oracles), key
