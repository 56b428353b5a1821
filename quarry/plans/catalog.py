"""All registered queries; importing a module registers its queries."""

from __future__ import annotations

from quarry.plans import (  # noqa: F401
    queries_clean,
    queries_discretize,
    queries_learn,
    queries_model,
    queries_profile,
)
from quarry.plans.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in ORACLES.items() if k in QUERIES}
