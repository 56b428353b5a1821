"""Small numeric expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-9

# Default labels of 2..5 ordered bins; other counts use G1..Gn.
BIN_LABELS = {
    2: ["Bajo", "Alto"],
    3: ["Bajo", "Medio", "Alto"],
    4: ["Bajo", "Medio-Bajo", "Medio-Alto", "Alto"],
    5: ["Muy Bajo", "Bajo", "Medio", "Alto", "Muy Alto"],
}


def bin_labels(n: int) -> list[str]:
    """Default labels for ``n`` ordered bins."""
    return list(BIN_LABELS.get(n, [f"G{i + 1}" for i in range(n)]))


def div0(num: Column, den: Column) -> Column:
    """num / den with 0/0 -> 0 (scikit-learn's zero_division=0)."""
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def r6(c: Column) -> Column:
    """Round half-up to 6 decimals: the value format shared with the SQL oracle."""
    return F.round(c.cast("double"), 6)
