"""Stateless parts of a fitted run applied to a Structured Streaming source.

The reference has no streaming operator.  What carries over unchanged is
everything that, once fitted on a batch table, is a per-row projection:
text cleaning with the columns chosen by the batch audit, target binning
with frozen edges, and the fitted preprocessing + model.  These functions
take a ``readStream`` DataFrame and return a streaming DataFrame; no state
store is involved.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import clean_text
from quarry.operators.classify import Trained, predict
from quarry.operators.clean import CleanResult, convert_columns, text_columns
from quarry.operators.discretize import bin_index, label_of
from quarry.operators.features import FeatureModel
from quarry.operators.schema import q


@dataclass
class CleanPlan:
    """What the batch audit decided: the text columns and which of them are numbers."""
    text: list[str]
    converted: list[str]

    @staticmethod
    def from_result(batch: DataFrame, res: CleanResult) -> "CleanPlan":
        return CleanPlan(text_columns(batch), list(res.converted))


def clean_stream(stream: DataFrame, plan: CleanPlan) -> DataFrame:
    """Trim + null markers on the text columns, then the batch's number conversions."""
    marked = stream.select(*[clean_text(q(c)).alias(c) if c in plan.text else q(c) for c in stream.columns])
    return convert_columns(marked, plan.converted)


def bin_stream(stream: DataFrame, col: str, edges: list[float], labels: list[str], out: str) -> DataFrame:
    """Frozen bin edges (from a batch ``bin_quantile`` / ``bin_uniform``) applied per row."""
    idx = bin_index(q(col).cast("double"), edges)
    return stream.withColumn(f"{out}_idx", idx).withColumn(out, label_of(F.col(f"{out}_idx"), labels))


def score_stream(stream: DataFrame, fm: FeatureModel, model: Trained, target: str,
                 keep: list[str] | None = None) -> DataFrame:
    """Fitted preprocessing + classifier on each micro-batch row."""
    return predict(model, fm.transform(stream), target, keep)
