"""Leakage-safe preprocessing fitted on the train split only.

Numeric columns: NULL -> exact train median, then (x - mean) / population
std (a zero std divides by 1).  Categorical columns: NULL -> most frequent
train value (smallest on a tie), then one 0/1 slot per train category;
categories never seen in train give all zeros.

Statistics are a few distributed aggregates over ``split = 'train'``; they
come back as one number per column and are frozen as literals in a
``SQLTransformer``, followed by ``StringIndexer`` / ``OneHotEncoder`` /
``VectorAssembler`` -- one ``PipelineModel`` that can be reused for
validation, test, scoring and streams.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import order_stats
from quarry.operators.profile import long_numeric
from quarry.operators.schema import q


#: Slots of a column with more train values than this: values share them by hash.
MAX_SLOTS = 10_000


def _sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(float(v))


def train_medians(train: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """X2 statistics: exact median per numeric column (NULLs ignored)."""
    if not cols:
        return {}
    qs = order_stats.quantiles(long_numeric(train, cols), "value", [0.5], ["column"]).collect()
    got = {r["column"]: float(r["q"]) for r in qs}
    return {c: got.get(c) for c in cols}


def impute_median(df: DataFrame, cols: list[str], medians: dict[str, float | None]) -> DataFrame:
    """NULL -> train median (columns with no train value are left as they are)."""
    return df.select(*[F.coalesce(q(c).cast("double"), F.lit(medians[c])).alias(c)
                       if c in cols and medians.get(c) is not None else q(c) for c in df.columns])


def train_moments(train: DataFrame, cols: list[str], medians: dict[str, float | None]) -> dict[str, tuple[float, float]]:
    """X3 statistics: mean and population std of the imputed train values."""
    if not cols:
        return {}
    aggs = []
    for i, c in enumerate(cols):
        x = F.coalesce(q(c).cast("double"), F.lit(medians.get(c)))
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    r = train.agg(*aggs).first()
    out = {}
    for i, c in enumerate(cols):
        sd = r[f"s{i}"]
        out[c] = (r[f"m{i}"], sd if sd else 1.0)
    return out


def standardize(df: DataFrame, cols: list[str], moments: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / std with the train moments."""
    return df.select(*[((q(c) - F.lit(moments[c][0])) / F.lit(moments[c][1])).alias(c)
                       if c in cols else q(c) for c in df.columns])


def train_modes(train: DataFrame, cols: list[str]) -> dict[str, str | None]:
    """The mode of each column."""
    return {c: m for c, (m, _) in category_stats(train, cols).items()}


def category_stats(train: DataFrame, cols: list[str]) -> dict[str, tuple[str | None, int]]:
    """X4 statistics: most frequent train value per column (smallest on a tie) and number of values.

    Counts per (column, value) are pre-aggregated map-side; the pick per
    column is a ``min_by`` aggregate, so no task holds all values of a column.
    """
    if not cols:
        return {}
    stack = F.array(*[F.struct(F.lit(c).alias("column"), q(c).cast("string").alias("value")) for c in cols])
    long = train.select(F.explode(stack).alias("s")).select("s.*").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("nn"), F.col("value").alias("v"))).alias("mode"),
        F.count(F.lit(1)).alias("n_values")).collect()
    got = {r["column"]: (r["mode"], int(r["n_values"])) for r in best}
    return {c: got.get(c, (None, 0)) for c in cols}


def impute_mode(df: DataFrame, cols: list[str], modes: dict[str, str | None]) -> DataFrame:
    """Categorical NULL -> train mode (as text)."""
    return df.select(*[F.coalesce(q(c).cast("string"), F.lit(modes.get(c))).alias(c)
                       if c in cols else q(c) for c in df.columns])


@dataclass
class FeatureModel:
    model: PipelineModel
    numeric: list[str]
    categorical: list[str]
    medians: dict
    moments: dict
    modes: dict
    names: list[str] = field(default_factory=list)
    hashed: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


def fit_features(data: DataFrame, numeric: list[str], categorical: list[str],
                 split_col: str | None = "split", output: str = "features", max_slots: int = MAX_SLOTS) -> FeatureModel:
    """Fit the whole preprocessing on ``split = 'train'`` rows (all rows when split_col is None).

    A categorical column with more than ``max_slots`` train values gets that many slots, which its values
    share by hash (named ``column_#slot``): no column is left out, and neither the category lists nor the
    vectors grow with the table.
    """
    train = data.where(F.col(split_col) == "train") if split_col else data
    medians = train_medians(train, numeric)
    num = [c for c in numeric if medians.get(c) is not None]
    moments = train_moments(train, num, medians)
    stats = category_stats(train, categorical)
    modes = {c: m for c, (m, _) in stats.items()}
    cat = [c for c in categorical if modes.get(c) is not None]
    hashed = [c for c in cat if stats[c][1] > max_slots]
    exprs = ["*"]
    for i, c in enumerate(num):
        m, s = moments[c]
        exprs.append(f"(coalesce(CAST(`{c}` AS DOUBLE), {_sql_lit(medians[c])}) - {_sql_lit(m)}) / {_sql_lit(s)}"
                     f" AS `__f{i}`")
    for j, c in enumerate(cat):
        value = f"coalesce(CAST(`{c}` AS STRING), {_sql_lit(modes[c])})"
        if c in hashed:
            value = f"concat('#', pmod(xxhash64({value}), {max_slots}))"
        exprs.append(f"{value} AS `__c{j}`")
    sqlt = SQLTransformer(statement=f"SELECT {', '.join(exprs)} FROM __THIS__")
    stages = [sqlt]
    names = list(num)
    vec_inputs = [f"__f{i}" for i in range(len(num))]
    if cat:
        prepared = sqlt.transform(train)
        si = StringIndexer(inputCols=[f"__c{j}" for j in range(len(cat))],
                           outputCols=[f"__i{j}" for j in range(len(cat))],
                           stringOrderType="alphabetAsc", handleInvalid="keep").fit(prepared)
        ohe = OneHotEncoder(inputCols=[f"__i{j}" for j in range(len(cat))],
                            outputCols=[f"__o{j}" for j in range(len(cat))],
                            dropLast=True, handleInvalid="error").fit(si.transform(prepared))
        stages += [si, ohe]
        for j, c in enumerate(cat):
            names += [f"{c}_{v}" for v in si.labelsArray[j]]
        vec_inputs += [f"__o{j}" for j in range(len(cat))]
    stages.append(VectorAssembler(inputCols=vec_inputs, outputCol=output, handleInvalid="keep"))
    return FeatureModel(PipelineModel(stages=stages), num, cat, medians, moments, modes, names, hashed)


def feature_names(fm: FeatureModel) -> DataFrame:
    """Names of the vector slots: numeric columns, then ``column_value`` per train category."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    return spark.createDataFrame([(i, n) for i, n in enumerate(fm.names)], "idx int, feature string")


def baseline_majority(data: DataFrame, target: str, split_col: str = "split",
                      eval_split: str = "val") -> DataFrame:
    """Predict the most frequent train class (smallest on a tie) for the rows of ``eval_split``.

    Returns the predictions: ``y``, ``pred`` (same type as the target).
    """
    train = data.where(F.col(split_col) == "train")
    counts = train.groupBy(q(target).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    top = counts.agg(F.min_by("y", F.struct((-F.col("n")).alias("nn"), F.col("y").alias("v"))).alias("pred")).first()
    pred = top["pred"]
    ev = data.where(F.col(split_col) == eval_split)
    return ev.select(q(target).alias("y"), F.lit(pred).cast(data.schema[target].dataType).alias("pred"))
