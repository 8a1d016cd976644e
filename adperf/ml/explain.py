"""Feature importance and per-row contributions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adperf.ml import metrics
from adperf.ml.permute import exchanged
from adperf.ml.prep import Prepared
from adperf.ml.train import score
from adperf.sources.staging import stage


def importances(model: Model, names: Sequence[str], label: str) -> DataFrame:
    """Importance per feature as rows; absolute coefficients for linear models."""
    from pyspark.sql import SparkSession

    weights = (
        model.featureImportances.toArray()
        if hasattr(model, "featureImportances")
        else [abs(float(c)) for c in model.coefficients.toArray()]
    )
    rows = [(label, n, float(w)) for n, w in zip(names, weights)]
    return SparkSession.getActiveSession().createDataFrame(
        rows, "model string, feature string, importance double"
    )


def combined_importances(frames: Sequence[DataFrame]) -> DataFrame:
    """Importances of several models side by side, with their mean."""
    long = reduce(DataFrame.unionByName, frames)
    return long.groupBy("feature").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("model", "importance")))).alias("by_model"),
        F.avg("importance").alias("mean_importance"),
    )


def permutation_importance(
    model: Model,
    prepared: Prepared,
    df: DataFrame,
    key: str,
    target: str,
    columns: Sequence[str],
    repeats: int = 3,
) -> DataFrame:
    """Loss of r2 when a column's values are exchanged between the rows.

    All trials, one for each column and repeat, and the rows as they are, are scored in
    one job.
    """
    coded = prepared._columns(df).withColumn("label", F.col(target).cast("double"))
    coded = coded.withColumns({c: F.col(c).cast("double") for c in columns})
    factors = [f for pair in prepared.interactions.values() for f in pair]
    # every row is copied for each trial, so only what a prediction takes goes along
    coded = coded.select(*dict.fromkeys([key, "label", *columns, *prepared.features, *factors]))
    changed = exchanged(coded, key, columns, repeats)
    if prepared.interactions:
        changed = changed.withColumns(
            {n: F.col(a) * F.col(b) for n, (a, b) in prepared.interactions.items()}
        )
    scored = score(model, prepared.assemble(changed), "p").withColumn("feature", F.col("trial.column"))
    fit = metrics.regression_metrics(
        scored.withColumn("repeat", F.col("trial.repeat")), "label", "p", ["feature", "repeat"]
    ).select("feature", "r2")
    fit = stage(fit, "importance")
    base = fit.filter("feature = ''").agg(F.max("r2")).scalar()
    return (
        fit.filter("feature <> ''")
        .withColumn("loss", base - F.col("r2"))
        .groupBy("feature")
        .agg(F.avg("loss").alias("importance"), F.stddev_pop("loss").alias("spread"))
    )


def linear_contributions(model: Model, df: DataFrame, names: Sequence[str], key: str) -> DataFrame:
    """Exact contribution of each standardised feature to a linear prediction.

    Features are centred, so a contribution is coefficient times value and the
    contributions of a row add up to its prediction less the intercept.
    """
    values = vector_to_array(F.col("features"))
    entries = [
        F.struct(F.lit(n).alias("feature"), (values[i] * F.lit(float(w))).alias("contribution"))
        for i, (n, w) in enumerate(zip(names, model.coefficients.toArray()))
    ]
    return df.select(key, F.inline(F.array(*entries)))
