"""Choosing among trained models: best per target, improvement, overviews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adperf.functions.expr import steps_above

# Labels by r2 and by improvement in percent.
FIT_LABELS = [(0.3, "EXCELLENT"), (0.15, "GOOD"), (0.0, "FAIR")]
GAIN_LABELS = [(50.0, "GREAT"), (10.0, "GOOD"), (0.0, "MODEST")]


def select_best(results: DataFrame, metric: str, keep: Sequence[str] = ()) -> DataFrame:
    """The model with the highest metric per target, the first name on ties."""
    rank = F.struct(-F.col(metric), F.col("model"))
    picked = F.min_by(F.struct("model", metric, *keep), rank).alias("b")
    return results.groupBy("target").agg(picked).select("target", "b.*")


def selection_table(regression: DataFrame, binary: DataFrame) -> DataFrame:
    """Best regressor per target by r2 and best classifier by AUC, in one table."""
    reg = select_best(regression, "r2").select(
        "target", "model", F.lit("R2").alias("metric"), F.col("r2").alias("value")
    )
    cls = select_best(binary, "auc").select(
        "target", "model", F.lit("AUC").alias("metric"), F.col("auc").alias("value")
    )
    return reg.unionByName(cls)


def compare(best: DataFrame, baseline: DataFrame, metric: str = "r2") -> DataFrame:
    """Improvement over the baseline in percent; 0 when there is no baseline value."""
    base = baseline.select("target", F.col(metric).alias("_base"))
    gain = (F.col(metric) - F.col("baseline")) / F.abs("baseline") * 100
    return (
        best.join(base, "target", "left")
        .withColumn("baseline", F.coalesce("_base", F.lit(0.0)))
        .drop("_base")
        .withColumn(
            "improvement_pct", F.when(F.col("baseline") != 0, F.round(gain, 6)).otherwise(0.0)
        )
        .withColumns(
            {
                "fit": steps_above(metric, FIT_LABELS, "POOR"),
                "status": steps_above("improvement_pct", GAIN_LABELS, "NEGATIVE"),
            }
        )
    )


def model_matrix(results: DataFrame, targets: Sequence[str], metric: str = "r2") -> DataFrame:
    """One row per model, one column per target."""
    return results.groupBy("model").pivot("target", list(targets)).agg(F.max(metric))


def win_counts(best: DataFrame) -> DataFrame:
    return best.groupBy("model").agg(F.count(F.lit(1)).alias("targets"))


def top_targets(best: DataFrame, metric: str = "r2", k: int = 3) -> DataFrame:
    return best.orderBy(F.desc(metric), "target").limit(k)


def poor_targets(best: DataFrame, metric: str = "r2") -> DataFrame:
    return best.filter(F.col(metric) <= 0)
