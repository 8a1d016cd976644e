"""Model metrics as aggregates: one pass, any number of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.operators.windows import running_totals
from adperf.sources.staging import stage


def regression_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """rmse, mae and r2 per group; r2 is 0 for a constant target hit exactly or not."""
    error = F.col(y) - F.col(p)
    spread = F.var_pop(y) * F.count(y)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.when(spread > 0, F.lit(1.0) - F.sum(error * error) / spread).otherwise(0.0).alias("r2"),
    )


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(0.0)


def binary_metrics(df: DataFrame, y: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """accuracy, precision, recall and f1 of 0/1 predictions, 0 where undefined."""
    true, said = F.col(y) == 1, F.col(predicted) == 1
    tp, fp = F.count_if(true & said), F.count_if(~true & said)
    fn, tn = F.count_if(true & ~said), F.count_if(~true & ~said)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        _ratio((tp + tn).cast("double"), F.count(F.lit(1))).alias("accuracy"),
        _ratio(tp.cast("double"), tp + fp).alias("precision"),
        _ratio(tp.cast("double"), tp + fn).alias("recall"),
        _ratio((tp * 2).cast("double"), tp * 2 + fp + fn).alias("f1"),
    )


def multiclass_metrics(df: DataFrame, y: str, predicted: str) -> DataFrame:
    """accuracy and the class-weighted and plain means of f1.

    Counted per (class, prediction) pair; the rest runs on that small table.
    """
    pairs = df.groupBy(F.col(y).alias("y"), F.col(predicted).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("y").alias("label"), F.col("n").alias("true_n"), F.lit(0).cast("long").alias("said_n"),
                         F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit_n")),
                F.struct(F.col("p").alias("label"), F.lit(0).cast("long").alias("true_n"), F.col("n").alias("said_n"),
                         F.lit(0).cast("long").alias("hit_n")),
            )
        )
    )
    per_class = sides.groupBy("label").agg(
        F.sum("true_n").alias("true_n"), F.sum("said_n").alias("said_n"), F.sum("hit_n").alias("hit_n")
    ).withColumn(
        "f1", _ratio((F.col("hit_n") * 2).cast("double"), F.col("true_n") + F.col("said_n"))
    )
    return per_class.agg(
        (F.sum("hit_n") / F.sum("true_n")).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("true_n")) / F.sum("true_n")).alias("weighted_f1"),
        F.avg("f1").alias("macro_f1"),
    )


def confusion(df: DataFrame, y: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(y).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def roc(df: DataFrame, y: str, score: str) -> DataFrame:
    """One row per distinct score, from the highest: cumulative hits, alarms and rates.

    Rows are merged per score first, then accumulated range by range, so neither
    a hot score nor many scores end in one task.
    """
    grouped = stage(
        df.groupBy(F.col(score).alias("score")).agg(
            F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg")
        ),
        "scores",
    )
    totals = grouped.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    points = running_totals(grouped, "score", ["pos", "neg"])
    return points.withColumns(
        {
            "tpr": F.coalesce(F.try_divide(F.col("cum_pos"), totals.select("p").scalar()), F.lit(0.0)),
            "fpr": F.coalesce(F.try_divide(F.col("cum_neg"), totals.select("n").scalar()), F.lit(0.0)),
        }
    )


def auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """Area under the ROC curve by rank sums, ties counted half; 0.5 for one class."""
    points = roc(df, y, score)
    above = F.col("cum_pos") - F.col("pos")
    area = F.sum(F.col("neg").cast("double") * (above + F.col("pos") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return points.agg(F.when(pairs > 0, area / pairs).otherwise(0.5).alias("auc"))


def youden(df: DataFrame, y: str, score: str) -> DataFrame:
    """Score with the largest tpr - fpr, the highest one on ties."""
    gain = F.col("tpr") - F.col("fpr")
    return roc(df, y, score).agg(
        F.max_by("score", F.struct(F.round(gain, 12), F.col("score"))).alias("threshold"),
        F.max(gain).alias("youden_j"),
    )


def apply_threshold(df: DataFrame, score: str, threshold: Column, into: str = "predicted") -> DataFrame:
    return df.withColumn(into, (F.col(score) >= threshold).cast("int"))
