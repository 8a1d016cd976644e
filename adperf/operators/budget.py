"""Budget reallocation by return.

Ads are first summed per segment; shares and weights then need totals over that
small aggregate, which come from scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.functions.expr import first_match
from adperf.operators import features
from adperf.operators.reports import without_all_devices

# Exponent of the return advantage, spend assumed when there is none.
RETURN_POWER = 2.5
ASSUMED_SPEND = 50_000.0


def _total(df: DataFrame, c: str) -> Column:
    return df.agg(F.coalesce(F.sum(c), F.lit(0.0))).scalar()


def _share(df: DataFrame, c: str) -> Column:
    """Part of the column's total, equal parts when the total is 0."""
    total = _total(df, c)
    groups = df.agg(F.count(F.lit(1))).scalar()
    return F.when(total == 0, F.lit(1.0) / groups).otherwise(F.try_divide(F.col(c), total))


def segments(gold: DataFrame, group: str) -> DataFrame:
    """Spend and mean return per segment."""
    return gold.groupBy(group).agg(
        F.sum("total_ad_spend").alias("total_ad_spend"), F.avg("roas").alias("roas")
    )


def allocate(gold: DataFrame, group: str, budget: float, baseline: str = "history") -> DataFrame:
    """Budget per segment in proportion to its mean return, next to a baseline split.

    The baseline follows past spend (`history`) or is equal over segments (`equal`).
    """
    stats = segments(gold, group)
    if baseline == "history":
        base = _share(stats, "total_ad_spend")
    elif baseline == "equal":
        base = F.lit(1.0) / stats.agg(F.count(F.lit(1))).scalar()
    else:
        raise ValueError(f"unknown baseline {baseline}")
    return (
        stats.withColumns({"spend_share": base, "weight": _share(stats, "roas")})
        .withColumns(
            {
                "baseline_budget": F.bround(F.col("spend_share") * F.lit(budget), 2),
                "recommended_budget": F.bround(F.col("weight") * F.lit(budget), 2),
            }
        )
        .withColumns(
            {
                "baseline_return": F.bround(F.col("baseline_budget") * F.col("roas"), 2),
                "optimized_return": F.bround(F.col("recommended_budget") * F.col("roas"), 2),
            }
        )
    )


def channel_mix(gold: DataFrame, budget: float) -> DataFrame:
    named = gold.withColumn("platform", features.primary_platform())
    return allocate(named, "platform", budget)


def device_mix(gold: DataFrame, budget: float) -> DataFrame:
    """Ads for all devices are left out unless there are no others."""
    return allocate(without_all_devices(gold), "ad_device", budget)


def type_mix(gold: DataFrame, budget: float) -> DataFrame:
    return allocate(gold, "ad_type", budget)


def target_mix(gold: DataFrame, group: str = "ad_type", power: float = RETURN_POWER) -> DataFrame:
    """Target share per format: current share times the return advantage to a power.

    Shares add up to 100 percent before rounding to one place.
    """
    stats = segments(gold, group)
    spent = _total(stats, "total_ad_spend")
    spend = F.when(spent > 0, spent).otherwise(F.lit(ASSUMED_SPEND))
    mean_roas = stats.agg(F.avg("roas")).scalar()
    advantage = F.when(mean_roas > 0, F.pow(F.col("roas") / mean_roas, F.lit(power))).otherwise(1.0)
    weighted = stats.withColumn("current_share", _share(stats, "total_ad_spend")).withColumn(
        "raw_weight", F.col("current_share") * advantage
    )
    ends = stats.agg(
        F.min_by(group, F.struct(-F.col("roas"), F.col(group))).alias("best"),
        F.max_by(group, F.struct(-F.col("roas"), F.col(group))).alias("worst"),
    )
    action = first_match(
        [
            (F.col(group) == ends.select("best").scalar(), "Scale Spend (Top Performer)"),
            (F.col(group) == ends.select("worst").scalar(), "Reduce & Reallocate Spend"),
            (F.col("roas") >= mean_roas, "Maintain & Optimize"),
        ],
        "Monitor Performance",
    )
    return (
        weighted.withColumns(
            {
                "target_pct": F.bround(
                    F.try_divide(F.col("raw_weight"), _total(weighted, "raw_weight")) * 100, 1
                ),
                "current_pct": F.bround(F.col("current_share") * 100, 1),
            }
        )
        .withColumn("target_budget", spend * (F.col("target_pct") / 100))
        .withColumns(
            {
                "current_revenue": F.col("total_ad_spend") * F.col("roas"),
                "predicted_revenue": F.col("target_budget") * F.col("roas"),
            }
        )
        .withColumns(
            {
                "revenue_lift": F.col("predicted_revenue") - F.col("current_revenue"),
                "action": action,
            }
        )
        .drop("raw_weight", "current_share")
    )


def impact(mixes: Mapping[str, DataFrame]) -> DataFrame:
    """Mean baseline and optimized return over the mixes, uplift and lift in percent."""
    sums = [
        mix.agg(
            F.coalesce(F.sum("baseline_return"), F.lit(0.0)).alias("baseline"),
            F.coalesce(F.sum("optimized_return"), F.lit(0.0)).alias("optimized"),
            F.count(F.lit(1)).alias("n"),
        ).filter(F.col("n") > 0)
        for mix in mixes.values()
    ]
    return (
        reduce(DataFrame.unionByName, sums)
        .agg(
            F.coalesce(F.avg("baseline"), F.lit(0.0)).alias("avg_baseline"),
            F.coalesce(F.avg("optimized"), F.lit(0.0)).alias("avg_optimized"),
        )
        .withColumn("avg_uplift", F.col("avg_optimized") - F.col("avg_baseline"))
        .withColumn(
            "lift_pct",
            F.when(
                F.col("avg_baseline") > 0, F.col("avg_uplift") / F.col("avg_baseline") * 100
            ).otherwise(0.0),
        )
    )


def best_segments(mixes: Mapping[str, DataFrame]) -> DataFrame:
    """Segment with the best mean return of each mix; the first column names segments."""
    parts = []
    for name, mix in mixes.items():
        group = mix.columns[0]
        best = mix.agg(
            F.min_by(group, F.struct(-F.col("roas"), F.col(group))).alias("segment"),
            F.max("roas").alias("roas"),
        )
        parts.append(best.select(F.lit(name).alias("mix"), "segment", "roas"))
    return reduce(DataFrame.unionByName, parts)
