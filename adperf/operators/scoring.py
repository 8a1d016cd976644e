"""Forecasts for ads before launch: a factor model, calibration and decisions.

All of it is arithmetic on columns, so it scores any number of rows in one scan.
Inputs are the coded categories of `features.code_numbers`, `cost_per_click`,
`ad_video_length`, `category_age_affinity` and `avg_ded_score`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.functions import fixed
from adperf.functions.expr import clip, first_match
from adperf.operators import features


def _by_code(code: str, factors: Sequence[float]) -> Column:
    """Factor listed under a code number; larger codes wrap around."""
    table = F.array(*[F.lit(float(f)) for f in factors])
    return F.element_at(table, (F.pmod(F.col(code).cast("int"), F.lit(len(factors))) + 1).cast("int"))


def _format(metric: str) -> Column:
    return _by_code("ad_type_encoded", fixed.TYPE_FACTOR[metric])


def _device(metric: str) -> Column:
    return _by_code("ad_device_encoded", fixed.DEVICE_FACTOR[metric])


def _location() -> Column:
    return _by_code("ad_location_encoded", fixed.LOCATION_FACTOR)


def _falling(start: float, slope: float, floor: float) -> Column:
    """Discount that grows with the click cost down to a floor."""
    return F.greatest(F.lit(floor), F.lit(start) - F.col("cost_per_click") * F.lit(slope))


def _video() -> Column:
    """Bonus for short videos, malus for long ones, 1 for other formats."""
    length = F.col("ad_video_length")
    (low, mid), short = fixed.VIDEO_LENGTH_FACTORS[0]
    (_, high), medium = fixed.VIDEO_LENGTH_FACTORS[1]
    is_video = F.pmod(F.col("ad_type_encoded").cast("int"), F.lit(4)) == 0
    return first_match(
        [
            (~is_video, 1.0),
            (length.between(low, mid), short),
            ((length > mid) & (length <= high), medium),
            (length > high, fixed.VIDEO_LONG_FACTOR),
        ],
        1.0,
    )


def _affinity() -> Column:
    return clip(F.lit(1.0) + (F.col("category_age_affinity") - F.lit(0.05)) * F.lit(1.5), 0.90, 1.10)


def _risk() -> Column:
    return clip(F.lit(1.02) - (F.col("avg_ded_score") - F.lit(0.12)) * F.lit(0.7), 0.92, 1.05)


def heuristic(df: DataFrame) -> DataFrame:
    """Forecast click rate, conversion rate, return and win probability from fixed factors.

    The return takes the device factors of the click rate.
    """
    cost = _falling(1.08, 0.10, 0.88)
    base = {m: _by_code("ad_category_encoded", f) for m, f in fixed.CATEGORY_BASE.items()}
    ctr = base["ctr"] * _format("ctr") * _device("ctr") * _location() * cost * _video() * _affinity() * _risk()
    conversion = (
        base["conversion"] * _format("conversion") * _device("conversion") * _location() * cost
        * _affinity() * _risk()
    )
    roas = (
        base["roas"] * _format("roas") * _device("ctr") * _location() * _falling(1.08, 0.12, 0.88)
        * _affinity() * _risk()
    )
    return (
        df.withColumns(
            {
                "pred_ctr": F.round(clip(ctr, 0.008, 0.032), 4),
                "pred_conversion": F.round(clip(conversion, 0.010, 0.050), 4),
                "pred_roas": F.round(clip(roas, 1.40, 3.60), 2),
            }
        )
        .withColumn("win_probability", F.round(clip((F.col("pred_roas") - 1.4) / 2.2, 0.10, 0.95), 2))
        .withColumn("win_class", F.when(F.col("pred_roas") >= 2.75, 1).otherwise(0))
    )


# Fixed values per metric: plausible range of a raw rate, stand-in value, result limits.
RATE_RULES = {
    "ctr": ((0.005, 0.05), 0.018, (0.008, 0.035)),
    "conversion": ((0.008, 0.08), 0.023, (0.010, 0.050)),
}
RETURN_LIMITS = (1.10, 4.50)


def calibrate(metric: str, raw: str) -> Column:
    """A model's raw output adjusted by the factors and limited to a realistic range.

    Rates above 0.5 are taken as percentages; implausible rates are replaced by a
    typical one; returns above 20 are taken as ten times too large.
    """
    value = F.col(raw)
    category = _by_code("ad_category_encoded", fixed.CATEGORY_FACTOR[metric])
    if metric == "roas":
        shrunk = F.when(value > 20, value / 10).otherwise(value)
        adjusted = (
            shrunk * category * _format(metric) * _device(metric) * _location()
            * _falling(1.10, 0.15, 0.85) * _affinity() * _risk()
        )
        return F.round(clip(adjusted, *RETURN_LIMITS), 2)
    (low, high), typical, limits = RATE_RULES[metric]
    rate = F.when(value > 0.5, value / 100).otherwise(value)
    rate = F.when(rate.between(low, high), rate).otherwise(F.lit(typical))
    adjusted = rate * category * _format(metric) * _device(metric) * _location() * _falling(1.08, 0.10, 0.88)
    if metric == "ctr":
        adjusted = adjusted * _video()
    return F.round(clip(adjusted * _affinity() * _risk(), *limits), 4)


def win_probability(roas: str) -> Column:
    return F.round(clip((F.col(roas) - 1.2) / 2.3, 0.15, 0.95), 2)


def win_class(roas: str) -> Column:
    return F.when(F.col(roas) >= 2.75, 1).otherwise(0)


def decide(df: DataFrame) -> DataFrame:
    """Approve, caution or hold by forecast return, and the tips that apply."""
    roas = F.col("pred_roas")
    decision = first_match([(roas >= 2.95, "approve"), (roas >= 2.75, "caution")], "hold")
    tips = F.array_compact(
        F.array(
            F.when((F.col("ad_type") == "Video") & (F.col("ad_video_length") > 30), F.lit("shorten video")),
            F.when(F.col("cost_per_click") > 1.50, F.lit("lower bid")),
            F.when(F.col("pred_ctr") < 0.02, F.lit("change format")),
            F.when(F.col("pred_conversion") * 100 < 2.0, F.lit("improve landing page")),
        )
    )
    return df.withColumns({"decision": decision, "tips": tips})


def spend_forecast(df: DataFrame, spend: float, click_cost: float = 0.75) -> DataFrame:
    """Revenue and clicks expected from a proposed spend."""
    clicks = F.when(
        F.col("pred_ctr") > 0, F.floor(F.lit(spend / click_cost) * F.col("pred_ctr"))
    ).otherwise(F.floor(F.lit(spend / 1.2)))
    return df.withColumns(
        {
            "est_revenue": F.round(F.lit(spend) * F.col("pred_roas"), 2),
            "est_clicks": clicks.cast("long"),
        }
    )


def scenarios(ads: DataFrame, options: Mapping[str, Sequence]) -> DataFrame:
    """Every ad under every combination of the options, scored and decided.

    The options replace the ad's own columns.  Their number is fixed by the
    caller, so the rows grow with the ads alone.
    """
    grid = ads
    for column, values in options.items():
        grid = grid.withColumn(column, F.explode(F.array(*[F.lit(v) for v in values])))
    return decide(heuristic(features.code_numbers(grid)))
