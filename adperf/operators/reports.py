"""Reporting queries over the gold table.

Every report aggregates ads by a few attributes, so the result is small; totals
and winners are taken from the aggregate, never from the ads again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.functions import fixed
from adperf.functions.expr import (
    clock_label,
    first_match,
    first_token,
    guarded_ratio,
    nearest_hour,
    nearest_quarter_hour,
    shown,
    steps_above,
)
from adperf.operators import features, tables, windows
from adperf.sources.staging import stage

AD = "Ad_Reference_ID"


def _steady(c: str) -> Column:
    """Sums of doubles differ in the last digits with the order of addition; ranks should not."""
    return F.round(c, 6)


# ---- building blocks ------------------------------------------------------------------------


def mean(c: str, name: str | None = None, scale: float | None = None) -> Column:
    value = F.avg(c) if scale is None else F.avg(c) * F.lit(scale)
    return value.alias(name or c)


def by(gold: DataFrame, keys: str | Sequence[str], *aggs: Column) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return gold.groupBy(*keys).agg(*aggs)


def money_columns() -> list[Column]:
    return [
        F.sum("total_ad_spend").alias("total_ad_spend"),
        F.sum("total_revenue").alias("total_revenue"),
    ]


def without_all_devices(gold: DataFrame, c: str = "ad_device") -> DataFrame:
    """Drop ads for all devices, unless there are no others."""
    named = F.lower(F.translate(F.col(c), " ", "-")) != "all-devices"
    others = gold.agg(F.coalesce(F.bool_or(named), F.lit(False))).scalar()
    return gold.filter(named | ~others)


def with_platform(gold: DataFrame) -> DataFrame:
    """One row per ad and platform it ran on."""
    exploded = gold.withColumn("platform", F.explode_outer("platforms_used"))
    name = F.trim(F.lower(F.coalesce("platform", F.lit("unknown"))))
    return exploded.withColumn("platform", name).filter(F.col("platform") != "")


def with_display_age(gold: DataFrame) -> DataFrame:
    return gold.withColumn("age_group", features.display_age_band("avg_user_age"))


# ---- headline figures -------------------------------------------------------------------------


def owner_kpis(gold: DataFrame) -> DataFrame:
    """Revenue, spend, profit, mean and blended return, share of winning ads."""
    return gold.agg(
        *money_columns(),
        (F.sum("total_revenue") - F.sum("total_ad_spend")).alias("profit"),
        mean("roas", "avg_roas"),
        guarded_ratio(F.sum("total_revenue"), F.sum("total_ad_spend")).alias("blended_roas"),
        mean("high_performance", "profitable_pct", 100.0),
    )


def agency_kpis(gold: DataFrame) -> DataFrame:
    return gold.agg(
        mean("ctr", "avg_ctr_pct", 100.0),
        mean("conversion_rate", "avg_conversion_pct", 100.0),
        mean("cost_per_click", "avg_cpc"),
        F.count_distinct("ad_category").alias("categories"),
    )


def portfolio(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.count(F.lit(1)).alias("ads"),
        *money_columns(),
        mean("roas", "avg_roas"),
        mean("ctr", "avg_ctr_pct", 100.0),
        mean("cost_per_click", "avg_cpc"),
    )


def quick_insights(gold: DataFrame, group: str = "ad_category") -> DataFrame:
    """Revenue leader, return leader, mean return, share of winners."""
    groups = by(gold, group, F.sum("total_revenue").alias("revenue"), mean("roas"))
    leaders = groups.agg(
        F.min_by(group, F.struct(-F.col("revenue"), F.col(group))).alias("revenue_leader"),
        F.max("revenue").alias("leader_revenue"),
        F.min_by(group, F.struct(-F.col("roas"), F.col(group))).alias("roas_leader"),
        F.max("roas").alias("leader_roas"),
    )
    overall = gold.agg(
        mean("roas", "avg_roas"),
        F.sum("total_revenue").alias("total_revenue"),
        F.count_distinct(group).alias("groups"),
        mean("high_performance", "profitable_pct", 100.0),
    )
    return leaders.withColumns({c: overall.select(c).scalar() for c in overall.columns}).withColumn(
        "above_target", F.col("avg_roas") > fixed.WIN_ROAS
    )


# ---- by attribute -----------------------------------------------------------------------------


def format_revenue(gold: DataFrame, group: str = "ad_type") -> DataFrame:
    """Revenue and mean return by format, with a flag for returns of at least 2."""
    return by(gold, group, F.sum("total_revenue").alias("total_revenue"), mean("roas")).withColumn(
        "profitable", F.col("roas") >= fixed.WIN_ROAS
    )


def trend(gold: DataFrame, date: str = "ingestion_date", hour: str = "avg_hour") -> DataFrame:
    """Revenue, spend and return by time unit in long form; the unit adapts to the span."""
    unit = tables.adaptive_grain(gold, date, hour).alias("time_unit")
    sums = gold.groupBy(unit).agg(
        F.sum("total_revenue").alias("Revenue"),
        F.sum("total_ad_spend").alias("Ad Spend"),
        F.avg("roas").alias("ROAS"),
    )
    return tables.long_form(sums, "metric", "amount", ["time_unit"])


def ctr_by_device(gold: DataFrame) -> DataFrame:
    """Click rate by device type, best and worst marked."""
    rates = by(without_all_devices(gold), "ad_device", mean("ctr", "ctr_pct", 100.0))
    return tables.label_extremes(rates, "ad_device", "ctr_pct")


def ctr_by_quarter_hour(gold: DataFrame) -> DataFrame:
    """Click rate by quarter hour with a clock label, peak and lowest marked."""
    slots = gold.withColumn("slot", nearest_quarter_hour("avg_hour")).groupBy("slot").agg(
        mean("ctr", "ctr_pct", 100.0)
    )
    return tables.label_extremes(slots, "slot", "ctr_pct").withColumn(
        "time_label", clock_label("slot")
    )


def roas_by_platform(gold: DataFrame) -> DataFrame:
    return by(with_platform(gold), "platform", mean("roas"))


def conversion_by_category(gold: DataFrame) -> DataFrame:
    return by(gold, "ad_category", mean("conversion_rate", "conversion_pct", 100.0))


def actions(gold: DataFrame) -> DataFrame:
    """Recommended actions as (action, subject, metric, value) rows."""

    def pick(df: DataFrame, subject: str, metric: str, action: str, worst: bool = False) -> DataFrame:
        rank = F.struct(-F.col(metric), F.col(subject))
        choose = F.max_by if worst else F.min_by
        best = df.agg(
            choose(F.struct(F.col(subject).cast("string").alias("s"), F.col(metric).alias("v")), rank).alias("b"),
            F.count(F.lit(1)).alias("n"),
        )
        best = best.filter(F.col("n") > (1 if worst else 0))
        return best.select(
            F.lit(action).alias("action"), F.col("b.s").alias("subject"),
            F.lit(metric).alias("metric"), F.col("b.v").alias("value"),
        )

    device, slots = ctr_by_device(gold), ctr_by_quarter_hour(gold)
    parts = [
        pick(device, "ad_device", "ctr_pct", "increase device budget"),
        pick(device, "ad_device", "ctr_pct", "reduce device spend", worst=True),
        pick(slots, "slot", "ctr_pct", "run ads around"),
        pick(roas_by_platform(gold), "platform", "roas", "increase platform budget"),
        pick(conversion_by_category(gold), "ad_category", "conversion_pct", "invest in category"),
    ]
    return reduce(DataFrame.unionByName, parts)


def ad_type_performance(gold: DataFrame) -> DataFrame:
    return by(
        gold, "ad_type", mean("ctr", "ctr_pct", 100.0), mean("roas"), F.count(AD).alias("volume")
    ).withColumn("profitable", F.col("roas") >= fixed.WIN_ROAS)


def platform_performance(gold: DataFrame) -> DataFrame:
    """Spend, revenue and return by the ad's primary platform."""
    named = gold.withColumn("platform", features.primary_platform())
    return by(named, "platform", *money_columns(), mean("roas"))


def age_category_usage(gold: DataFrame) -> DataFrame:
    """Ads per age band and category, and the band's share of the category in percent."""
    counted = by(with_display_age(gold), ["ad_category", "age_group"], F.count(F.lit(1)).alias("ads"))
    shared = windows.share_of_group(counted, ["ad_category"], "ads", "share")
    return shared.select(
        "ad_category", first_token("age_group").alias("age_bracket"), "ads",
        shown(F.col("share") * 100, 2).alias("share_pct"),
    )


def best_category_by_age(gold: DataFrame) -> DataFrame:
    groups = by(with_display_age(gold), ["age_group", "ad_category"], mean("roas"))
    return tables.best_per_group(groups, "age_group", "ad_category", "roas").withColumn(
        "age_group", first_token("age_group")
    )


def best_hour_by_age(gold: DataFrame) -> DataFrame:
    binned = with_display_age(gold).withColumn("hour_bin", nearest_hour("avg_hour"))
    groups = by(binned, ["age_group", "hour_bin"], mean("ctr"))
    best = tables.best_per_group(groups, "age_group", "hour_bin", "ctr")
    return best.select(
        first_token("age_group").alias("age_group"), "hour_bin",
        clock_label("hour_bin").alias("clock"), (F.col("ctr") * 100).alias("ctr_pct"),
    )


def device_format_cells(gold: DataFrame) -> DataFrame:
    """Mean return per format and device with a band; the best cell is marked."""
    cells = by(
        gold.filter(~F.lower("ad_device").contains("all")), ["ad_type", "ad_device"], mean("roas")
    )
    top = cells.agg(
        F.min_by(
            F.struct("ad_type", "ad_device"),
            F.struct(-F.col("roas"), F.col("ad_type"), F.col("ad_device")),
        ).alias("cell")
    )
    is_best = F.struct("ad_type", "ad_device") == top.scalar()
    band = steps_at_least("roas", fixed.MATRIX_BANDS, "weak")
    return cells.withColumn("band", F.when(is_best, "best").otherwise(band))


def steps_at_least(c: str, steps: Sequence[tuple[float, str]], floor: str) -> Column:
    return first_match([(F.col(c) >= limit, label) for limit, label in steps], floor)


def device_format_matrix(gold: DataFrame, devices: Sequence[str]) -> DataFrame:
    """The same cells as a matrix: one row per format, one column per device."""
    return (
        gold.groupBy("ad_type")
        .pivot("ad_device", list(devices))
        .agg(shown(F.avg("roas"), 2))
    )


def weekday_performance(gold: DataFrame) -> DataFrame:
    """Click rate and return by the ad's best weekday, peak day marked."""
    days = by(
        gold, "best_day",
        shown(F.avg("ctr") * 100, 2).alias("ctr_pct"), shown(F.avg("roas"), 2).alias("roas"),
    )
    peak = days.agg(F.min_by("best_day", F.struct(-F.col("ctr_pct"), F.col("best_day")))).scalar()
    return days.withColumns(
        {"day_name": features.day_name("best_day"), "is_peak": F.col("best_day") == peak}
    )


def category_comparison(gold: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Chosen categories ranked by mean return."""
    chosen = gold.filter(F.lower("ad_category").isin([c.lower() for c in categories]))
    groups = by(
        chosen, "ad_category", F.count(F.lit(1)).alias("ads"), *money_columns(), mean("roas", "avg_roas")
    )
    ahead = F.expr(
        "size(filter(_all, x -> x.r > avg_roas OR (x.r = avg_roas AND x.c < ad_category))) + 1"
    )
    listed = groups.agg(
        F.collect_list(F.struct(F.col("avg_roas").alias("r"), F.col("ad_category").alias("c")))
    ).scalar()
    return groups.withColumn("_all", listed).withColumn("rank", ahead.cast("long")).drop("_all")


def category_focus(gold: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Totals over the chosen categories."""
    chosen = gold.filter(F.lower("ad_category").isin([c.lower() for c in categories]))
    return chosen.agg(
        F.count(F.lit(1)).alias("ads"), *money_columns(), mean("roas", "avg_roas")
    )


def roas_by_time_slot(gold: DataFrame) -> DataFrame:
    slots = gold.withColumn("time_slot", F.explode("active_time_slots"))
    return by(slots, "time_slot", shown(F.avg("roas"), 2).alias("avg_roas"))


def roas_by_weekday(gold: DataFrame) -> DataFrame:
    named = gold.withColumn(
        "day_name", F.coalesce(features.day_name("best_day"), F.lit("Weekday"))
    )
    return by(named, "day_name", shown(F.avg("roas"), 2).alias("avg_roas"))


# ---- rankings ----------------------------------------------------------------------------------


def top_campaigns(gold: DataFrame, k: int = 5) -> DataFrame:
    return windows.top_k(gold, [F.desc("roas"), F.asc(AD)], k)


def top_campaigns_per_category(gold: DataFrame, k: int = 2) -> DataFrame:
    return windows.top_per_group(gold, ["ad_category"], [F.desc("roas"), F.asc(AD)], k)


def waste(gold: DataFrame, k: int = 8, limit: float = fixed.WASTE_ROAS) -> DataFrame:
    """The k ads with most spend among returns below the limit; without any, the k lowest."""
    poor = F.col("roas") < limit
    any_poor = gold.agg(F.coalesce(F.bool_or(poor), F.lit(False))).scalar()
    order = F.when(any_poor, -_steady("total_ad_spend")).otherwise(_steady("roas"))
    return windows.top_k(gold.filter(poor | ~any_poor), [order.asc(), F.asc(AD)], k)


def waste_per_category(gold: DataFrame, k: int = 2, limit: float = fixed.WASTE_ROAS) -> DataFrame:
    """The same per category: poor ads by spend first, others by return as a fallback."""
    poor = F.col("roas") < limit
    counts = stage(gold.groupBy("ad_category").agg(F.bool_or(poor).alias("_any")), "poor")
    marked = gold.join(counts, "ad_category").filter(poor | ~F.col("_any"))
    order = F.when(F.col("_any"), -_steady("total_ad_spend")).otherwise(_steady("roas"))
    return windows.top_per_group(marked, ["ad_category"], [order.asc(), F.asc(AD)], k).drop("_any")


def expensive_clicks(gold: DataFrame, k: int = 5) -> DataFrame:
    return windows.top_k(gold, [F.desc("cost_per_click"), F.asc(AD)], k)


def breakdown(gold: DataFrame, group: str) -> DataFrame:
    """Return, spend, revenue and conversion by one attribute, to 3 places."""
    sums = by(
        gold, group, mean("roas"), *money_columns(), mean("conversion_rate")
    )
    return sums.select(group, *[shown(c, 3).alias(c) for c in sums.columns if c != group])


def best_per_category(gold: DataFrame, subject: str) -> DataFrame:
    """Attribute value with the best mean return per category, with its revenue."""
    groups = by(gold, ["ad_category", subject], mean("roas"), F.sum("total_revenue").alias("total_revenue"))
    rank = F.struct(-F.col("roas"), F.col(subject))
    return (
        groups.groupBy("ad_category")
        .agg(F.min_by(F.struct(subject, "roas", "total_revenue"), rank).alias("b"))
        .select("ad_category", "b.*")
    )


def top_locations(gold: DataFrame, k: int = 5) -> DataFrame:
    groups = by(gold, "ad_location", mean("roas"), F.sum("total_revenue").alias("total_revenue"))
    return windows.top_k(groups, [F.desc("roas"), F.asc("ad_location")], k)


def low_ctr_high_impressions(gold: DataFrame, ctr: float = 0.01, k: int = 10) -> DataFrame:
    return windows.top_k(
        gold.filter(F.col("ctr") < ctr), [F.desc("total_impressions"), F.asc(AD)], k
    )


def low_roas_high_spend(gold: DataFrame, roas: float = 1.5, k: int = 10) -> DataFrame:
    poor = gold.filter(F.col("roas") < roas)
    return windows.top_k(poor, [_steady("total_ad_spend").desc(), F.asc(AD)], k)


def filter_options(gold: DataFrame) -> DataFrame:
    """Values a report can be filtered by, with their number of ads."""
    category = tables.frequency(gold, "ad_category", "value")
    device = tables.frequency(without_all_devices(gold), "ad_device", "value")
    return category.select(F.lit("ad_category").alias("filter"), "value", "n").unionByName(
        device.select(F.lit("ad_device").alias("filter"), "value", "n")
    )


# ---- verification reports ------------------------------------------------------------------------


def _rates(places: int = 2) -> dict[str, Column]:
    return {
        "ad_count": F.count(F.lit(1)),
        "avg_ctr_pct": shown(F.avg("ctr") * 100, places),
        "avg_roas": shown(F.avg("roas"), places),
    }


def verification(gold: DataFrame, group: str | Column | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """Count, click rate and return, overall or by a group; more columns on request."""
    more: Mapping[str, Column] = {
        "avg_conversion_pct": shown(F.avg("conversion_rate") * 100, 2),
        "winning_ads": F.sum("high_performance"),
        "win_rate_pct": shown(F.avg("high_performance") * 100.0, 2),
        "avg_engagement": shown(F.avg("engagement_score"), 2),
    }
    aggs = [c.alias(n) for n, c in {**_rates(), **{n: more[n] for n in extra}}.items()]
    return gold.agg(*aggs) if group is None else gold.groupBy(group).agg(*aggs)


def efficiency_band() -> Column:
    return steps_above(
        "cost_efficiency_score", fixed.EFFICIENCY_BANDS, fixed.EFFICIENCY_FLOOR
    ).alias("efficiency_level")


def engagement_band() -> Column:
    return steps_above(
        "engagement_score", fixed.ENGAGEMENT_BANDS, fixed.ENGAGEMENT_FLOOR
    ).alias("engagement_level")


def one_line_summary(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.count(F.lit(1)).alias("total_rows"),
        shown(F.avg("roas"), 2).cast("decimal(5,2)").alias("avg_roas"),
        shown(F.avg("ctr") * 100, 2).cast("decimal(5,2)").alias("avg_ctr_pct"),
        F.sum("high_performance").alias("winning_ads"),
    ).select(F.lit("GOLD LAYER").alias("layer"), "*")


# ---- cubes ----------------------------------------------------------------------------------

def _cube_sums() -> dict[str, Column]:
    """Sums of the gold table that hold for any group of ads."""
    return {
        "ads": F.count(F.lit(1)),
        "impressions": F.sum("total_impressions"),
        "clicks": F.sum("total_clicks"),
        "spend": F.sum("total_ad_spend"),
        "revenue": F.sum("total_revenue"),
    }


def cube(df: DataFrame, dims: Sequence[str], aggs: Mapping[str, Column] | None = None) -> DataFrame:
    """Aggregates for all combinations of the dimensions and all their totals.

    `level` has one bit for each dimension, the first the highest; a set bit says that
    the row is a total over it, so that its null is no missing value.  Rows are expanded
    and added up before the one shuffle.
    """
    sums = aggs or _cube_sums()
    found = df.cube(*dims).agg(F.grouping_id().alias("level"), *[a.alias(name) for name, a in sums.items()])
    if not aggs:
        found = found.withColumn("roas", F.when(F.col("spend") > 0, F.col("revenue") / F.col("spend")).otherwise(0.0))
    return found


def labelled(found: DataFrame, dims: Sequence[str], total: str = "All", missing: str = "Unknown") -> DataFrame:
    """A cube with words for totals and for missing values."""
    bits = {dim: 1 << (len(dims) - 1 - i) for i, dim in enumerate(dims)}
    return found.withColumns({
        dim: F.when(F.col("level").bitwiseAND(bit) != 0, total).otherwise(F.coalesce(dim, F.lit(missing)))
        for dim, bit in bits.items()
    })
