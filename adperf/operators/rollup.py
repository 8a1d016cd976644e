"""Impressions to one row per ad.

One pass reduces the rows to a *grain*: one row per ad, age band, platform,
device and ad type, with sums only, so partial aggregation does the work before
the shuffle and any key may hold any part of the rows.  Every statistic of the
gold table, the per-age and per-platform ones included, is computed from that
grain, so the impressions are shuffled for nothing else.  The grain is written once
and read by all of them.  Distinct users are the one exception: they need the
(ad, user) pairs.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.functions import fixed
from adperf.functions.expr import guarded_ratio
from adperf.operators import features
from adperf.operators.tables import quantile
from adperf.sources.staging import stage

AD = "Ad_Reference_ID"
GRAIN = [
    AD, "Ad_Category_Standard", "age_category", "platform_source_cleaned",
    "device_cleaned", "Ad_Type_Standard",
]
DAY_PARTS = sorted(set(fixed.DAY_PARTS))


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def grain(rows: DataFrame) -> DataFrame:
    """Sums per ad, age band, platform, device and ad type."""
    clicked = F.col(features.CLICKED)
    sums = {
        "n": F.count(F.lit(1)),
        "impressions": F.count("User_ID"),
        "clicks": F.sum(clicked),
        "clicks_n": F.count(clicked),
        "conversions": F.sum("is_converted"),
        "cost": F.sum("total_cost"),
        "revenue": F.sum("total_revenue"),
        "row_roas": F.sum("return_on_ad_spend"),
        "watch": F.sum("Watch_Duration_Cleaned"),
        "watch_n": F.count("Watch_Duration_Cleaned"),
        "ratio": F.sum("watch_duration_ratio_clipped"),
        "ratio_n": F.count("watch_duration_ratio_clipped"),
        "age": F.sum("user_age_cleaned"),
        "age_n": F.count("user_age_cleaned"),
        "hours": F.sum("hour_of_day"),
        "hours_n": F.count("hour_of_day"),
        "first_date": F.min("ingestion_date"),
    }
    sums |= {f"day_{d}": _count(F.col("day_of_week") == d) for d in range(1, 8)}
    sums |= {f"month_{m}": _count(F.col("month") == m) for m in range(1, 13)}
    sums |= {f"part_{p}": _count(F.col("time_of_day_category") == p) for p in DAY_PARTS}
    return rows.groupBy(*GRAIN).agg(*[c.alias(name) for name, c in sums.items()])


def _most_frequent(parts: Mapping[int, str]) -> Column:
    """Key whose counter is largest, the smallest key on ties, null if all are 0."""
    entries = F.array(
        *[F.struct(F.col(c).alias("n"), F.lit(-k).alias("minus_key")) for k, c in parts.items()]
    )
    best = F.array_max(entries)
    return F.when(best["n"] > 0, -best["minus_key"])


def _weighted_mode(cells: DataFrame, c: str, into: str) -> DataFrame:
    per_value = cells.filter(F.col(c).isNotNull()).groupBy(AD, c).agg(F.sum("n").alias("_n"))
    return per_value.groupBy(AD).agg(
        F.min_by(F.col(c), F.struct(-F.col("_n"), F.col(c))).alias(into)
    )


def ad_performance(
    clicks: DataFrame,
    catalog: DataFrame,
    as_of: str | Column | None = None,
    draw_key: str | None = None,
    approx_users: bool = False,
    **derived,
) -> DataFrame:
    """Conformed clicks and catalog to the gold table, one row per advertised ad.

    Distinct users are exact unless `approx_users`; the estimate needs no
    shuffle of (ad, user) pairs.
    """
    rows = features.enrich(features.join_catalog(clicks, catalog), draw_key)
    cells = stage(grain(rows), "grain")

    # Stored, so that the planner knows they are small and joins without a shuffle.
    rates = stage(
        cells.groupBy("age_category", "Ad_Category_Standard").agg(
            (F.sum("clicks") / F.sum("clicks_n")).alias("age_rate")
        ),
        "rates",
    )
    rated = cells.join(
        rates.withColumnsRenamed({"age_category": "_a", "Ad_Category_Standard": "_c"}),
        F.col("age_category").eqNullSafe(F.col("_a"))
        & F.col("Ad_Category_Standard").eqNullSafe(F.col("_c")),
        "left",
    ).withColumn("age_delta", features.demographic_delta("age_rate"))

    def mean(total: str, n: str) -> Column:
        return F.try_divide(F.sum(total), F.sum(n))

    per_ad = rated.groupBy(AD).agg(
        F.sum("clicks").alias("total_clicks"),
        F.sum("impressions").alias("total_impressions"),
        mean("watch", "watch_n").alias("avg_watch_duration"),
        F.sum("cost").alias("total_ad_spend"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("conversions").alias("total_conversions"),
        mean("age", "age_n").alias("avg_user_age"),
        mean("ratio", "ratio_n").alias("avg_watch_ratio"),
        (F.sum(F.col("age_delta") * F.col("n")) / F.sum("n")).alias("avg_ded_score"),
        (
            F.sum(F.col("age_rate") * F.col("n"))
            / F.sum(F.when(F.col("age_rate").isNotNull(), F.col("n")))
        ).alias("category_age_affinity"),
        F.sort_array(F.collect_set("platform_source_cleaned")).alias("platforms_used"),
        F.sort_array(F.collect_set("device_cleaned")).alias("devices_used"),
        *[F.sum(f"part_{p}").alias(f"part_{p}") for p in DAY_PARTS],
        *[F.sum(f"day_{d}").alias(f"day_{d}") for d in range(1, 8)],
        *[F.sum(f"month_{m}").alias(f"month_{m}") for m in range(1, 13)],
        mean("hours", "hours_n").alias("avg_hour"),
        F.min("first_date").alias("ingestion_date"),
    )
    per_ad = per_ad.withColumns(
        {
            "active_time_slots": F.array_compact(
                F.array(*[F.when(F.col(f"part_{p}") > 0, F.lit(p)) for p in DAY_PARTS])
            ),
            "best_day": _most_frequent({d: f"day_{d}" for d in range(1, 8)}),
            "month": _most_frequent({m: f"month_{m}" for m in range(1, 13)}),
        }
    ).drop(
        *[f"part_{p}" for p in DAY_PARTS],
        *[f"day_{d}" for d in range(1, 8)],
        *[f"month_{m}" for m in range(1, 13)],
    )

    platform_stats = stage(
        cells.groupBy("platform_source_cleaned").agg(
            (F.sum("row_roas") / F.sum("n")).alias("platform_avg_roas"),
            F.sum("cost").alias("platform_total_spend"),
            F.sum("revenue").alias("platform_total_revenue"),
        ),
        "platforms",
    )
    main_platform = _weighted_mode(cells, "platform_source_cleaned", "main_platform")
    main_type = _weighted_mode(cells, "Ad_Type_Standard", "ad_type")
    matched = clicks.join(cells.select(AD).distinct(), AD, "left_semi")  # ads of the catalog only
    users = distinct_users(matched, approx_users)
    attributes = catalog.select(
        AD,
        F.col("Ad_Category_Standard").alias("ad_category"),
        F.col("Ad_Device_Cleaned").alias("ad_device"),
        F.col("Ad_Location_Cleaned").alias("ad_location"),
        F.col("Ad_Type_Standard").alias("ad_type_catalog"),
        F.col("Cost_Per_Click_Cleaned").cast("double").alias("cost_per_click"),
        F.col("ad_video_length_cleaned").alias("ad_video_length"),
    )
    gold = (
        reduce(
            lambda left, right: left.join(right, AD, "left"),
            [main_platform, main_type, users, attributes],
            per_ad,
        )
        .join(
            platform_stats.withColumnRenamed("platform_source_cleaned", "main_platform"),
            "main_platform",
            "left",
        )
        .drop("main_platform")
    )
    return add_derived(add_rates(gold), as_of, **derived)


def distinct_users(rows: DataFrame, approx: bool = False) -> DataFrame:
    if approx:
        return rows.groupBy(AD).agg(F.approx_count_distinct("User_ID").alias("unique_users"))
    pairs = rows.select(AD, "User_ID").distinct()
    return pairs.groupBy(AD).agg(F.count("User_ID").alias("unique_users"))


#: Size of a user sketch: 2 ** 14 registers, a standard error of 0.8 %.
SKETCH_BITS = 14
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def user_sketches(rows: DataFrame, date: str, by: tuple[str, ...] = (AD,), user: str = "User_ID") -> DataFrame:
    """`by`, day, users: a sketch of the users of each group and day.

    Sketches add up: those of any days and groups make one of their union, so distinct
    users of a range need no second look at the log.  Small groups take a few bytes for
    each user, large ones 16 KB.  Rows are sketched before the shuffle.
    """
    return rows.groupBy(*by, F.to_date(date).alias("day")).agg(F.hll_sketch_agg(user, SKETCH_BITS).alias("users"))


def users_between(sketches: DataFrame, first: str, last: str, by: tuple[str, ...] = (AD,)) -> DataFrame:
    """Distinct users of each group from first to last day; few are exact, many within SKETCH_ERROR standard errors."""
    days = sketches.filter(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    union = F.hll_union_agg("users")
    return days.groupBy(*by).agg(F.hll_sketch_estimate(union).alias("unique_users"))


#: Parts that the users of an ad are dealt into, so that an ad of very many rows is not one task's.
USER_PARTS = 8


def impression_totals(rows: DataFrame) -> DataFrame:
    """Ad totals of an impression log that brings cost, outcome and revenue columns."""
    # one shuffle of the log: all rows of a user meet in one part of an ad, so sums and distinct users of parts add up;
    # its tasks are counted, for merged by bytes they would hold ten times as much in tables of users
    clicked, tasks = F.col(features.CLICKED), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.filter(F.col(AD).isNotNull()).select(
        AD, F.pmod(F.xxhash64("User_ID"), F.lit(USER_PARTS)).cast("int").alias("_part"), "User_ID", "platform_source_cleaned",
        clicked.alias("clicks"), F.col("Watch_Duration_Cleaned").alias("watch"),
        (F.col("Cost_Per_Click_Cleaned") * clicked).alias("cost"),
        (F.col("order_value") * F.col("is_converted")).alias("revenue"), F.col("is_converted").alias("conversions"),
    ).repartition(tasks, AD, "_part")
    parts = dealt.groupBy(AD, "_part").agg(
        *[F.sum(c).alias(c) for c in ("clicks", "watch", "cost", "revenue", "conversions")],
        F.count("User_ID").alias("n"), F.count("watch").alias("watch_n"), F.count_distinct("User_ID").alias("users"),
        F.collect_set("platform_source_cleaned").alias("platforms"))
    per_ad = parts.groupBy(AD).agg(
        F.sum("clicks").alias("total_clicks"),
        F.sum("n").alias("total_impressions"),
        (F.sum("watch") / F.sum("watch_n")).alias("avg_watch_duration"),
        F.sum("cost").alias("total_ad_spend"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("conversions").alias("total_conversions"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("platforms")))).alias("platforms_used"),
        F.sum("users").alias("unique_users"),
    )
    return per_ad.withColumn("ctr", guarded_ratio("total_clicks", "total_impressions"))


def platform_cells(rows: DataFrame) -> DataFrame:
    """Sums per ad and platform of such a log."""
    return rows.groupBy(AD, "platform_source_cleaned").agg(*_cell_sums())


def _cell_sums() -> list[Column]:
    clicked = F.col(features.CLICKED)
    return [
        F.sum(clicked).alias("clicks"),
        F.count("User_ID").alias("n"),
        F.sum("Watch_Duration_Cleaned").alias("watch"),
        F.count("Watch_Duration_Cleaned").alias("watch_n"),
        F.sum(F.col("Cost_Per_Click_Cleaned") * clicked).alias("cost"),
        F.sum(F.col("order_value") * F.col("is_converted")).alias("revenue"),
        F.sum("is_converted").alias("conversions"),
    ]


def add_rates(gold: DataFrame) -> DataFrame:
    """Ratios of sums: click, conversion and return rates."""
    return gold.withColumns(
        {
            "ctr": guarded_ratio("total_clicks", "total_impressions"),
            "roas": guarded_ratio("total_revenue", "total_ad_spend"),
            "conversion_rate": guarded_ratio("total_conversions", "total_clicks"),
            "overall_conversion_rate": guarded_ratio("total_conversions", "total_impressions"),
        }
    )


def add_derived(
    gold: DataFrame,
    as_of: str | Column | None = None,
    weights: Mapping[str, float] | None = None,
    win_roas: float = fixed.WIN_ROAS,
) -> DataFrame:
    """Scores, labels and the processing date of the gold table."""
    if as_of is None:
        as_of = F.current_date()
    today = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    weights = weights or fixed.ENGAGEMENT_WEIGHTS
    spend, revenue = F.col("total_ad_spend"), F.col("total_revenue")
    return gold.withColumns(
        {
            "engagement_efficiency": F.col("avg_watch_ratio") * F.col("ctr"),
            "profit_margin": guarded_ratio(revenue - spend, spend),
            "cost_per_conversion": guarded_ratio(spend, "total_conversions"),
            "high_performance": F.when(F.col("roas") > win_roas, 1).otherwise(0),
            "cost_efficiency_score": guarded_ratio(
                F.col("ctr") * F.col("conversion_rate"), "cost_per_click"
            ),
            "engagement_score": reduce(
                lambda a, b: a + b, [F.col(c) * F.lit(w) for c, w in weights.items()]
            ),
            "audience_alignment_score": F.col("avg_ded_score") * F.col("category_age_affinity"),
            "ad_age_days": F.date_diff(today, "ingestion_date"),
            "location_type": features.location_type("ad_location"),
            "season": features.season("month"),
            "processing_date": today,
        }
    ).withColumn("ad_lifecycle_stage", features.lifecycle_stage("ad_age_days"))


def top_share_flag(gold: DataFrame, metric: str = "ctr", share: float = 0.2) -> DataFrame:
    """Alternative win label: 1 for the top part of ads by a metric."""
    cut = quantile(gold, metric, 1 - share).scalar()
    return gold.withColumn("high_performance", F.when(F.col(metric) >= cut, 1).otherwise(0))
