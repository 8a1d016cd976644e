"""Row-level features of the click x catalog join, and group statistics on rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.functions import fixed
from adperf.functions.expr import (
    as_col,
    blank_to,
    bucketize,
    capitalise,
    clamp,
    guarded_ratio,
    key_draw,
    lookup,
    primary_element,
    steps_above,
    value_map,
)
from adperf.operators import spread
from adperf.operators.windows import group_stats_onto_rows

AD = "Ad_Reference_ID"
CLICKED = "user_clicked_cleaned"


# ---- join ---------------------------------------------------------------------------


def join_catalog(clicks: DataFrame, catalog: DataFrame, **hot) -> DataFrame:
    """Impressions of known ads with the ad's attributes (inner join).

    Ads holding a large part of the log are met by broadcast of their catalog
    rows; for the rest Spark picks the join by the catalog's size.
    """
    side = catalog.select(
        AD,
        "Ad_Category_Standard",
        "Ad_Device_Cleaned",
        "Ad_Location_Cleaned",
        F.col("Cost_Per_Click_Cleaned").cast("double").alias("Cost_Per_Click_Cleaned"),
        F.col("Ad_Type_Standard").alias("Ad_Type_Catalog"),
        "ad_video_length_cleaned",
    ).filter(F.col(AD).isNotNull())
    return spread.attach_by_key(clicks, side, [AD], "inner", **hot)


# ---- columns ------------------------------------------------------------------------


def day_part(hour: str | Column) -> Column:
    return bucketize(hour, fixed.DAY_PART_EDGES, fixed.DAY_PARTS)


def age_band(age: str | Column) -> Column:
    return bucketize(age, fixed.AGE_EDGES, fixed.AGE_BANDS)


def display_age_band(age: str | Column) -> Column:
    return bucketize(age, fixed.AGE_EDGES, fixed.DISPLAY_AGE_BANDS, right=True)


def with_calendar(df: DataFrame, ts: str = "Click_Timestamp_Standard") -> DataFrame:
    """Hour, weekday (1 = Sunday), month, weekend flag and part of the day."""
    weekday = F.dayofweek(ts)
    return df.withColumns(
        {
            "hour_of_day": F.hour(ts),
            "day_of_week": weekday,
            "month": F.month(ts),
            "is_weekend": F.when(weekday.isin(1, 7), 1).otherwise(0),
            "time_of_day_category": day_part(F.hour(ts)),
        }
    )


def watch_ratio(
    duration: str = "Watch_Duration_Cleaned", length: str = "ad_video_length_cleaned"
) -> Column:
    return guarded_ratio(duration, length)


def with_watch_ratio(df: DataFrame) -> DataFrame:
    """Watched part of the video, raw and limited to 0-1; 0 without a length."""
    return df.withColumns(
        {
            "watch_duration_ratio": watch_ratio(),
            "watch_duration_ratio_clipped": clamp(watch_ratio(), 0.0, 1.0),
        }
    )


def draw_column(df: DataFrame, draw_key: str | None) -> Column:
    """The key of the draws: a column, or a hash of the impression's business key."""
    if draw_key:
        return F.col(draw_key)
    return F.xxhash64("User_ID", "Click_Timestamp_Standard", AD)


def converted(draw_key: str | Column, percent: int = fixed.CONVERSION_PERCENT) -> Column:
    """Clicked, watched enough, in the converting ages, and drawn by key.

    A log that records outcomes should bring its own `is_converted` column.
    """
    drawn = key_draw(draw_key, fixed.CONVERSION_DRAW) < percent
    qualified = (
        (F.col(CLICKED) == 1)
        & (F.col("watch_duration_ratio") > fixed.CONVERSION_WATCH_RATIO)
        & F.col("user_age_cleaned").between(*fixed.CONVERTING_AGES)
    )
    return F.when(qualified & drawn, 1).otherwise(0)


def return_multiple(draw_key: str | Column) -> Column:
    """Revenue per unit of cost of a converted click, 5 to 15 by key."""
    return F.lit(5.0) + key_draw(draw_key, fixed.REVENUE_DRAW).cast("double") / F.lit(100.0)


def with_financials(df: DataFrame, draw_key: str | Column) -> DataFrame:
    """Revenue, cost and return on ad spend of each impression.

    A log that records the value of its conversions as `order_value` keeps it; the
    value is drawn only where the log has no such column.
    """
    cpc = F.col("Cost_Per_Click_Cleaned")
    if "order_value" in df.columns:
        revenue = F.coalesce(F.col("order_value") * F.col("is_converted"), F.lit(0.0))
        rows = df.withColumns({"revenue_per_click": revenue, "total_revenue": revenue})
    else:
        per_click = F.when(F.col("is_converted") == 1, cpc * return_multiple(draw_key)).otherwise(0.0)
        rows = df.withColumn("revenue_per_click", per_click).withColumn(
            "total_revenue", F.col("revenue_per_click") * F.col(CLICKED))
    return rows.withColumn("total_cost", cpc * F.col(CLICKED)).withColumn(
        "return_on_ad_spend", guarded_ratio("total_revenue", "total_cost"))


def enrich(joined: DataFrame, draw_key: str | None = None) -> DataFrame:
    """All row-level features; no shuffle."""
    draw = draw_column(joined, draw_key)
    rows = with_watch_ratio(with_calendar(joined))
    if "is_converted" not in rows.columns:
        rows = rows.withColumn("is_converted", converted(draw))
    rows = rows.withColumn("age_category", age_band("user_age_cleaned"))
    return with_financials(rows, draw)


# ---- group statistics on rows ---------------------------------------------------------


def add_user_totals(rows: DataFrame, **hot) -> DataFrame:
    stats = {"user_total_clicks": F.sum(CLICKED), "user_total_impressions": F.count("User_ID")}
    return group_stats_onto_rows(rows, ["User_ID"], stats, **hot).withColumn(
        "user_ctr", guarded_ratio("user_total_clicks", "user_total_impressions")
    )


def add_ad_totals(rows: DataFrame, **hot) -> DataFrame:
    stats = {
        "ad_total_clicks": F.sum(CLICKED),
        "ad_total_impressions": F.count(AD),
        "ad_avg_watch_duration": F.avg("Watch_Duration_Cleaned"),
    }
    return group_stats_onto_rows(rows, [AD], stats, **hot).withColumn(
        "ad_ctr", guarded_ratio("ad_total_clicks", "ad_total_impressions")
    )


def demographic_delta(rate: str | Column) -> Column:
    return steps_above(rate, fixed.DED_STEPS, fixed.DED_FLOOR)


def add_demographic_fit(rows: DataFrame, **hot) -> DataFrame:
    """Click rate of the row's age band in its category, and its stepped score."""
    stats = {"category_performance_by_age": F.avg(CLICKED)}
    keys = ["age_category", "Ad_Category_Standard"]
    return group_stats_onto_rows(rows, keys, stats, **hot).withColumn(
        "demographic_engagement_delta", demographic_delta("category_performance_by_age")
    )


def add_platform_totals(rows: DataFrame, **hot) -> DataFrame:
    stats = {
        "platform_avg_roas": F.avg("return_on_ad_spend"),
        "platform_total_spend": F.sum("total_cost"),
        "platform_total_revenue": F.sum("total_revenue"),
    }
    return group_stats_onto_rows(rows, ["platform_source_cleaned"], stats, **hot)


# ---- ad-level columns -------------------------------------------------------------------


def lifecycle_stage(age_days: str | Column) -> Column:
    return bucketize(age_days, fixed.LIFECYCLE_EDGES, fixed.LIFECYCLE_STAGES)


def location_type(c: str) -> Column:
    return F.coalesce(lookup(c, fixed.LOCATION_TYPES), F.lit("Rural"))


def season(month: str | Column) -> Column:
    return F.coalesce(lookup(as_col(month).cast("int"), fixed.SEASONS), F.lit("Unknown"))


def day_name(day: str | Column) -> Column:
    return lookup(as_col(day).cast("int"), fixed.DAY_NAMES)


def primary_platform(platforms: str = "platforms_used") -> Column:
    """First platform of an ad in standard spelling, placeholders as Other."""
    name = F.lower(blank_to(primary_element(platforms), "other"))
    return capitalise(value_map(name, fixed.PLATFORM_PLACEHOLDERS))


def corrected_revenue(df: DataFrame, factor: float = 1.0) -> DataFrame:
    """Scale revenue by an attribution factor, recompute ROAS and margin on revenue."""
    scaled = df.withColumn("total_revenue", F.col("total_revenue") * F.lit(factor))
    margin = (F.col("total_revenue") - F.col("total_ad_spend")) / F.col("total_revenue")
    return scaled.withColumns(
        {
            "roas": F.round(guarded_ratio("total_revenue", "total_ad_spend"), 2),
            "profit_margin": F.when(F.col("total_revenue") > 0, F.round(margin, 4)).otherwise(-1.0),
        }
    )


def display_ad_type(c: str = "ad_type") -> Column:
    return value_map(blank_to(c, "Carousel"), fixed.AD_TYPE_PLACEHOLDERS)


def engagement_per_cost(score: str = "engagement_score", cpc: str = "cost_per_click") -> Column:
    return guarded_ratio(score, cpc)


def alternative_metrics(df: DataFrame) -> DataFrame:
    """Conversions per unit of spend, and engagement as 5 ctr + 0.5 watch ratio."""
    return df.withColumns(
        {
            "conversions_per_spend": guarded_ratio("total_conversions", "total_ad_spend"),
            "engagement_ctr_watch": F.col("ctr") * 5 + F.col("avg_watch_ratio") * 0.5,
        }
    )


def code_numbers(df: DataFrame) -> DataFrame:
    """Fixed code numbers of the categorical model inputs, unknown values 0."""
    tables = {
        "ad_category": fixed.CATEGORY_CODES,
        "ad_device": fixed.DEVICE_CODES,
        "ad_type": fixed.TYPE_CODES,
        "ad_location": fixed.LOCATION_CODES,
    }
    return df.withColumns(
        {
            f"{c}_encoded": F.coalesce(lookup(F.lower(F.col(c)), t), F.lit(0))
            for c, t in tables.items()
        }
    )


def interactions(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "device_type_interaction": F.col("ad_device_encoded") * F.col("ad_type_encoded"),
            "category_type_interaction": F.col("ad_category_encoded") * F.col("ad_type_encoded"),
            "cost_video_interaction": F.col("cost_per_click") * F.col("ad_video_length"),
        }
    )
