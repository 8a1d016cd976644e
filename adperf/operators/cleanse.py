"""Cleaning: raw click log and catalog to conformed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.functions import fixed
from adperf.functions.expr import (
    blank_to,
    clamp,
    parse_number,
    parse_timestamp,
    present,
    repair_range,
    strip_leading_age,
    value_map,
)
from adperf.operators import windows
from adperf.sources import schemas

# ---- single-column rules (each one cleaning operator) -----------------------------


def timestamp(c: str = "Click_Timestamp") -> Column:
    return parse_timestamp(c)


def click_ad_type(c: str = "Ad_Type") -> Column:
    return value_map(c, fixed.CLICK_AD_TYPES, missing="Unknown")


def watch_duration(c: str = "Watch_Duration") -> Column:
    return clamp(c, *fixed.WATCH_LIMITS)


def age(c: str = "user_age") -> Column:
    low, high = fixed.AGE_LIMITS
    return repair_range(c, low, fixed.AGE_BELOW, high, fixed.AGE_ABOVE, fixed.AGE_MISSING)


def click_device(c: str = "device") -> Column:
    """Drop a leading age, map spellings; null and empty become Unknown."""
    bare = F.nullif(strip_leading_age(c), F.lit(""))
    return value_map(bare, fixed.CLICK_DEVICES, missing="Unknown")


def platform(c: str = "platform_source") -> Column:
    return value_map(c, fixed.PLATFORMS, missing="other")


def clicked(c: str = "user_clicked", watch: str = "Watch_Duration_Cleaned") -> Column:
    """A click without watch time does not count."""
    return F.when((F.col(c) == 1) & (F.col(watch) == 0), F.lit(0)).otherwise(F.col(c))


def category(c: str = "Ad_Category") -> Column:
    return value_map(c, fixed.CATEGORIES, missing="Unknown")


def cost_per_click(c: str = "Cost_Per_Click") -> Column:
    """Amount without currency sign; 0 where it is no number, negative or too large to store."""
    amount = F.greatest(parse_number(c, strip="$"), F.lit(0.0))
    return F.coalesce(amount.try_cast("decimal(10,2)"), F.lit(0).cast("decimal(10,2)"))


def catalog_device(c: str = "Ad_Device") -> Column:
    return value_map(blank_to(c, fixed.ALL_DEVICES), fixed.CATALOG_DEVICES)


def location(c: str = "Ad_Location") -> Column:
    return F.coalesce(F.trim(F.col(c)), F.lit("Unknown"))


def catalog_ad_type(c: str = "Ad_Type") -> Column:
    return value_map(c, fixed.CATALOG_AD_TYPES, missing="Unknown")


def video_length(c: str = "ad_video_length", ad_type: str = "Ad_Type_Standard") -> Column:
    """Seconds; 0 for non-video ads and where it is no number."""
    seconds = F.coalesce(parse_number(c, suffix="s"), F.lit(0.0))
    return F.when((F.col(ad_type) != "Video") & (seconds > 0), F.lit(0.0)).otherwise(seconds)


# ---- rows -------------------------------------------------------------------------


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def drop_business_duplicates(
    df: DataFrame, keys: Sequence[str], tiebreak: Sequence[str]
) -> DataFrame:
    """One row per key; the smallest tie-break columns win.  Null keys are equal."""
    return windows.latest_per_key(df, keys, [F.col(c).asc_nulls_last() for c in tiebreak])


def fill_gender(df: DataFrame, user: str = "User_ID", c: str = "user_gender", **hot) -> DataFrame:
    """`user_gender_fixed`: the given value, else the user's most frequent, else Other."""
    return windows.fill_from_group(df, user, c, "Other", into="user_gender_fixed", **hot)


# ---- whole tables -------------------------------------------------------------------


def clean_click_columns(df: DataFrame) -> DataFrame:
    """Every cleaned click column that needs only its own row."""
    return df.withColumns(
        {
            "Click_Timestamp_Standard": timestamp(),
            "Ad_Type_Standard": click_ad_type(),
            "Watch_Duration_Cleaned": watch_duration(),
            "user_age_cleaned": age(),
            "device_cleaned": click_device(),
            "platform_source_cleaned": platform(),
        }
    ).withColumn("user_clicked_cleaned", clicked())


BUSINESS_KEY = ["User_ID", "Click_Timestamp_Standard", "Ad_Reference_ID"]


def clean_clicks(
    df: DataFrame, tiebreak: Sequence[str] = (), extra: Sequence[str] = ()
) -> DataFrame:
    """Raw click log to the conformed click table.

    Of several rows with one business key the smallest by the tie-break columns
    stays, then by the other columns; `extra` columns are kept.

    Row-level columns first (no shuffle), then the gender fill, in which only
    the rows without a gender are joined, then one de-duplication by business
    key.  Copies of a row share its business key, so that last step removes
    exact duplicates as well and the table is shuffled once, not twice.
    """
    order = [*tiebreak, *[c for c in df.columns if c not in tiebreak]]
    cleaned = fill_gender(clean_click_columns(df))
    kept = drop_business_duplicates(cleaned, BUSINESS_KEY, order)
    return kept.select(*present(kept, [*extra, *schemas.SILVER_CLICKS]))


def clean_catalog_columns(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "Ad_Category_Standard": category(),
            "Ad_Device_Cleaned": catalog_device(),
            "Ad_Location_Cleaned": location(),
            "Cost_Per_Click_Cleaned": cost_per_click(),
            "Ad_Type_Standard": catalog_ad_type(),
        }
    ).withColumn("ad_video_length_cleaned", video_length())


def clean_catalog(
    df: DataFrame,
    key: str = "Ad_Reference_ID",
    order_by: Sequence[Column] | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Raw catalog to the conformed catalog, one row per ad.

    `order_by` says which of several rows of one ad wins; by default the newest
    ingestion.
    """
    cleaned = clean_catalog_columns(df)
    if order_by is None:
        order_by = [F.col("ingestion_timestamp").desc_nulls_last()]
    order_by = [*order_by, *[F.col(c).asc_nulls_last() for c in df.columns]]
    kept = windows.latest_per_key(cleaned, [key], order_by)
    return kept.select(*present(kept, [*schemas.SILVER_CATALOG, *extra]))
