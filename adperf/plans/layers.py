"""The layers, composed: raw tables -> conformed tables -> ad performance.

Conformed and gold layers are tables: each is written once per application to
the staging folder and read by everything downstream, as a scheduled run would.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adperf.operators import cleanse, features, rollup
from adperf.sources import adapters
from adperf.sources.staging import stage, staging_root  # noqa: F401

AS_OF = "2024-02-15"
DRAW_KEY = "Event_ID"
MODEL_WIN_ROAS = 12.0

_written: dict[tuple[str, str, str], DataFrame] = {}


def run_id() -> str:
    return uuid.uuid4().hex[:12]


def layer(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        _written[key] = stage(build(), name)
    return _written[key]


def bronze_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.clicks(spark, sf_dir)


def bronze_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.catalog(spark, sf_dir)


def build_silver_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse.clean_clicks(bronze_clicks(spark, sf_dir), [DRAW_KEY], [DRAW_KEY])


def build_silver_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse.clean_catalog(
        bronze_catalog(spark, sf_dir), order_by=[F.col("load_seq").asc()]
    )


def silver_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layer(
        spark, sf_dir, "silver_clicks", lambda: build_silver_clicks(spark, sf_dir)
    )


def silver_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layer(
        spark, sf_dir, "silver_catalog", lambda: build_silver_catalog(spark, sf_dir)
    )


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Impressions of known ads with all row-level features."""
    joined = features.join_catalog(silver_clicks(spark, sf_dir), silver_catalog(spark, sf_dir))
    return features.enrich(joined, DRAW_KEY)


def build_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.ad_performance(
        silver_clicks(spark, sf_dir), silver_catalog(spark, sf_dir), AS_OF, DRAW_KEY
    )


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layer(spark, sf_dir, "gold", lambda: build_gold(spark, sf_dir))


def build_model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-level training rows: totals of the large impression log with catalog attributes."""
    totals = rollup.impression_totals(adapters.impressions(spark, sf_dir))
    attributes = silver_catalog(spark, sf_dir).select(
        "Ad_Reference_ID",
        F.col("Ad_Category_Standard").alias("ad_category"),
        F.col("Ad_Device_Cleaned").alias("ad_device"),
        F.col("Ad_Location_Cleaned").alias("ad_location"),
        F.col("Ad_Type_Standard").alias("ad_type"),
        F.col("Cost_Per_Click_Cleaned").cast("double").alias("cost_per_click"),
        F.col("ad_video_length_cleaned").alias("ad_video_length"),
    )
    rated = rollup.add_rates(totals.drop("ctr", "platforms_used")).join(
        attributes, "Ad_Reference_ID"
    )
    return rated.withColumn(
        "high_performance", F.when(F.col("roas") > MODEL_WIN_ROAS, 1).otherwise(0)
    )


def model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layer(spark, sf_dir, "model_frame", lambda: build_model_frame(spark, sf_dir))
