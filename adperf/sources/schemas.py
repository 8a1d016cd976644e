"""Explicit schemas: reading never infers types, so dirty files cannot change them."""

from __future__ import annotations

RAW_CLICKS = (
    "User_ID string, Click_Timestamp string, Ad_Reference_ID string, Ad_Type string, "
    "Watch_Duration double, user_age int, device string, platform_source string, "
    "user_gender string, user_clicked int"
)
RAW_CATALOG = (
    "Ad_Reference_ID string, Ad_Category string, Ad_Device string, Ad_Location string, "
    "Cost_Per_Click string, Ad_Type string, ad_video_length string"
)
INGESTION_AUDIT = (
    "ingestion_timestamp timestamp, ingestion_date date, source_file string, "
    "ingestion_batch_id string, environment string, git_commit string, "
    "processing_status string"
)
BATCH_LOG = (
    "batch_id string, layer string, table_name string, source string, rows_read long, "
    "rows_written long, started_at timestamp, finished_at timestamp, status string, "
    "environment string, message string"
)
VERSION_HISTORY = (
    "version_id string, deployed_at timestamp, description string, status string, "
    "environment string, git_commit string"
)
MODEL_RESULTS = (
    "target string, model string, metric string, value double, version string, "
    "environment string, trained_at timestamp"
)

SILVER_CLICKS = [
    "User_ID", "Click_Timestamp_Standard", "Ad_Reference_ID", "Ad_Type_Standard",
    "Watch_Duration_Cleaned", "user_age_cleaned", "device_cleaned",
    "platform_source_cleaned", "user_gender_fixed", "user_clicked_cleaned",
    "ingestion_timestamp", "ingestion_date", "source_file", "ingestion_batch_id",
]
SILVER_CATALOG = [
    "Ad_Reference_ID", "Ad_Category_Standard", "Ad_Device_Cleaned", "Ad_Location_Cleaned",
    "Cost_Per_Click_Cleaned", "Ad_Type_Standard", "ad_video_length_cleaned",
    "ingestion_timestamp", "ingestion_date", "source_file", "ingestion_batch_id",
]
