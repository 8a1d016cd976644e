"""One whole batch from CSV files to the exported gold table."""

from __future__ import annotations

from pyspark.sql import functions as F

from adperf.operators import reports
from adperf.plans import layers, run
from adperf.sources import io, schemas

RUN = io.Run("b1", "2024-02-15 06:00:00", "test", "abc", "v1")


def test_batch(spark, sf_dir, tmp_path):
    raw = layers.bronze_clicks(spark, sf_dir).drop("ingestion_date")
    catalog = layers.bronze_catalog(spark, sf_dir).filter("load_seq = 0").drop("load_seq")
    io.export_text(raw, str(tmp_path / "clicks"), "csv")
    io.export_text(catalog, str(tmp_path / "catalog"), "csv")
    clicks = io.read_csv(spark, str(tmp_path / "clicks"), f"Event_ID long, {schemas.RAW_CLICKS}")
    ads = io.read_csv(spark, str(tmp_path / "catalog"), schemas.RAW_CATALOG)

    run.run_batch(spark, clicks, ads, "batch_test", RUN, "Event_ID", str(tmp_path / "export"))

    gold = spark.table("batch_test.fact_ad_performance")
    want = layers.gold(spark, sf_dir)
    same = ["Ad_Reference_ID", "total_clicks", "total_impressions", "total_conversions", "unique_users", "ad_type", "best_day"]
    assert gold.select(*same).exceptAll(want.select(*same)).isEmpty()
    assert gold.count() == want.count()
    assert reports.verification(gold, "ad_category").count() == want.select("ad_category").distinct().count()

    log = spark.table("batch_test.batch_log")
    assert {r["layer"] for r in log.collect()} == {"bronze", "anomalies", "silver", "gold", "checks", "export"}
    assert spark.table("batch_test.export_log").first()["status"] == "MATCH"
    assert spark.table("batch_test.gold_quality_report").count() == 1
    assert spark.table("batch_test.silver_clicks").select("processing_batch_id").distinct().first()[0] == "b1"
    report = spark.table("batch_test.anomaly_report")
    assert report.filter("status = 'ANOMALY_DETECTED'").count() > 20
    pruned = gold.filter(F.col("ad_category") == "Food")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ad_category" in pruned
    spark.sql("DROP SCHEMA batch_test CASCADE")


def test_a_failed_step_is_logged_and_raises(spark, sf_dir):
    import pytest

    raw = layers.bronze_clicks(spark, sf_dir).drop("ingestion_date")
    broken = layers.bronze_catalog(spark, sf_dir).filter("load_seq = 0").drop("load_seq", "Ad_Category")
    with pytest.raises(Exception, match="Ad_Category"):
        run.run_batch(spark, raw, broken, "failed_batch", RUN, "Event_ID")
    log = {r["layer"]: r for r in spark.table("failed_batch.batch_log").collect()}
    assert log["bronze"]["status"] == "SUCCESS"
    failed = [r for r in log.values() if r["status"] == "FAILED"]
    assert len(failed) == 1 and "Ad_Category" in failed[0]["message"]
    assert spark.table("failed_batch.version_history").first()["status"] == "FAILED"
    spark.sql("DROP SCHEMA failed_batch CASCADE")
