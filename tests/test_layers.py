"""Cleaning and roll-up: injected counts, idempotence, edge cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from adperf.functions import fixed
from adperf.operators import cleanse, features, quality, rollup
from adperf.plans import layers


def injected(d, spark):
    n = spark.read.parquet(f"{d}/events.parquet").count()
    return n, sum(1 for i in range(n) if i % 250 == 3), sum(1 for i in range(n) if i % 12 == 4)


def test_injected_anomalies_are_counted(spark, sf_dir):
    n, future, corrupt = injected(sf_dir, spark)
    raw = layers.bronze_clicks(spark, sf_dir)
    report = quality.anomaly_report({"clicks": raw}, quality.CLICK_ANOMALIES)
    counts = {r["anomaly_type"]: r["count"] for r in report.collect()}
    repeated = [i for i in range(n) if i % 200 == 0]
    assert counts["Duplicate Rows"] == len(repeated)
    assert counts["Timestamp - Future Dates"] == future + sum(1 for i in repeated if i % 250 == 3)
    assert counts["Device - Corruption CRITICAL"] == corrupt + sum(1 for i in repeated if i % 12 == 4)


def test_cleaning_leaves_no_residue(spark, sf_dir):
    frames = {
        "silver_clicks": layers.silver_clicks(spark, sf_dir),
        "silver_catalog": layers.silver_catalog(spark, sf_dir),
    }
    report = quality.run_rules(frames, quality.RESIDUAL_RULES + quality.SILVER_RULES)
    assert {r["status"] for r in report.collect()} == {"PASS"}


def test_cleaned_values_are_stable(spark, sf_dir):
    """Cleaning cleaned columns again changes nothing."""
    once = layers.silver_clicks(spark, sf_dir)
    again = once.select(
        (cleanse.click_ad_type("Ad_Type_Standard") == F.col("Ad_Type_Standard")).alias("a"),
        (cleanse.click_device("device_cleaned") == F.col("device_cleaned")).alias("b"),
        (cleanse.platform("platform_source_cleaned") == F.col("platform_source_cleaned")).alias("c"),
        (cleanse.watch_duration("Watch_Duration_Cleaned") == F.col("Watch_Duration_Cleaned")).alias("d"),
        (cleanse.age("user_age_cleaned") == F.col("user_age_cleaned")).alias("e"),
    )
    assert again.filter("NOT (a AND b AND c AND d AND e)").count() == 0


def test_duration_clamp_comes_before_conflict_repair(spark):
    df = spark.createDataFrame([(1, -12.5), (1, 3.0), (0, 0.0)], "user_clicked int, Watch_Duration double")
    out = df.withColumn("Watch_Duration_Cleaned", cleanse.watch_duration()).select(cleanse.clicked())
    assert [r[0] for r in out.collect()] == [0, 1, 0]


def test_video_length_needs_the_standard_type(spark):
    rows = [("Video", "45s"), ("Image", "20.0"), (None, "20.0"), ("Vedeo", "12"), ("Video", "x")]
    df = spark.createDataFrame(rows, "Ad_Type string, ad_video_length string")
    out = df.withColumn("Ad_Type_Standard", cleanse.catalog_ad_type()).select(cleanse.video_length())
    assert [r[0] for r in out.collect()] == [45.0, 0.0, 0.0, 12.0, 0.0]


def test_unparsable_timestamps_of_one_user_and_ad_collapse(spark):
    rows = [(1, "u", "bad", "a"), (2, "u", "worse", "a"), (3, "u", "bad", "b")]
    df = spark.createDataFrame(rows, "Event_ID int, User_ID string, Click_Timestamp string, Ad_Reference_ID string")
    parsed = df.withColumn("Click_Timestamp_Standard", cleanse.timestamp())
    kept = cleanse.drop_business_duplicates(parsed, cleanse.BUSINESS_KEY, ["Event_ID"])
    assert sorted(r["Event_ID"] for r in kept.collect()) == [1, 3]


def test_hot_ads_join_gives_the_same_rows(spark, sf_dir):
    clicks, catalog = layers.silver_clicks(spark, sf_dir), layers.silver_catalog(spark, sf_dir)
    plain = features.join_catalog(clicks, catalog)
    hot = features.join_catalog(clicks, catalog, share=0.005, min_rows=0)
    assert plain.exceptAll(hot).isEmpty() and hot.exceptAll(plain).isEmpty()


def test_gold_totals_match_the_impressions(spark, sf_dir):
    gold, rows = layers.gold(spark, sf_dir), layers.enriched(spark, sf_dir)
    g = gold.agg(F.sum("total_impressions"), F.sum("total_clicks"), F.sum("total_conversions"), F.sum("total_ad_spend")).first()
    r = rows.agg(F.count("*"), F.sum("user_clicked_cleaned"), F.sum("is_converted"), F.sum("total_cost")).first()
    assert tuple(g)[:3] == tuple(r)[:3] and g[3] == pytest.approx(r[3])
    assert gold.count() == rows.select("Ad_Reference_ID").distinct().count()


def test_lifecycle_and_win_threshold_are_parameters(spark, sf_dir):
    gold = layers.gold(spark, sf_dir)
    late = rollup.add_derived(gold, "2025-01-01", win_roas=-1.0)
    assert {r[0] for r in late.select("ad_lifecycle_stage").distinct().collect()} == {"Declining"}
    assert late.filter("high_performance = 0").count() == 0
    top = rollup.top_share_flag(gold, "ctr", 0.2)
    flagged, others = top.filter("high_performance = 1"), top.filter("high_performance = 0")
    assert flagged.count() >= 0.2 * top.count() and others.count() > 0
    assert flagged.agg(F.min("ctr")).first()[0] > others.agg(F.max("ctr")).first()[0]


def test_approximate_users_are_close(spark, sf_dir):
    clicks = layers.silver_clicks(spark, sf_dir)
    exact = {r[0]: r[1] for r in rollup.distinct_users(clicks).collect()}
    near = {r[0]: r[1] for r in rollup.distinct_users(clicks, approx=True).collect()}
    assert exact.keys() == near.keys()
    assert all(abs(near[k] - exact[k]) <= max(2, 0.2 * exact[k]) for k in exact)


def test_true_outcomes_replace_the_draw(spark):
    df = spark.createDataFrame([(1, 1)], "Event_ID int, is_converted int").select(
        "*", F.lit(1).alias("user_clicked_cleaned"), F.lit(2.0).alias("Cost_Per_Click_Cleaned"),
        F.lit(30).alias("user_age_cleaned"), F.lit(0.0).alias("Watch_Duration_Cleaned"),
        F.lit(0.0).alias("ad_video_length_cleaned"),
        F.lit("2024-01-06 05:00:00").cast("timestamp").alias("Click_Timestamp_Standard"),
    )
    row = features.enrich(df, "Event_ID").first()
    assert row["is_converted"] == 1 and row["watch_duration_ratio"] == 0.0
    assert row["is_weekend"] == 1 and row["age_category"] == "25-34"
    multiple = 5 + ((1 * fixed.REVENUE_DRAW[0]) % fixed.REVENUE_DRAW[1]) / 100
    assert row["total_revenue"] == pytest.approx(2.0 * multiple)


def test_a_log_without_id_is_cleaned_and_rolled_up(spark, sf_dir):
    """The ten raw columns are enough; draws then come from the business key."""
    raw = layers.bronze_clicks(spark, sf_dir).drop("Event_ID")
    clicks = cleanse.clean_clicks(raw)
    assert clicks.count() == layers.silver_clicks(spark, sf_dir).count()
    gold = rollup.ad_performance(clicks, layers.silver_catalog(spark, sf_dir), as_of="2024-02-15")
    want = layers.gold(spark, sf_dir)
    same = ["Ad_Reference_ID", "total_impressions", "unique_users"]
    assert gold.select(*same).exceptAll(want.select(*same)).isEmpty()
    again = rollup.ad_performance(clicks, layers.silver_catalog(spark, sf_dir), as_of="2024-02-15")
    cols = ["Ad_Reference_ID", "total_conversions"]
    assert gold.select(*cols).exceptAll(again.select(*cols)).isEmpty()


def test_shuffle_partitions_follow_the_size():
    from adperf.session import shuffle_partitions

    assert shuffle_partitions(1) == 1
    assert shuffle_partitions(2 * 1024**4) == 10_486
    assert shuffle_partitions(100 * 1024**4) == 524_288


def test_ad_totals_shuffle_the_log_once(spark):
    data = [
        (f"AD_{i % 3}" if i % 50 else None, f"U{i % 7}" if i % 11 else None, "asia" if i % 2 else "europe", float(i % 5), i % 2,
         int(i % 4 == 1), 0.5, float(i)) for i in range(400)]
    rows = spark.createDataFrame(
        data, "Ad_Reference_ID string, User_ID string, platform_source_cleaned string, Watch_Duration_Cleaned double,"
        " user_clicked_cleaned int, is_converted int, Cost_Per_Click_Cleaned double, order_value double")
    totals = rollup.impression_totals(rows)
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # the log, and sums of the parts of an ad
    assert "REPARTITION_BY_NUM" in plan  # so that tasks of the log are not merged
    found = {r.Ad_Reference_ID: r for r in totals.collect()}
    assert set(found) == {"AD_0", "AD_1", "AD_2"}
    for ad, r in found.items():
        own = [x for x in data if x[0] == ad]
        assert r.unique_users == len({x[1] for x in own} - {None})
        assert r.total_impressions == sum(x[1] is not None for x in own)
        assert r.platforms_used == ["asia", "europe"] and r.total_clicks == sum(x[4] for x in own)
        assert r.total_revenue == sum(x[7] * x[5] for x in own)
