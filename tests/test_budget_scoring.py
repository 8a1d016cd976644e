"""Budget splits and forecasts on small portfolios."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from adperf.operators import budget, features, reports, scoring, tables

SCHEMA = (
    "Ad_Reference_ID string, ad_category string, ad_type string, ad_device string, "
    "total_ad_spend double, total_revenue double, roas double, platforms_used array<string>"
)


def gold(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def by(df, key):
    return {r[key]: r for r in df.collect()}


@pytest.fixture(scope="module")
def ads(spark):
    return gold(
        spark,
        [
            ("1", "Food", "Video", "Mobile", 100.0, 300.0, 3.0, ["google"]),
            ("2", "Food", "Image", "Desktop", 300.0, 300.0, 1.0, ["facebook", "google"]),
            ("3", "Travel", "Image", "All-Devices", 0.0, 0.0, 1.0, []),
        ],
    )


def test_allocation(ads):
    got = by(budget.allocate(ads, "ad_type", 1000.0), "ad_type")
    assert got["Video"]["spend_share"] == 0.25 and got["Video"]["weight"] == 0.75
    assert got["Video"]["baseline_budget"] == 250.0 and got["Video"]["optimized_return"] == 2250.0


def test_allocation_without_spend_or_return(spark):
    flat = gold(spark, [(str(i), "Food", t, "Mobile", 0.0, 0.0, 0.0, []) for i, t in enumerate("ab")])
    got = by(budget.allocate(flat, "ad_type", 100.0), "ad_type")
    assert [got["a"][c] for c in ("spend_share", "weight", "baseline_budget", "recommended_budget")] == [0.5, 0.5, 50.0, 50.0]
    mix = by(budget.target_mix(flat), "ad_type")
    assert mix["a"]["target_pct"] == 50.0 and mix["a"]["target_budget"] == 25_000.0
    zero = budget.impact({"t": budget.type_mix(flat, 100.0)}).first()
    assert zero["lift_pct"] == 0.0


def test_one_group(spark):
    one = gold(spark, [("1", "Food", "Video", "Mobile", 5.0, 10.0, 2.0, [])])
    assert budget.allocate(one, "ad_type", 10.0).first()["recommended_budget"] == 10.0
    assert budget.target_mix(one).first()["action"].startswith("Scale")


def test_device_filter_falls_back(spark, ads):
    assert set(by(budget.device_mix(ads, 10.0), "ad_device")) == {"Mobile", "Desktop"}
    only_all = ads.filter("ad_device = 'All-Devices'")
    assert set(by(budget.device_mix(only_all, 10.0), "ad_device")) == {"All-Devices"}


def test_target_mix_actions(ads):
    got = by(budget.target_mix(ads), "ad_type")
    assert got["Video"]["action"].startswith("Scale") and got["Image"]["action"].startswith("Reduce")
    assert got["Video"]["target_pct"] + got["Image"]["target_pct"] == pytest.approx(100.0)


def test_primary_platform_of_empty_list(ads):
    got = [r[0] for r in ads.orderBy("Ad_Reference_ID").select(features.primary_platform()).collect()]
    assert got == ["Google", "Facebook", "Other"]


def test_filters(ads):
    assert tables.apply_filters(ads, {"ad_type": []}).count() == 0
    assert tables.apply_filters(ads, {"ad_type": None}).count() == 3
    assert tables.apply_filters(ads, {"ad_type": ["Image"], "ad_category": "Food"}).count() == 1
    domain = {"ad_type": ["Video", "Image"]}
    assert tables.apply_filters(ads, {"ad_type": ["Image", "Video"]}, domain).count() == 3


def test_keyword_search_falls_back(ads):
    hit = tables.keyword_search(ads.select("Ad_Reference_ID", "ad_category"), "show travel ads", "Ad_Reference_ID")
    assert [r[0] for r in hit.collect()] == ["3"]
    none = tables.keyword_search(ads.select("Ad_Reference_ID"), "zzzzz", "Ad_Reference_ID", k=2)
    assert none.count() == 2


def test_waste_fallback(spark):
    good = gold(spark, [(str(i), "Food", "Video", "Mobile", float(i), 9.0, 2.0 + i, []) for i in range(4)])
    assert [r["roas"] for r in reports.waste(good, k=2).collect()] == [2.0, 3.0]
    mixed = good.withColumn("roas", F.when(F.col("Ad_Reference_ID") == "1", 0.5).otherwise(F.col("roas")))
    assert [r["Ad_Reference_ID"] for r in reports.waste(mixed, k=2).collect()] == ["1"]


FEATURES = "ad_category string, ad_device string, ad_type string, ad_location string, cost_per_click double, ad_video_length double, category_age_affinity double, avg_ded_score double"


def expected_ctr(base, fmt, dev, loc, cpc, video, affinity, risk):
    value = base * fmt * dev * loc * max(0.88, 1.08 - cpc * 0.10) * video
    value *= max(0.90, min(1.10, 1.0 + (affinity - 0.05) * 1.5)) * max(0.92, min(1.05, 1.02 - (risk - 0.12) * 0.7))
    return round(min(max(value, 0.008), 0.032), 4)


def test_heuristic_by_hand(spark):
    df = spark.createDataFrame([("Fashion", "Mobile", "Video", "Delhi", 0.5, 15.0, 0.05, 0.12)], FEATURES)
    row = scoring.decide(scoring.heuristic(features.code_numbers(df))).first()
    assert row["pred_ctr"] == expected_ctr(0.0162, 1.18, 1.12, 1.06, 0.5, 1.08, 0.05, 0.12)
    assert row["decision"] == "approve" and row["win_class"] == 1 and row["tips"] == []


def test_unknown_categories_take_code_zero(spark):
    df = spark.createDataFrame([("Cars", "Watch", "Audio", "Goa", 0.5, 0.0, 0.05, 0.12)], FEATURES)
    row = features.code_numbers(df).first()
    assert [row[f"{c}_encoded"] for c in ("ad_category", "ad_device", "ad_type", "ad_location")] == [0, 0, 0, 0]


def test_calibration_limits(spark):
    df = spark.createDataFrame([("Fashion", "Mobile", "Video", "Delhi", 0.5, 15.0, 0.05, 0.12)], FEATURES)
    raws = features.code_numbers(df.withColumn("raw", F.explode(F.array(F.lit(1.8), F.lit(0.018), F.lit(-3.0), F.lit(25.0)))))
    got = raws.select(scoring.calibrate("ctr", "raw").alias("c"), scoring.calibrate("roas", "raw").alias("r")).collect()
    assert got[0]["c"] == got[1]["c"] == got[2]["c"]
    assert got[2]["r"] == 1.10 and 1.10 <= got[3]["r"] <= 4.50


def test_scenarios_grow_with_the_ads(spark):
    df = spark.createDataFrame([("Fashion", "Mobile", "Video", "Delhi", 0.5, 15.0, 0.05, 0.12)] * 3, FEATURES)
    got = scoring.scenarios(df, {"ad_type": ["Video", "Text"], "cost_per_click": [0.25, 0.5, 2.0]})
    assert got.count() == 18
