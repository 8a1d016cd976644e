"""Column expressions on literal frames, dirty values included."""

from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adperf.functions import expr, fixed
from adperf.operators import cleanse, features


def values(spark, rows, column, kind="string"):
    df = spark.createDataFrame([(r,) for r in rows], f"v {kind}")
    return [r[0] for r in df.select(column).collect()]


def test_parse_currency(spark):
    got = values(spark, ["$1.50", "-1.50", "n/a", None, " $2 ", ""], expr.parse_number("v", "$"))
    assert got == [1.5, -1.5, None, None, 2.0, None]


def test_cost_per_click_is_never_negative(spark):
    got = values(spark, ["$1.50", "-1.50", "n/a", None], cleanse.cost_per_click("v"))
    assert [float(x) for x in got] == [1.5, 0.0, 0.0, 0.0]


def test_parse_seconds(spark):
    got = values(spark, ["45s", "20.0", "", None, "s"], expr.parse_number("v", suffix="s"))
    assert got == [45.0, 20.0, None, None, None]


def test_parse_timestamps(spark):
    rows = ["2024-01-05 10:20:30", "05/01/2024 10:20", "not-a-date", None, "2024-01-05 10:20", "99/99/2024 10:20"]
    strict = values(spark, rows, expr.parse_timestamp("v"))
    assert strict == [datetime(2024, 1, 5, 10, 20, 30), datetime(2024, 1, 5, 10, 20), None, None, None, None]
    wide = values(spark, rows, expr.parse_timestamp("v", fixed.PROFILE_TIMESTAMP_FORMATS))
    assert wide[4] == datetime(2024, 1, 5, 10, 20)


def test_clamp_keeps_null(spark):
    assert values(spark, [-1.0, 5.0, 200.0, None], expr.clamp("v", 0.0, 180.0), "double") == [0.0, 5.0, 180.0, None]


def test_age_repair(spark):
    assert values(spark, [-1, 17, 18, 100, 125, None], cleanse.age("v"), "int") == [25, 25, 18, 100, 35, 30]


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(expr.guarded_ratio("a", "b")).collect()] == [0.5, 0.0, 0.0]


def test_device_repair(spark):
    rows = ["47 DESKTOP", "moble", "", None, "Tablet", "desktop"]
    assert values(spark, rows, cleanse.click_device("v")) == [
        "Desktop", "Mobile", "Unknown", "Unknown", "Tablet", "Desktop",
    ]


def test_platform_unknown_passes_through(spark):
    assert values(spark, ["gogle", None, "Unknown"], cleanse.platform("v")) == ["google", "other", "Unknown"]


def test_edges_of_both_age_bands(spark):
    assert values(spark, [24, 25, 34, 35, 49, 50], features.age_band("v"), "int") == [
        "18-24", "25-34", "25-34", "35-49", "35-49", "50+",
    ]
    assert [x.split(" ")[0] for x in values(spark, [25.0, 25.1, 35.0, 50.0, 50.5], features.display_age_band("v"), "double")] == [
        "18-25", "26-35", "26-35", "36-50", "50+",
    ]


def test_null_hour_is_late_night(spark):
    assert values(spark, [None, 5, 6, 17, 21, 22], features.day_part("v"), "int") == [
        "Late_Night", "Late_Night", "Morning", "Afternoon", "Evening_Prime", "Late_Night",
    ]


def test_clock_labels(spark):
    assert values(spark, [0.0, 9.25, 12.0, 23.75, 23.9], expr.clock_label("v"), "double") == [
        "12:00 AM", "9:15 AM", "12:00 PM", "11:45 PM", "12:00 AM",
    ]


def test_quarter_hours_round_half_to_even(spark):
    assert values(spark, [9.125, 9.375], expr.nearest_quarter_hour("v"), "double") == [9.0, 9.5]


def test_season_and_location(spark):
    assert values(spark, [12, 4, 7, 10, None], features.season("v"), "int") == [
        "Winter", "Spring", "Summer", "Fall", "Unknown",
    ]
    assert values(spark, ["Delhi", "Tamil Nadu", "Goa", None], features.location_type("v")) == [
        "Urban", "Semi-Urban", "Rural", "Rural",
    ]


def test_signed_money(spark):
    assert values(spark, [1234.0, -5.0], expr.signed_money("v"), "double") == ["+$1,234", "-$5"]


def test_capitalise_and_first_token(spark):
    assert values(spark, ["tAMIL nadu"], expr.capitalise("v")) == ["Tamil nadu"]
    assert values(spark, ["18-25 (Gen Z)"], expr.first_token("v")) == ["18-25"]


def test_value_map_passes_other_values(spark):
    assert values(spark, ["video", "Text", None], expr.value_map("v", fixed.CLICK_AD_TYPES, "Unknown")) == [
        "Video", "Text", "Unknown",
    ]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=12), min_size=1, max_size=8))
def test_parsers_never_raise(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    out = df.select(
        expr.parse_number("v", "$").alias("a"),
        expr.parse_number("v", suffix="s").alias("b"),
        expr.parse_timestamp("v").cast("string").alias("c"),
        cleanse.cost_per_click("v").alias("d"),
        expr.coerce_number("v").alias("e"),
    ).collect()
    assert len(out) == len(texts)
    assert all(r["d"] >= 0 for r in out)


@pytest.mark.parametrize("n", [0, 1, 999])
def test_key_draw_is_integer_arithmetic(spark, n):
    assert values(spark, [n], expr.key_draw("v", fixed.CONVERSION_DRAW), "long") == [(n * 7919) % 100]


def test_first_match_null_condition_falls_through(spark):
    col = expr.first_match([(F.col("v") > 1, "big")], "other")
    assert values(spark, [None, 2], col, "int") == ["other", "big"]
