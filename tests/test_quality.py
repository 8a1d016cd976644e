"""Rule engine, scores and checks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from adperf.operators import quality
from adperf.operators.quality import Rule


@pytest.fixture(scope="module")
def people(spark):
    rows = [(1, "a", 10), (1, "a", 10), (2, None, 20), (3, "c", None), (3, "d", 30)]
    return spark.createDataFrame(rows, "id int, name string, age int")


def results(frames, rules, **kw):
    return {r["rule"]: (r["observed"], r["status"]) for r in quality.run_rules(frames, rules, **kw).collect()}


def test_all_rule_kinds(spark, people):
    known = spark.createDataFrame([(1,), (2,)], "id int")
    rules = [
        Rule("rows", "p", "rows", minimum=1, maximum=4),
        Rule("old", "p", condition="age > 15", maximum=2),
        Rule("null name", "p", "null_share", ("name",), maximum=0.2),
        Rule("repeated id", "p", "repeated_keys", ("id",), maximum=0),
        Rule("repeated rows", "p", "repeated_rows", maximum=1),
        Rule("repeated share", "p", "repeated_share", maximum=0.1),
        Rule("mixed", "p", "mixed_values", ("id", "name"), maximum=0),
        Rule("known", "p", "match_percent", ("id",), minimum=50, reference="k"),
    ]
    got = results({"p": people, "k": known}, rules)
    assert got["rows"] == (5.0, "FAIL")
    assert got["old"] == (2.0, "PASS")
    assert got["null name"] == (0.2, "PASS")
    assert got["repeated id"] == (2.0, "FAIL")
    assert got["repeated rows"] == (1.0, "PASS")
    assert got["repeated share"] == (pytest.approx(0.2), "FAIL")
    assert got["mixed"] == (1.0, "FAIL")
    assert got["known"] == (pytest.approx(200 / 3), "PASS")


def test_one_sided_bounds(people):
    got = results({"p": people}, [Rule("low", "p", "rows", minimum=6), Rule("high", "p", "rows", maximum=9), Rule("free", "p", "rows")])
    assert [got[k][1] for k in ("low", "high", "free")] == ["FAIL", "PASS", "PASS"]


def test_lag(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS ts")
    rules = [Rule("lag", "t", "lag_hours", ("ts",), maximum=24)]
    assert results({"t": df}, rules, as_of="2024-01-01 12:00:00")["lag"] == (12.0, "PASS")
    assert results({"t": df}, rules, as_of="2024-01-03 00:00:00")["lag"] == (48.0, "FAIL")


def test_row_conditions_share_one_scan(people):
    rules = [Rule(f"r{i}", "p", condition=f"age > {i}") for i in range(42)]
    plan = quality.run_rules({"p": people}, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_enforce(people):
    stop = quality.run_rules({"p": people}, [Rule("rows", "p", "rows", maximum=1, action="fail_pipeline")])
    with pytest.raises(quality.QualityError, match="rows"):
        quality.enforce(stop)
    quality.enforce(quality.run_rules({"p": people}, [Rule("rows", "p", "rows", maximum=1)]))


def test_actions_are_ordered_by_severity(people):
    rules = [
        Rule("a", "p", "rows", maximum=1, severity="low"),
        Rule("b", "p", "rows", maximum=1, severity="critical"),
        Rule("c", "p", "rows", maximum=9, severity="critical"),
    ]
    report = quality.run_rules({"p": people}, rules)
    assert [r["rule"] for r in quality.actions_due(report).collect()] == ["b", "a"]


def test_violations(people):
    rules = [Rule("old", "p", condition="age > 15"), Rule("no name", "p", condition="name IS NULL")]
    got = quality.violations(people, rules, ["id"]).collect()
    assert sorted((r["id"], r["rule"]) for r in got) == [(2, "no name"), (2, "old"), (3, "old")]
    assert quality.violations(people, rules, ["id"], per_rule=1).count() == 2


def test_schema_diff(people):
    diff = {r["column_name"]: r["problem"] for r in quality.schema_diff(people, "id long, name string, city string").collect()}
    assert diff == {"id": "type", "city": "missing", "age": "extra"}


def test_score_of_a_bad_table(spark):
    rows = [("a", 0.5, 1.0, None), ("a", 1.5, -1.0, 1), ("b", 0.1, 1.0, 2)]
    df = spark.createDataFrame(rows, "Ad_Reference_ID string, ctr double, roas double, x int")
    row = quality.quality_score(df).first()
    assert (row["null_columns"], row["duplicates"], row["score"]) == (1, 1, 100 - 5 - 0.5 - 20)
    assert row["grade"] == "C (Fair)" and row["status"] == "FAIL"


def test_empty_input(spark):
    empty = spark.createDataFrame([], "User_ID string, name string")
    got = results({"t": empty}, [Rule("n", "t", "null_share", ("name",), maximum=0), Rule("d", "t", "repeated_rows", maximum=0)])
    assert got == {"n": (0.0, "PASS"), "d": (0.0, "PASS")}


def test_layer_health(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("health_probe")
    rows = {r["table_name"]: (r["status"], r["row_count"]) for r in quality.layer_health(spark, ["health_probe", "nowhere"]).collect()}
    spark.sql("DROP TABLE health_probe")
    assert rows == {"health_probe": ("EXISTS", 3), "nowhere": ("MISSING", 0)}


def test_mixed_groups_ignore_null(spark):
    df = spark.createDataFrame([(1, "M"), (1, None), (2, "M"), (2, "F")], "u int, g string")
    got = quality.mixed_groups(df, "u", "g").collect()
    assert [(r["u"], r["value_set"]) for r in got] == [(2, ["F", "M"])]


def test_json_report(people, tmp_path):
    from adperf.sources import io

    report = quality.run_rules({"p": people}, [Rule("rows", "p", "rows")])
    io.export_text(report, str(tmp_path / "report"), "json")
    back = people.sparkSession.read.json(str(tmp_path / "report"))
    assert back.select("rule").first()[0] == "rows" and back.filter(F.col("status") == "PASS").count() == 1
