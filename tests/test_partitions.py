"""Partition-wise replacement, dated folders, quantiles of many positions, sketches."""

from __future__ import annotations

import os
from datetime import date
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from adperf.operators import rollup, tables
from adperf.sources import io
from adperf.sources.adapters import impressions

RUN = io.Run("b1", "2024-02-15 06:00:00", "test", "abc", "v1")


@pytest.fixture
def schema(spark):
    io.create_schema(spark, "adperf_parts")
    yield "adperf_parts"
    for row in io.list_tables(spark, "adperf_parts").collect():
        io.drop_table(spark, f"adperf_parts.{row['tableName']}")
    spark.sql("DROP SCHEMA adperf_parts")


def files(folder):
    return {str(p.relative_to(folder)): os.stat(p).st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def rows(table):
    return sorted(tuple(r) for r in table.collect())


def test_a_day_run_again_rewrites_that_day_only(spark, schema):
    name = f"{schema}.t"
    io.replace_partitions(spark.sql("SELECT id AS a, 'd' || id % 3 AS day FROM range(9)"), name, ["day"])
    folder = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"].removeprefix("file:")
    before = files(folder)
    io.replace_partitions(spark.sql("SELECT 100L AS a, 'd1' AS day"), name, ["day"])
    after = files(folder)
    kept = {f for f in before if after.get(f) == before[f]}
    assert kept == {f for f in before if "day=d1" not in f}
    assert rows(spark.table(name)) == sorted([(i, f"d{i % 3}") for i in range(9) if i % 3 != 1] + [(100, "d1")])
    io.replace_partitions(spark.table(name).limit(0), name, ["day"])
    assert files(folder) == after
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_columns_come_and_go_by_type(spark, schema):
    name = f"{schema}.e"
    io.replace_partitions(spark.sql("SELECT 1L AS a, 1.5D AS x, 'd1' AS day"), name, ["day"])
    narrow = spark.sql("SELECT 'd2' AS day, 2 AS a, 2.5F AS x")
    io.replace_partitions(narrow, name, ["day"])  # widened, and put in the table's order
    assert rows(spark.table(name)) == [(1, 1.5, "d1"), (2, 2.5, "d2")]
    with pytest.raises(io.SchemaConflict, match="a: string into bigint"):
        io.replace_partitions(spark.sql("SELECT 'x' AS a, 1D AS x, 'd1' AS day"), name, ["day"])
    with pytest.raises(io.SchemaConflict, match="b: new; x: absent"):
        io.replace_partitions(spark.sql("SELECT 3L AS a, 7 AS b, 'd3' AS day"), name, ["day"])
    io.replace_partitions(spark.sql("SELECT 3L AS a, 7 AS b, 'd3' AS day"), name, ["day"], evolve=True)
    assert spark.table(name).columns == ["a", "x", "b", "day"]
    found = {r.day: (r.a, r.x, r.b) for r in spark.table(name).collect()}
    assert found == {"d1": (1, 1.5, None), "d2": (2, 2.5, None), "d3": (3, None, 7)}
    with pytest.raises(io.SchemaConflict, match="partitioned by"):
        io.replace_partitions(spark.sql("SELECT 3L AS a, 'd3' AS day"), name, ["a"])


@pytest.mark.parametrize(("into", "given", "ok"), [
    ("bigint", "int", True), ("int", "bigint", False), ("double", "float", True), ("float", "double", False),
    ("float", "int", False), ("decimal(10,2)", "decimal(5,2)", True), ("decimal(10,2)", "decimal(10,4)", False),
    ("string", "void", True), ("date", "timestamp", False),
])
def test_types_that_fit(spark, into, given, ok):
    stored = spark.createDataFrame([], f"a {into}").schema
    df = spark.sql(f"SELECT CAST(NULL AS {given}) AS a")
    if ok:
        assert io.fitted(df, stored, False)[0].schema["a"].dataType == stored["a"].dataType
    else:
        with pytest.raises(io.SchemaConflict):
            io.fitted(df, stored, False)


def test_folders_are_replaced_alike(spark, tmp_path):
    path = str(tmp_path / "t")
    io.replace_folders(spark.sql("SELECT id, id % 2 AS p FROM range(4)"), path, ["p"])
    before = files(path)
    io.replace_folders(spark.sql("SELECT CAST(9 AS INT) AS id, 1L AS p"), path, ["p"])
    after = files(path)
    assert {f for f in before if after.get(f) == before[f]} == {f for f in before if "p=0" in f}
    assert rows(spark.read.parquet(path)) == [(0, 0), (2, 0), (9, 1)]
    with pytest.raises(io.SchemaConflict):
        io.replace_folders(spark.sql("SELECT 'x' AS id, 1L AS p"), path, ["p"])


def test_dated_folders_are_pruned_before_files_are_opened(spark, tmp_path):
    root = str(tmp_path / "export")
    data = spark.sql("SELECT id, date_add(DATE'2023-12-30', CAST(id AS INT) % 5) AS d FROM range(50)")
    io.export_partitioned(data, root, "d", RUN)
    between = io.read_between(spark, root, date(2023, 12, 31), date(2024, 1, 1))
    plan = between._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "make_date" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert sorted({r.d for r in between.collect()}) == [date(2023, 12, 31), date(2024, 1, 1)]
    one = io.read_day(spark, root, date(2024, 1, 2), ddl="id long, d date")
    assert {f.split("/export_")[1] for f in one.inputFiles()} == {"year=2024"}
    assert all("export_month=1/export_day=2/" in f for f in one.inputFiles())
    assert one.count() == 10 and dict(one.dtypes)["export_day"] == "int"
    assert io.read_matching(spark, root, f"{root}/export_year=2024/*/*").count() == 30
    with pytest.raises(io.MissingInput):
        io.read_day(spark, root, date(2025, 1, 2))


@pytest.mark.parametrize("accuracy", [10, 100, 10_000])
def test_quantiles_equal_numpy(spark, accuracy):
    rng = np.random.default_rng(accuracy)
    groups = {"hot": rng.normal(size=3000).round(2), "ties": rng.integers(0, 3, 200).astype(float), "one": np.array([4.0]), None: rng.random(50)}
    data = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("hot", None), ("empty", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    positions = {"low": 0.0, "q1": 0.25, "near": 0.26, "half": 0.5, "far": 0.99, "top": 1.0}
    for limits in ({}, {"share": 0.3, "min_rows": 0}):
        found = {r["g"]: [r[p] for p in positions] for r in tables.quantiles(df, "v", positions, "g", accuracy, **limits).collect()}
        assert set(found) == set(groups)
        for g, xs in groups.items():
            assert found[g] == pytest.approx(np.quantile(xs, list(positions.values())))
    every = tables.quantiles(df.filter("g = 'hot'"), "v", positions, accuracy=accuracy).first()
    assert list(every) == pytest.approx(np.quantile(groups["hot"], list(positions.values())))


def test_sketches_of_any_range_add_up(spark, sf_dir):
    log = impressions(spark, sf_dir)
    sketches = rollup.user_sketches(log, "Click_Timestamp_Standard").cache()
    for first, last in (("1994-01-01", "1994-12-31"), ("1995-03-05", "1995-03-05"), ("1990-01-01", "1991-01-01")):
        inside = log.filter(F.to_date("Click_Timestamp_Standard").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        exact = {r[0]: r[1] for r in inside.groupBy("Ad_Reference_ID").agg(F.count_distinct("User_ID")).collect()}
        got = {r[0]: r[1] for r in rollup.users_between(sketches, first, last).collect()}
        assert got.keys() == exact.keys()
        assert all(abs(got[ad] - n) <= 3 * rollup.SKETCH_ERROR * n + 0.5 for ad, n in exact.items())
    sketches.unpersist()
