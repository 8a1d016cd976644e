"""Sources, sinks, audit, run log, export, reconciliation."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from adperf.sources import io, schemas, staging

RUN = io.Run("b1", "2024-02-15 06:00:00", "test", "abc", "v1")


@pytest.fixture
def schema(spark):
    io.create_schema(spark, "adperf_test")
    yield "adperf_test"
    for row in io.list_tables(spark, "adperf_test").collect():
        io.drop_table(spark, f"adperf_test.{row['tableName']}")
    spark.sql("DROP SCHEMA adperf_test")


def test_csv_with_quotes_line_breaks_and_bad_rows(spark, tmp_path):
    header = ",".join(c.strip().split(" ")[0] for c in schemas.RAW_CATALOG.split(","))
    lines = [header, 'A1,"Food ""fresh""",Mobile,"two\nlines",$1.20,Video,45s', "A2,Food,Mobile,Delhi,x,Text,0"]
    path = tmp_path / "catalog.csv"
    path.write_text("\n".join(lines) + "\n")
    rows = io.read_csv(spark, str(path), schemas.RAW_CATALOG).orderBy("Ad_Reference_ID").collect()
    assert rows[0]["Ad_Category"] == 'Food "fresh"' and rows[0]["Ad_Location"] == "two\nlines"
    assert rows[1]["Cost_Per_Click"] == "x" and rows[1]["_corrupt_record"] is None


def test_csv_keeps_rows_of_the_wrong_type(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,x\nbad,y\n")
    rows = io.read_csv(spark, str(path), "a int, b string").cache().orderBy("b").collect()
    assert [r["a"] for r in rows] == [1, None]
    assert rows[1]["_corrupt_record"] == "bad,y"


def test_first_available(spark, tmp_path):
    good = str(tmp_path / "good")
    spark.range(2).write.parquet(good)
    read = io.first_available(
        lambda: spark.read.parquet(str(tmp_path / "absent")),
        lambda: spark.range(0),
        lambda: io.read_table(spark, "no_such_table"),
        lambda: spark.read.parquet(good),
    )
    assert read.count() == 2
    with pytest.raises(io.MissingInput):
        io.first_available(lambda: spark.range(0))


def test_partitioned_overwrite_evolve_and_replace(spark, schema):
    name = f"{schema}.t"
    io.write_table(spark.sql("SELECT 1 AS a, 'x' AS p"), name, partition_by=["p"])
    io.write_table(spark.sql("SELECT 2 AS a, 3 AS b, 'y' AS p"), name, partition_by=["p"], evolve=True)
    assert set(spark.table(name).columns) == {"a", "b", "p"} and spark.table(name).count() == 1
    io.write_table(spark.sql("SELECT 'z' AS only"), name)
    assert spark.table(name).columns == ["only"]
    assert io.describe_table(spark, name).count() >= 1


def test_bucketed_tables_join_without_shuffle(spark, schema, sf_dir):
    from adperf.operators import features
    from adperf.plans import layers

    for table, df in (("clicks", layers.silver_clicks(spark, sf_dir)), ("ads", layers.silver_catalog(spark, sf_dir))):
        io.write_table(df, f"{schema}.{table}", bucket_by=(4, "Ad_Reference_ID"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = features.join_catalog(spark.table(f"{schema}.clicks"), spark.table(f"{schema}.ads"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == layers.enriched(spark, sf_dir).count()


def test_run_log_latest_and_summary(spark, schema):
    log = f"{schema}.batch_log"
    for i, ts in enumerate(["2024-01-01 00:00:00", "2024-01-02 00:00:00"]):
        from datetime import datetime

        io.log_run(
            spark, log, batch_id=f"b{i}", layer="bronze", table_name="clicks", rows_written=10 + i,
            finished_at=datetime.fromisoformat(ts), status="SUCCESS",
        )
    assert io.latest_run(spark.table(log)).select("batch_id").first()[0] == "b1"
    assert io.batch_summary(spark.table(log)).count() == 2
    history = f"{schema}.version_history"
    io.log_version(spark, history, version_id="v1", description="Gold run", status="SUCCESS")
    io.log_version(spark, history, version_id="v2", description="Gold run", status="FAILED")
    row = io.run_summary(spark.table(history)).first()
    assert (row["total"], row["success"], row["failed"]) == (2, 1, 1)


def test_audit_columns(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(3).coalesce(1).write.parquet(path)
    audited = io.with_ingestion_audit(spark.read.parquet(path), RUN)
    row = audited.first()
    assert row["source_file"].endswith(".parquet") and str(row["ingestion_date"]) == "2024-02-15"
    assert io.with_ingestion_audit(spark.range(1), RUN, "given.csv").first()["source_file"] == "given.csv"
    assert io.with_processing_audit(spark.range(1), RUN).first()["processing_status"] == "CLEANED"


def test_export_read_back_and_reconcile(spark, sf_dir, tmp_path):
    source = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("month", F.lit(99))
    path = str(tmp_path / "export")
    io.export_partitioned(source, path, "o_orderdate", RUN)
    back = spark.read.parquet(path)
    assert {"export_year", "export_month", "export_day"} <= set(back.columns)
    assert back.filter("month <> 99").count() == 0
    assert io.reconcile(source, back, io.EXPORT_COLUMNS).first()["status"] == "MATCH"
    assert io.reconcile(source, back).first()["status"] == "MISMATCH"
    lost = io.reconcile(source, back.drop("o_orderpriority"), io.EXPORT_COLUMNS).first()
    assert (lost["status"], lost["lost_columns"]) == ("MISMATCH", "o_orderpriority")
    assert io.reconcile(source, back.filter("o_orderkey > 10"), io.EXPORT_COLUMNS).first()["status"] == "MISMATCH"
    files = io.file_report(spark, path)
    assert files.agg(F.sum("row_count")).first()[0] == source.count()


def test_text_exports(spark, tmp_path):
    df = spark.range(4).withColumn("name", F.lit("a,b"))
    io.write_csv_backup(df, str(tmp_path / "backup"))
    assert len(list((tmp_path / "backup").glob("*.csv"))) == 1
    tricky = df.withColumn("name", F.lit('a,"b"'))
    for fmt, reader in (
        ("csv", lambda p: io.read_csv(spark, p, "id long, name string")), ("json", spark.read.json),
    ):
        io.export_text(tricky, str(tmp_path / fmt), fmt)
        assert reader(str(tmp_path / fmt)).filter("name = 'a,\"b\"'").count() == 4
    with pytest.raises(ValueError):
        io.export_text(df, str(tmp_path / "x"), "xml")


def test_union_of_differing_columns(spark):
    got = io.union_all(spark.sql("SELECT 1 AS a"), spark.sql("SELECT 2 AS a, 'x' AS b"))
    assert sorted((r["a"], r["b"]) for r in got.collect() if r["b"]) == [(2, "x")] and got.count() == 2


def test_guards(spark):
    with pytest.raises(io.MissingInput):
        io.require_rows(spark.range(0))
    with pytest.raises(io.MissingInput):
        io.require_table(spark, "nope")
    assert io.require_rows(spark.range(1)).count() == 1


def test_temp_view(spark):
    spark.range(2).createOrReplaceTempView("summary_view")
    assert spark.sql("SELECT * FROM summary_view").count() == 2


def test_staged_frame_is_a_stored_table(spark):
    staged = staging.stage(spark.range(5).withColumn("x", F.rand()))
    assert staged.collect() == staged.collect()
    assert "Scan parquet" in staged._jdf.queryExecution().executedPlan().toString()
