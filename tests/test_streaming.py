"""Streams: restarts, replays, copies, late and ill-dated events."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from adperf.operators import quality, windows
from adperf.plans import layers
from adperf.sources import schemas
from adperf.streaming import clicks

SCHEMA = f"Event_ID long, {schemas.RAW_CLICKS}, ingestion_date date"


def event(i, at="2024-01-01 10:00:00", day=1, user="u1", clicked=1, watch=5.0):
    return (i, user, at, "AD_000001", "video", watch, 30, "moble", "gogle", "Male", clicked, date(2024, 1, day))


def land(spark, path, *rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def ingest(spark, root, delay="3 days", files=None):
    rows = clicks.arriving(spark, f"{root}/in", spark.createDataFrame([], SCHEMA).schema, files)
    return clicks.ingest(clicks.conform(rows, ["Event_ID"], "ingestion_date", delay), f"{root}/out", f"{root}/check")


def ids(spark, root):
    return sorted(r.Event_ID for r in spark.read.parquet(f"{root}/out").collect())


def test_a_second_run_adds_only_what_is_new(spark, tmp_path):
    root = str(tmp_path)
    land(spark, f"{root}/in", event(1), event(2), event(2))
    assert ingest(spark, root).rows_in == 3
    assert ids(spark, root) == [1, 2]
    assert ingest(spark, root).rows_in == 0
    land(spark, f"{root}/in", event(2), event(3, day=2))
    ingest(spark, root)
    assert ids(spark, root) == [1, 2, 3]
    row = spark.read.parquet(f"{root}/out").filter("Event_ID = 3").first()
    assert (row.Ad_Type_Standard, row.device_cleaned, row.platform_source_cleaned) == ("Video", "Mobile", "google")


def test_rows_beyond_the_delay_are_late_and_counted(spark, tmp_path):
    root = str(tmp_path)
    land(spark, f"{root}/in", event(1, day=1))
    ingest(spark, root)
    land(spark, f"{root}/in", event(2, day=20))
    ingest(spark, root)
    land(spark, f"{root}/in", event(1, day=1), event(3, day=2), event(4, day=19), event(2, day=20))
    assert ingest(spark, root).late_rows == 2
    assert ids(spark, root) == [1, 2, 4]


def test_stopping_in_the_middle_loses_and_repeats_nothing(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    raw = layers.bronze_clicks(spark, sf_dir).repartition(12)
    raw.write.parquet(f"{root}/in")
    def stream():
        return clicks.conform(clicks.arriving(spark, f"{root}/in", raw.schema, 1), ["Event_ID"], "ingestion_date", "60 days")
    query = (
        stream().writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/check")
        .partitionBy("ingestion_date").start()
    )
    while not query.lastProgress:
        query.awaitTermination(0.2)
    query.stop()
    outcome = clicks.ingest(stream(), f"{root}/out", f"{root}/check")
    assert 0 < outcome.batches < 14
    assert ids(spark, root) == sorted(r[0] for r in raw.select("Event_ID").distinct().collect())


def test_a_batch_that_runs_again_replaces_its_first_try(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    raw = layers.bronze_clicks(spark, sf_dir).repartition(6)
    raw.write.parquet(f"{root}/in")
    rules = [r for r in quality.CLICK_ANOMALIES if r.kind == "condition"]
    stream = clicks.arriving(spark, f"{root}/in", raw.schema, 2)
    tries = []

    def failing(batch, number):
        clicks.into_batches(lambda b: {"counts": quality.run_rules({"clicks": b}, rules).select(
            "table_name", "rule", F.col("observed").cast("long").alias("n"))}, f"{root}/out")(batch, number)
        tries.append(number)
        if number == 1 and tries.count(1) == 1:
            raise RuntimeError("lost after the write, before the commit")

    with pytest.raises(Exception, match="lost after the write"):
        clicks.run_available(stream.writeStream.foreachBatch(failing), f"{root}/check")
    clicks.run_available(stream.writeStream.foreachBatch(failing), f"{root}/check")
    assert sorted(tries) == [0, 1, 1, 2]
    want = {r.rule: r.observed for r in quality.run_rules({"clicks": raw}, rules).collect()}
    got = {r.anomaly_type: r["count"] for r in clicks.quality_totals(spark, f"{root}/out").collect()}
    assert got == want


def conformed(spark, *rows):
    data = [(i, u, datetime.fromisoformat(t) if t else None, c, date(2024, 1, 1)) for i, u, t, c in rows]
    return spark.createDataFrame(
        data, "Event_ID long, User_ID string, Click_Timestamp_Standard timestamp, user_clicked_cleaned int, ingestion_date date")


def test_events_from_the_future_do_not_move_the_watermark(spark, tmp_path):
    root = str(tmp_path)
    first = conformed(spark, (1, "a", "2024-01-01 10:05:00", 1), (2, "a", "2035-12-25 12:00:00", 1), (3, "a", None, 1))
    later = conformed(spark, (4, "b", "2024-01-01 10:59:59", 0), (5, "b", "2024-01-01 11:00:00", 1))
    for rows in (first, later):
        rows.coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = clicks.arriving(spark, f"{root}/in", first.schema).filter(clicks.on_time())
        clicks.window_updates(clicks.ctr_by_window(stream, "1 hour", delay="2 hours"), f"{root}/out", f"{root}/check")
    stored = spark.read.parquet(f"{root}/out/windows")
    assert stored.count() == 3  # the first hour twice, as it changed
    found = clicks.newest(stored, ["window_start", "window_end"]).orderBy("window_start").collect()
    assert [(r.window_start.hour, r.impressions, r.clicks, r.ctr) for r in found] == [(10, 2, 1, 0.5), (11, 1, 1, 1.0)]


def test_late_events_join_open_sessions_only(spark, tmp_path):
    root = str(tmp_path)
    files = [
        [(1, "a", "2024-01-01 10:00:00", 1), (2, "a", "2024-01-01 10:40:00", 0)],
        [(3, "a", "2024-01-01 10:20:00", 1), (4, "b", "2024-01-01 11:00:00", 1)],  # joins the two sessions of a
        [(5, "b", "2024-01-01 18:00:00", 0)],
        [(6, "a", "2024-01-01 10:50:00", 1)],  # the session is closed: late
    ]
    late = 0
    for rows in files:
        frame = conformed(spark, *rows)
        frame.coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = clicks.visits(clicks.arriving(spark, f"{root}/in", frame.schema), delay="1 hour")
        late += clicks.run_available(stream.writeStream.format("parquet").option("path", f"{root}/out"), f"{root}/check").late_rows
    found = sorted((r.User_ID, r.first_event.hour, r.last_event.minute, r.events, r.clicks) for r in spark.read.parquet(f"{root}/out").collect())
    assert found == [("a", 10, 40, 3, 2), ("b", 11, 0, 1, 1)]
    assert late == 1


def test_sessions_equal_those_by_rows(spark, sf_dir):
    rows = layers.silver_clicks(spark, sf_dir).filter(clicks.on_time())
    by_row = windows.sessionize(rows, "User_ID", "Click_Timestamp_Standard", ["Event_ID"])
    want = by_row.groupBy("User_ID", "session_id").agg(F.count("*").alias("events")).select("User_ID", "events")
    got = clicks.visits(rows).select("User_ID", "events")
    assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()


def test_landing_of_no_rows(spark, tmp_path):
    for step in clicks.land(spark.createDataFrame([], SCHEMA), f"{tmp_path}/in", "ingestion_date", 2):
        step()
    assert ingest(spark, str(tmp_path)).rows_in == 0


def test_a_batch_writes_few_files_for_a_day(spark, tmp_path):
    root, before = str(tmp_path), spark.conf.get("spark.sql.shuffle.partitions")
    land(spark, f"{root}/in", *[event(i, day=1 + i % 2) for i in range(200)])
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        ingest(spark, root)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert ids(spark, root) == list(range(200))
    assert len(spark.read.parquet(f"{root}/out").inputFiles()) <= 8
