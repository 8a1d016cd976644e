"""Queries: streams over the click log, event-time windows, and the cube of a report."""

from __future__ import annotations

from pyspark.sql import functions as F

from adperf.operators import quality, reports
from adperf.plans import layers, oracle
from adperf.plans.q_quality import CLICK_CONDITIONS_SQL
from adperf.plans.registry import query
from adperf.streaming import clicks

ID = "Event_ID"


def _folder(spark, name):
    return f"{layers.staging_root(spark)}/{name}_{layers.run_id()}"


def _ingested(spark, d, slices=4, runs=2, again=None):
    """Path of the conformed rows after the raw log has arrived in slices, over several runs of the stream."""
    raw, root = layers.bronze_clicks(spark, d), _folder(spark, "stream")
    steps = clicks.land(raw, f"{root}/landing", "ingestion_date", slices)
    if again is not None:
        steps.insert(again + 1, steps[again])
    for i, step in enumerate(steps):
        step()
        if i + 1 == len(steps) or i % -(-len(steps) // runs) == 0:
            arriving = clicks.arriving(spark, f"{root}/landing", raw.schema, files_per_batch=8)
            clicks.ingest(clicks.conform(arriving, [ID], "ingestion_date", "40 days"), f"{root}/conformed", f"{root}/ingest")
    return f"{root}/conformed"


# ---- ingestion ----------------------------------------------------------------------------

# The rules over the log without its copies, which the stream never lets in.
_UNIQUE = f"""WITH uniq AS (SELECT DISTINCT * FROM clicks),
cols AS ({oracle.CTES['click_cols'].replace('FROM clicks', 'FROM uniq')})"""
_PICK = f"pick AS ({oracle.CTES['gender_pick'].replace('FROM clicks', 'FROM uniq')})"
_SETTLED = oracle.CTES["silver_clicks"].replace("click_cols c", "cols c").replace("gender_pick", "pick")
_INGESTED_SQL = f"""{_UNIQUE}, {_PICK}, settled AS ({_SETTLED})
SELECT Event_ID, User_ID, strftime(Click_Timestamp_Standard, '%Y-%m-%d %H:%M:%S') AS Click_Timestamp_Standard,
  Ad_Reference_ID, Ad_Type_Standard, round(Watch_Duration_Cleaned, 6) AS Watch_Duration_Cleaned,
  CAST(user_age_cleaned AS BIGINT) AS user_age_cleaned, device_cleaned, platform_source_cleaned, user_gender_fixed,
  CAST(user_clicked_cleaned AS BIGINT) AS user_clicked_cleaned, strftime(ingestion_date, '%Y-%m-%d') AS ingestion_date
FROM settled"""
_COLUMNS = [
    ID, "User_ID", "Click_Timestamp_Standard", "Ad_Reference_ID", "Ad_Type_Standard", "Watch_Duration_Cleaned",
    "user_age_cleaned", "device_cleaned", "platform_source_cleaned", "user_gender_fixed", "user_clicked_cleaned",
    "ingestion_date",
]


@query("x1_stream_ingest", _INGESTED_SQL)
def _(spark, d):
    """The cleaning rules over a stream of the raw log, run twice as it arrives."""
    return clicks.settle(spark.read.parquet(_ingested(spark, d)), [ID]).select(*_COLUMNS)


@query("x1_stream_redelivery", _INGESTED_SQL)
def _(spark, d):
    """The same with a slice delivered twice and the stream started again between."""
    return clicks.settle(spark.read.parquet(_ingested(spark, d, runs=5, again=1)), [ID]).select(*_COLUMNS)


# ---- windows ------------------------------------------------------------------------------

_TIMELY = "Click_Timestamp_Standard < ingestion_date + INTERVAL 1 DAY"


def _windows_sql(source: str, start: str, width: str, by: str, extra: str = "") -> str:
    return f"""SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(s + INTERVAL {width}, '%Y-%m-%d %H:%M:%S') AS window_end,
  {by}, count(*) AS impressions, CAST(sum(user_clicked_cleaned) AS BIGINT) AS clicks,
  round(sum(user_clicked_cleaned) / count(*), 6) AS ctr
FROM (SELECT *, {start} AS s FROM {source}{extra} WHERE {_TIMELY}) GROUP BY s, {by}"""


def _timely(spark, d):
    return layers.silver_clicks(spark, d).filter(clicks.on_time())


_TUMBLING = ("date_trunc('hour', Click_Timestamp_Standard)", "1 HOUR", "device_cleaned")


@query("x2_ctr_tumbling", _windows_sql("silver_clicks", *_TUMBLING))
def _(spark, d):
    """Click rate by hour and device."""
    return clicks.ctr_by_window(_timely(spark, d), "1 hour", by=["device_cleaned"])


@query(
    "x2_ctr_sliding",
    _windows_sql(
        "silver_clicks", "time_bucket(INTERVAL 6 HOURS, Click_Timestamp_Standard) - k * INTERVAL 6 HOURS", "1 DAY",
        "platform_source_cleaned", ", (SELECT unnest(range(4)) AS k)"),
)
def _(spark, d):
    """Click rate of a day by platform, every six hours."""
    return clicks.ctr_by_window(_timely(spark, d), "1 day", "6 hours", ["platform_source_cleaned"])


_CLICKED = "CASE WHEN user_clicked = 1 AND Watch_Duration_Cleaned = 0 THEN 0 ELSE user_clicked END AS user_clicked_cleaned"
_STREAMED = f"{_UNIQUE}, rows_once AS (SELECT *, {_CLICKED} FROM cols)"


@query("x2_ctr_stream", f"{_STREAMED} {_windows_sql('rows_once', *_TUMBLING)}")
def _(spark, d):
    """Click rate by hour and device, kept up to date by a stream over the conformed rows."""
    path, root = _ingested(spark, d), _folder(spark, "windows")
    schema = spark.read.parquet(path).schema
    for files in (40, None):  # a first run, and one that goes on
        rows = clicks.arriving(spark, path, schema, files).filter(clicks.on_time())
        counted = clicks.ctr_by_window(rows, "1 hour", by=["device_cleaned"], delay="60 days")
        clicks.window_updates(counted, f"{root}/out", f"{root}/checkpoint")
    stored = spark.read.parquet(f"{root}/out/windows")
    return clicks.newest(stored, ["window_start", "window_end", "device_cleaned"])


def _visits_sql(source: str, closed: str = "") -> str:
    return f"""SELECT User_ID, strftime(min(t), '%Y-%m-%d %H:%M:%S') AS first_event, strftime(max(t), '%Y-%m-%d %H:%M:%S') AS last_event,
  count(*) AS events, CAST(sum(user_clicked_cleaned) AS BIGINT) AS clicks
FROM (
  SELECT *, sum(CASE WHEN gap > 1800 THEN 1 ELSE 0 END) OVER (PARTITION BY User_ID ORDER BY t, Event_ID) AS session_id
  FROM (
    SELECT *, Click_Timestamp_Standard AS t, epoch(Click_Timestamp_Standard)
      - epoch(lag(Click_Timestamp_Standard) OVER (PARTITION BY User_ID ORDER BY Click_Timestamp_Standard, Event_ID)) AS gap
    FROM {source} WHERE {_TIMELY}))
GROUP BY User_ID, session_id {closed}"""


@query("x2_visits", _visits_sql("silver_clicks"))
def _(spark, d):
    """Sessions by 30 minutes of inactivity as session windows."""
    return clicks.visits(_timely(spark, d))


@query(
    "x2_visits_stream",
    f"""{_STREAMED} {_visits_sql('rows_once', f'''HAVING max(t) + INTERVAL 30 MINUTES <= (
      SELECT max(Click_Timestamp_Standard) FROM rows_once WHERE {_TIMELY}) - INTERVAL 1 DAY''')}""",
)
def _(spark, d):
    """Sessions that the watermark has closed, a day behind the newest event."""
    path, root = _ingested(spark, d), _folder(spark, "visits")
    rows = clicks.arriving(spark, path, spark.read.parquet(path).schema).filter(clicks.on_time())
    found = clicks.visits(rows, delay="1 day")
    clicks.run_available(found.writeStream.format("parquet").option("path", f"{root}/out"), f"{root}/checkpoint")
    return spark.read.schema(found.schema).parquet(f"{root}/out")


# ---- counters -----------------------------------------------------------------------------


@query(
    "x3_stream_counters",
    f"""{CLICK_CONDITIONS_SQL} UNION ALL SELECT 'clicks', 'Gender - Identity Shifting',
    (SELECT count(*) FROM (SELECT User_ID FROM clicks GROUP BY 1 HAVING count(DISTINCT user_gender) > 1))""",
)
def _(spark, d):
    """Anomaly counters by micro-batch, summed; users with several genders from the batches' pairs."""
    raw, root = layers.bronze_clicks(spark, d), _folder(spark, "counters")
    for step in clicks.land(raw, f"{root}/landing", "ingestion_date", 4):
        step()
    arriving = clicks.arriving(spark, f"{root}/landing", raw.schema, files_per_batch=10)
    clicks.quality_batches(
        arriving, quality.CLICK_ANOMALIES, "clicks", f"{root}/out", f"{root}/checkpoint", {"genders": ["User_ID", "user_gender"]})
    pairs = spark.read.parquet(f"{root}/out/genders").drop("batch")
    shifting = quality.mixed_groups(pairs, "User_ID", "user_gender").agg(F.count(F.lit(1)).alias("count"))
    return clicks.quality_totals(spark, f"{root}/out").unionByName(
        shifting.select(F.lit("clicks").alias("table_name"), F.lit("Gender - Identity Shifting").alias("anomaly_type"), "count"))


# ---- cube ---------------------------------------------------------------------------------


@query(
    "x4_cube_report",
    """SELECT ad_category, ad_device, ad_type, grouping_id(ad_category, ad_device, ad_type) AS level, count(*) AS ads,
      CAST(sum(total_impressions) AS BIGINT) AS impressions, CAST(sum(total_clicks) AS BIGINT) AS clicks,
      round(sum(total_ad_spend), 6) AS spend, round(sum(total_revenue), 6) AS revenue,
      round(CASE WHEN sum(total_ad_spend) > 0 THEN sum(total_revenue) / sum(total_ad_spend) ELSE 0 END, 6) AS roas
    FROM gold GROUP BY CUBE (ad_category, ad_device, ad_type)""",
)
def _(spark, d):
    """Category x device x format with all totals."""
    return reports.cube(layers.gold(spark, d), ["ad_category", "ad_device", "ad_type"])


@query(
    "x4_cube_labels",
    """SELECT CASE WHEN grouping(device) = 1 THEN 'All' ELSE coalesce(device, 'Unknown') END AS device,
      CASE WHEN grouping(platform_source) = 1 THEN 'All' ELSE coalesce(platform_source, 'Unknown') END AS platform_source,
      grouping_id(device, platform_source) AS level, count(*) AS n, count(device) AS known
    FROM clicks GROUP BY CUBE (device, platform_source)""",
)
def _(spark, d):
    """Totals told from groups without a value, on the raw log."""
    rows = layers.bronze_clicks(spark, d)
    counts = {"n": F.count(F.lit(1)), "known": F.count("device")}
    dims = ["device", "platform_source"]
    return reports.labelled(reports.cube(rows, dims, counts), dims)
