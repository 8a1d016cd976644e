"""Queries: joins, windows, aggregates, sorts, sets and feature columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from adperf.functions import expr, fixed
from adperf.operators import cleanse, features, rollup, tables, windows
from adperf.plans import layers
from adperf.plans.registry import query
from adperf.sources.adapters import impressions, table

AD = "Ad_Reference_ID"
ID = "Event_ID"

# ---- joins ------------------------------------------------------------------------------


@query(
    "j1_click_catalog_join",
    """SELECT Event_ID, Ad_Reference_ID, Ad_Category_Standard, Ad_Type_Standard, Ad_Type_Catalog,
      round(Cost_Per_Click_Cleaned, 6) AS Cost_Per_Click_Cleaned FROM joined""",
)
def _(spark, d):
    """Impressions of known ads with the ad's attributes."""
    joined = features.join_catalog(layers.silver_clicks(spark, d), layers.silver_catalog(spark, d))
    return joined.select(
        ID, AD, "Ad_Category_Standard", "Ad_Type_Standard", "Ad_Type_Catalog",
        "Cost_Per_Click_Cleaned",
    )


_INTEGRITY_SQL = """
SELECT count(*) FILTER (WHERE known) AS matched_keys, count(*) FILTER (WHERE NOT known) AS unmatched_keys,
  CAST(sum(n) FILTER (WHERE NOT known) AS BIGINT) AS unmatched_rows,
  round(count(*) FILTER (WHERE known) * 100.0 / count(*), 6) AS match_pct
FROM (SELECT Ad_Reference_ID, count(*) AS n,
        Ad_Reference_ID IN (SELECT Ad_Reference_ID FROM catalog) AS known
      FROM clicks GROUP BY Ad_Reference_ID)"""


@query("j2_key_integrity", _INTEGRITY_SQL)
def _(spark, d):
    """Matched and unmatched distinct keys, unmatched rows, match percentage."""
    from adperf.operators import quality

    return quality.integrity(layers.bronze_clicks(spark, d), layers.bronze_catalog(spark, d), AD)


@query(
    "j3_orphan_rows",
    "SELECT Event_ID, Ad_Reference_ID FROM clicks WHERE Ad_Reference_ID NOT IN (SELECT Ad_Reference_ID FROM catalog)",
)
def _(spark, d):
    """Rows whose ad is not in the catalog."""
    return (
        layers.bronze_clicks(spark, d)
        .join(layers.bronze_catalog(spark, d), AD, "left_anti")
        .select(ID, AD)
    )


@query(
    "j4_two_aggregates_joined",
    """SELECT a.ad_type, round(a.spend, 6) AS spend, round(b.winning_spend, 6) AS winning_spend
    FROM (SELECT ad_type, sum(total_ad_spend) AS spend FROM gold GROUP BY ad_type) a
    LEFT JOIN (SELECT ad_type, sum(total_ad_spend) AS winning_spend FROM gold WHERE roas > 0 GROUP BY ad_type) b
      ON a.ad_type = b.ad_type""",
)
def _(spark, d):
    """Two aggregates of one frame under different filters, in one grouping."""
    winning = F.when(F.col("roas") > 0, F.col("total_ad_spend"))
    return layers.gold(spark, d).groupBy("ad_type").agg(
        F.sum("total_ad_spend").alias("spend"), F.sum(winning).alias("winning_spend")
    )


# ---- windows ----------------------------------------------------------------------------


@query(
    "w1_user_totals",
    """SELECT Event_ID, CAST(sum(user_clicked_cleaned) OVER u AS BIGINT) AS user_total_clicks,
      count(User_ID) OVER u AS user_total_impressions,
      round(sum(user_clicked_cleaned) OVER u / count(User_ID) OVER u, 6) AS user_ctr
    FROM enriched WINDOW u AS (PARTITION BY User_ID)""",
)
def _(spark, d):
    """Clicks, impressions and click rate of the row's user."""
    rows = layers.enriched(spark, d).select(ID, "User_ID", features.CLICKED)
    return features.add_user_totals(rows).drop("User_ID", features.CLICKED)


@query(
    "w1_user_totals_volume",
    """SELECT User_ID, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
      CAST(sum(user_clicked_cleaned) OVER u AS BIGINT) AS user_total_clicks,
      count(User_ID) OVER u AS user_total_impressions,
      round(sum(user_clicked_cleaned) OVER u / count(User_ID) OVER u, 6) AS user_ctr
    FROM impressions WINDOW u AS (PARTITION BY User_ID)""",
)
def _(spark, d):
    """User totals on every row of the large impression log."""
    rows = impressions(spark, d).select(
        "User_ID", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", features.CLICKED
    )
    return features.add_user_totals(rows).drop(features.CLICKED)


@query(
    "w2_ad_totals",
    """SELECT Event_ID, CAST(sum(user_clicked_cleaned) OVER a AS BIGINT) AS ad_total_clicks,
      count(Ad_Reference_ID) OVER a AS ad_total_impressions,
      round(avg(Watch_Duration_Cleaned) OVER a, 6) AS ad_avg_watch_duration,
      round(sum(user_clicked_cleaned) OVER a / count(Ad_Reference_ID) OVER a, 6) AS ad_ctr
    FROM enriched WINDOW a AS (PARTITION BY Ad_Reference_ID)""",
)
def _(spark, d):
    """Clicks, impressions, click rate and watch time of the row's ad."""
    rows = layers.enriched(spark, d).select(ID, AD, features.CLICKED, "Watch_Duration_Cleaned")
    return features.add_ad_totals(rows).drop(AD, features.CLICKED, "Watch_Duration_Cleaned")


@query(
    "w3_age_category_rate",
    """SELECT Event_ID, age_category, round(category_performance_by_age, 6) AS category_performance_by_age,
      round(demographic_engagement_delta, 6) AS demographic_engagement_delta FROM scored""",
)
def _(spark, d):
    """Click rate of the age band in the category, and its stepped score."""
    rows = layers.enriched(spark, d).select(
        ID, "age_category", "Ad_Category_Standard", features.CLICKED
    )
    return features.add_demographic_fit(rows).drop("Ad_Category_Standard", features.CLICKED)


@query(
    "w4_platform_totals",
    """SELECT Event_ID, round(platform_avg_roas, 6) AS platform_avg_roas,
      round(platform_total_spend, 6) AS platform_total_spend,
      round(platform_total_revenue, 6) AS platform_total_revenue FROM scored""",
)
def _(spark, d):
    """Return, spend and revenue of the row's platform."""
    rows = layers.enriched(spark, d).select(
        ID, "platform_source_cleaned", "return_on_ad_spend", "total_cost", "total_revenue"
    )
    return features.add_platform_totals(rows).select(
        ID, "platform_avg_roas", "platform_total_spend", "platform_total_revenue"
    )


_GAPS = """SELECT Event_ID, User_ID, Click_Timestamp_Standard AS ts,
  CAST(epoch(Click_Timestamp_Standard) - epoch(lag(Click_Timestamp_Standard) OVER (
    PARTITION BY User_ID ORDER BY Click_Timestamp_Standard NULLS FIRST, Event_ID)) AS DOUBLE) AS gap
  FROM silver_clicks"""


def _sessions(spark, d, **options):
    rows = layers.silver_clicks(spark, d).select(ID, "User_ID", "Click_Timestamp_Standard")
    found = windows.sessionize(rows, "User_ID", "Click_Timestamp_Standard", [ID], **options)
    return found.withColumn(
        "time_since_last_action", F.col("time_since_last_action").cast("double")
    ).drop("Click_Timestamp_Standard")


@query("w5_gap_to_previous", f"SELECT Event_ID, User_ID, gap AS time_since_last_action FROM ({_GAPS})")
def _(spark, d):
    """Seconds since the user's previous event."""
    return _sessions(spark, d).drop("session_id")


_SESSIONS_SQL = f"""SELECT Event_ID, User_ID, gap AS time_since_last_action,
  CAST(sum(CASE WHEN gap > 1800 THEN 1 ELSE 0 END) OVER (
    PARTITION BY User_ID ORDER BY ts NULLS FIRST, Event_ID
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_id
  FROM ({_GAPS})"""


@query("w6_sessionize", _SESSIONS_SQL)
def _(spark, d):
    """Sessions by 30 minutes of inactivity."""
    return _sessions(spark, d)


@query("w6_sessionize_hot_users", _SESSIONS_SQL)
def _(spark, d):
    """The same sessions by the path for hot users: time chunks and carried counts."""
    return _sessions(spark, d, share=0.005, min_rows=0)


_IMPRESSION_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "w6_sessionize_volume",
    """SELECT User_ID, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
      CAST(sum(CASE WHEN gap > 86400 * 7 THEN 1 ELSE 0 END) OVER (PARTITION BY User_ID
        ORDER BY ts, l_orderkey, l_linenumber, l_partkey, l_suppkey
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_id
    FROM (SELECT *, Click_Timestamp_Standard AS ts, epoch(Click_Timestamp_Standard) - epoch(lag(Click_Timestamp_Standard) OVER (
        PARTITION BY User_ID ORDER BY Click_Timestamp_Standard, l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS gap
      FROM impressions)""",
)
def _(spark, d):
    """Visits of the large impression log, ended by a week without an impression."""
    rows = impressions(spark, d).select(
        "User_ID", *_IMPRESSION_KEY, F.col("Click_Timestamp_Standard").cast("timestamp").alias("ts")
    )
    found = windows.sessionize(rows, "User_ID", "ts", _IMPRESSION_KEY, gap_seconds=7 * 86_400)
    return found.select("User_ID", *_IMPRESSION_KEY, "session_id")


@query(
    "w7_latest_per_key",
    """SELECT o_custkey, o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""",
)
def _(spark, d):
    """Newest order of each customer."""
    orders = table(spark, d, "orders")
    newest = [F.desc("o_orderdate"), F.asc("o_orderkey")]
    return windows.latest_per_key(orders, ["o_custkey"], newest).select(
        "o_custkey", "o_orderkey", "o_totalprice"
    )


@query(
    "w8_fill_from_group",
    """SELECT c.Event_ID, c.User_ID, coalesce(c.user_gender, g.typical, 'none') AS user_gender
    FROM clicks c LEFT JOIN gender_pick g ON c.User_ID = g.User_ID""",
)
def _(spark, d):
    """Nulls from the group's most frequent value; hot-group path."""
    rows = layers.bronze_clicks(spark, d).select(ID, "User_ID", "user_gender")
    return windows.fill_from_group(
        rows, "User_ID", "user_gender", "none", share=0.01, min_rows=0
    )


@query(
    "w9_non_null_count",
    "SELECT Event_ID, count(user_gender) OVER (PARTITION BY User_ID) AS known_genders FROM clicks",
)
def _(spark, d):
    """Non-null values of the row's group."""
    rows = layers.bronze_clicks(spark, d).select(ID, "User_ID", "user_gender")
    stats = {"known_genders": F.count("user_gender")}
    return windows.group_stats_onto_rows(rows, ["User_ID"], stats).select(ID, "known_genders")


@query(
    "w10_share_of_group",
    """SELECT l_returnflag, l_linestatus, n, round(n / sum(n) OVER (PARTITION BY l_returnflag), 6) AS share
    FROM (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL)""",
)
def _(spark, d):
    """Share of a group total."""
    counted = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n")
    )
    return windows.share_of_group(counted, ["l_returnflag"], "n", "share")


@query(
    "w11_best_worst_label",
    """WITH g AS (SELECT ad_type, avg(roas) AS roas FROM gold GROUP BY ad_type)
    SELECT ad_type, round(roas, 6) AS roas,
      CASE WHEN ad_type = (SELECT ad_type FROM g ORDER BY roas DESC, ad_type LIMIT 1) THEN 'best'
        WHEN ad_type = (SELECT ad_type FROM g ORDER BY roas ASC, ad_type DESC LIMIT 1) THEN 'worst'
        ELSE 'middle' END AS label FROM g""",
)
def _(spark, d):
    """Best and worst group by a metric."""
    by_type = layers.gold(spark, d).groupBy("ad_type").agg(F.avg("roas").alias("roas"))
    return tables.label_extremes(by_type, "ad_type", "roas")


# ---- aggregates -------------------------------------------------------------------------


@query("a1_row_count", "SELECT count(*) AS n FROM clicks")
def _(spark, d):
    """Rows of a table."""
    return layers.bronze_clicks(spark, d).agg(F.count(F.lit(1)).alias("n"))


@query(
    "a2_conditional_counts",
    """SELECT count(*) FILTER (WHERE Click_Timestamp_Standard IS NULL) AS null_ts,
      count(*) FILTER (WHERE user_age_cleaned < 18) AS underage,
      count(*) FILTER (WHERE Watch_Duration_Cleaned < 0) AS negative_watch,
      count(*) FILTER (WHERE device_cleaned = 'Unknown') AS unknown_device FROM silver_clicks""",
)
def _(spark, d):
    """Several conditional counts in one pass."""
    return tables.conditional_counts(
        layers.silver_clicks(spark, d),
        {
            "null_ts": "Click_Timestamp_Standard IS NULL",
            "underage": "user_age_cleaned < 18",
            "negative_watch": "Watch_Duration_Cleaned < 0",
            "unknown_device": "device_cleaned = 'Unknown'",
        },
    )


@query(
    "a4_repeated_keys",
    "SELECT Ad_Reference_ID, count(*) AS n FROM catalog GROUP BY 1 HAVING count(*) > 1",
)
def _(spark, d):
    """Keys that occur more than once."""
    return tables.repeated_keys(layers.bronze_catalog(spark, d), [AD])


@query(
    "a5_distinct_set_per_group",
    """SELECT User_ID, count(DISTINCT user_gender) AS n_values,
      string_agg(DISTINCT user_gender, ',' ORDER BY user_gender) AS value_set FROM clicks
    WHERE user_gender IS NOT NULL GROUP BY User_ID""",
)
def _(spark, d):
    """Distinct values per group, counted and listed."""
    pairs = layers.bronze_clicks(spark, d).select("User_ID", "user_gender").dropna().distinct()
    return pairs.groupBy("User_ID").agg(
        F.count("user_gender").alias("n_values"),
        F.sort_array(F.collect_list("user_gender")).alias("value_set"),
    )


_GOLD_COLUMNS_SQL = """
SELECT Ad_Reference_ID, ad_category, ad_device, ad_location, ad_type, ad_type_catalog,
  round(cost_per_click, 6) AS cost_per_click, round(ad_video_length, 6) AS ad_video_length,
  total_clicks, total_impressions, round(ctr, 6) AS ctr,
  round(avg_watch_duration, 6) AS avg_watch_duration, round(total_ad_spend, 6) AS total_ad_spend,
  round(total_revenue, 6) AS total_revenue, round(roas, 6) AS roas, total_conversions,
  round(conversion_rate, 6) AS conversion_rate,
  round(overall_conversion_rate, 6) AS overall_conversion_rate,
  round(avg_user_age, 6) AS avg_user_age, unique_users, round(avg_watch_ratio, 6) AS avg_watch_ratio,
  round(avg_ded_score, 6) AS avg_ded_score, round(category_age_affinity, 6) AS category_age_affinity,
  array_to_string(platforms_used, ',') AS platforms_used,
  array_to_string(devices_used, ',') AS devices_used,
  array_to_string(active_time_slots, ',') AS active_time_slots,
  round(platform_avg_roas, 6) AS platform_avg_roas, round(platform_total_spend, 6) AS platform_total_spend,
  round(platform_total_revenue, 6) AS platform_total_revenue, best_day, round(avg_hour, 6) AS avg_hour, month,
  strftime(ingestion_date, '%Y-%m-%d') AS ingestion_date,
  round(engagement_efficiency, 6) AS engagement_efficiency, round(profit_margin, 6) AS profit_margin,
  round(cost_per_conversion, 6) AS cost_per_conversion, CAST(high_performance AS BIGINT) AS high_performance,
  round(cost_efficiency_score, 6) AS cost_efficiency_score, round(engagement_score, 6) AS engagement_score,
  round(audience_alignment_score, 6) AS audience_alignment_score, CAST(ad_age_days AS BIGINT) AS ad_age_days,
  ad_lifecycle_stage, location_type, season, strftime(processing_date, '%Y-%m-%d') AS processing_date
FROM gold"""


@query("a6_ad_rollup", _GOLD_COLUMNS_SQL)
def _(spark, d):
    """The gold table: impressions to one row per ad, all columns."""
    return layers.build_gold(spark, d)


@query(
    "a6_recorded_revenue",
    """WITH r AS (
      SELECT j.*, e.value AS order_value, j.user_clicked_cleaned AS converted
      FROM joined j JOIN events e ON j.Event_ID = e.event_id)
    SELECT Ad_Reference_ID, round(coalesce(sum(order_value * converted), 0), 6) AS total_revenue,
      CAST(sum(converted) AS BIGINT) AS total_conversions, count(DISTINCT User_ID) AS unique_users,
      round(sum(Cost_Per_Click_Cleaned * user_clicked_cleaned), 6) AS total_ad_spend
    FROM r GROUP BY Ad_Reference_ID""",
)
def _(spark, d):
    """The gold table of a log that records conversions and their value."""
    values = table(spark, d, "events").select(F.col("event_id").alias("Event_ID"), F.col("value").alias("order_value"))
    clicks = layers.silver_clicks(spark, d).join(values, "Event_ID").withColumn("is_converted", F.col("user_clicked_cleaned"))
    gold = rollup.ad_performance(clicks, layers.silver_catalog(spark, d), layers.AS_OF)
    return gold.select("Ad_Reference_ID", "total_revenue", "total_conversions", "unique_users", "total_ad_spend")


@query(
    "a6_volume_rollup",
    """SELECT Ad_Reference_ID, CAST(sum(user_clicked_cleaned) AS BIGINT) AS total_clicks,
      count(User_ID) AS total_impressions, round(sum(user_clicked_cleaned) / count(User_ID), 6) AS ctr,
      round(avg(Watch_Duration_Cleaned), 6) AS avg_watch_duration,
      round(sum(Cost_Per_Click_Cleaned * user_clicked_cleaned), 6) AS total_ad_spend,
      round(sum(order_value * is_converted), 6) AS total_revenue,
      CAST(sum(is_converted) AS BIGINT) AS total_conversions,
      count(DISTINCT User_ID) AS unique_users,
      string_agg(DISTINCT platform_source_cleaned, ',' ORDER BY platform_source_cleaned) AS platforms_used
    FROM impressions GROUP BY Ad_Reference_ID""",
)
def _(spark, d):
    """Ad roll-up of the large impression log."""
    return rollup.impression_totals(impressions(spark, d))


_YEAR = ("1995-01-01", "1995-12-31")


def _sketches(spark, d):
    return layers.layer(spark, d, "user_sketches", lambda: rollup.user_sketches(impressions(spark, d), "Click_Timestamp_Standard"))


@query(
    "a6d_users_from_sketches",
    f"""SELECT Ad_Reference_ID, count(DISTINCT User_ID) AS unique_users FROM impressions
    WHERE CAST(Click_Timestamp_Standard AS DATE) BETWEEN DATE '{_YEAR[0]}' AND DATE '{_YEAR[1]}' GROUP BY 1""",
)
def _(spark, d):
    """Distinct users of each ad in a year, from stored sketches by day; so few are exact."""
    return rollup.users_between(_sketches(spark, d), *_YEAR)


@query(
    "a6d_sketch_error",
    """SELECT CAST(year(Click_Timestamp_Standard) AS BIGINT) AS year, count(DISTINCT User_ID) AS exact_users, true AS within_three_errors
    FROM impressions GROUP BY 1""",
)
def _(spark, d):
    """Distinct users of all ads by year against the exact count."""
    year = F.year("Click_Timestamp_Standard").alias("year")
    exact = impressions(spark, d).select(year, "User_ID").distinct().groupBy("year").agg(F.count("User_ID").alias("exact_users"))
    estimates = rollup.users_between(
        _sketches(spark, d).withColumn("year", F.year("day")), "1900-01-01", "2100-01-01", ("year",))
    apart = F.abs(F.col("unique_users") - F.col("exact_users")) <= 3 * rollup.SKETCH_ERROR * F.col("exact_users")
    return exact.join(estimates, "year").select("year", "exact_users", apart.alias("within_three_errors"))


@query(
    "a7_describe",
    """SELECT 'l_quantity' AS column_name, count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean,
      round(stddev(l_quantity), 6) AS stddev, min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem
    UNION ALL SELECT 'l_discount', count(l_discount), round(avg(l_discount), 6),
      round(stddev(l_discount), 6), min(l_discount), max(l_discount) FROM lineitem""",
)
def _(spark, d):
    """count, mean, stddev, min and max per column."""
    return tables.describe(table(spark, d, "lineitem"), ["l_quantity", "l_discount"])


@query(
    "a7_quartiles",
    " UNION ALL ".join(
        f"SELECT '{name}' AS quartile, round(quantile_cont(l_extendedprice, {q}), 6) AS value FROM lineitem"
        for name, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
    ),
)
def _(spark, d):
    """Exact quartiles of the largest table, from two scans."""
    positions = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    found = tables.quantiles(table(spark, d, "lineitem"), "l_extendedprice", positions)
    return found.unpivot([], list(positions), "quartile", "value")


@query(
    "a7_quartiles_by_group",
    """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 6) AS q25, round(quantile_cont(l_extendedprice, 0.5), 6) AS q50,
      round(quantile_cont(l_extendedprice, 0.75), 6) AS q75, round(quantile_cont(l_extendedprice, 0.999), 6) AS q999
    FROM lineitem GROUP BY 1""",
)
def _(spark, d):
    """Exact quartiles and a far quantile of groups, those of hot groups by broadcast brackets."""
    positions = {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q999": 0.999}
    return tables.quantiles(
        table(spark, d, "lineitem"), "l_extendedprice", positions, "l_returnflag", share=0.3, min_rows=0)


@query(
    "a8_frequency_top",
    """SELECT device_cleaned AS device, count(*) AS n FROM silver_clicks GROUP BY 1
    ORDER BY n DESC, device LIMIT 3""",
)
def _(spark, d):
    """Most frequent values."""
    return tables.frequency(layers.silver_clicks(spark, d), "device_cleaned", "device", 3)


@query(
    "a9_bucketed_distribution",
    """SELECT CASE WHEN engagement_score > 0.7 THEN 'High (>0.7)' WHEN engagement_score > 0.5
      THEN 'Medium (0.5-0.7)' ELSE 'Low (<0.5)' END AS band, count(*) AS n FROM gold GROUP BY 1""",
)
def _(spark, d):
    """Rows per score band."""
    band = expr.steps_above("engagement_score", fixed.ENGAGEMENT_BANDS, fixed.ENGAGEMENT_FLOOR)
    return tables.frequency(layers.gold(spark, d), band, "band")


_NULL_COLUMNS = [
    "Event_ID", "User_ID", "Click_Timestamp", "Ad_Reference_ID", "Ad_Type", "Watch_Duration", "user_age", "device",
    "platform_source", "user_gender", "user_clicked", "ingestion_date",
]


@query(
    "a10_null_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
        f"round((count(*) - count({c})) * 100.0 / count(*), 6) AS null_pct FROM clicks"
        for c in _NULL_COLUMNS
    ),
)
def _(spark, d):
    """Nulls per column, one pass."""
    return tables.null_profile(layers.bronze_clicks(spark, d))


@query(
    "a11_duplicate_rows",
    """SELECT (SELECT count(*) FROM clicks) AS total_rows, count(*) AS distinct_rows,
      (SELECT count(*) FROM clicks) - count(*) AS duplicate_rows,
      round(((SELECT count(*) FROM clicks) - count(*)) * 100.0 / (SELECT count(*) FROM clicks), 6) AS duplicate_pct
    FROM (SELECT DISTINCT * FROM clicks)""",
)
def _(spark, d):
    """Rows that repeat another row."""
    return tables.duplicate_profile(layers.bronze_clicks(spark, d))


@query(
    "a12_metric_averages",
    """SELECT round(avg(ctr), 6) AS ctr, round(avg(roas), 6) AS roas, round(avg(conversion_rate), 6)
      AS conversion_rate, round(avg(engagement_score), 6) AS engagement_score,
      round(avg(cost_efficiency_score), 6) AS cost_efficiency_score FROM gold""",
)
def _(spark, d):
    """Averages of several metrics."""
    metrics = ["ctr", "roas", "conversion_rate", "engagement_score", "cost_efficiency_score"]
    return layers.gold(spark, d).agg(*[F.avg(m).alias(m) for m in metrics])


@query(
    "a13_group_report",
    """SELECT l_shipmode_like AS flag, count(*) AS n, round(avg(l_extendedprice), 2) AS avg_price,
      CAST(sum(win) AS BIGINT) AS wins, round(sum(win) * 100.0 / count(*), 2) AS win_rate
    FROM (SELECT l_returnflag AS l_shipmode_like, l_extendedprice,
            CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS win FROM lineitem) GROUP BY 1""",
)
def _(spark, d):
    """Count, rounded average, wins and win rate per group."""
    rows = table(spark, d, "lineitem").withColumn("win", (F.col("l_quantity") > 25).cast("int"))
    return rows.groupBy(F.col("l_returnflag").alias("flag")).agg(
        F.count(F.lit(1)).alias("n"),
        expr.shown(F.avg("l_extendedprice"), 2).alias("avg_price"),
        F.sum("win").alias("wins"),
        expr.shown(F.avg("win") * 100.0, 2).alias("win_rate"),
    )


@query(
    "a14_run_log_rollup",
    """SELECT description, strftime(max(deployed_at), '%Y-%m-%d %H:%M:%S') AS last_run, count(*) AS total,
      count(*) FILTER (WHERE status = 'SUCCESS') AS success, count(*) FILTER (WHERE status = 'FAILED') AS failed
    FROM (SELECT o_orderpriority AS description, o_orderdate AS deployed_at,
            CASE o_orderstatus WHEN 'F' THEN 'FAILED' ELSE 'SUCCESS' END AS status FROM orders) GROUP BY 1""",
)
def _(spark, d):
    """Runs per description: last, total, succeeded, failed (orders as the run log)."""
    from adperf.sources import io

    log = table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("description"),
        F.col("o_orderdate").alias("deployed_at"),
        F.when(F.col("o_orderstatus") == "F", "FAILED").otherwise("SUCCESS").alias("status"),
    )
    return io.run_summary(log)


@query(
    "a15_median_defaults",
    """SELECT ad_category, round(median(category_age_affinity), 6) AS median_category_age_affinity
    FROM gold GROUP BY ad_category""",
)
def _(spark, d):
    """Median per category as a form default."""
    return tables.medians(layers.gold(spark, d), "ad_category", "category_age_affinity")


@query(
    "a15_median_volume",
    "SELECT l_returnflag, round(median(l_extendedprice), 6) AS median_l_extendedprice FROM lineitem GROUP BY 1",
)
def _(spark, d):
    """Exact median per group of the largest table."""
    return tables.medians(table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice")


_CORR = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "a16_correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS corr FROM lineitem"
        for a in _CORR
        for b in _CORR
    ),
)
def _(spark, d):
    """Pairwise correlations in one pass."""
    return tables.correlations(table(spark, d, "lineitem"), _CORR)


@query(
    "a16_target_correlations",
    """SELECT 'cost_per_click' AS feature, round(corr(cost_per_click, ctr), 6) AS corr FROM gold
    UNION ALL SELECT 'avg_user_age', round(corr(avg_user_age, ctr), 6) FROM gold
    UNION ALL SELECT 'avg_hour', round(corr(avg_hour, ctr), 6) FROM gold""",
)
def _(spark, d):
    """Correlations with one target."""
    return tables.target_correlations(
        layers.gold(spark, d), "ctr", ["cost_per_click", "avg_user_age", "avg_hour"]
    )


@query(
    "a17_variance_gate",
    """SELECT 'ctr' AS column_name, round(stddev(ctr), 6) AS stddev, min(ctr) = max(ctr) AS constant,
      stddev(ctr) > 1e-10 AS varies FROM gold
    UNION ALL SELECT 'high_performance', round(stddev(high_performance), 6),
      min(high_performance) = max(high_performance), stddev(high_performance) > 1e-10 FROM gold""",
)
def _(spark, d):
    """Targets that vary enough to model."""
    return tables.variation(layers.gold(spark, d), ["ctr", "high_performance"])


@query(
    "a18_argmax_per_group",
    """SELECT o_orderpriority, o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) = 1""",
)
def _(spark, d):
    """Row with the best metric per group."""
    return tables.best_per_group(
        table(spark, d, "orders"), "o_orderpriority", "o_orderkey", "o_totalprice"
    )


@query(
    "a19_pivot_mean",
    """SELECT l_returnflag, round(avg(l_quantity) FILTER (WHERE l_linestatus = 'F'), 6) AS F,
      round(avg(l_quantity) FILTER (WHERE l_linestatus = 'O'), 6) AS O FROM lineitem GROUP BY 1""",
)
def _(spark, d):
    """Mean per row and column value."""
    return tables.pivot_mean(
        table(spark, d, "lineitem"), "l_returnflag", "l_linestatus", ["F", "O"], "l_quantity"
    )


@query(
    "a20_unpivot",
    """SELECT ad_type, 'total_revenue' AS metric, round(sum(total_revenue), 6) AS amount FROM gold GROUP BY 1
    UNION ALL SELECT ad_type, 'total_ad_spend', round(sum(total_ad_spend), 6) FROM gold GROUP BY 1""",
)
def _(spark, d):
    """Wide metrics to long rows."""
    sums = layers.gold(spark, d).groupBy("ad_type").agg(
        F.sum("total_revenue").alias("total_revenue"), F.sum("total_ad_spend").alias("total_ad_spend")
    )
    return tables.long_form(sums, "metric", "amount", ["ad_type"])


@query("a21_distinct_values", "SELECT count(DISTINCT User_ID) AS users, count(DISTINCT Ad_Reference_ID) AS ads FROM clicks")
def _(spark, d):
    """Distinct values of two columns."""
    return layers.bronze_clicks(spark, d).agg(
        F.count_distinct("User_ID").alias("users"), F.count_distinct(AD).alias("ads")
    )


@query(
    "a22_adaptive_grain",
    """WITH k AS (SELECT count(DISTINCT CAST(Click_Timestamp_Standard AS DATE)) AS dates FROM silver_clicks)
    SELECT CASE WHEN (SELECT dates FROM k) <= 1 THEN CAST(hour(Click_Timestamp_Standard) AS VARCHAR)
        WHEN (SELECT dates FROM k) <= 31 THEN strftime(Click_Timestamp_Standard, '%d')
        ELSE strftime(Click_Timestamp_Standard, '%Y-%m') END AS time_unit, count(*) AS n
    FROM silver_clicks GROUP BY 1""",
)
def _(spark, d):
    """Events per time unit, the unit chosen by the number of dates."""
    ts = "Click_Timestamp_Standard"
    rows = layers.silver_clicks(spark, d).withColumn("hour", F.hour(ts))
    unit = tables.adaptive_grain(rows, ts, "hour").alias("time_unit")
    return rows.groupBy(unit).agg(F.count(F.lit(1)).alias("n"))


@query(
    "a23_time_bins",
    """SELECT Ad_Reference_ID, round_even(avg_hour, 0) AS hour_bin, round_even(avg_hour * 4, 0) / 4 AS quarter_bin
    FROM gold""",
)
def _(spark, d):
    """Nearest hour and quarter hour."""
    return layers.gold(spark, d).select(
        AD,
        expr.nearest_hour("avg_hour").cast("double").alias("hour_bin"),
        expr.nearest_quarter_hour("avg_hour").alias("quarter_bin"),
    )


@query(
    "a24_crosstab",
    """SELECT user_clicked, count(*) FILTER (WHERE user_gender = 'Male') AS "user_gender_Male",
      count(*) FILTER (WHERE user_gender = 'Female') AS "user_gender_Female",
      count(*) FILTER (WHERE user_gender = 'Other') AS "user_gender_Other"
    FROM (SELECT CAST(user_clicked AS BIGINT) AS user_clicked, user_gender FROM clicks) GROUP BY 1""",
)
def _(spark, d):
    """Counts of value pairs."""
    return tables.crosstab(
        layers.bronze_clicks(spark, d), "user_clicked", "user_gender", fixed.EXPECTED_GENDERS
    )


@query(
    "a26_unexpected_values",
    """SELECT DISTINCT device AS value FROM clicks
    WHERE device IS NOT NULL AND device NOT IN ('Desktop', 'Mobile', 'Tablet', 'moble', 'DESKTOP') ORDER BY 1 LIMIT 10""",
)
def _(spark, d):
    """Values outside the allowed list."""
    return tables.unexpected_values(
        layers.bronze_clicks(spark, d), "device", fixed.EXPECTED_CLICK_DEVICES, top=10
    )


# ---- sort, limit, top-k -----------------------------------------------------------------


@query(
    "t1_order_by_metric",
    "SELECT ad_category, round(avg(roas), 6) AS avg_roas FROM gold GROUP BY 1 ORDER BY 2 DESC",
)
def _(spark, d):
    """Groups by a metric, best first."""
    return (
        layers.gold(spark, d).groupBy("ad_category").agg(F.avg("roas").alias("avg_roas"))
        .orderBy(F.desc("avg_roas"))
    )


@query(
    "t2_custom_order",
    """SELECT ad_lifecycle_stage, count(*) AS n,
      CAST(CASE ad_lifecycle_stage WHEN 'New' THEN 1 WHEN 'Growing' THEN 2 WHEN 'Mature' THEN 3 ELSE 4 END AS BIGINT) AS position
    FROM gold GROUP BY 1 ORDER BY 3""",
)
def _(spark, d):
    """Rows in a given order of labels."""
    position = tables.label_position("ad_lifecycle_stage", fixed.LIFECYCLE_STAGES)
    return (
        layers.gold(spark, d).groupBy("ad_lifecycle_stage").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("position", position).orderBy("position")
    )


@query(
    "t3_latest_record",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders
    ORDER BY orders.o_orderdate DESC, o_orderkey LIMIT 1""",
)
def _(spark, d):
    """The newest record of a log."""
    newest = [F.desc("o_orderdate"), F.asc("o_orderkey")]
    return windows.top_k(table(spark, d, "orders"), newest, 1).select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate")
    )


@query(
    "t4_top_k",
    """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
      round(l_extendedprice, 6) AS l_extendedprice FROM lineitem
    ORDER BY lineitem.l_extendedprice DESC, l_orderkey, l_partkey, l_suppkey, lineitem.l_linenumber LIMIT 10""",
)
def _(spark, d):
    """Ten largest rows of the largest table."""
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    rows = table(spark, d, "lineitem").select(*keys, "l_extendedprice")
    return windows.top_k(rows, [F.desc("l_extendedprice"), *[F.asc(k) for k in keys]], 10)


@query(
    "t5_top_k_per_group",
    """SELECT ad_category, Ad_Reference_ID, round(roas, 6) AS roas,
      row_number() OVER (PARTITION BY ad_category ORDER BY gold.roas DESC, Ad_Reference_ID) AS rank
    FROM gold QUALIFY rank <= 2""",
)
def _(spark, d):
    """Two best ads of each category."""
    rows = layers.gold(spark, d).select("ad_category", AD, "roas")
    return windows.top_per_group(rows, ["ad_category"], [F.desc("roas"), F.asc(AD)], 2)


_WASTE_SQL = """
WITH c AS (SELECT Ad_Reference_ID, total_ad_spend, roas,
    (SELECT count(*) FROM gold WHERE roas < 1.8) > 0 AS any_poor FROM gold)
SELECT Ad_Reference_ID, round(total_ad_spend, 6) AS total_ad_spend, round(roas, 6) AS roas FROM c
WHERE NOT any_poor OR roas < 1.8
ORDER BY CASE WHEN any_poor THEN -round(c.total_ad_spend, 6) ELSE round(c.roas, 6) END, Ad_Reference_ID LIMIT 8"""


@query("t6_filtered_top_k_fallback", _WASTE_SQL)
def _(spark, d):
    """Costliest poor ads, or the poorest ads when none is below the limit."""
    from adperf.operators import reports

    return reports.waste(layers.gold(spark, d), k=8).select(AD, "total_ad_spend", "roas")


@query(
    "t7_top_k_after_aggregation",
    """SELECT User_ID, count(*) AS n FROM clicks GROUP BY 1 ORDER BY n DESC, User_ID LIMIT 5""",
)
def _(spark, d):
    """Five most active users."""
    return tables.frequency(layers.bronze_clicks(spark, d), "User_ID", "User_ID", 5)


# ---- sets -------------------------------------------------------------------------------


@query(
    "s1_union_summaries",
    """SELECT 'clicks' AS source, count(*) AS n FROM clicks UNION ALL SELECT 'catalog', count(*) FROM catalog
    UNION ALL SELECT 'gold', count(*) FROM gold""",
)
def _(spark, d):
    """Row counts of the layers as rows."""
    return tables.union_counts(
        {
            "clicks": layers.bronze_clicks(spark, d),
            "catalog": layers.bronze_catalog(spark, d),
            "gold": layers.gold(spark, d),
        }
    )


@query(
    "s2_distinct_rows",
    """SELECT DISTINCT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment
    FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 3 = 0) x""",
)
def _(spark, d):
    """Exact-row de-duplication of whole rows, a third of them given twice."""
    rows = table(spark, d, "customer")
    return cleanse.drop_exact_duplicates(rows.unionByName(rows.filter("c_custkey % 3 = 0")))


@query(
    "s3_key_dedup",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, lineitem.l_linenumber ORDER BY l_partkey, l_suppkey) = 1""",
)
def _(spark, d):
    """One row per key, smallest tie-break first."""
    from adperf.operators import cleanse

    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return cleanse.drop_business_duplicates(
        rows, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"]
    )


@query(
    "s4_id_sets",
    """SELECT 'both' AS side, count(*) AS n FROM (SELECT Ad_Reference_ID FROM clicks INTERSECT SELECT Ad_Reference_ID FROM catalog)
    UNION ALL SELECT 'clicks only', count(*) FROM (SELECT Ad_Reference_ID FROM clicks EXCEPT SELECT Ad_Reference_ID FROM catalog)
    UNION ALL SELECT 'catalog only', count(*) FROM (SELECT Ad_Reference_ID FROM catalog EXCEPT SELECT Ad_Reference_ID FROM clicks)""",
)
def _(spark, d):
    """Intersection and differences of two id sets."""
    clicks = layers.bronze_clicks(spark, d).select(AD).distinct()
    catalog = layers.bronze_catalog(spark, d).select(AD).distinct()
    return tables.union_counts(
        {
            "both": clicks.intersect(catalog),
            "clicks only": clicks.subtract(catalog),
            "catalog only": catalog.subtract(clicks),
        },
        "side",
    )


# ---- features ---------------------------------------------------------------------------


@query(
    "m1_calendar",
    """SELECT Event_ID, CAST(hour_of_day AS DOUBLE) AS hour_of_day, CAST(day_of_week AS DOUBLE) AS day_of_week,
      CAST(month AS DOUBLE) AS month, CAST(is_weekend AS BIGINT) AS is_weekend FROM enriched""",
)
def _(spark, d):
    """Hour, weekday, month, weekend."""
    rows = features.with_calendar(layers.silver_clicks(spark, d).join(
        layers.silver_catalog(spark, d).select(AD), AD, "left_semi"))
    parts = ["hour_of_day", "day_of_week", "month"]
    return rows.select(ID, *[F.col(c).cast("double").alias(c) for c in parts], "is_weekend")


@query("m2_day_part", "SELECT Event_ID, time_of_day_category FROM enriched")
def _(spark, d):
    """Part of the day."""
    return layers.enriched(spark, d).select(ID, "time_of_day_category")


@query(
    "m3_session_compat",
    f"""SELECT Event_ID, User_ID, time_since_last_action,
      CASE WHEN time_since_last_action > 1800 THEN session_id ELSE 0 END AS session_id FROM ({_SESSIONS_SQL})""",
)
def _(spark, d):
    """Session id kept only on the row that opens a session."""
    return _sessions(spark, d, compat=True)


@query(
    "m4_watch_ratio",
    """SELECT Event_ID, round(watch_duration_ratio, 6) AS watch_duration_ratio,
      round(watch_duration_ratio_clipped, 6) AS watch_duration_ratio_clipped FROM enriched""",
)
def _(spark, d):
    """Watched part of the video."""
    return layers.enriched(spark, d).select(
        ID, "watch_duration_ratio", "watch_duration_ratio_clipped"
    )


@query("m5_conversion", "SELECT Event_ID, CAST(is_converted AS BIGINT) AS is_converted FROM enriched")
def _(spark, d):
    """Conversion flag."""
    return layers.enriched(spark, d).select(ID, "is_converted")


@query(
    "m6_demographic_fit",
    """SELECT age_category, Ad_Category_Standard, count(*) AS n,
      round(avg(category_performance_by_age), 6) AS rate, round(avg(demographic_engagement_delta), 6) AS delta
    FROM scored GROUP BY ALL""",
)
def _(spark, d):
    """Age bands, their click rate per category and the stepped score."""
    rows = layers.enriched(spark, d).select("age_category", "Ad_Category_Standard", features.CLICKED)
    fit = features.add_demographic_fit(rows, share=0.05, min_rows=0)
    return fit.groupBy("age_category", "Ad_Category_Standard").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("category_performance_by_age").alias("rate"),
        F.avg("demographic_engagement_delta").alias("delta"),
    )


@query(
    "m7_financials",
    """SELECT Event_ID, round(total_revenue, 6) AS total_revenue, round(total_cost, 6) AS total_cost,
      round(return_on_ad_spend, 6) AS return_on_ad_spend FROM enriched""",
)
def _(spark, d):
    """Revenue, cost and return per impression."""
    return layers.enriched(spark, d).select(ID, "total_revenue", "total_cost", "return_on_ad_spend")


def _gold_columns(name: str, doc: str, *columns: str) -> None:
    """Register a query showing derived gold columns, recomputed from their inputs."""
    picked = ", ".join(f"round({c}, 6) AS {c}" for c in columns)

    @query(name, f"SELECT Ad_Reference_ID, {picked} FROM gold")
    def _(spark, d):
        base = layers.gold(spark, d).drop(*columns)
        return rollup.add_derived(base, layers.AS_OF).select(AD, *columns)

    _.__doc__ = doc


_gold_columns("m8_engagement_efficiency", "Watch ratio times click rate.", "engagement_efficiency")
_gold_columns("m9_return_on_cost", "Profit over cost.", "profit_margin")
_gold_columns("m10_cost_per_conversion", "Spend per conversion.", "cost_per_conversion")
_gold_columns("m12_cost_efficiency", "Rates per cost.", "cost_efficiency_score")
_gold_columns("m13_engagement_score", "Weighted engagement.", "engagement_score")
_gold_columns("m14_audience_alignment", "Score times affinity.", "audience_alignment_score")


@query(
    "m11_high_performance",
    """SELECT Ad_Reference_ID, CAST(CASE WHEN roas > 2 THEN 1 ELSE 0 END AS BIGINT) AS high_performance FROM gold""",
)
def _(spark, d):
    """Ads with a return above 2."""
    base = layers.gold(spark, d).drop("high_performance")
    return rollup.add_derived(base, layers.AS_OF).select(AD, "high_performance")


@query(
    "m15_age_lifecycle",
    """SELECT event_id, date_diff('day', CAST(ts AS DATE), DATE '2024-02-15') AS days,
      CASE WHEN date_diff('day', CAST(ts AS DATE), DATE '2024-02-15') < 7 THEN 'New'
        WHEN date_diff('day', CAST(ts AS DATE), DATE '2024-02-15') < 30 THEN 'Growing'
        WHEN date_diff('day', CAST(ts AS DATE), DATE '2024-02-15') < 60 THEN 'Mature' ELSE 'Declining' END AS stage
    FROM events""",
)
def _(spark, d):
    """Age in days and lifecycle stage."""
    as_of = F.to_date(F.lit(layers.AS_OF))
    days = table(spark, d, "events").select(
        "event_id", F.date_diff(as_of, F.col("ts").cast("date")).alias("days")
    )
    return days.withColumn("stage", features.lifecycle_stage("days"))


@query(
    "m16_location_type",
    """SELECT Ad_Reference_ID, CASE WHEN Ad_Location_Cleaned IN ('Maharashtra', 'Delhi', 'Karnataka') THEN 'Urban'
      WHEN Ad_Location_Cleaned = 'Tamil Nadu' THEN 'Semi-Urban' ELSE 'Rural' END AS location_type FROM silver_catalog""",
)
def _(spark, d):
    """Urban, semi-urban or rural."""
    return layers.silver_catalog(spark, d).select(
        AD, features.location_type("Ad_Location_Cleaned").alias("location_type")
    )


@query(
    "m17_season",
    """SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter' WHEN month(o_orderdate) IN (3, 4, 5)
      THEN 'Spring' WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season FROM orders""",
)
def _(spark, d):
    """Season of a date."""
    return table(spark, d, "orders").select(
        "o_orderkey", features.season(F.month("o_orderdate")).alias("season")
    )


@query(
    "m18_corrected_revenue",
    """SELECT Ad_Reference_ID, round(total_revenue * 10, 6) AS total_revenue,
      CASE WHEN total_ad_spend > 0 THEN round(total_revenue * 10 / total_ad_spend, 2) ELSE 0 END AS roas,
      CASE WHEN total_revenue > 0 THEN round((total_revenue * 10 - total_ad_spend) / (total_revenue * 10), 4)
        ELSE -1 END AS profit_margin FROM gold""",
)
def _(spark, d):
    """Revenue times an attribution factor, return and margin recomputed."""
    return features.corrected_revenue(layers.gold(spark, d), 10.0).select(
        AD, "total_revenue", "roas", "profit_margin"
    )


@query(
    "m19_display_ad_type",
    """SELECT Event_ID, CASE WHEN Ad_Type IS NULL OR trim(Ad_Type) IN ('', '0', 'unknown', 'Unknown', 'none', 'None')
      THEN 'Carousel' ELSE trim(Ad_Type) END AS ad_type FROM clicks""",
)
def _(spark, d):
    """Unknown ad types shown as Carousel."""
    return layers.bronze_clicks(spark, d).select(
        ID, features.display_ad_type("Ad_Type").alias("ad_type")
    )


_PRIMARY = """CASE WHEN lower(trim(platforms_used[1])) IN ('unknown', 'none', '') THEN 'Other'
  ELSE upper(substr(trim(platforms_used[1]), 1, 1)) || lower(substr(trim(platforms_used[1]), 2)) END"""


@query("m20_primary_platform", f"SELECT Ad_Reference_ID, {_PRIMARY} AS platform FROM gold")
def _(spark, d):
    """First platform of an ad in standard spelling."""
    return layers.gold(spark, d).select(AD, features.primary_platform().alias("platform"))


@query(
    "m21_engagement_per_cost",
    """SELECT Ad_Reference_ID, round(CASE WHEN cost_per_click > 0 THEN engagement_score / cost_per_click
      ELSE 0 END, 6) AS efficiency FROM gold""",
)
def _(spark, d):
    """Engagement per unit of click cost."""
    return layers.gold(spark, d).select(AD, features.engagement_per_cost().alias("efficiency"))


@query(
    "m22_alternative_metrics",
    """SELECT Ad_Reference_ID, round(CASE WHEN total_ad_spend > 0 THEN total_conversions / total_ad_spend ELSE 0 END, 6)
      AS conversions_per_spend, round(ctr * 5 + avg_watch_ratio * 0.5, 6) AS engagement_ctr_watch FROM gold""",
)
def _(spark, d):
    """Two alternative metric definitions."""
    return features.alternative_metrics(layers.gold(spark, d)).select(
        AD, "conversions_per_spend", "engagement_ctr_watch"
    )


_CODES = """
CASE lower(ad_category) WHEN 'fashion' THEN 1 WHEN 'health' THEN 2 WHEN 'food' THEN 3 WHEN 'gaming' THEN 4
  WHEN 'travel' THEN 5 ELSE 0 END AS cat,
CASE lower(ad_device) WHEN 'mobile' THEN 1 WHEN 'desktop' THEN 2 WHEN 'tablet' THEN 3 ELSE 0 END AS dev,
CASE lower(ad_type) WHEN 'image' THEN 1 WHEN 'text' THEN 2 WHEN 'carousel' THEN 3 ELSE 0 END AS typ,
CASE lower(ad_location) WHEN 'delhi' THEN 1 WHEN 'karnataka' THEN 2 WHEN 'tamil nadu' THEN 3
  WHEN 'uttar pradesh' THEN 4 ELSE 0 END AS loc"""


@query(
    "m23_interactions",
    f"""SELECT Ad_Reference_ID, dev * typ AS device_type_interaction, cat * typ AS category_type_interaction,
      round(cost_per_click * ad_video_length, 6) AS cost_video_interaction
    FROM (SELECT Ad_Reference_ID, cost_per_click, ad_video_length, CAST(cat AS BIGINT) AS cat,
            CAST(dev AS BIGINT) AS dev, CAST(typ AS BIGINT) AS typ FROM (SELECT *, {_CODES} FROM gold))""",
)
def _(spark, d):
    """Products of coded inputs."""
    return features.interactions(features.code_numbers(layers.gold(spark, d))).select(
        AD, "device_type_interaction", "category_type_interaction", "cost_video_interaction"
    )


@query(
    "m24_code_numbers",
    f"""SELECT Ad_Reference_ID, CAST(cat AS BIGINT) AS ad_category_encoded, CAST(dev AS BIGINT) AS ad_device_encoded,
      CAST(typ AS BIGINT) AS ad_type_encoded, CAST(loc AS BIGINT) AS ad_location_encoded
    FROM (SELECT *, {_CODES} FROM gold)""",
)
def _(spark, d):
    """Fixed code numbers of categories."""
    coded = features.code_numbers(layers.gold(spark, d))
    return coded.select(AD, *[c for c in coded.columns if c.endswith("_encoded")])
