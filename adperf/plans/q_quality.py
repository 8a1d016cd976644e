"""Queries: anomaly report, expected bounds, profiles, checks and scores."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from adperf.functions.expr import shown
from adperf.operators import quality, tables
from adperf.plans import layers
from adperf.plans.registry import query
from adperf.sources import io
from adperf.sources.adapters import table

# ---- anomaly report -----------------------------------------------------------------------

_CLICK_SQL = {
    "Timestamp - Slash Format": r"regexp_matches(Click_Timestamp, '^\d{2}/\d{2}/\d{4} \d{2}:\d{2}$')",
    "Timestamp - Future Dates": "Click_Timestamp = '2035-12-25 12:00:00'",
    "Ad_Type - Null": "Ad_Type IS NULL",
    "Ad_Type - Lowercase video": "Ad_Type = 'video'",
    "Ad_Type - Uppercase IMAGE": "Ad_Type = 'IMAGE'",
    "Watch - Negative": "Watch_Duration < 0",
    "Watch - Overflow": "Watch_Duration > 1000",
    "Watch - Logical Conflict": "user_clicked = 1 AND Watch_Duration = 0",
    "Age - Negative": "user_age < 0",
    "Age - Old": "user_age > 100",
    "Age - Null": "user_age IS NULL",
    "Device - Typo": "device = 'moble'",
    "Device - Uppercase": "device = 'DESKTOP'",
    "Device - Null": "device IS NULL",
    "Device - Empty": "device = ''",
    "Device - Corruption CRITICAL": r"regexp_matches(device, '^\d+\s+')",
    "Platform - gogle": "platform_source = 'gogle'",
    "Platform - facebok": "platform_source = 'facebok'",
    "Platform - Unknown": "platform_source = 'Unknown'",
    "Platform - Null": "platform_source IS NULL",
}
_CATALOG_SQL = {
    "Corrupted Categories": "Ad_Category = 'Corrupted_Category'",
    "Category - Lowercase": "lower(Ad_Category) = Ad_Category",
    "Category - Typo": "Ad_Category = 'Eletronics'",
    "Category - Null": "Ad_Category IS NULL",
    "Device - Null": "Ad_Device IS NULL",
    "Device - Padded": "Ad_Device = '  Mobile  '",
    "Device - Typo": "Ad_Device = 'moble'",
    "Device - Empty": "Ad_Device = ''",
    "Location - Trailing Spaces": "Ad_Location LIKE '% '",
    "Location - Null": "Ad_Location IS NULL",
    "CPC - String Format": "Cost_Per_Click LIKE '%$%'",
    "CPC - Negative": "try_cast(replace(Cost_Per_Click, '$', '') AS DOUBLE) < 0",
    "Ad_Type - Lowercase video": "Ad_Type = 'video'",
    "Ad_Type - Typo Vedeo": "Ad_Type = 'Vedeo'",
    "Ad_Type - Uppercase IMAGE": "Ad_Type = 'IMAGE'",
    "Ad_Type - Typo Carusel": "Ad_Type = 'Carusel'",
    "Ad_Type - Null": "Ad_Type IS NULL",
    "Video Length - String": "ad_video_length = '45s'",
    "Video Length - Conflict": (
        "Ad_Type <> 'Video' AND ad_video_length IS NOT NULL AND ad_video_length NOT IN ('0', '0.0', '')"
    ),
}


def _counts_sql(source: str, conditions: dict[str, str], extra: list[tuple[str, str]]) -> str:
    parts = [
        f"SELECT '{source}' AS table_name, '{name}' AS anomaly_type, "
        f"count(*) FILTER (WHERE {sql}) AS count FROM {source}"
        for name, sql in conditions.items()
    ]
    parts += [f"SELECT '{source}', '{name}', {sql}" for name, sql in extra]
    return " UNION ALL ".join(parts)


CLICK_CONDITIONS_SQL = _counts_sql("clicks", _CLICK_SQL, [])
_CLICK_COUNTS = _counts_sql(
    "clicks",
    _CLICK_SQL,
    [
        (
            "Gender - Identity Shifting",
            "(SELECT count(*) FROM (SELECT User_ID FROM clicks GROUP BY 1 HAVING count(DISTINCT user_gender) > 1))",
        ),
        ("Duplicate Rows", "(SELECT count(*) FROM clicks) - (SELECT count(*) FROM (SELECT DISTINCT * FROM clicks))"),
    ],
)
_CATALOG_COUNTS = _counts_sql(
    "catalog",
    _CATALOG_SQL,
    [
        ("Total Rows", "(SELECT count(*) FROM catalog)"),
        (
            "Duplicate Ad_Reference_IDs",
            "(SELECT count(*) FROM (SELECT Ad_Reference_ID FROM catalog GROUP BY 1 HAVING count(*) > 1))",
        ),
    ],
)
_STATUS = "CASE WHEN count > 0 AND anomaly_type <> 'Total Rows' THEN 'ANOMALY_DETECTED' ELSE 'NO_ANOMALY' END"


def _frames(spark, d):
    return {"clicks": layers.bronze_clicks(spark, d), "catalog": layers.bronze_catalog(spark, d)}


def _report(spark, d):
    return quality.anomaly_report(_frames(spark, d), batch_id="b1", environment="test")


@query("q1_click_anomalies", _CLICK_COUNTS)
def _(spark, d):
    """Anomaly counters of the click log: one pass for the row conditions."""
    frames = {"clicks": layers.bronze_clicks(spark, d)}
    report = quality.anomaly_report(frames, quality.CLICK_ANOMALIES)
    return report.select("table_name", "anomaly_type", "count")


@query("q2_catalog_anomalies", _CATALOG_COUNTS)
def _(spark, d):
    """Anomaly counters of the catalog."""
    frames = {"catalog": layers.bronze_catalog(spark, d)}
    report = quality.anomaly_report(frames, quality.CATALOG_ANOMALIES)
    return report.select("table_name", "anomaly_type", "count")


@query(
    "a3_fused_predicate_counts",
    _counts_sql("clicks", _CLICK_SQL, []).replace("'clicks' AS table_name, ", ""),
)
def _(spark, d):
    """One count per predicate, all in one aggregate, as rows."""
    conditions = {r.name: r.condition for r in quality.CLICK_ANOMALIES if r.kind == "condition"}
    counts = tables.conditional_counts(layers.bronze_clicks(spark, d), conditions)
    return tables.long_form(counts, "anomaly_type", "count")


@query(
    "q3_identity_shift",
    """SELECT User_ID, count(DISTINCT user_gender) AS n_values,
      string_agg(DISTINCT user_gender, ',' ORDER BY user_gender) AS value_set
    FROM clicks WHERE user_gender IS NOT NULL GROUP BY User_ID HAVING count(DISTINCT user_gender) > 1""",
)
def _(spark, d):
    """Users with several genders."""
    return quality.mixed_groups(layers.bronze_clicks(spark, d), "User_ID", "user_gender")


@query(
    "q4_anomaly_report",
    f"""SELECT *, {_STATUS} AS status, 'b1' AS batch_id, 'test' AS environment
    FROM ({_CLICK_COUNTS} UNION ALL {_CATALOG_COUNTS})""",
)
def _(spark, d):
    """The full report with status and batch."""
    return _report(spark, d).drop("severity")


@query(
    "q5_critical_anomalies",
    f"""SELECT table_name, anomaly_type, count FROM ({_CLICK_COUNTS} UNION ALL {_CATALOG_COUNTS})
    WHERE count > 0 AND (anomaly_type LIKE '%CRITICAL%' OR anomaly_type LIKE '%Corruption%'
      OR anomaly_type LIKE '%Logical Conflict%')""",
)
def _(spark, d):
    """Critical anomalies that occur."""
    return quality.critical_only(_report(spark, d)).select("table_name", "anomaly_type", "count")


_TOTALS = f"""SELECT count(*) FILTER (WHERE count > 0) AS types_hit, CAST(sum(count) AS BIGINT) AS total,
  CAST(sum(count) FILTER (WHERE table_name = 'clicks') AS BIGINT) AS clicks_total,
  CAST(sum(count) FILTER (WHERE table_name = 'catalog') AS BIGINT) AS catalog_total
FROM ({_CLICK_COUNTS} UNION ALL {_CATALOG_COUNTS}) WHERE anomaly_type <> 'Total Rows'"""


@query("q6_report_totals", _TOTALS)
def _(spark, d):
    """Types hit and totals of the report."""
    return quality.report_totals(_report(spark, d))


@query("a25_filtered_totals", _TOTALS)
def _(spark, d):
    """Totals over summary rows, filtered per table."""
    return quality.report_totals(_report(spark, d))


@query(
    "q7_violations",
    " UNION ALL ".join(
        f"SELECT Event_ID, '{name}' AS rule FROM clicks WHERE {sql}" for name, sql in _CLICK_SQL.items()
    ),
)
def _(spark, d):
    """Every broken condition of every row."""
    return quality.violations(layers.bronze_clicks(spark, d), quality.CLICK_ANOMALIES, ["Event_ID"])


@query(
    "q7_violation_samples",
    "SELECT Event_ID, rule FROM ("
    + " UNION ALL ".join(
        f"SELECT Event_ID, '{name}' AS rule FROM clicks WHERE {sql}" for name, sql in _CLICK_SQL.items()
    )
    + ") QUALIFY row_number() OVER (PARTITION BY rule ORDER BY Event_ID) <= 5",
)
def _(spark, d):
    """The first five offending rows of each rule."""
    return quality.violations(
        layers.bronze_clicks(spark, d), quality.CLICK_ANOMALIES, ["Event_ID"], per_rule=5
    )


# ---- expected bounds ------------------------------------------------------------------------


def _bounds_sql(rows: list[tuple[str, str, float | None, float | None]]) -> str:
    parts = []
    for name, sql, low, high in rows:
        broken = " OR ".join(
            [f"v < {low}"] * (low is not None) + [f"v > {high}"] * (high is not None)
        )
        parts.append(
            f"SELECT '{name}' AS rule, round(CAST(v AS DOUBLE), 6) AS observed, "
            f"CASE WHEN {broken or 'false'} THEN 'FAIL' ELSE 'PASS' END AS status FROM ({sql})"
        )
    return " UNION ALL ".join(parts)


# Usual rows of the published sample's tables.
CATALOG_ROWS, CLICK_ROWS, GOLD_ROWS = (10_400, 10_600), (2_400_000, 2_600_000), (800, 1_200)


def _run(spark, d, rules, as_of=None, frames=None):
    report = quality.run_rules(frames or _frames(spark, d), rules, as_of)
    return report.select("rule", "observed", "status")


@query(
    "q8_row_bounds",
    _bounds_sql(
        [
            ("catalog rows", "SELECT count(*) AS v FROM catalog", *CATALOG_ROWS),
            ("click rows", "SELECT count(*) AS v FROM clicks", *CLICK_ROWS),
        ]
    ),
)
def _(spark, d):
    """Row counts against their bounds."""
    return _run(spark, d, quality.row_bounds(CATALOG_ROWS, CLICK_ROWS))


@query(
    "q9_null_limits",
    "SELECT table_name || '.' || rule AS rule, observed, status FROM ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, * FROM ("
        + _bounds_sql(
            [
                (f"nulls {c}", f"SELECT (count(*) - count({c})) / count(*) AS v FROM {t}", None, lim[0])
                for c, lim in limits.items()
            ]
        )
        + ")"
        for t, limits in (
            ("catalog", quality.CATALOG_NULL_LIMITS),
            ("clicks", quality.CLICK_NULL_LIMITS),
        )
    )
    + ")",
)
def _(spark, d):
    """Null shares against their limits, one pass per table."""
    rules = quality.null_limits("catalog", quality.CATALOG_NULL_LIMITS) + quality.null_limits(
        "clicks", quality.CLICK_NULL_LIMITS
    )
    report = quality.run_rules(_frames(spark, d), rules)
    return report.select(F.concat_ws(".", "table_name", "rule").alias("rule"), "observed", "status")


@query(
    "q10_duplicate_limits",
    _bounds_sql(
        [
            ("duplicate ad ids", "SELECT count(*) - count(DISTINCT Ad_Reference_ID) AS v FROM catalog", None, 510),
            (
                "duplicate rows",
                "SELECT 1 - (SELECT count(*) FROM (SELECT DISTINCT * FROM clicks)) / count(*) AS v FROM clicks",
                None,
                0.01,
            ),
            ("repeated users", "SELECT 1 - count(DISTINCT User_ID) / count(*) AS v FROM clicks", None, 0.99),
        ]
    ),
)
def _(spark, d):
    """Duplicates per key and over all columns against their limits."""
    return _run(spark, d, quality.DUPLICATE_LIMITS)


_RANGES = {
    "ad_id_format": ("catalog", "NOT regexp_matches(Ad_Reference_ID, '^AD_[0-9]{6}$')", None, 0),
    "corrupted_category": ("catalog", "Ad_Category = 'Corrupted_Category'", 450, 550),
    "category_lowercase": ("catalog", "Ad_Category = lower(Ad_Category)", 600, 750),
    "category_typo": ("catalog", "Ad_Category = 'Eletronics'", 350, 450),
    "cpc_with_dollar": ("catalog", "starts_with(Cost_Per_Click, '$')", 900, 1100),
    "cpc_negative": ("catalog", "try_cast(replace(Cost_Per_Click, '$', '') AS DOUBLE) < 0", 300, None),
    "ad_type_lowercase": ("catalog", "Ad_Type = 'video'", 600, 750),
    "ad_type_typo": ("catalog", "Ad_Type IN ('Vedeo', 'Carusel')", 300, 500),
    "video_length_string": ("catalog", "ad_video_length = '45s'", 400, 500),
    "video_length_conflict": ("catalog", "NOT contains(Ad_Type, 'Video') AND try_cast(ad_video_length AS DOUBLE) > 0", 750, 950),
    "device_typo": ("catalog", "Ad_Device = 'moble'", 1, 10),
    "timestamp_slash_format": ("clicks", "Click_Timestamp LIKE '%/%/% %:%'", 1500, 1800),
    "future_dates_2035": ("clicks", "Click_Timestamp = '2035-12-25 12:00:00'", 500, 600),
    "negative_watch_duration": ("clicks", "Watch_Duration < 0", 450, 550),
    "extreme_watch_duration": ("clicks", "Watch_Duration > 1000", 450, 550),
    "underage_users": ("clicks", "user_age < 0", 600, 700),
    "old_users": ("clicks", "user_age > 100", 350, 450),
    "device_typos": ("clicks", "device IN ('moble', 'DESKTOP')", 1, None),
    "platform_typos": ("clicks", "platform_source IN ('gogle', 'facebok')", 1, None),
    "invalid_user_clicked": ("clicks", "user_clicked NOT IN (0, 1)", None, 0),
    "click_watch_conflict": ("clicks", "user_clicked = 1 AND Watch_Duration = 0", 900, 1100),
}


@query(
    "q11_expected_ranges",
    _bounds_sql(
        [
            (name, f"SELECT count(*) FILTER (WHERE {sql}) AS v FROM {t}", low, high)
            for name, (t, sql, low, high) in _RANGES.items()
        ]
    ),
)
def _(spark, d):
    """Anomaly counts against their expected ranges."""
    return _run(spark, d, quality.expected_ranges())


@query(
    "q12_reference_minimum",
    _bounds_sql(
        [
            (
                "ads in catalog",
                """SELECT count(*) FILTER (WHERE a IN (SELECT Ad_Reference_ID FROM catalog)) * 100.0 / count(*) AS v
                FROM (SELECT DISTINCT Ad_Reference_ID AS a FROM clicks)""",
                2.5,
                None,
            )
        ]
    ),
)
def _(spark, d):
    """Share of distinct ads known to the catalog against its minimum."""
    return _run(spark, d, quality.REFERENCE_LIMITS)


@query(
    "q13_freshness",
    """SELECT round((epoch(TIMESTAMP '2024-02-01 00:00:00') - epoch(date_trunc('second', max(ts)))) / 3600.0, 6) AS lag_hours,
      CASE WHEN (epoch(TIMESTAMP '2024-02-01 00:00:00') - epoch(date_trunc('second', max(ts)))) / 3600.0 <= 24
        THEN 'PASS' ELSE 'FAIL' END AS status FROM events""",
)
def _(spark, d):
    """Hours since the newest event."""
    return quality.freshness(table(spark, d, "events"), "ts", "2024-02-01 00:00:00", 24)


@query(
    "q14_actions_due",
    f"""SELECT rule, observed FROM ({_bounds_sql([
        (name, f"SELECT count(*) FILTER (WHERE {sql}) AS v FROM {t}", low, high)
        for name, (t, sql, low, high) in _RANGES.items()])}) WHERE status = 'FAIL'""",
)
def _(spark, d):
    """Broken rules, the most severe first."""
    report = quality.run_rules(_frames(spark, d), quality.expected_ranges())
    return quality.actions_due(report).select("rule", "observed")


# ---- profiles -------------------------------------------------------------------------------

_TITLE = """list_aggregate(list_transform(string_split(lower(trim({c})), '{s}'),
  lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), 'string_agg', '{s}')"""
_LEN = "try_cast(regexp_replace(trim(ad_video_length), 's$', '') AS DOUBLE)"
_CPC = "try_cast(replace(trim(Cost_Per_Click), '$', '') AS DOUBLE)"
_KIND = """CASE WHEN t LIKE '%Vedeo%' OR t LIKE 'Vid%' THEN 'Video' WHEN t IN ('Image', 'Img') THEN 'Image'
  WHEN t IN ('Carusel', 'Carousel') THEN 'Carousel' ELSE t END"""


def _profile_sql(source: str, conditions: dict[str, str], singles: dict[str, str]) -> str:
    parts = [
        f"SELECT '{name}' AS \"check\", count(*) FILTER (WHERE {sql}) AS value FROM {source}"
        for name, sql in conditions.items()
    ]
    parts += [f"SELECT '{name}', ({sql})" for name, sql in singles.items()]
    return " UNION ALL ".join(parts)


@query(
    "q16_catalog_profile",
    f"""WITH p AS (SELECT *, {_KIND} AS kind FROM (
        SELECT *, {_TITLE.format(c='Ad_Type', s=' ')} AS t, {_TITLE.format(c='Ad_Category', s=' ')} AS cat,
          upper(substr(trim(Ad_Device), 1, 1)) || lower(substr(trim(Ad_Device), 2)) AS dev FROM catalog))
    """
    + _profile_sql(
        "p",
        {
            "total_rows": "true",
            "null_Ad_Category": "Ad_Category IS NULL",
            "null_Ad_Device": "Ad_Device IS NULL",
            "null_Ad_Location": "Ad_Location IS NULL",
            "null_Cost_Per_Click": "Cost_Per_Click IS NULL",
            "null_Ad_Type": "Ad_Type IS NULL",
            "invalid_ad_id_format": "NOT regexp_matches(Ad_Reference_ID, '^AD_[0-9]{6}$')",
            "cpc_negative": f"{_CPC} < 0",
            "cpc_zero": f"{_CPC} = 0",
            "cpc_parse_errors": f"{_CPC} IS NULL AND Cost_Per_Click IS NOT NULL",
            "empty_locations": "trim(Ad_Location) = ''",
            "video_ads_with_invalid_length": f"kind = 'Video' AND {_LEN} <= 0",
            "nonvideo_ads_with_positive_length": f"coalesce(kind <> 'Video', true) AND {_LEN} > 0",
        },
        {
            "unknown_categories": """SELECT count(DISTINCT Ad_Category) FROM p WHERE Ad_Category IS NOT NULL
              AND cat NOT IN ('Electronics', 'Fashion', 'Travel', 'Health', 'Gaming', 'Food')""",
            "unknown_devices": """SELECT count(DISTINCT Ad_Device) FROM p WHERE Ad_Device IS NOT NULL
              AND dev NOT IN ('Desktop', 'Mobile', 'Tablet', 'All-devices')""",
            "unknown_ad_types": """SELECT count(DISTINCT Ad_Type) FROM p WHERE Ad_Type IS NOT NULL
              AND kind NOT IN ('Video', 'Image', 'Text', 'Carousel')""",
            "duplicate_ad_ids": "SELECT count(*) - count(DISTINCT Ad_Reference_ID) FROM p",
        },
    ),
)
def _(spark, d):
    """Catalog profile."""
    return quality.catalog_profile(layers.bronze_catalog(spark, d))


_TS3 = """coalesce(try_strptime(Click_Timestamp, '%Y-%m-%d %H:%M:%S'),
  try_strptime(Click_Timestamp, '%d/%m/%Y %H:%M'), try_strptime(Click_Timestamp, '%Y-%m-%d %H:%M'))"""


@query(
    "q17_click_profile",
    _profile_sql(
        "clicks",
        {
            "total_rows": "true",
            "null_Ad_Type": "Ad_Type IS NULL",
            "null_user_age": "user_age IS NULL",
            "null_device": "device IS NULL",
            "null_platform_source": "platform_source IS NULL",
            "null_user_gender": "user_gender IS NULL",
            "empty_user_ids": "trim(User_ID) = ''",
            "invalid_uuid_format": "NOT regexp_matches(User_ID, '^[0-9a-f]{8}-[0-9a-f]{4}-', 'i')",
            "timestamp_parse_errors": f"{_TS3} IS NULL",
            "timestamp_outside_range": f"{_TS3} < TIMESTAMP '2026-01-01' OR {_TS3} > TIMESTAMP '2027-12-31'",
            "watch_duration_negative": "Watch_Duration < 0",
            "watch_duration_zero": "Watch_Duration = 0",
            "watch_duration_extreme_outliers": "Watch_Duration > 1000",
            "watch_exactly_minus_12_5": "Watch_Duration = -12.5",
            "watch_exactly_999999": "Watch_Duration = 999999",
            "age_negative": "user_age < 0",
            "age_above_65": "user_age > 65",
            "age_exactly_minus_1": "user_age = -1",
            "age_exactly_125": "user_age = 125",
            "invalid_user_clicked": "user_clicked NOT IN (0, 1)",
        },
        {
            "unknown_devices": """SELECT count(DISTINCT device) FROM clicks WHERE device IS NOT NULL
              AND coalesce(nullif(trim(device), ''), '?') NOT IN ('Desktop', 'Mobile', 'Tablet', 'moble', 'DESKTOP')""",
            "unknown_platforms": """SELECT count(DISTINCT platform_source) FROM clicks WHERE platform_source
              NOT IN ('google', 'facebook', 'instagram', 'gogle', 'facebok', 'Unknown')""",
            "unknown_genders": "SELECT count(DISTINCT user_gender) FROM clicks WHERE user_gender NOT IN ('Male', 'Female', 'Other')",
            "unknown_ad_types": "SELECT count(DISTINCT Ad_Type) FROM clicks WHERE trim(Ad_Type) NOT IN ('Video', 'Image', 'Text', 'video', 'IMAGE')",
            "duplicate_rows": "SELECT (SELECT count(*) FROM clicks) - count(*) FROM (SELECT DISTINCT * FROM clicks)",
            "unique_users": "SELECT count(DISTINCT User_ID) FROM clicks",
            "ad_ids_in_catalog": "SELECT count(DISTINCT Ad_Reference_ID) FROM clicks WHERE Ad_Reference_ID IN (SELECT Ad_Reference_ID FROM catalog)",
            "ad_ids_not_in_catalog": "SELECT count(DISTINCT Ad_Reference_ID) FROM clicks WHERE Ad_Reference_ID NOT IN (SELECT Ad_Reference_ID FROM catalog)",
            "rows_with_unmatched_ad_id": "SELECT count(*) FROM clicks WHERE Ad_Reference_ID NOT IN (SELECT Ad_Reference_ID FROM catalog)",
        },
    ),
)
def _(spark, d):
    """Click-log profile with references to the catalog."""
    frames = _frames(spark, d)
    return quality.click_profile(frames["clicks"], frames["catalog"])


# ---- checks after cleaning --------------------------------------------------------------------


def _silver(spark, d):
    return {
        "silver_clicks": layers.silver_clicks(spark, d),
        "silver_catalog": layers.silver_catalog(spark, d),
    }


def _zero_sql(entries: dict[str, tuple[str, str]]) -> str:
    return _bounds_sql(
        [
            (n, f"SELECT count(*) AS v FROM (SELECT 1 FROM {t} {cond})", None, 0)
            for n, (t, cond) in entries.items()
        ]
    )


@query(
    "q19_residual_checks",
    _zero_sql(
        {
            "ages in range": ("silver_clicks", "WHERE user_age_cleaned NOT BETWEEN 18 AND 100"),
            "watch time in range": ("silver_clicks", "WHERE Watch_Duration_Cleaned NOT BETWEEN 0 AND 180"),
            "no click conflict": ("silver_clicks", "WHERE user_clicked_cleaned = 1 AND Watch_Duration_Cleaned = 0"),
            "no device corruption": ("silver_clicks", r"WHERE regexp_matches(device_cleaned, '^\d+\s+')"),
            "no device spelling": ("silver_clicks", "WHERE device_cleaned IN ('moble', 'DESKTOP')"),
            "no platform spelling": ("silver_clicks", "WHERE platform_source_cleaned IN ('gogle', 'facebok')"),
            "no missing gender": ("silver_clicks", "WHERE user_gender_fixed IS NULL"),
            "no repeated business key": (
                "silver_clicks",
                "GROUP BY User_ID, Click_Timestamp_Standard, Ad_Reference_ID HAVING count(*) > 1",
            ),
            "cost not negative": ("silver_catalog", "WHERE Cost_Per_Click_Cleaned < 0"),
            "no category spelling": ("silver_catalog", "WHERE Ad_Category_Standard IN ('Eletronics', 'Corrupted_Category')"),
            "video length only on video": ("silver_catalog", "WHERE Ad_Type_Standard <> 'Video' AND ad_video_length_cleaned > 0"),
            "no repeated ad": ("silver_catalog", "GROUP BY Ad_Reference_ID HAVING count(*) > 1"),
        }
    ),
)
def _(spark, d):
    """Anomalies left after cleaning."""
    return _run(spark, d, quality.RESIDUAL_RULES, frames=_silver(spark, d))


@query(
    "q20_silver_rules",
    _zero_sql(
        {
            "adult users": ("silver_clicks", "WHERE user_age_cleaned < 18"),
            "watch time not negative": ("silver_clicks", "WHERE Watch_Duration_Cleaned < 0"),
            "clicks have watch time": ("silver_clicks", "WHERE user_clicked_cleaned = 1 AND Watch_Duration_Cleaned <= 0"),
        }
    ),
)
def _(spark, d):
    """Declared rules of the conformed click table."""
    frames = {"silver_clicks": layers.silver_clicks(spark, d)}
    return _run(spark, d, quality.SILVER_RULES, frames=frames)


@query(
    "q21_gold_checks",
    " UNION ALL ".join(
        [
            f"SELECT 'No nulls in {c}' AS \"check\", CASE WHEN count(*) = count({c}) THEN 'PASS' ELSE 'FAIL' END AS status FROM gold"
            for c in quality.GOLD_CRITICAL
        ]
        + [
            f"SELECT '{n}', CASE WHEN count(*) FILTER (WHERE {sql}) = 0 THEN 'PASS' ELSE 'FAIL' END FROM gold"
            for n, sql in {
                "CTR in valid range (0-1)": "ctr NOT BETWEEN 0 AND 1",
                "ROAS non-negative": "roas < 0",
                "Conversion rate in valid range (0-1)": "conversion_rate NOT BETWEEN 0 AND 1",
                "Engagement score in valid range (0-1)": "engagement_score NOT BETWEEN 0 AND 1",
            }.items()
        ]
        + [
            "SELECT 'No duplicate Ad_Reference_ID', CASE WHEN count(*) = count(DISTINCT Ad_Reference_ID) THEN 'PASS' ELSE 'FAIL' END FROM gold",
            f"SELECT 'Row count in expected range', CASE WHEN count(*) BETWEEN {GOLD_ROWS[0]} AND {GOLD_ROWS[1]} THEN 'PASS' ELSE 'WARN' END FROM gold",
            "SELECT 'High performance rate in expected range', CASE WHEN avg(high_performance) * 100 BETWEEN 10 AND 40 THEN 'PASS' ELSE 'WARN' END FROM gold",
        ]
    ),
)
def _(spark, d):
    """PASS, FAIL and WARN list of the gold table."""
    return quality.gold_checks(layers.gold(spark, d), rows=GOLD_ROWS)


_SCORE_SQL = """SELECT rows, CAST(0 AS BIGINT) AS null_columns, duplicates, bad_ctr, bad_roas, score,
  CASE WHEN score >= 90 THEN 'A (Excellent)' WHEN score >= 80 THEN 'B (Good)' WHEN score >= 70 THEN 'C (Fair)'
    ELSE 'D (Poor)' END AS grade, CASE WHEN score >= 80 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT *, greatest(100.0 - least(duplicates * 0.5, 10) - CASE WHEN bad_ctr > 0 THEN 10 ELSE 0 END
    - CASE WHEN bad_roas > 0 THEN 10 ELSE 0 END, 0)::DOUBLE AS score
  FROM (SELECT count(*) AS rows, count(*) - count(DISTINCT Ad_Reference_ID) AS duplicates,
      count(*) FILTER (WHERE ctr NOT BETWEEN 0 AND 1) AS bad_ctr, count(*) FILTER (WHERE roas < 0) AS bad_roas FROM gold))"""


@query("q22_quality_score", _SCORE_SQL)
def _(spark, d):
    """Score, grade and status of the gold table."""
    return quality.quality_score(layers.gold(spark, d))


@query(
    "q23_quality_report",
    f"""SELECT *, (SELECT round(avg(ctr), 6) FROM gold) AS avg_ctr, (SELECT round(avg(roas), 6) FROM gold) AS avg_roas,
      (SELECT round(avg(conversion_rate), 6) FROM gold) AS avg_conversion_rate,
      (SELECT round(avg(engagement_score), 6) FROM gold) AS avg_engagement_score,
      '2024-02-15 06:00:00' AS checked_at, 'test' AS environment, 'v1' AS version FROM ({_SCORE_SQL})""",
)
def _(spark, d):
    """The score row with headline averages and run columns."""
    return quality.quality_report(layers.gold(spark, d), "2024-02-15 06:00:00", "test", "v1")


@query(
    "q24_layer_reconciliation",
    """SELECT 'Silver Catalog' AS source, count(*) AS n FROM silver_catalog
    UNION ALL SELECT 'Gold Fact', count(*) FROM gold
    UNION ALL SELECT 'Advertised in Catalog', count(DISTINCT c.Ad_Reference_ID)
      FROM silver_clicks c JOIN silver_catalog k ON c.Ad_Reference_ID = k.Ad_Reference_ID""",
)
def _(spark, d):
    """Ads per layer."""
    catalog = layers.silver_catalog(spark, d)
    ids = layers.silver_clicks(spark, d).select("Ad_Reference_ID").distinct()
    return tables.union_counts(
        {
            "Silver Catalog": catalog,
            "Gold Fact": layers.gold(spark, d),
            "Advertised in Catalog": ids.join(catalog, "Ad_Reference_ID", "left_semi"),
        }
    )


# ---- sources and audit ------------------------------------------------------------------------


@query(
    "io3_parquet_scan",
    "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity > 45 GROUP BY 1",
)
def _(spark, d):
    """Pruned and filtered parquet scan."""
    rows = io.read_parquet(spark, f"{d}/lineitem.parquet")
    return rows.filter("l_quantity > 45").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query(
    "io4_multi_file_union",
    """SELECT 'customer' AS kind, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer
    UNION ALL SELECT 'supplier', count(*), round(sum(s_acctbal), 2) FROM supplier""",
)
def _(spark, d):
    """Files of different columns read under one schema."""
    customer = io.read_parquet(spark, f"{d}/customer.parquet").select(
        F.lit("customer").alias("kind"), F.col("c_acctbal").alias("balance"), "c_mktsegment"
    )
    supplier = io.read_parquet(spark, f"{d}/supplier.parquet").select(
        F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance")
    )
    return io.union_all(customer, supplier).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), shown(F.sum("balance"), 2).alias("balance")
    )


_RUN = io.Run("b1", "2024-02-15 06:00:00", "test", "abc123", "v1")


@query(
    "io20_ingestion_audit",
    """SELECT event_id, '2024-02-15 06:00:00' AS ingestion_timestamp, '2024-02-15' AS ingestion_date,
      'events.parquet' AS source_file, 'b1' AS ingestion_batch_id, 'test' AS environment,
      'abc123' AS git_commit, 'INGESTED' AS processing_status FROM events""",
)
def _(spark, d):
    """Ingestion audit columns, the file name from the reader."""
    rows = table(spark, d, "events").select("event_id", "_metadata")
    return io.with_ingestion_audit(rows, _RUN).drop("_metadata")


@query(
    "io21_processing_audit",
    """SELECT Ad_Reference_ID, '2024-02-15 06:00:00' AS processing_timestamp, 'b1' AS processing_batch_id,
      'CLEANED' AS processing_status, 'test' AS environment FROM silver_catalog""",
)
def _(spark, d):
    """Processing audit columns of the conformed catalog."""
    rows = layers.silver_catalog(spark, d).select("Ad_Reference_ID")
    return io.with_processing_audit(rows, _RUN)


@query(
    "io12_reconcile",
    """SELECT (SELECT count(*) FROM gold) AS source_rows, (SELECT count(*) FROM gold) AS target_rows,
      true AS same_content, '' AS lost_columns, 'MATCH' AS status""",
)
def _(spark, d):
    """The gold table against its written copy."""
    built = layers.gold(spark, d)
    copy = layers.stage(built, "gold_copy")
    return io.reconcile(built, copy).drop("source_columns", "target_columns")


_DAMAGED_SQL = """SELECT count(*) AS source_rows, count(*) AS target_rows, CAST(6 AS BIGINT) AS source_columns, CAST({columns} AS BIGINT) AS target_columns,
  {same} AS same_content, {lost} AS lost_columns, 'MISMATCH' AS status FROM events"""


@query("io12_changed_copy", _DAMAGED_SQL.format(columns=6, same="false", lost="''"))
def _(spark, d):
    """A copy with one changed value does not match."""
    rows = table(spark, d, "events")
    first = rows.agg(F.min("event_id")).scalar()
    changed = rows.withColumn("value", F.when(F.col("event_id") == first, F.col("value") + 1).otherwise(F.col("value")))
    return io.reconcile(rows, layers.stage(changed, "changed_copy"))


@query("io12_narrowed_copy", _DAMAGED_SQL.format(columns=5, same="true", lost="'props'"))
def _(spark, d):
    """A copy that lost a column does not match."""
    rows = table(spark, d, "events")
    return io.reconcile(rows, layers.stage(rows.drop("props"), "narrowed_copy"))


@query(
    "io22_preview",
    "SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 10",
)
def _(spark, d):
    """The first rows in a given order."""
    return io.preview(table(spark, d, "events"), ["event_id"]).select(
        "event_id", "user_id", "event_type"
    )


@query("io13_file_report", "SELECT 'lineitem.parquet' AS file, count(*) AS row_count FROM lineitem")
def _(spark, d):
    """Files of a folder with size and rows."""
    return io.file_report(spark, f"{d}/lineitem.parquet").drop("bytes")


@query(
    "io1_csv_scan",
    """SELECT event_type, count(*) AS n, round(sum(value), 6) AS total, count(*) FILTER (WHERE props LIKE '{%}') AS quoted,
      strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts
    FROM events GROUP BY 1""",
)
def _(spark, d):
    """Events written as CSV and read back under an explicit schema."""
    path = f"{layers.staging_root(spark)}/events_csv_{layers.run_id()}"
    io.export_text(table(spark, d, "events"), path, "csv")
    ddl = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    back = io.read_csv(spark, path, ddl, multi_line=False)
    return back.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"),
        F.count_if(F.col("props").like("{%}")).alias("quoted"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
    )


@query(
    "io11_dated_export",
    """SELECT CAST(year(ingestion_date) AS BIGINT) AS export_year, CAST(month(ingestion_date) AS BIGINT) AS export_month,
      CAST(day(ingestion_date) AS BIGINT) AS export_day, 'v1' AS export_version, count(*) AS n
    FROM silver_clicks GROUP BY 1, 2, 3""",
)
def _(spark, d):
    """Conformed clicks exported by year, month and day, read back by partition."""
    path = f"{layers.staging_root(spark)}/clicks_export_{layers.run_id()}"
    io.export_partitioned(layers.silver_clicks(spark, d), path, "ingestion_date", _RUN)
    parts = ["export_year", "export_month", "export_day", "export_version"]
    return io.read_parquet(spark, path).groupBy(*parts).agg(F.count(F.lit(1)).alias("n"))


@query(
    "io15_json_export",
    "SELECT ad_category, count(*) AS n, round(sum(total_ad_spend), 6) AS spend FROM gold WHERE ad_category IN ('Food', 'Travel') GROUP BY 1",
)
def _(spark, d):
    """A filtered gold table exported as JSON lines and read back."""
    path = f"{layers.staging_root(spark)}/gold_json_{layers.run_id()}"
    picked = tables.apply_filters(layers.gold(spark, d), {"ad_category": ["Food", "Travel"]})
    io.export_text(picked, path, "json")
    back = spark.read.schema("ad_category string, total_ad_spend double").json(path)
    return back.groupBy("ad_category").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_ad_spend").alias("spend")
    )


# ---- dated folders --------------------------------------------------------------------------

_DAYS_SQL = """SELECT CAST(year(ingestion_date) AS BIGINT) AS export_year, CAST(month(ingestion_date) AS BIGINT) AS export_month,
  CAST(day(ingestion_date) AS BIGINT) AS export_day, count(*) AS n, CAST(sum(user_clicked_cleaned) AS BIGINT) AS clicks
FROM silver_clicks WHERE {} GROUP BY 1, 2, 3"""
_CLICK_DDL = "Event_ID long, User_ID string, user_clicked_cleaned int, ingestion_date date"


def _export(spark, d):
    """The conformed clicks as a dated export, written once."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _exports:
        _exports[key] = f"{layers.staging_root(spark)}/dated_clicks_{layers.run_id()}"
        io.export_partitioned(layers.silver_clicks(spark, d), _exports[key], "ingestion_date", _RUN)
    return _exports[key]


_exports: dict[tuple[str, str], str] = {}


def _by_day(rows):
    return rows.groupBy(*io.EXPORT_PARTS).agg(F.count(F.lit(1)).alias("n"), F.sum("user_clicked_cleaned").alias("clicks"))


@query("io4_dated_day", _DAYS_SQL.format("ingestion_date = DATE '2024-01-15'"))
def _(spark, d):
    """One day of a dated export by its folder."""
    return _by_day(io.read_day(spark, _export(spark, d), date(2024, 1, 15), ddl=_CLICK_DDL))


@query("io4_dated_range", _DAYS_SQL.format("ingestion_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'"))
def _(spark, d):
    """A range of days; other folders are pruned by their names."""
    return _by_day(io.read_between(spark, _export(spark, d), date(2024, 1, 10), date(2024, 1, 12), ddl=_CLICK_DDL))


@query("io4_dated_glob", _DAYS_SQL.format("year(ingestion_date) = 2024 AND month(ingestion_date) = 1 AND day(ingestion_date) BETWEEN 1 AND 9"))
def _(spark, d):
    """Days of a month by a glob, with the parts of their paths as columns."""
    root = _export(spark, d)
    return _by_day(io.read_matching(spark, root, f"{root}/export_year=2024/export_month=1/export_day=[1-9]", ddl=_CLICK_DDL))


@query(
    "io7_replace_day",
    """SELECT strftime(ingestion_date, '%Y-%m-%d') AS ingestion_date,
      count(*) FILTER (WHERE ingestion_date <> DATE '2024-01-15' OR user_clicked_cleaned = 1) AS n, ingestion_date = DATE '2024-01-15' AS rewritten
    FROM silver_clicks GROUP BY silver_clicks.ingestion_date""",
)
def _(spark, d):
    """A day run again with other rows: its files are new, those of all other days are the same."""
    path = f"{layers.staging_root(spark)}/clicks_by_day_{layers.run_id()}"
    rows = layers.silver_clicks(spark, d).select("Event_ID", "User_ID", "user_clicked_cleaned", "ingestion_date")
    io.replace_folders(rows, path, ["ingestion_date"])
    files = F.collect_set("_metadata.file_path").alias("files")  # the files of a day
    before = layers.stage(spark.read.parquet(path).groupBy("ingestion_date").agg(files), "files")
    io.replace_folders(rows.filter("ingestion_date = DATE '2024-01-15' AND user_clicked_cleaned = 1"), path, ["ingestion_date"])
    after = spark.read.parquet(path).groupBy("ingestion_date").agg(files.alias("now"), F.count(F.lit(1)).alias("n"))
    return after.join(before, "ingestion_date").select(
        "ingestion_date", "n", (F.size(F.array_intersect("now", "files")) == 0).alias("rewritten"))


@query(
    "io8_evolved_columns",
    """SELECT strftime(ingestion_date, '%Y-%m-%d') AS ingestion_date, count(*) AS n,
      count(CASE WHEN ingestion_date >= DATE '2024-01-20' THEN device_cleaned END) AS with_device,
      count(CASE WHEN ingestion_date < DATE '2024-01-20' THEN platform_source_cleaned END) AS with_platform
    FROM silver_clicks GROUP BY silver_clicks.ingestion_date""",
)
def _(spark, d):
    """Later days bring a new column and lack an old one; both read as one table."""
    path = f"{layers.staging_root(spark)}/clicks_evolving_{layers.run_id()}"
    rows = layers.silver_clicks(spark, d)
    early = rows.filter("ingestion_date < DATE '2024-01-20'").select("Event_ID", "platform_source_cleaned", "ingestion_date")
    late = rows.filter("ingestion_date >= DATE '2024-01-20'").select("Event_ID", "device_cleaned", "ingestion_date")
    io.replace_folders(early, path, ["ingestion_date"])
    io.replace_folders(late, path, ["ingestion_date"], evolve=True)
    return io.read_parquet(spark, path, merge_schema=True).groupBy("ingestion_date").agg(
        F.count(F.lit(1)).alias("n"), F.count("device_cleaned").alias("with_device"),
        F.count("platform_source_cleaned").alias("with_platform"))
