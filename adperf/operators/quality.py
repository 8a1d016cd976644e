"""Declarative data-quality rules, run as one aggregate per table.

A rule is data: what to measure, the expected bounds, how bad a breach is and
what to do about it.  All row conditions, null shares, row counts and lags of a
table are measured in a single pass; only rules about groups (repeated keys,
mixed values, references) need a grouping of their own.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adperf.functions import fixed
from adperf.functions.expr import first_match, parse_number, parse_timestamp
from adperf.operators import tables, windows
from adperf.sources.staging import stage

ONE_PASS = ("condition", "rows", "null_share", "lag_hours")


@dataclass(frozen=True)
class Rule:
    """One check.

    `kind` is one of
      condition       rows for which the SQL text `condition` is true
      rows            row count
      null_share      fraction of nulls in the column
      lag_hours       hours from the newest value of the column to the as-of time
      repeated_keys   keys (the columns) that occur more than once
      repeated_rows   rows beyond the first of their key; all columns if none given
      repeated_share  the same as a fraction of all rows
      mixed_values    values of the first column with several values of the second
      match_percent   distinct keys found in the table `reference`, in percent
    """

    name: str
    table: str
    kind: str = "condition"
    columns: tuple[str, ...] = ()
    condition: str | None = None
    minimum: float | None = None
    maximum: float | None = None
    severity: str = "medium"
    action: str = "alert"
    reference: str | None = None


class QualityError(RuntimeError):
    """A rule whose action is `fail_pipeline` was broken."""


# ---- engine -----------------------------------------------------------------------------


def _measure(rule: Rule, as_of: str | None) -> Column:
    if rule.kind == "condition":
        return F.count_if(F.expr(rule.condition))
    if rule.kind == "rows":
        return F.count(F.lit(1))
    column = F.col(rule.columns[0])
    if rule.kind == "null_share":
        return F.coalesce(
            F.try_divide(F.count_if(column.isNull()), F.count(F.lit(1))), F.lit(0.0)
        )
    now = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    return (F.unix_timestamp(now) - F.unix_timestamp(F.max(column).cast("timestamp"))) / 3600.0


def _grouped_measure(rule: Rule, frames: Mapping[str, DataFrame]) -> DataFrame:
    df = frames[rule.table]
    keys = list(rule.columns or df.columns)
    if rule.kind == "repeated_keys":
        return tables.repeated_keys(df, keys).agg(F.count(F.lit(1)).alias("v"))
    if rule.kind == "repeated_rows":
        return tables.duplicate_profile(df, keys).select(F.col("duplicate_rows").alias("v"))
    if rule.kind == "repeated_share":
        return tables.duplicate_profile(df, keys).select((F.col("duplicate_pct") / 100).alias("v"))
    if rule.kind == "mixed_values":
        group, value = keys
        pairs = df.select(group, value).filter(F.col(value).isNotNull()).distinct()
        return tables.repeated_keys(pairs, [group]).agg(F.count(F.lit(1)).alias("v"))
    if rule.kind == "match_percent":
        found = integrity(df, frames[rule.reference], keys[0])
        return found.select(F.col("match_pct").alias("v"))
    raise ValueError(f"unknown rule kind {rule.kind}")


def _result(rule: Rule, value: Column) -> Column:
    value = value.cast("double")
    low = F.lit(rule.minimum).cast("double")
    high = F.lit(rule.maximum).cast("double")
    broken = F.coalesce(value < low, F.lit(False)) | F.coalesce(value > high, F.lit(False))
    return F.struct(
        F.lit(rule.name).alias("rule"),
        F.lit(rule.table).alias("table_name"),
        F.lit(",".join(rule.columns)).alias("columns"),
        F.lit(rule.severity).alias("severity"),
        F.lit(rule.action).alias("action"),
        value.alias("observed"),
        low.alias("minimum"),
        high.alias("maximum"),
        F.when(broken, "FAIL").otherwise("PASS").alias("status"),
    )


def run_rules(
    frames: Mapping[str, DataFrame], rules: Sequence[Rule], as_of: str | None = None
) -> DataFrame:
    """One row per rule: observed value, bounds and PASS or FAIL."""
    parts = []
    for name, df in frames.items():
        fused = [r for r in rules if r.table == name and r.kind in ONE_PASS]
        if fused:
            wide = df.agg(*[_measure(r, as_of).alias(f"m{i}") for i, r in enumerate(fused)])
            results = [_result(r, F.col(f"m{i}")) for i, r in enumerate(fused)]
            parts.append(wide.select(F.inline(F.array(*results))))
        for rule in rules:
            if rule.table == name and rule.kind not in ONE_PASS:
                value = _grouped_measure(rule, frames)
                parts.append(value.select(_result(rule, F.col("v")).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, parts)


def enforce(report: DataFrame) -> None:
    """Raise when a rule that must stop the run is broken.  Write the report first."""
    stopping = report.filter((F.col("status") == "FAIL") & (F.col("action") == "fail_pipeline"))
    broken = stopping.agg(F.array_sort(F.collect_set("rule"))).first()[0]  # one entry per declared rule
    if broken:
        raise QualityError("broken rules: " + ", ".join(broken))


def actions_due(report: DataFrame) -> DataFrame:
    """Broken rules per action, the most severe first."""
    rank = first_match(
        [(F.col("severity") == s, i) for i, s in enumerate(["critical", "high", "medium", "low"])], 9
    )
    return (
        report.filter(F.col("status") == "FAIL")
        .withColumn("severity_rank", rank)
        .orderBy("severity_rank", "rule")
        .drop("severity_rank")
    )


def violations(
    df: DataFrame, rules: Iterable[Rule], key: Sequence[str], per_rule: int | None = None
) -> DataFrame:
    """One row per broken condition and row; optionally the first rows of each rule."""
    broken = F.array_compact(
        F.array(*[F.when(F.expr(r.condition), F.lit(r.name)) for r in rules if r.condition])
    )
    long = df.select(*key, F.explode(broken).alias("rule"))
    if per_rule is None:
        return long
    order = [F.col(k).asc_nulls_last() for k in key]
    return windows.top_per_group(long, ["rule"], order, per_rule).drop("rank")


# ---- references, freshness, schema -------------------------------------------------------


def integrity(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct keys found and not found in the dimension, rows without a match, match %.

    The fact is first reduced to one row per key with its row count.
    """
    keys = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(F.col(key).alias("_known")).distinct()
    marked = keys.join(known, F.col(key) == F.col("_known"), "left")
    found = F.col("_known").isNotNull()
    return marked.agg(
        F.count_if(found).alias("matched_keys"),
        F.count_if(~found).alias("unmatched_keys"),
        F.coalesce(F.sum(F.when(~found, F.col("n"))), F.lit(0)).alias("unmatched_rows"),
        F.coalesce(
            F.try_divide(F.count_if(found) * 100.0, F.count(F.lit(1))), F.lit(0.0)
        ).alias("match_pct"),
    )


def mixed_groups(df: DataFrame, group: str, value: str) -> DataFrame:
    """Groups with several distinct values, the values counted and listed."""
    pairs = df.select(group, value).filter(F.col(value).isNotNull()).distinct()
    return (
        pairs.groupBy(group)
        .agg(
            F.count(value).alias("n_values"),
            F.sort_array(F.collect_list(value)).alias("value_set"),
        )
        .filter(F.col("n_values") > 1)
    )


def freshness(df: DataFrame, ts: str, as_of: str, max_lag_hours: float) -> DataFrame:
    """Hours since the newest row and whether that is within the limit."""
    lag = (
        F.unix_timestamp(F.lit(as_of).cast("timestamp"))
        - F.unix_timestamp(F.max(ts).cast("timestamp"))
    ) / 3600.0
    return df.agg(lag.alias("lag_hours")).withColumn(
        "status", F.when(F.col("lag_hours") <= max_lag_hours, "PASS").otherwise("FAIL")
    )


def schema_diff(df: DataFrame, expected_ddl: str) -> DataFrame:
    """Missing, extra and differently typed columns against a DDL schema."""
    expected = {f.name: f.dataType for f in T.StructType.fromDDL(expected_ddl).fields}
    actual = {f.name: f.dataType for f in df.schema.fields}
    rows = []
    for name, kind in expected.items():
        if name not in actual:
            rows.append((name, "missing", kind.simpleString(), None))
        elif actual[name] != kind:
            rows.append((name, "type", kind.simpleString(), actual[name].simpleString()))
    rows += [(n, "extra", None, k.simpleString()) for n, k in actual.items() if n not in expected]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, problem string, expected string, actual string"
    )


def layer_health(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """EXISTS or MISSING and the row count per table name."""
    found = [n for n in names if spark.catalog.tableExists(n)]
    missing = spark.createDataFrame(
        [(n, "MISSING", 0) for n in names if n not in found],
        "table_name string, status string, row_count long",
    )
    counted = [
        spark.table(n)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(n).alias("table_name"), F.lit("EXISTS").alias("status"), "row_count")
        for n in found
    ]
    return reduce(DataFrame.unionByName, counted, missing)


# ---- anomaly report ------------------------------------------------------------------------


def _equals(table: str, entries: Sequence[tuple[str, str]], severity: str = "medium") -> list[Rule]:
    return [Rule(name, table, condition=sql, severity=severity) for name, sql in entries]


# Names and conditions of the reported anomalies.
CLICK_ANOMALIES: list[Rule] = [
    *_equals(
        "clicks",
        [
            ("Timestamp - Slash Format", "Click_Timestamp RLIKE '^[0-9]{2}/[0-9]{2}/[0-9]{4} [0-9]{2}:[0-9]{2}$'"),
            ("Timestamp - Future Dates", "Click_Timestamp = '2035-12-25 12:00:00'"),
            ("Ad_Type - Null", "Ad_Type IS NULL"),
            ("Ad_Type - Lowercase video", "Ad_Type = 'video'"),
            ("Ad_Type - Uppercase IMAGE", "Ad_Type = 'IMAGE'"),
            ("Watch - Negative", "Watch_Duration < 0"),
            ("Watch - Overflow", "Watch_Duration > 1000"),
        ],
    ),
    Rule(
        "Watch - Logical Conflict", "clicks", severity="critical",
        condition="user_clicked = 1 AND Watch_Duration = 0",
    ),
    *_equals(
        "clicks",
        [
            ("Age - Negative", "user_age < 0"),
            ("Age - Old", "user_age > 100"),
            ("Age - Null", "user_age IS NULL"),
            ("Device - Typo", "device = 'moble'"),
            ("Device - Uppercase", "device = 'DESKTOP'"),
            ("Device - Null", "device IS NULL"),
            ("Device - Empty", "device = ''"),
        ],
    ),
    Rule(
        "Device - Corruption CRITICAL", "clicks", severity="critical",
        condition="device RLIKE '^[0-9]+[ ]+'",
    ),
    *_equals(
        "clicks",
        [
            ("Platform - gogle", "platform_source = 'gogle'"),
            ("Platform - facebok", "platform_source = 'facebok'"),
            ("Platform - Unknown", "platform_source = 'Unknown'"),
            ("Platform - Null", "platform_source IS NULL"),
        ],
    ),
    Rule("Gender - Identity Shifting", "clicks", "mixed_values", ("User_ID", "user_gender")),
    Rule("Duplicate Rows", "clicks", "repeated_rows"),
]

CATALOG_ANOMALIES: list[Rule] = [
    Rule("Total Rows", "catalog", "rows", severity="info"),
    Rule("Duplicate Ad_Reference_IDs", "catalog", "repeated_keys", ("Ad_Reference_ID",)),
    Rule(
        "Corrupted Categories", "catalog", severity="high",
        condition="Ad_Category = 'Corrupted_Category'",
    ),
    *_equals(
        "catalog",
        [
            ("Category - Lowercase", "lower(Ad_Category) = Ad_Category"),
            ("Category - Typo", "Ad_Category = 'Eletronics'"),
            ("Category - Null", "Ad_Category IS NULL"),
            ("Device - Null", "Ad_Device IS NULL"),
            ("Device - Padded", "Ad_Device = '  Mobile  '"),
            ("Device - Typo", "Ad_Device = 'moble'"),
            ("Device - Empty", "Ad_Device = ''"),
            ("Location - Trailing Spaces", "endswith(Ad_Location, ' ')"),
            ("Location - Null", "Ad_Location IS NULL"),
            ("CPC - String Format", "contains(Cost_Per_Click, '$')"),
            ("CPC - Negative", "try_cast(replace(Cost_Per_Click, '$', '') AS DOUBLE) < 0"),
            ("Ad_Type - Lowercase video", "Ad_Type = 'video'"),
            ("Ad_Type - Typo Vedeo", "Ad_Type = 'Vedeo'"),
            ("Ad_Type - Uppercase IMAGE", "Ad_Type = 'IMAGE'"),
            ("Ad_Type - Typo Carusel", "Ad_Type = 'Carusel'"),
            ("Ad_Type - Null", "Ad_Type IS NULL"),
            ("Video Length - String", "ad_video_length = '45s'"),
        ],
    ),
    Rule(
        "Video Length - Conflict", "catalog", severity="high",
        condition=(
            "Ad_Type <> 'Video' AND ad_video_length IS NOT NULL "
            "AND ad_video_length NOT IN ('0', '0.0', '')"
        ),
    ),
]


def anomaly_report(
    frames: Mapping[str, DataFrame],
    rules: Sequence[Rule] = (*CLICK_ANOMALIES, *CATALOG_ANOMALIES),
    batch_id: str = "",
    environment: str = "",
) -> DataFrame:
    """Counts per anomaly with a status and the batch they belong to."""
    counted = run_rules(frames, rules)
    hit = (F.col("observed") > 0) & (F.col("severity") != "info")
    return counted.select(
        "table_name",
        F.col("rule").alias("anomaly_type"),
        F.col("observed").cast("long").alias("count"),
        "severity",
        F.when(hit, "ANOMALY_DETECTED").otherwise("NO_ANOMALY").alias("status"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(environment).alias("environment"),
    )


def critical_only(report: DataFrame) -> DataFrame:
    return report.filter((F.col("severity") == "critical") & (F.col("count") > 0))


def report_totals(report: DataFrame) -> DataFrame:
    """Anomaly types hit, anomalies in all and per table."""
    hits = report.filter(F.col("severity") != "info")
    return hits.agg(
        F.count_if(F.col("count") > 0).alias("types_hit"),
        F.sum("count").alias("total"),
        F.sum(F.when(F.col("table_name") == "clicks", F.col("count"))).alias("clicks_total"),
        F.sum(F.when(F.col("table_name") == "catalog", F.col("count"))).alias("catalog_total"),
    )


# ---- expected bounds ------------------------------------------------------------------------


def null_limits(table: str, limits: Mapping[str, tuple[float, str, str]]) -> list[Rule]:
    """Rules from column -> (largest null share, severity, action)."""
    return [
        Rule(f"nulls {c}", table, "null_share", (c,), maximum=share, severity=sev, action=act)
        for c, (share, sev, act) in limits.items()
    ]


# Largest null share per raw column, severity and action.
CATALOG_NULL_LIMITS = {
    "Ad_Reference_ID": (0.0, "critical", "fail_pipeline"),
    "Ad_Category": (0.0, "high", "alert"),
    "Ad_Device": (0.10, "medium", "alert"),
    "Ad_Location": (0.0, "medium", "alert"),
    "Cost_Per_Click": (0.0, "high", "alert"),
    "Ad_Type": (0.02, "medium", "alert"),
    "ad_video_length": (0.0, "low", "log"),
}
CLICK_NULL_LIMITS = {
    "User_ID": (0.0, "critical", "fail_pipeline"),
    "Click_Timestamp": (0.01, "high", "alert"),
    "Ad_Reference_ID": (0.0, "critical", "fail_pipeline"),
    "user_clicked": (0.0, "critical", "fail_pipeline"),
    "user_age": (0.0, "medium", "alert"),
    "device": (0.18, "medium", "alert"),
    "Ad_Type": (0.18, "medium", "alert"),
    "platform_source": (0.0, "low", "log"),
    "user_gender": (0.0, "low", "log"),
}


def expected_ranges() -> list[Rule]:
    """Anomaly counts expected in the raw tables at their usual volume."""
    # Name, condition, minimum, maximum, severity, action.
    catalog = [
        ("ad_id_format", "Ad_Reference_ID NOT RLIKE '^AD_[0-9]{6}$'", None, 0, "critical", "fail_pipeline"),
        ("corrupted_category", "Ad_Category = 'Corrupted_Category'", 450, 550, "high", "fix"),
        ("category_lowercase", "Ad_Category = lower(Ad_Category)", 600, 750, "low", "fix"),
        ("category_typo", "Ad_Category = 'Eletronics'", 350, 450, "medium", "fix"),
        ("cpc_with_dollar", "Cost_Per_Click LIKE '$%'", 900, 1100, "medium", "fix"),
        ("cpc_negative", "try_cast(replace(Cost_Per_Click, '$', '') AS DOUBLE) < 0", 300, None, "high", "fix_to_category_avg"),
        ("ad_type_lowercase", "Ad_Type = 'video'", 600, 750, "low", "fix"),
        ("ad_type_typo", "Ad_Type IN ('Vedeo', 'Carusel')", 300, 500, "medium", "fix"),
        ("video_length_string", "ad_video_length = '45s'", 400, 500, "low", "fix_to_45"),
        ("video_length_conflict", "Ad_Type NOT LIKE '%Video%' AND try_cast(ad_video_length AS DOUBLE) > 0", 750, 950, "critical", "fix_to_zero"),
        ("device_typo", "Ad_Device = 'moble'", 1, 10, "medium", "fix"),
    ]
    clicks = [
        ("timestamp_slash_format", "Click_Timestamp LIKE '%/%/% %:%'", 1500, 1800, "low", "log"),
        ("future_dates_2035", "Click_Timestamp = '2035-12-25 12:00:00'", 500, 600, "high", "alert"),
        ("negative_watch_duration", "Watch_Duration < 0", 450, 550, "high", "flag"),
        ("extreme_watch_duration", "Watch_Duration > 1000", 450, 550, "high", "flag"),
        ("underage_users", "user_age < 0", 600, 700, "medium", "flag"),
        ("old_users", "user_age > 100", 350, 450, "low", "flag"),
        ("device_typos", "device IN ('moble', 'DESKTOP')", 1, None, "low", "fix"),
        ("platform_typos", "platform_source IN ('gogle', 'facebok')", 1, None, "low", "fix"),
        ("invalid_user_clicked", "user_clicked NOT IN (0, 1)", None, 0, "critical", "fail_pipeline"),
        ("click_watch_conflict", "user_clicked = 1 AND Watch_Duration = 0", 900, 1100, "medium", "flag"),
    ]
    return [
        Rule(name, table, condition=sql, minimum=low, maximum=high, severity=sev, action=act)
        for table, entries in (("catalog", catalog), ("clicks", clicks))
        for name, sql, low, high, sev, act in entries
    ]


def row_bounds(catalog: tuple[int, int], clicks: tuple[int, int]) -> list[Rule]:
    """Rules on the rows of the raw tables; what is usual depends on the volume of the caller's data."""
    return [
        Rule(f"{name} rows", table, "rows", minimum=low, maximum=high, severity="critical", action="fail_pipeline")
        for name, table, (low, high) in (("catalog", "catalog", catalog), ("click", "clicks", clicks))
    ]


# Bounds on duplicates and references.
DUPLICATE_LIMITS = [
    Rule("duplicate ad ids", "catalog", "repeated_rows", ("Ad_Reference_ID",), maximum=510, severity="high", action="fix"),
    Rule("duplicate rows", "clicks", "repeated_share", maximum=0.01),
    Rule("repeated users", "clicks", "repeated_share", ("User_ID",), maximum=0.99, severity="low", action="log"),
]
REFERENCE_LIMITS = [
    Rule(
        "ads in catalog", "clicks", "match_percent", ("Ad_Reference_ID",), minimum=2.5,
        severity="high", reference="catalog",
    ),
]
SILVER_RULES = [
    Rule("adult users", "silver_clicks", condition="user_age_cleaned < 18", maximum=0, severity="high"),
    Rule("watch time not negative", "silver_clicks", condition="Watch_Duration_Cleaned < 0", maximum=0, severity="high"),
    Rule("clicks have watch time", "silver_clicks", condition="user_clicked_cleaned = 1 AND Watch_Duration_Cleaned <= 0", maximum=0, severity="high"),
]
RESIDUAL_RULES = [
    Rule("ages in range", "silver_clicks", condition="user_age_cleaned < 18 OR user_age_cleaned > 100", maximum=0),
    Rule("watch time in range", "silver_clicks", condition="Watch_Duration_Cleaned < 0 OR Watch_Duration_Cleaned > 180", maximum=0),
    Rule("no click conflict", "silver_clicks", condition="user_clicked_cleaned = 1 AND Watch_Duration_Cleaned = 0", maximum=0),
    Rule("no device corruption", "silver_clicks", condition="device_cleaned RLIKE '^[0-9]+[ ]+'", maximum=0),
    Rule("no device spelling", "silver_clicks", condition="device_cleaned IN ('moble', 'DESKTOP')", maximum=0),
    Rule("no platform spelling", "silver_clicks", condition="platform_source_cleaned IN ('gogle', 'facebok')", maximum=0),
    Rule("no missing gender", "silver_clicks", "null_share", ("user_gender_fixed",), maximum=0),
    Rule("no repeated business key", "silver_clicks", "repeated_keys", ("User_ID", "Click_Timestamp_Standard", "Ad_Reference_ID"), maximum=0),
    Rule("cost not negative", "silver_catalog", condition="Cost_Per_Click_Cleaned < 0", maximum=0),
    Rule("no category spelling", "silver_catalog", condition="Ad_Category_Standard IN ('Eletronics', 'Corrupted_Category')", maximum=0),
    Rule("video length only on video", "silver_catalog", condition="Ad_Type_Standard <> 'Video' AND ad_video_length_cleaned > 0", maximum=0),
    Rule("no repeated ad", "silver_catalog", "repeated_keys", ("Ad_Reference_ID",), maximum=0),
]
GOLD_CRITICAL = ["Ad_Reference_ID", "ad_category", "ctr", "roas", "conversion_rate", "high_performance"]


def gold_checks(gold: DataFrame, rows: tuple[int, int], win_pct=(10, 40)) -> DataFrame:
    """PASS, FAIL or WARN per check of the gold table."""
    wide = gold.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg("high_performance").alias("wins"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in GOLD_CRITICAL],
        F.count_if(~F.col("ctr").between(0, 1)).alias("bad_ctr"),
        F.count_if(F.col("roas") < 0).alias("bad_roas"),
        F.count_if(~F.col("conversion_rate").between(0, 1)).alias("bad_conversion"),
        F.count_if(~F.col("engagement_score").between(0, 1)).alias("bad_engagement"),
    )
    repeated = tables.repeated_keys(gold, ["Ad_Reference_ID"]).agg(F.count(F.lit(1))).scalar()
    fail, warn = (lambda ok: F.when(ok, "PASS").otherwise("FAIL")), (
        lambda ok: F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise("WARN")
    )
    checks = {f"No nulls in {c}": fail(F.col(f"null_{c}") == 0) for c in GOLD_CRITICAL}
    checks |= {
        "CTR in valid range (0-1)": fail(F.col("bad_ctr") == 0),
        "ROAS non-negative": fail(F.col("bad_roas") == 0),
        "Conversion rate in valid range (0-1)": fail(F.col("bad_conversion") == 0),
        "Engagement score in valid range (0-1)": fail(F.col("bad_engagement") == 0),
        "No duplicate Ad_Reference_ID": fail(repeated == 0),
        "Row count in expected range": warn(F.col("rows").between(*rows)),
        "High performance rate in expected range": warn((F.col("wins") * 100).between(*win_pct)),
    }
    return wide.select(
        F.inline(
            F.array(*[F.struct(F.lit(n).alias("check"), s.alias("status")) for n, s in checks.items()])
        )
    )


def quality_score(gold: DataFrame, key: str = "Ad_Reference_ID") -> DataFrame:
    """Score from 100 down, grade and status of the gold table, in one row.

    Five points per column with nulls (at most 30), half a point per repeated key
    (at most 10), ten for click rates outside 0-1, ten for negative returns.
    """
    wide = gold.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.bool_or(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(gold.columns)],
        F.count_if(~F.col("ctr").between(0, 1)).alias("bad_ctr"),
        F.count_if(F.col("roas") < 0).alias("bad_roas"),
    )
    null_columns = reduce(
        lambda a, b: a + b,
        [F.coalesce(F.col(f"n{i}"), F.lit(False)).cast("int") for i in range(len(gold.columns))],
    )
    repeated = tables.repeated_keys(gold, [key]).agg(F.count(F.lit(1))).scalar()
    points = (
        F.lit(100.0)
        - F.least(F.col("null_columns") * 5.0, F.lit(30.0))
        - F.least(F.col("duplicates") * 0.5, F.lit(10.0))
        - F.when(F.col("bad_ctr") > 0, 10.0).otherwise(0.0)
        - F.when(F.col("bad_roas") > 0, 10.0).otherwise(0.0)
    )
    grade = first_match(
        [
            (F.col("score") >= 90, "A (Excellent)"),
            (F.col("score") >= 80, "B (Good)"),
            (F.col("score") >= 70, "C (Fair)"),
        ],
        "D (Poor)",
    )
    return (
        wide.select(
            "rows", null_columns.alias("null_columns"), repeated.alias("duplicates"),
            "bad_ctr", "bad_roas",
        )
        .withColumn("score", F.greatest(points, F.lit(0.0)))
        .withColumn("grade", grade)
        .withColumn("status", F.when(F.col("score") >= 80, "PASS").otherwise("FAIL"))
    )


def quality_report(
    gold: DataFrame, run_ts: str, environment: str = "", version: str = ""
) -> DataFrame:
    """The score row with headline averages and the run it belongs to."""
    score = quality_score(gold)
    means = gold.agg(
        *[F.avg(c).alias(f"avg_{c}") for c in ("ctr", "roas", "conversion_rate", "engagement_score")]
    )
    extra = {c: means.select(c).scalar() for c in means.columns}
    return score.withColumns(
        {
            **extra,
            "checked_at": F.lit(run_ts).cast("timestamp"),
            "environment": F.lit(environment),
            "version": F.lit(version),
        }
    )


# ---- profiles ---------------------------------------------------------------------------------


def _known(c: str, allowed: Sequence[str]) -> Column:
    """Allowed in any letter case."""
    return F.lower(F.trim(F.col(c))).isin([a.lower() for a in allowed])


def _distinct_count(df: DataFrame, c: str, unexpected: Column) -> DataFrame:
    return (
        df.filter(F.col(c).isNotNull() & unexpected).select(c).distinct().agg(F.count(F.lit(1)).alias("v"))
    )


def catalog_profile(df: DataFrame) -> DataFrame:
    """Catalog checks as (check, value) rows."""
    cpc = parse_number("Cost_Per_Click", strip="$")
    length = parse_number("ad_video_length", suffix="s")
    title = F.initcap(F.trim("Ad_Type"))
    kind = first_match(
        [
            (title.contains("Vedeo") | title.startswith("Vid"), "Video"),
            (title.isin("Image", "Img"), "Image"),
            (title.isin("Carusel", "Carousel"), "Carousel"),
        ],
        title,
    )
    conditions = {
        f"null_{c}": F.col(c).isNull()
        for c in ("Ad_Category", "Ad_Device", "Ad_Location", "Cost_Per_Click", "Ad_Type")
    } | {
        "invalid_ad_id_format": ~F.col("Ad_Reference_ID").rlike(fixed.AD_ID),
        "cpc_negative": cpc < 0,
        "cpc_zero": cpc == 0,
        "cpc_parse_errors": cpc.isNull() & F.col("Cost_Per_Click").isNotNull(),
        "empty_locations": F.trim("Ad_Location") == "",
        "video_ads_with_invalid_length": (kind == "Video") & (length <= 0),
        "nonvideo_ads_with_positive_length": F.coalesce(kind != "Video", F.lit(True)) & (length > 0),
    }
    counts = tables.conditional_counts(df, {"total_rows": F.lit(True), **conditions})
    distinct = {
        "unknown_categories": _distinct_count(
            df, "Ad_Category", ~_known("Ad_Category", fixed.ALLOWED_CATEGORIES)
        ),
        "unknown_devices": _distinct_count(
            df, "Ad_Device", ~_known("Ad_Device", fixed.ALLOWED_CATALOG_DEVICES)
        ),
        "unknown_ad_types": _distinct_count(df, "Ad_Type", ~kind.isin(fixed.ALLOWED_AD_TYPES)),
        "duplicate_ad_ids": tables.duplicate_profile(df, ["Ad_Reference_ID"]).select(
            F.col("duplicate_rows").alias("v")
        ),
    }
    return _check_rows(counts, distinct)


def click_profile(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Click-log checks, references to the catalog included, as (check, value) rows."""
    ts = parse_timestamp(F.trim("Click_Timestamp"), fixed.PROFILE_TIMESTAMP_FORMATS)
    watch, years = F.col("Watch_Duration"), F.col("user_age")
    outside = (ts < F.lit("2026-01-01").cast("timestamp")) | (
        ts > F.lit("2027-12-31").cast("timestamp")
    )
    conditions = {
        f"null_{c}": F.col(c).isNull()
        for c in ("Ad_Type", "user_age", "device", "platform_source", "user_gender")
    } | {
        "empty_user_ids": F.trim("User_ID") == "",
        "invalid_uuid_format": ~F.col("User_ID").rlike(fixed.UUID),
        "timestamp_parse_errors": ts.isNull(),
        "timestamp_outside_range": outside,
        "watch_duration_negative": watch < 0,
        "watch_duration_zero": watch == 0,
        "watch_duration_extreme_outliers": watch > 1000,
        "watch_exactly_minus_12_5": watch == -12.5,
        "watch_exactly_999999": watch == 999999.0,
        "age_negative": years < 0,
        "age_above_65": years > 65,
        "age_exactly_minus_1": years == -1,
        "age_exactly_125": years == 125,
        "invalid_user_clicked": ~F.col("user_clicked").isin(0, 1),
    }
    counts = tables.conditional_counts(df, {"total_rows": F.lit(True), **conditions})
    expected = {
        "device": ("unknown_devices", F.nullif(F.trim("device"), F.lit("")), fixed.EXPECTED_CLICK_DEVICES),
        "platform_source": ("unknown_platforms", F.col("platform_source"), fixed.EXPECTED_PLATFORMS),
        "user_gender": ("unknown_genders", F.col("user_gender"), fixed.EXPECTED_GENDERS),
        "Ad_Type": ("unknown_ad_types", F.trim("Ad_Type"), fixed.EXPECTED_CLICK_AD_TYPES),
    }
    looked_at = {
        name: F.when(F.coalesce(~value.isin(allowed), F.lit(True)), F.col(c))
        for c, (name, value, allowed) in expected.items()
    } | {"unique_users": F.col("User_ID"), "ads": F.col("Ad_Reference_ID")}
    entries = F.array(*[
        F.struct(F.lit(name).alias("what"), value.cast("string").alias("seen")) for name, value in looked_at.items()
    ])
    # one grouping for all distinct counts, one row per value, stored for its two uses
    seen = stage(
        df.select(F.inline(entries)).groupBy("what", "seen").agg(F.count(F.lit(1)).alias("n")), "seen_values")
    known = catalog.select(F.col("Ad_Reference_ID").alias("_known")).distinct()
    ads = seen.filter("what = 'ads'").join(known, F.col("seen") == F.col("_known"), "left")
    missing = F.col("_known").isNull()
    found = ads.agg(
        F.count_if(~missing).alias("ad_ids_in_catalog"),
        F.count_if(missing).alias("ad_ids_not_in_catalog"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("rows_with_unmatched_ad_id"),
    )
    names = [n for n in looked_at if n != "ads"]
    distinct = seen.agg(*[F.count_if((F.col("what") == n) & F.col("seen").isNotNull()).alias(n) for n in names])
    duplicates = tables.duplicate_profile(df).select(F.col("duplicate_rows").alias("duplicate_rows"))
    return reduce(
        DataFrame.unionByName,
        [tables.long_form(x, "check", "value") for x in (counts, distinct, duplicates, found)],
    )


def _check_rows(counts: DataFrame, singles: Mapping[str, DataFrame]) -> DataFrame:
    parts = [tables.long_form(counts, "check", "value")]
    parts += [
        df.select(F.lit(name).alias("check"), F.col("v").cast("long").alias("value"))
        for name, df in singles.items()
    ]
    return reduce(DataFrame.unionByName, parts)
