"""Queries: cleaning rules, projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adperf.functions import expr, fixed
from adperf.operators import cleanse, features, tables
from adperf.plans import layers
from adperf.plans.registry import query

ID = "Event_ID"


# ---- cleaning -------------------------------------------------------------------------


@query(
    "c1_exact_dedup",
    """SELECT DISTINCT Event_ID, User_ID, Click_Timestamp, Ad_Reference_ID, Ad_Type,
      round(Watch_Duration, 6) AS Watch_Duration, CAST(user_age AS DOUBLE) AS user_age, device,
      platform_source, user_gender, CAST(user_clicked AS BIGINT) AS user_clicked,
      strftime(ingestion_date, '%Y-%m-%d') AS ingestion_date FROM clicks""",
)
def _(spark, d):
    """Exact-row de-duplication of the raw log."""
    distinct = cleanse.drop_exact_duplicates(layers.bronze_clicks(spark, d))
    return distinct.withColumn("user_age", F.col("user_age").cast("double"))


@query(
    "c2_timestamp_conform",
    """SELECT Event_ID, Click_Timestamp,
      strftime(Click_Timestamp_Standard, '%Y-%m-%d %H:%M:%S') AS parsed FROM click_cols""",
)
def _(spark, d):
    """Two text formats to one timestamp, anything else to null."""
    clicks = layers.bronze_clicks(spark, d)
    return clicks.select(ID, "Click_Timestamp", cleanse.timestamp().alias("parsed"))


@query("c3_click_ad_type", "SELECT Event_ID, Ad_Type, Ad_Type_Standard FROM click_cols")
def _(spark, d):
    """Ad-type spellings of the click log."""
    return layers.bronze_clicks(spark, d).select(
        ID, "Ad_Type", cleanse.click_ad_type().alias("Ad_Type_Standard")
    )


@query(
    "c4_watch_clamp",
    "SELECT Event_ID, round(Watch_Duration, 6) AS Watch_Duration, round(Watch_Duration_Cleaned, 6) AS cleaned FROM click_cols",
)
def _(spark, d):
    """Watch time limited to 0-180 seconds."""
    return layers.bronze_clicks(spark, d).select(
        ID, "Watch_Duration", cleanse.watch_duration().alias("cleaned")
    )


@query(
    "c5_age_repair",
    "SELECT Event_ID, CAST(user_age AS DOUBLE) AS user_age, CAST(user_age_cleaned AS BIGINT) AS cleaned FROM click_cols",
)
def _(spark, d):
    """Ages outside 18-100 and missing ages replaced by constants."""
    return layers.bronze_clicks(spark, d).select(
        ID, F.col("user_age").cast("double").alias("user_age"), cleanse.age().alias("cleaned")
    )


@query("c6_device_repair", "SELECT Event_ID, device, device_cleaned FROM click_cols")
def _(spark, d):
    """Leading age stripped from the device, spellings mapped, blanks Unknown."""
    return layers.bronze_clicks(spark, d).select(
        ID, "device", cleanse.click_device().alias("device_cleaned")
    )


@query(
    "c7_platform_conform",
    "SELECT Event_ID, platform_source, platform_source_cleaned FROM click_cols",
)
def _(spark, d):
    """Platform spellings, null to other."""
    return layers.bronze_clicks(spark, d).select(
        ID, "platform_source", cleanse.platform().alias("platform_source_cleaned")
    )


@query(
    "c8_gender_fill",
    """SELECT c.Event_ID, c.User_ID, coalesce(c.user_gender, g.typical, 'Other') AS user_gender_fixed
    FROM clicks c LEFT JOIN gender_pick g ON c.User_ID = g.User_ID""",
)
def _(spark, d):
    """Missing genders from the user's other events."""
    clicks = layers.bronze_clicks(spark, d).select(ID, "User_ID", "user_gender")
    return cleanse.fill_gender(clicks).select(ID, "User_ID", "user_gender_fixed")


@query(
    "c9_conflict_repair",
    """SELECT Event_ID, CAST(user_clicked AS BIGINT) AS user_clicked,
      CAST(CASE WHEN user_clicked = 1 AND Watch_Duration_Cleaned = 0 THEN 0 ELSE user_clicked END AS BIGINT)
        AS cleaned FROM click_cols""",
)
def _(spark, d):
    """A click with zero (clamped) watch time is no click."""
    cleaned = layers.bronze_clicks(spark, d).withColumn(
        "Watch_Duration_Cleaned", cleanse.watch_duration()
    )
    return cleaned.select(ID, "user_clicked", cleanse.clicked().alias("cleaned"))


@query(
    "c10_business_dedup",
    """SELECT Event_ID, User_ID, Ad_Reference_ID,
      strftime(Click_Timestamp_Standard, '%Y-%m-%d %H:%M:%S') AS ts FROM click_cols
    QUALIFY row_number() OVER (
      PARTITION BY User_ID, Click_Timestamp_Standard, Ad_Reference_ID ORDER BY Event_ID) = 1""",
)
def _(spark, d):
    """One row per user, parsed timestamp and ad."""
    parsed = layers.bronze_clicks(spark, d).withColumn(
        "Click_Timestamp_Standard", cleanse.timestamp()
    )
    kept = cleanse.drop_business_duplicates(parsed, cleanse.BUSINESS_KEY, [ID])
    return kept.select(
        ID, "User_ID", "Ad_Reference_ID", F.col("Click_Timestamp_Standard").alias("ts")
    )


@query(
    "c11_category_conform",
    "SELECT Ad_Reference_ID, CAST(load_seq AS BIGINT) AS load_seq, Ad_Category_Standard FROM catalog_cols",
)
def _(spark, d):
    """Category spellings."""
    return layers.bronze_catalog(spark, d).select(
        "Ad_Reference_ID", "load_seq", cleanse.category().alias("Ad_Category_Standard")
    )


@query(
    "c12_cpc_parse",
    """SELECT Ad_Reference_ID, CAST(load_seq AS BIGINT) AS load_seq, Cost_Per_Click,
      round(Cost_Per_Click_Cleaned, 6) AS cpc FROM catalog_cols""",
)
def _(spark, d):
    """Cost per click from text; unparsable and negative become 0."""
    return layers.bronze_catalog(spark, d).select(
        "Ad_Reference_ID", "load_seq", "Cost_Per_Click", cleanse.cost_per_click().alias("cpc")
    )


@query(
    "c13_catalog_device",
    "SELECT Ad_Reference_ID, CAST(load_seq AS BIGINT) AS load_seq, Ad_Device_Cleaned FROM catalog_cols",
)
def _(spark, d):
    """Target device: blanks and spellings."""
    return layers.bronze_catalog(spark, d).select(
        "Ad_Reference_ID", "load_seq", cleanse.catalog_device().alias("Ad_Device_Cleaned")
    )


@query(
    "c14_location_trim",
    "SELECT Ad_Reference_ID, CAST(load_seq AS BIGINT) AS load_seq, Ad_Location_Cleaned FROM catalog_cols",
)
def _(spark, d):
    """Location without outer blanks."""
    return layers.bronze_catalog(spark, d).select(
        "Ad_Reference_ID", "load_seq", cleanse.location().alias("Ad_Location_Cleaned")
    )


@query(
    "c15_catalog_ad_type",
    "SELECT Ad_Reference_ID, CAST(load_seq AS BIGINT) AS load_seq, Ad_Type_Standard FROM catalog_cols",
)
def _(spark, d):
    """Ad-type spellings of the catalog."""
    return layers.bronze_catalog(spark, d).select(
        "Ad_Reference_ID", "load_seq", cleanse.catalog_ad_type().alias("Ad_Type_Standard")
    )


@query(
    "c16_video_length",
    """SELECT Ad_Reference_ID, CAST(load_seq AS BIGINT) AS load_seq,
      round(ad_video_length_cleaned, 6) AS seconds FROM catalog_cols""",
)
def _(spark, d):
    """Video length in seconds; 0 for other ad types."""
    return (
        layers.bronze_catalog(spark, d)
        .withColumn("Ad_Type_Standard", cleanse.catalog_ad_type())
        .select("Ad_Reference_ID", "load_seq", cleanse.video_length().alias("seconds"))
    )


_SILVER_CATALOG_SQL = """SELECT Ad_Reference_ID, Ad_Category_Standard, Ad_Device_Cleaned,
  Ad_Location_Cleaned, round(Cost_Per_Click_Cleaned, 6) AS Cost_Per_Click_Cleaned,
  Ad_Type_Standard, round(ad_video_length_cleaned, 6) AS ad_video_length_cleaned FROM silver_catalog"""


@query("c17_catalog_latest", _SILVER_CATALOG_SQL)
def _(spark, d):
    """The conformed catalog: cleaned, one row per ad."""
    return layers.build_silver_catalog(spark, d)


@query(
    "c18_rows_accounting",
    """SELECT 'clicks' AS table_name, (SELECT count(*) FROM clicks) AS rows_in,
      (SELECT count(*) FROM silver_clicks) AS rows_out
    UNION ALL SELECT 'catalog', (SELECT count(*) FROM catalog), (SELECT count(*) FROM silver_catalog)""",
)
def _(spark, d):
    """Rows before and after cleaning."""
    return tables.rows_in_out(
        {
            "clicks": (layers.bronze_clicks(spark, d), layers.silver_clicks(spark, d)),
            "catalog": (layers.bronze_catalog(spark, d), layers.silver_catalog(spark, d)),
        }
    )


@query(
    "silver_clicks",
    """SELECT Event_ID, User_ID, strftime(Click_Timestamp_Standard, '%Y-%m-%d %H:%M:%S')
        AS Click_Timestamp_Standard, Ad_Reference_ID, Ad_Type_Standard,
      round(Watch_Duration_Cleaned, 6) AS Watch_Duration_Cleaned,
      CAST(user_age_cleaned AS BIGINT) AS user_age_cleaned, device_cleaned, platform_source_cleaned,
      user_gender_fixed, CAST(user_clicked_cleaned AS BIGINT) AS user_clicked_cleaned,
      strftime(ingestion_date, '%Y-%m-%d') AS ingestion_date FROM silver_clicks""",
)
def _(spark, d):
    """The conformed click table."""
    return layers.build_silver_clicks(spark, d)


# ---- projections and filters -------------------------------------------------------------


@query(
    "pf1_select_present",
    "SELECT Ad_Reference_ID, User_ID, Event_ID FROM clicks",
)
def _(spark, d):
    """The existing part of a wanted column list."""
    clicks = layers.bronze_clicks(spark, d)
    return clicks.select(expr.present(clicks, ["Ad_Reference_ID", "campaign", "User_ID", ID]))


@query(
    "pf2_rename_for_join",
    """SELECT Event_ID, c.Ad_Type_Standard AS click_type, k.Ad_Type_Standard AS Ad_Type_Catalog
    FROM silver_clicks c JOIN silver_catalog k ON c.Ad_Reference_ID = k.Ad_Reference_ID""",
)
def _(spark, d):
    """Rename one side before joining on a shared column name."""
    clicks = layers.silver_clicks(spark, d).select(
        ID, "Ad_Reference_ID", F.col("Ad_Type_Standard").alias("click_type")
    )
    catalog = layers.silver_catalog(spark, d).select("Ad_Reference_ID", "Ad_Type_Standard")
    return clicks.join(
        catalog.withColumnRenamed("Ad_Type_Standard", "Ad_Type_Catalog"), "Ad_Reference_ID"
    ).drop("Ad_Reference_ID")


@query(
    "pf3_add_replace_drop",
    """SELECT Event_ID, upper(User_ID) AS User_ID, 'CLEANED' AS status FROM clicks""",
)
def _(spark, d):
    """Literal column added, column replaced, columns dropped."""
    clicks = layers.bronze_clicks(spark, d)
    changed = clicks.withColumns({"status": F.lit("CLEANED"), "User_ID": F.upper("User_ID")})
    return changed.drop(*[c for c in clicks.columns if c not in (ID, "User_ID")])


@query(
    "pf4_first_match",
    """SELECT Event_ID, CASE WHEN Watch_Duration < 0 THEN 'negative' WHEN Watch_Duration = 0 THEN 'none'
      WHEN Watch_Duration > 1000 THEN 'overflow' WHEN user_age > 60 THEN 'senior' ELSE 'plain' END AS kind
    FROM clicks""",
)
def _(spark, d):
    """Multi-branch CASE; a null condition falls through."""
    watch = F.col("Watch_Duration")
    kind = expr.first_match(
        [
            (watch < 0, "negative"),
            (watch == 0, "none"),
            (watch > 1000, "overflow"),
            (F.col("user_age") > 60, "senior"),
        ],
        "plain",
    )
    return layers.bronze_clicks(spark, d).select(ID, kind.alias("kind"))


@query(
    "pf5_value_map",
    """SELECT platform_source_cleaned AS platform, count(*) AS n FROM click_cols GROUP BY ALL""",
)
def _(spark, d):
    """Spelling map with pass-through, counted per result."""
    mapped = layers.bronze_clicks(spark, d).select(
        expr.value_map("platform_source", fixed.PLATFORMS, missing="other").alias("platform")
    )
    return mapped.groupBy("platform").agg(F.count(F.lit(1)).alias("n"))


@query(
    "pf6_blank_to_label",
    "SELECT Ad_Reference_ID, CAST(load_seq AS BIGINT) AS load_seq, CASE WHEN Ad_Device IS NULL OR trim(Ad_Device) = '' THEN 'All-Devices' ELSE trim(Ad_Device) END AS device FROM catalog",
)
def _(spark, d):
    """Null and blank text to a default label."""
    return layers.bronze_catalog(spark, d).select(
        "Ad_Reference_ID", "load_seq", expr.blank_to("Ad_Device", fixed.ALL_DEVICES).alias("device")
    )


@query(
    "pf7_clamp",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      round(CASE WHEN l_quantity < 5 THEN 5 WHEN l_quantity > 40 THEN 40 ELSE l_quantity END, 6) AS q
    FROM (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem)""",
)
def _(spark, d):
    """Range clamp over the largest table."""
    return layers.adapters.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        expr.clamp("l_quantity", 5.0, 40.0).alias("q"),
    )


@query(
    "pf8_repair_range",
    """SELECT c_custkey, round(CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal > 9000 THEN 9000
      WHEN c_acctbal IS NULL THEN -1 ELSE c_acctbal END, 6) AS bal FROM customer""",
)
def _(spark, d):
    """Constants per side and for null."""
    return layers.adapters.table(spark, d, "customer").select(
        "c_custkey", expr.repair_range("c_acctbal", 0.0, 0.0, 9000.0, 9000.0, -1.0).alias("bal")
    )


@query(
    "pf9_regex_filter",
    r"SELECT Event_ID, Click_Timestamp FROM clicks WHERE regexp_matches(Click_Timestamp, '^\d{2}/\d{2}/\d{4} \d{2}:\d{2}$')",
)
def _(spark, d):
    """Rows whose timestamp has the slash format."""
    return layers.bronze_clicks(spark, d).select(ID, "Click_Timestamp").filter(
        expr.matches("Click_Timestamp", fixed.SLASH_TIMESTAMP)
    )


@query(
    "pf10_equality_filters",
    "SELECT Event_ID FROM clicks WHERE device IS NULL OR device = '' OR Click_Timestamp = '2035-12-25 12:00:00' OR user_gender <> 'Male'",
)
def _(spark, d):
    """Equality, inequality, null and empty tests."""
    return (
        layers.bronze_clicks(spark, d)
        .filter(
            F.col("device").isNull()
            | (F.col("device") == "")
            | (F.col("Click_Timestamp") == fixed.SENTINEL_FUTURE)
            | (F.col("user_gender") != "Male")
        )
        .select(ID)
    )


@query(
    "pf11_text_tests",
    """SELECT Ad_Reference_ID, CAST(load_seq AS BIGINT) AS load_seq, contains(Cost_Per_Click, '$') AS dollar,
      ends_with(Ad_Location, ' ') AS padded, lower(Ad_Category) = Ad_Category AS lowercase FROM catalog""",
)
def _(spark, d):
    """contains, endswith and a case test."""
    return layers.bronze_catalog(spark, d).select(
        "Ad_Reference_ID",
        "load_seq",
        F.col("Cost_Per_Click").contains("$").alias("dollar"),
        F.col("Ad_Location").endswith(" ").alias("padded"),
        (F.lower("Ad_Category") == F.col("Ad_Category")).alias("lowercase"),
    )


@query(
    "pf12_membership_filters",
    """SELECT Event_ID FROM clicks WHERE device IN ('moble', 'DESKTOP') AND user_clicked NOT IN (2, 3)
      AND user_age BETWEEN 25 AND 45 AND Click_Timestamp LIKE '%-%'
      AND NOT regexp_matches(Ad_Reference_ID, '^AD_9')""",
)
def _(spark, d):
    """isin, NOT IN, BETWEEN, LIKE and NOT RLIKE."""
    return (
        layers.bronze_clicks(spark, d)
        .filter(
            F.col("device").isin("moble", "DESKTOP")
            & ~F.col("user_clicked").isin(2, 3)
            & F.col("user_age").between(25, 45)
            & F.col("Click_Timestamp").like("%-%")
            & ~F.col("Ad_Reference_ID").rlike("^AD_9")
        )
        .select(ID)
    )


@query(
    "pf13_cross_column_conflict",
    """SELECT Ad_Reference_ID, CAST(load_seq AS BIGINT) AS load_seq, Ad_Type, ad_video_length FROM catalog
    WHERE Ad_Type <> 'Video' AND NOT (ad_video_length IN ('0', '0.0', '') OR ad_video_length IS NULL)""",
)
def _(spark, d):
    """Non-video ads with a video length."""
    length = F.col("ad_video_length")
    return (
        layers.bronze_catalog(spark, d)
        .filter((F.col("Ad_Type") != "Video") & ~(length.isin("0", "0.0", "") | length.isNull()))
        .select("Ad_Reference_ID", "load_seq", "Ad_Type", "ad_video_length")
    )


@query(
    "pf14_sql_text_condition",
    "SELECT Event_ID FROM clicks WHERE user_clicked = 1 AND Watch_Duration = 0",
)
def _(spark, d):
    """A rule condition given as SQL text."""
    condition = "user_clicked = 1 AND Watch_Duration = 0"
    return layers.bronze_clicks(spark, d).filter(F.expr(condition)).select(ID)


@query(
    "pf15_category_filter",
    "SELECT Ad_Reference_ID, ad_category, ad_device FROM gold WHERE ad_category IN ('Food', 'Travel') AND ad_device = 'Mobile'",
)
def _(spark, d):
    """Multi-value and scalar filters as a report receives them."""
    picked = tables.apply_filters(
        layers.gold(spark, d), {"ad_category": ["Food", "Travel"], "ad_device": "Mobile"}
    )
    return picked.select("Ad_Reference_ID", "ad_category", "ad_device")


@query(
    "pf16_coerce_number",
    "SELECT Ad_Reference_ID, CAST(load_seq AS BIGINT) AS load_seq, round(coalesce(try_cast(ad_video_length AS DOUBLE), 0), 6) AS v FROM catalog",
)
def _(spark, d):
    """Text to number, bad values 0."""
    return layers.bronze_catalog(spark, d).select(
        "Ad_Reference_ID", "load_seq", expr.coerce_number("ad_video_length").alias("v")
    )


@query(
    "pf17_fill_nulls",
    "SELECT Event_ID, CAST(coalesce(user_age, 0) AS BIGINT) AS user_age FROM clicks",
)
def _(spark, d):
    """Numeric nulls to 0."""
    return layers.bronze_clicks(spark, d).select(ID, "user_age").fillna(0)


@query(
    "pf18_keyword_search",
    """WITH hay AS (SELECT Ad_Reference_ID, ad_category, ad_location,
        lower(concat_ws(' ', Ad_Reference_ID, ad_category, ad_location)) AS t FROM gold),
      hit AS (SELECT *, CASE WHEN contains(t, 'food') OR contains(t, 'delhi') THEN 0 ELSE 1 END AS miss FROM hay)
    SELECT Ad_Reference_ID, ad_category, ad_location FROM hit
    WHERE miss = (SELECT min(miss) FROM hit) ORDER BY Ad_Reference_ID LIMIT 5""",
)
def _(spark, d):
    """First five rows holding a word of the question, else the first five rows."""
    columns = ["Ad_Reference_ID", "ad_category", "ad_location"]
    return tables.keyword_search(
        layers.gold(spark, d).select(*columns), "ads for food in Delhi", "Ad_Reference_ID"
    )


@query(
    "pf19_positive_target",
    "SELECT Ad_Reference_ID, round(roas, 6) AS roas FROM gold WHERE roas > 0",
)
def _(spark, d):
    """Rows whose target is positive."""
    return layers.gold(spark, d).filter(F.col("roas") > 0).select("Ad_Reference_ID", "roas")


# ---- scalar functions -----------------------------------------------------------------------


@query(
    "f1_text_case",
    """SELECT Ad_Reference_ID, CAST(load_seq AS BIGINT) AS load_seq, lower(Ad_Category) AS low,
      trim(Ad_Device) AS trimmed,
      list_aggregate(list_transform(string_split(lower(Ad_Location), ' '),
        lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), 'string_agg', ' ') AS title,
      upper(substr(Ad_Location, 1, 1)) || lower(substr(Ad_Location, 2)) AS capital FROM catalog""",
)
def _(spark, d):
    """lower, trim, title case, capitalise."""
    return layers.bronze_catalog(spark, d).select(
        "Ad_Reference_ID",
        "load_seq",
        F.lower("Ad_Category").alias("low"),
        F.trim("Ad_Device").alias("trimmed"),
        F.initcap("Ad_Location").alias("title"),
        expr.capitalise("Ad_Location").alias("capital"),
    )


@query(
    "f2_strip_leading_age",
    r"SELECT Event_ID, regexp_extract(device, '^\d+\s+(\w+)', 1) AS inner_device FROM clicks WHERE regexp_matches(device, '^\d+\s+')",
)
def _(spark, d):
    """Device behind a leading age."""
    return (
        layers.bronze_clicks(spark, d)
        .filter(expr.matches("device", fixed.LEADING_AGE))
        .select(ID, expr.strip_leading_age("device").alias("inner_device"))
    )


@query(
    "f3_strip_currency",
    "SELECT Ad_Reference_ID, CAST(load_seq AS BIGINT) AS load_seq, replace(Cost_Per_Click, '$', '') AS bare FROM catalog",
)
def _(spark, d):
    """Currency sign removed."""
    return layers.bronze_catalog(spark, d).select(
        "Ad_Reference_ID",
        "load_seq",
        F.regexp_replace("Cost_Per_Click", r"\$", "").alias("bare"),
    )


@query(
    "f4_first_token",
    "SELECT o_orderkey, split_part(o_orderpriority, ' ', 1) AS token FROM orders",
)
def _(spark, d):
    """First token of a label."""
    return layers.adapters.table(spark, d, "orders").select(
        "o_orderkey", expr.first_token("o_orderpriority").alias("token")
    )


@query(
    "f5_pattern_validators",
    """SELECT Event_ID, regexp_matches(Ad_Reference_ID, '^AD_[0-9]{6}$') AS ad_id_ok,
      regexp_matches(User_ID, '^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$', 'i') AS uuid_ok
    FROM clicks""",
)
def _(spark, d):
    """Ad-id and UUID formats."""
    return layers.bronze_clicks(spark, d).select(
        ID,
        expr.matches("Ad_Reference_ID", fixed.AD_ID).alias("ad_id_ok"),
        expr.matches("User_ID", fixed.UUID).alias("uuid_ok"),
    )


@query(
    "f6_parse_numbers",
    """SELECT Ad_Reference_ID, CAST(load_seq AS BIGINT) AS load_seq,
      round(try_cast(replace(Cost_Per_Click, '$', '') AS DOUBLE), 6) AS cpc,
      round(try_cast(regexp_replace(ad_video_length, 's$', '') AS DOUBLE), 6) AS seconds FROM catalog""",
)
def _(spark, d):
    """Numbers with currency sign or unit."""
    return layers.bronze_catalog(spark, d).select(
        "Ad_Reference_ID",
        "load_seq",
        expr.parse_number("Cost_Per_Click", strip="$").alias("cpc"),
        expr.parse_number("ad_video_length", suffix="s").alias("seconds"),
    )


@query(
    "f7_parse_timestamps",
    """SELECT Event_ID, strftime(coalesce(try_strptime(Click_Timestamp, '%Y-%m-%d %H:%M:%S'),
      try_strptime(Click_Timestamp, '%d/%m/%Y %H:%M'), try_strptime(Click_Timestamp, '%Y-%m-%d %H:%M')),
      '%Y-%m-%d %H:%M:%S') AS ts FROM clicks""",
)
def _(spark, d):
    """Three timestamp formats."""
    parsed = expr.parse_timestamp("Click_Timestamp", fixed.PROFILE_TIMESTAMP_FORMATS)
    return layers.bronze_clicks(spark, d).select(ID, parsed.alias("ts"))


@query(
    "f8_date_parts",
    """SELECT event_id, hour(ts) AS h, dayofweek(ts) + 1 AS dow, month(ts) AS m, year(ts) AS y,
      day(ts) AS dom FROM events""",
)
def _(spark, d):
    """hour, weekday, month, year, day of month."""
    ts = "ts"
    return layers.adapters.table(spark, d, "events").select(
        "event_id",
        F.hour(ts).alias("h"),
        F.dayofweek(ts).alias("dow"),
        F.month(ts).alias("m"),
        F.year(ts).alias("y"),
        F.dayofmonth(ts).alias("dom"),
    )


@query(
    "f9_seconds_between",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
      CAST(epoch(l_shipdate) - epoch(o_orderdate) AS BIGINT) AS seconds
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _(spark, d):
    """Seconds between two timestamps."""
    lineitem = layers.adapters.table(spark, d, "lineitem")
    orders = layers.adapters.table(spark, d, "orders")
    seconds = F.unix_timestamp(F.col("l_shipdate").cast("timestamp")) - F.unix_timestamp(
        F.col("o_orderdate").cast("timestamp")
    )
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", seconds.alias("seconds")
    )


@query(
    "f10_days_since",
    "SELECT event_id, date_diff('day', CAST(ts AS DATE), DATE '2024-02-15') AS days FROM events",
)
def _(spark, d):
    """Days from a date to the as-of date."""
    as_of = F.to_date(F.lit(layers.AS_OF))
    return layers.adapters.table(spark, d, "events").select(
        "event_id", F.date_diff(as_of, F.col("ts").cast("date")).alias("days")
    )


@query(
    "f11_run_time_columns",
    "SELECT Event_ID, '2024-02-15 06:00:00' AS run_ts, '2024-02-15' AS run_date FROM clicks",
)
def _(spark, d):
    """Run time as a parameter in place of the clock."""
    run_ts = F.lit("2024-02-15 06:00:00").cast("timestamp")
    return layers.bronze_clicks(spark, d).select(
        ID, run_ts.alias("run_ts"), run_ts.cast("date").alias("run_date")
    )


@query(
    "f12_date_labels",
    """SELECT event_id, strftime(ts, '%d') AS dom, strftime(ts, '%Y-%m') AS ym,
      CASE WHEN hour(ts) % 12 = 0 THEN '12' ELSE CAST(hour(ts) % 12 AS VARCHAR) END || ':00 '
        || CASE WHEN hour(ts) < 12 THEN 'AM' ELSE 'PM' END AS clock FROM events""",
)
def _(spark, d):
    """Day, month and clock labels."""
    return layers.adapters.table(spark, d, "events").select(
        "event_id",
        F.date_format("ts", "dd").alias("dom"),
        F.date_format("ts", "yyyy-MM").alias("ym"),
        expr.clock_label(F.hour("ts")).alias("clock"),
    )


@query(
    "f13_casts",
    """SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS as_text, CAST(p_size AS DOUBLE) AS as_double,
      CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS as_decimal FROM part""",
)
def _(spark, d):
    """Casts to text, double and decimal."""
    return layers.adapters.table(spark, d, "part").select(
        "p_partkey",
        F.col("p_partkey").cast("string").alias("as_text"),
        F.col("p_size").cast("double").alias("as_double"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("as_decimal"),
    )


@query(
    "f14_math",
    """SELECT c_custkey, round(c_acctbal, 0) AS r0, abs(c_acctbal) AS a,
      round(pow(abs(c_acctbal) / 1000, 2.5), 6) AS p, round(least(greatest(c_acctbal, 0), 5000), 6) AS clipped
    FROM customer""",
)
def _(spark, d):
    """round, abs, power and clip."""
    bal = F.col("c_acctbal")
    return layers.adapters.table(spark, d, "customer").select(
        "c_custkey",
        F.round(bal, 0).alias("r0"),
        F.abs(bal).alias("a"),
        F.pow(F.abs(bal) / 1000, F.lit(2.5)).alias("p"),
        expr.clip(bal, 0.0, 5000.0).alias("clipped"),
    )


@query(
    "f15_key_draw",
    "SELECT event_id, (event_id * 7919) % 100 AS draw FROM events",
)
def _(spark, d):
    """Repeatable pseudo-random draw from a key."""
    return layers.adapters.table(spark, d, "events").select(
        "event_id", expr.key_draw("event_id", fixed.CONVERSION_DRAW).alias("draw")
    )


@query(
    "f16_array_first_explode",
    """SELECT Ad_Reference_ID, platforms_used[1] AS first_platform, unnest(platforms_used) AS platform FROM gold""",
)
def _(spark, d):
    """Primary element of an array, and one row per element."""
    return layers.gold(spark, d).select(
        "Ad_Reference_ID",
        expr.primary_element("platforms_used").alias("first_platform"),
        F.explode_outer("platforms_used").alias("platform"),
    )


@query(
    "f17_display_formats",
    """SELECT Ad_Reference_ID, '$' || format('{:,.2f}', spend) AS spend, format('{:,.2f}', ctr * 100) || '%' AS ctr,
      format('{:,.2f}', roas) || 'x' AS roas,
      CASE WHEN profit < 0 THEN '-' ELSE '+' END || '$' || format('{:,.2f}', abs(profit)) AS profit
    FROM (SELECT Ad_Reference_ID, round(total_ad_spend + 1e-9, 4) AS spend, round(ctr + 1e-9, 4) AS ctr,
        round(roas + 1e-9, 4) AS roas, round(total_revenue - total_ad_spend + 1e-9, 4) AS profit FROM gold)""",
)
def _(spark, d):
    """Money, percent, multiple and signed amounts as text."""
    figures = {
        "spend": F.col("total_ad_spend"),
        "ctr": F.col("ctr"),
        "roas": F.col("roas"),
        "profit": F.col("total_revenue") - F.col("total_ad_spend"),
    }
    rows = layers.gold(spark, d).select(
        "Ad_Reference_ID", *[expr.shown(c, 4).alias(n) for n, c in figures.items()]
    )
    return rows.select(
        "Ad_Reference_ID",
        expr.money("spend").alias("spend"),
        expr.percent("ctr").alias("ctr"),
        expr.multiple("roas").alias("roas"),
        expr.signed_money("profit", 2).alias("profit"),
    )
