"""Shared CTEs of the checking SQL.

Written as plain window and group SQL, on purpose in another way than the Spark
operators compute the same thing.
"""

from __future__ import annotations

import re

from adperf.sources import adapters


def _duck(sql: str) -> str:
    for spark_call, duck_call in adapters.DUCKDB_DATE_CALLS.items():
        sql = sql.replace(spark_call, duck_call)
    return sql


CTES: dict[str, str] = {
    "clicks": _duck(adapters.CLICKS_SQL),
    "catalog": _duck(adapters.CATALOG_SQL),
    "impressions": adapters.IMPRESSIONS_SQL,
    "click_cols": r"""
SELECT *,
  CASE WHEN regexp_matches(Click_Timestamp, '^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$')
         THEN try_strptime(Click_Timestamp, '%Y-%m-%d %H:%M:%S')
       WHEN regexp_matches(Click_Timestamp, '^\d{2}/\d{2}/\d{4} \d{2}:\d{2}$')
         THEN try_strptime(Click_Timestamp, '%d/%m/%Y %H:%M') END AS Click_Timestamp_Standard,
  CASE WHEN Ad_Type IS NULL THEN 'Unknown' WHEN Ad_Type IN ('video', 'Vedeo', 'vide') THEN 'Video'
       WHEN Ad_Type = 'IMAGE' THEN 'Image' WHEN Ad_Type = 'Carusel' THEN 'Carousel'
       ELSE Ad_Type END AS Ad_Type_Standard,
  CASE WHEN Watch_Duration < 0 THEN 0.0 WHEN Watch_Duration > 180 THEN 180.0
       ELSE Watch_Duration END AS Watch_Duration_Cleaned,
  CASE WHEN user_age < 18 THEN 25 WHEN user_age > 100 THEN 35 WHEN user_age IS NULL THEN 30
       ELSE user_age END AS user_age_cleaned,
  CASE WHEN device IS NULL OR device = '' THEN 'Unknown'
       WHEN regexp_replace(device, '^\d+\s+', '') IN ('DESKTOP', 'desktop') THEN 'Desktop'
       WHEN regexp_replace(device, '^\d+\s+', '') = 'moble' THEN 'Mobile'
       WHEN regexp_replace(device, '^\d+\s+', '') = 'tablet' THEN 'Tablet'
       ELSE regexp_replace(device, '^\d+\s+', '') END AS device_cleaned,
  CASE WHEN platform_source IS NULL THEN 'other' WHEN platform_source = 'gogle' THEN 'google'
       WHEN platform_source = 'facebok' THEN 'facebook' ELSE platform_source END
    AS platform_source_cleaned
FROM clicks""",
    "gender_pick": """
SELECT User_ID, user_gender AS typical FROM (
  SELECT User_ID, user_gender,
    row_number() OVER (PARTITION BY User_ID ORDER BY count(*) DESC, user_gender) AS rn
  FROM clicks WHERE user_gender IS NOT NULL GROUP BY User_ID, user_gender)
WHERE rn = 1""",
    "silver_clicks": """
SELECT c.Event_ID, c.User_ID, c.Click_Timestamp_Standard, c.Ad_Reference_ID, c.Ad_Type_Standard,
  c.Watch_Duration_Cleaned, c.user_age_cleaned, c.device_cleaned, c.platform_source_cleaned,
  coalesce(c.user_gender, g.typical, 'Other') AS user_gender_fixed,
  CASE WHEN c.user_clicked = 1 AND c.Watch_Duration_Cleaned = 0 THEN 0 ELSE c.user_clicked END
    AS user_clicked_cleaned,
  c.ingestion_date
FROM click_cols c LEFT JOIN gender_pick g ON c.User_ID = g.User_ID
QUALIFY row_number() OVER (
  PARTITION BY c.User_ID, c.Click_Timestamp_Standard, c.Ad_Reference_ID ORDER BY c.Event_ID) = 1""",
    "catalog_cols": r"""
SELECT *,
  CASE WHEN Ad_Type_Standard <> 'Video' AND seconds > 0 THEN 0.0 ELSE coalesce(seconds, 0.0) END
    AS ad_video_length_cleaned
FROM (
  SELECT *,
    CASE Ad_Category WHEN 'Eletronics' THEN 'Electronics' WHEN 'electronics' THEN 'Electronics'
      WHEN 'fashion' THEN 'Fashion' WHEN 'travel' THEN 'Travel' WHEN 'health' THEN 'Health'
      WHEN 'gaming' THEN 'Gaming' WHEN 'food' THEN 'Food' WHEN 'Corrupted_Category' THEN 'Unknown'
      ELSE coalesce(Ad_Category, 'Unknown') END AS Ad_Category_Standard,
    CASE WHEN Ad_Device IS NULL OR trim(Ad_Device) = '' THEN 'All-Devices'
      WHEN trim(Ad_Device) = 'moble' THEN 'Mobile' WHEN trim(Ad_Device) = 'DESKTOP' THEN 'Desktop'
      ELSE trim(Ad_Device) END AS Ad_Device_Cleaned,
    coalesce(trim(Ad_Location), 'Unknown') AS Ad_Location_Cleaned,
    CASE WHEN try_cast(replace(Cost_Per_Click, '$', '') AS DOUBLE) > 0
      THEN CAST(CAST(try_cast(replace(Cost_Per_Click, '$', '') AS DOUBLE) AS DECIMAL(10,2)) AS DOUBLE)
      ELSE 0.0 END AS Cost_Per_Click_Cleaned,
    CASE WHEN Ad_Type IS NULL THEN 'Unknown' WHEN Ad_Type IN ('video', 'Vedeo') THEN 'Video'
      WHEN Ad_Type = 'IMAGE' THEN 'Image' WHEN Ad_Type = 'Carusel' THEN 'Carousel'
      ELSE Ad_Type END AS Ad_Type_Standard,
    try_cast(regexp_replace(ad_video_length, 's$', '') AS DOUBLE) AS seconds
  FROM catalog)""",
    "silver_catalog": """
SELECT Ad_Reference_ID, Ad_Category_Standard, Ad_Device_Cleaned, Ad_Location_Cleaned,
  Cost_Per_Click_Cleaned, Ad_Type_Standard, ad_video_length_cleaned
FROM catalog_cols
QUALIFY row_number() OVER (PARTITION BY Ad_Reference_ID ORDER BY load_seq) = 1""",
    "joined": """
SELECT c.*, k.Ad_Category_Standard, k.Ad_Device_Cleaned, k.Ad_Location_Cleaned,
  k.Cost_Per_Click_Cleaned, k.Ad_Type_Standard AS Ad_Type_Catalog, k.ad_video_length_cleaned
FROM silver_clicks c JOIN silver_catalog k ON c.Ad_Reference_ID = k.Ad_Reference_ID""",
    "enriched": """
SELECT *,
  CASE WHEN is_converted = 1 THEN Cost_Per_Click_Cleaned * (5 + CAST((Event_ID * 104729) % 1000 AS DOUBLE) / 100)
    ELSE 0.0 END * user_clicked_cleaned AS total_revenue,
  Cost_Per_Click_Cleaned * user_clicked_cleaned AS total_cost,
  CASE WHEN Cost_Per_Click_Cleaned * user_clicked_cleaned > 0 AND is_converted = 1
    THEN Cost_Per_Click_Cleaned * (5 + CAST((Event_ID * 104729) % 1000 AS DOUBLE) / 100)
         / Cost_Per_Click_Cleaned ELSE 0.0 END AS return_on_ad_spend
FROM (
  SELECT *,
    CASE WHEN user_clicked_cleaned = 1 AND watch_duration_ratio > 0.5
      AND user_age_cleaned BETWEEN 25 AND 45 AND (Event_ID * 7919) % 100 < 30 THEN 1 ELSE 0 END
      AS is_converted,
    CASE WHEN watch_duration_ratio > 1 THEN 1.0 WHEN watch_duration_ratio < 0 THEN 0.0
      ELSE watch_duration_ratio END AS watch_duration_ratio_clipped
  FROM (
    SELECT *,
      hour(Click_Timestamp_Standard) AS hour_of_day,
      dayofweek(Click_Timestamp_Standard) + 1 AS day_of_week,
      month(Click_Timestamp_Standard) AS month,
      CASE WHEN dayofweek(Click_Timestamp_Standard) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
      CASE WHEN hour(Click_Timestamp_Standard) < 6 THEN 'Late_Night'
        WHEN hour(Click_Timestamp_Standard) < 12 THEN 'Morning'
        WHEN hour(Click_Timestamp_Standard) < 18 THEN 'Afternoon'
        WHEN hour(Click_Timestamp_Standard) < 22 THEN 'Evening_Prime'
        ELSE 'Late_Night' END AS time_of_day_category,
      CASE WHEN ad_video_length_cleaned > 0 THEN Watch_Duration_Cleaned / ad_video_length_cleaned
        ELSE 0.0 END AS watch_duration_ratio,
      CASE WHEN user_age_cleaned < 25 THEN '18-24' WHEN user_age_cleaned < 35 THEN '25-34'
        WHEN user_age_cleaned < 50 THEN '35-49' ELSE '50+' END AS age_category
    FROM joined))""",
    "scored": """
SELECT *,
  CASE WHEN category_performance_by_age > 0.7 THEN 0.95 WHEN category_performance_by_age > 0.4 THEN 0.6
    WHEN category_performance_by_age > 0.2 THEN 0.3 ELSE 0.1 END AS demographic_engagement_delta
FROM (
  SELECT *,
    avg(user_clicked_cleaned) OVER (PARTITION BY age_category, Ad_Category_Standard)
      AS category_performance_by_age,
    avg(return_on_ad_spend) OVER (PARTITION BY platform_source_cleaned) AS platform_avg_roas,
    sum(total_cost) OVER (PARTITION BY platform_source_cleaned) AS platform_total_spend,
    sum(total_revenue) OVER (PARTITION BY platform_source_cleaned) AS platform_total_revenue
  FROM enriched)""",
    "ad_modes": """
SELECT t.Ad_Reference_ID, t.v AS ad_type, p.v AS main_platform, d.v AS best_day, m.v AS month
FROM (SELECT Ad_Reference_ID, Ad_Type_Standard AS v FROM enriched GROUP BY Ad_Reference_ID, v
      QUALIFY row_number() OVER (PARTITION BY Ad_Reference_ID ORDER BY count(*) DESC, v) = 1) t
JOIN (SELECT Ad_Reference_ID, platform_source_cleaned AS v FROM enriched GROUP BY Ad_Reference_ID, v
      QUALIFY row_number() OVER (PARTITION BY Ad_Reference_ID ORDER BY count(*) DESC, v) = 1) p
  ON t.Ad_Reference_ID = p.Ad_Reference_ID
LEFT JOIN (SELECT Ad_Reference_ID, day_of_week AS v FROM enriched WHERE day_of_week IS NOT NULL GROUP BY Ad_Reference_ID, v
      QUALIFY row_number() OVER (PARTITION BY Ad_Reference_ID ORDER BY count(*) DESC, v) = 1) d
  ON t.Ad_Reference_ID = d.Ad_Reference_ID
LEFT JOIN (SELECT Ad_Reference_ID, month AS v FROM enriched WHERE month IS NOT NULL GROUP BY Ad_Reference_ID, v
      QUALIFY row_number() OVER (PARTITION BY Ad_Reference_ID ORDER BY count(*) DESC, v) = 1) m
  ON t.Ad_Reference_ID = m.Ad_Reference_ID""",
    "gold": """
SELECT *,
  avg_watch_ratio * ctr AS engagement_efficiency,
  CASE WHEN total_ad_spend > 0 THEN (total_revenue - total_ad_spend) / total_ad_spend ELSE 0.0 END
    AS profit_margin,
  CASE WHEN total_conversions > 0 THEN total_ad_spend / total_conversions ELSE 0.0 END
    AS cost_per_conversion,
  CASE WHEN roas > 2.0 THEN 1 ELSE 0 END AS high_performance,
  CASE WHEN cost_per_click > 0 THEN ctr * conversion_rate / cost_per_click ELSE 0.0 END
    AS cost_efficiency_score,
  avg_watch_ratio * 0.3 + ctr * 0.4 + conversion_rate * 0.3 AS engagement_score,
  avg_ded_score * category_age_affinity AS audience_alignment_score,
  CAST(date_diff('day', ingestion_date, DATE '2024-02-15') AS INT) AS ad_age_days,
  CASE WHEN date_diff('day', ingestion_date, DATE '2024-02-15') < 7 THEN 'New'
    WHEN date_diff('day', ingestion_date, DATE '2024-02-15') < 30 THEN 'Growing'
    WHEN date_diff('day', ingestion_date, DATE '2024-02-15') < 60 THEN 'Mature'
    ELSE 'Declining' END AS ad_lifecycle_stage,
  CASE WHEN ad_location IN ('Maharashtra', 'Delhi', 'Karnataka') THEN 'Urban'
    WHEN ad_location = 'Tamil Nadu' THEN 'Semi-Urban' ELSE 'Rural' END AS location_type,
  CASE WHEN month IN (12, 1, 2) THEN 'Winter' WHEN month IN (3, 4, 5) THEN 'Spring'
    WHEN month IN (6, 7, 8) THEN 'Summer' WHEN month IN (9, 10, 11) THEN 'Fall'
    ELSE 'Unknown' END AS season,
  DATE '2024-02-15' AS processing_date
FROM (
  SELECT g.*, m.ad_type, m.best_day, m.month, pf.platform_avg_roas, pf.platform_total_spend,
    pf.platform_total_revenue
  FROM (
    SELECT Ad_Reference_ID, min(Ad_Category_Standard) AS ad_category, min(Ad_Device_Cleaned) AS ad_device,
      min(Ad_Location_Cleaned) AS ad_location, min(Ad_Type_Catalog) AS ad_type_catalog,
      min(Cost_Per_Click_Cleaned) AS cost_per_click, min(ad_video_length_cleaned) AS ad_video_length,
      CAST(sum(user_clicked_cleaned) AS BIGINT) AS total_clicks, count(User_ID) AS total_impressions,
      sum(user_clicked_cleaned) / count(User_ID) AS ctr,
      avg(Watch_Duration_Cleaned) AS avg_watch_duration,
      sum(total_cost) AS total_ad_spend, sum(total_revenue) AS total_revenue,
      CASE WHEN sum(total_cost) > 0 THEN sum(total_revenue) / sum(total_cost) ELSE 0.0 END AS roas,
      CAST(sum(is_converted) AS BIGINT) AS total_conversions,
      CASE WHEN sum(user_clicked_cleaned) > 0 THEN sum(is_converted) / sum(user_clicked_cleaned)
        ELSE 0.0 END AS conversion_rate,
      sum(is_converted) / count(User_ID) AS overall_conversion_rate,
      avg(user_age_cleaned) AS avg_user_age, count(DISTINCT User_ID) AS unique_users,
      avg(watch_duration_ratio_clipped) AS avg_watch_ratio,
      avg(demographic_engagement_delta) AS avg_ded_score,
      avg(category_performance_by_age) AS category_age_affinity,
      list_sort(list(DISTINCT platform_source_cleaned)) AS platforms_used,
      list_sort(list(DISTINCT device_cleaned)) AS devices_used,
      list_sort(list(DISTINCT time_of_day_category)) AS active_time_slots,
      avg(hour_of_day) AS avg_hour, min(ingestion_date) AS ingestion_date
    FROM scored GROUP BY Ad_Reference_ID) g
  JOIN ad_modes m ON g.Ad_Reference_ID = m.Ad_Reference_ID
  JOIN (SELECT DISTINCT platform_source_cleaned, platform_avg_roas, platform_total_spend,
          platform_total_revenue FROM scored) pf ON pf.platform_source_cleaned = m.main_platform)""",
}


def _needed(sql: str) -> list[str]:
    """CTEs the text refers to, directly or through others, in definition order."""
    found: set[str] = set()
    queue = [sql]
    while queue:
        text = queue.pop()
        for name in CTES:
            if name not in found and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text, re.IGNORECASE):
                found.add(name)
                queue.append(CTES[name])
    return [name for name in CTES if name in found]


def steady_rounding(sql: str) -> str:
    """`round(x, n)` -> `round(x + 1e-9, n)` as on the Spark side.

    For results (6 places) and for aggregates shown with 2 or 3 places.
    """
    ends = []
    for match in re.finditer(r"\bround\(", sql):
        depth, j = 1, match.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[j], 0)
            j += 1
        inner = sql[match.end() : j]
        aggregate = "avg(" in inner or "sum(" in inner
        if inner.endswith(", 6)") or (aggregate and inner.endswith((", 2)", ", 3)"))):
            ends.append(j - len(", 6)"))
    for end in sorted(ends, reverse=True):
        sql = f"{sql[:end]} + 1e-9{sql[end:]}"
    return sql


def with_ctes(sql: str) -> str:
    sql = steady_rounding(sql.strip())
    parts = [f"{name} AS ({CTES[name].strip()})" for name in _needed(sql)]
    if not parts:
        return sql
    if sql[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(parts) + ",\n" + sql[5:]
    return "WITH " + ",\n".join(parts) + "\n" + sql
