"""Queries: dashboards, verification reports, budget and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from adperf.functions import fixed
from adperf.operators import budget, features, reports, scoring
from adperf.plans import layers
from adperf.plans.q_features import _CODES, _PRIMARY
from adperf.plans.registry import query

AD = "Ad_Reference_ID"
_AGE = """CASE WHEN avg_user_age <= 25 THEN '18-25' WHEN avg_user_age <= 35 THEN '26-35'
  WHEN avg_user_age <= 50 THEN '36-50' ELSE '50+' END"""
_DAY = """CASE best_day WHEN 1 THEN 'Sunday' WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday' WHEN 4 THEN 'Wednesday'
  WHEN 5 THEN 'Thursday' WHEN 6 THEN 'Friday' WHEN 7 THEN 'Saturday' END"""


def _r(expression: str, name: str, places: int = 6) -> str:
    return f"round({expression}, {places}) AS {name}"


_MONEY = f"{_r('sum(total_ad_spend)', 'total_ad_spend')}, {_r('sum(total_revenue)', 'total_revenue')}"


def report(name: str, sql: str):
    """Register a report over the gold table."""

    def wrap(fn):
        @query(name, sql)
        def _(spark, d):
            return fn(layers.gold(spark, d))

        return fn

    return wrap


# ---- headline -------------------------------------------------------------------------------


@report(
    "r1_owner_kpis",
    f"""SELECT {_MONEY}, {_r('sum(total_revenue) - sum(total_ad_spend)', 'profit')}, {_r('avg(roas)', 'avg_roas')},
      {_r('CASE WHEN sum(total_ad_spend) > 0 THEN sum(total_revenue) / sum(total_ad_spend) ELSE 0 END', 'blended_roas')},
      {_r('avg(high_performance) * 100', 'profitable_pct')} FROM gold""",
)
def _(gold):
    return reports.owner_kpis(gold)


@report(
    "r2_agency_kpis",
    f"""SELECT {_r('avg(ctr) * 100', 'avg_ctr_pct')}, {_r('avg(conversion_rate) * 100', 'avg_conversion_pct')},
      {_r('avg(cost_per_click)', 'avg_cpc')}, count(DISTINCT ad_category) AS categories FROM gold""",
)
def _(gold):
    return reports.agency_kpis(gold)


@report(
    "r3_format_revenue",
    f"""SELECT ad_type, {_r('sum(total_revenue)', 'total_revenue')}, {_r('avg(roas)', 'roas')},
      avg(roas) >= 2 AS profitable FROM gold GROUP BY 1""",
)
def _(gold):
    return reports.format_revenue(gold)


_GRAIN = """CASE WHEN (SELECT count(DISTINCT ingestion_date) FROM gold) <= 1 THEN CAST(CAST(round_even(avg_hour, 0) AS INT) AS VARCHAR)
  WHEN (SELECT count(DISTINCT ingestion_date) FROM gold) <= 31 THEN strftime(ingestion_date, '%d')
  ELSE strftime(ingestion_date, '%Y-%m') END"""


@report(
    "r4_trend",
    f"""WITH t AS (SELECT {_GRAIN} AS time_unit, total_revenue, total_ad_spend, roas FROM gold)
    SELECT time_unit, 'Revenue' AS metric, {_r('sum(total_revenue)', 'amount')} FROM t GROUP BY 1
    UNION ALL SELECT time_unit, 'Ad Spend', {_r('sum(total_ad_spend)', 'amount')} FROM t GROUP BY 1
    UNION ALL SELECT time_unit, 'ROAS', {_r('avg(roas)', 'amount')} FROM t GROUP BY 1""",
)
def _(gold):
    return reports.trend(gold)


@report(
    "r5_quick_insights",
    f"""WITH g AS (SELECT ad_category, sum(total_revenue) AS rev, avg(roas) AS roas FROM gold GROUP BY 1)
    SELECT (SELECT ad_category FROM g ORDER BY rev DESC, ad_category LIMIT 1) AS revenue_leader,
      (SELECT {_r('max(rev)', 'v')} FROM g) AS leader_revenue,
      (SELECT ad_category FROM g ORDER BY roas DESC, ad_category LIMIT 1) AS roas_leader,
      (SELECT {_r('max(roas)', 'v')} FROM g) AS leader_roas, {_r('avg(roas)', 'avg_roas')},
      {_r('sum(total_revenue)', 'total_revenue')}, count(DISTINCT ad_category) AS groups,
      {_r('avg(high_performance) * 100', 'profitable_pct')}, avg(roas) > 2 AS above_target FROM gold""",
)
def _(gold):
    return reports.quick_insights(gold)


_DEV = """SELECT ad_device, avg(ctr) * 100 AS ctr_pct FROM gold
  WHERE ad_device <> 'All-Devices' OR NOT EXISTS (SELECT 1 FROM gold WHERE ad_device <> 'All-Devices') GROUP BY 1"""
_SLOT = "SELECT round_even(avg_hour * 4, 0) / 4 AS slot, avg(ctr) * 100 AS ctr_pct FROM gold GROUP BY 1"
_PLAT = """SELECT platform, avg(roas) AS roas FROM (
  SELECT lower(trim(unnest(platforms_used))) AS platform, roas FROM gold) WHERE platform <> '' GROUP BY 1"""
_CONV = "SELECT ad_category, avg(conversion_rate) * 100 AS conversion_pct FROM gold GROUP BY 1"


def _ends(subject: str, metric: str) -> str:
    return f"""CASE WHEN {subject} = (SELECT {subject} FROM g ORDER BY {metric} DESC, {subject} LIMIT 1) THEN 'best'
      WHEN {subject} = (SELECT {subject} FROM g ORDER BY {metric} ASC, {subject} DESC LIMIT 1) THEN 'worst'
      ELSE 'middle' END AS label"""


@report(
    "r6_ctr_by_device",
    f"WITH g AS ({_DEV}) SELECT ad_device, {_r('ctr_pct', 'ctr_pct')}, {_ends('ad_device', 'g.ctr_pct')} FROM g",
)
def _(gold):
    return reports.ctr_by_device(gold)


_CLOCK = """CASE WHEN CAST(floor({m} / 60) AS INT) % 12 = 0 THEN '12' ELSE CAST(CAST(floor({m} / 60) AS INT) % 12 AS VARCHAR) END
  || ':' || lpad(CAST({m} % 60 AS VARCHAR), 2, '0') || ' ' || CASE WHEN CAST(floor({m} / 60) AS INT) % 24 < 12 THEN 'AM' ELSE 'PM' END"""


@report(
    "r7_ctr_by_quarter_hour",
    f"""WITH g AS ({_SLOT}) SELECT slot, {_r('ctr_pct', 'ctr_pct')}, {_ends('slot', 'g.ctr_pct')},
      {_CLOCK.format(m='CAST(slot * 60 AS INT)')} AS time_label FROM g""",
)
def _(gold):
    return reports.ctr_by_quarter_hour(gold)


@report("r8_roas_by_platform", f"SELECT platform, {_r('roas', 'roas')} FROM ({_PLAT})")
def _(gold):
    return reports.roas_by_platform(gold)


@report("r9_conversion_by_category", f"SELECT ad_category, {_r('conversion_pct', 'conversion_pct')} FROM ({_CONV})")
def _(gold):
    return reports.conversion_by_category(gold)


def _action(action: str, source: str, subject: str, metric: str, worst: bool = False) -> str:
    order = f"v ASC, {subject} DESC" if worst else f"v DESC, {subject}"
    text = f"CAST({subject} AS VARCHAR)"
    return f"""SELECT * FROM (SELECT '{action}' AS action, {text} AS subject, '{metric}' AS metric, round(v, 6) AS value
      FROM (SELECT {subject}, {metric} AS v FROM ({source})) ORDER BY {order} LIMIT 1)"""


@report(
    "r10_actions",
    " UNION ALL ".join(
        [
            _action("increase device budget", _DEV, "ad_device", "ctr_pct"),
            _action("reduce device spend", _DEV, "ad_device", "ctr_pct", worst=True),
            _action("run ads around", _SLOT, "slot", "ctr_pct"),
            _action("increase platform budget", _PLAT, "platform", "roas"),
            _action("invest in category", _CONV, "ad_category", "conversion_pct"),
        ]
    ),
)
def _(gold):
    return reports.actions(gold)


# ---- insights ---------------------------------------------------------------------------------


@report(
    "r11_ad_type_performance",
    f"""SELECT ad_type, {_r('avg(ctr) * 100', 'ctr_pct')}, {_r('avg(roas)', 'roas')}, count(Ad_Reference_ID) AS volume,
      avg(roas) >= 2 AS profitable FROM gold GROUP BY 1""",
)
def _(gold):
    return reports.ad_type_performance(gold)


@report(
    "r12_platform_performance",
    f"SELECT {_PRIMARY} AS platform, {_MONEY}, {_r('avg(roas)', 'roas')} FROM gold GROUP BY 1",
)
def _(gold):
    return reports.platform_performance(gold)


@report(
    "r13_age_category_usage",
    f"""SELECT ad_category, age_bracket, ads, round(ads / sum(ads) OVER (PARTITION BY ad_category) * 100, 2) AS share_pct
    FROM (SELECT ad_category, {_AGE} AS age_bracket, count(*) AS ads FROM gold GROUP BY 1, 2)""",
)
def _(gold):
    return reports.age_category_usage(gold)


@report(
    "r14_best_category_by_age",
    f"""SELECT age_group, ad_category, {_r('roas', 'roas')} FROM (
      SELECT {_AGE} AS age_group, ad_category, avg(roas) AS roas FROM gold GROUP BY 1, 2) g
    QUALIFY row_number() OVER (PARTITION BY age_group ORDER BY g.roas DESC, ad_category) = 1""",
)
def _(gold):
    return reports.best_category_by_age(gold)


@report(
    "r15_best_hour_by_age",
    f"""SELECT age_group, CAST(h AS BIGINT) AS hour_bin, {_CLOCK.format(m='(h * 60)')} AS clock, {_r('ctr * 100', 'ctr_pct')} FROM (
      SELECT {_AGE} AS age_group, CAST(round_even(avg_hour, 0) AS INT) AS h, avg(ctr) AS ctr FROM gold GROUP BY 1, 2) g
    QUALIFY row_number() OVER (PARTITION BY age_group ORDER BY g.ctr DESC, h) = 1""",
)
def _(gold):
    return reports.best_hour_by_age(gold)


@report(
    "r16_device_format_cells",
    f"""WITH c AS (SELECT ad_type, ad_device, avg(roas) AS roas FROM gold WHERE lower(ad_device) NOT LIKE '%all%' GROUP BY 1, 2)
    SELECT ad_type, ad_device, {_r('roas', 'roas')},
      CASE WHEN row_number() OVER (ORDER BY c.roas DESC, ad_type, ad_device) = 1 THEN 'best'
        WHEN c.roas >= 2.75 THEN 'strong' WHEN c.roas >= 2 THEN 'fair' ELSE 'weak' END AS band FROM c""",
)
def _(gold):
    return reports.device_format_cells(gold)


@report(
    "r16_device_format_matrix",
    """SELECT ad_type, """
    + ", ".join(
        f"round(avg(roas) FILTER (WHERE ad_device = '{x}'), 2) AS \"{x}\"" for x in ("Desktop", "Mobile", "Tablet")
    )
    + " FROM gold GROUP BY 1",
)
def _(gold):
    return reports.device_format_matrix(gold, ["Desktop", "Mobile", "Tablet"])


@report(
    "r17_weekday_performance",
    f"""WITH w AS (SELECT CAST(best_day AS BIGINT) AS best_day, {_DAY} AS day_name, round(avg(ctr) * 100, 2) AS ctr_pct,
        round(avg(roas), 2) AS roas FROM gold GROUP BY gold.best_day)
    SELECT *, best_day = (SELECT best_day FROM w ORDER BY ctr_pct DESC, best_day LIMIT 1) AS is_peak FROM w""",
)
def _(gold):
    return reports.weekday_performance(gold)


# ---- question contexts ---------------------------------------------------------------------------


@report(
    "r18_portfolio",
    f"""SELECT count(*) AS ads, {_MONEY}, {_r('avg(roas)', 'avg_roas')}, {_r('avg(ctr) * 100', 'avg_ctr_pct')},
      {_r('avg(cost_per_click)', 'avg_cpc')} FROM gold""",
)
def _(gold):
    return reports.portfolio(gold)


@report(
    "r19_category_comparison",
    f"""SELECT ad_category, count(*) AS ads, {_MONEY}, {_r('avg(roas)', 'avg_roas')},
      row_number() OVER (ORDER BY avg(roas) DESC, ad_category) AS rank
    FROM gold WHERE lower(ad_category) IN ('food', 'travel', 'gaming') GROUP BY 1""",
)
def _(gold):
    return reports.category_comparison(gold, ["food", "travel", "gaming"])


@report(
    "r19_category_focus",
    f"""SELECT count(*) AS ads, {_MONEY}, {_r('avg(roas)', 'avg_roas')} FROM gold
    WHERE lower(ad_category) IN ('food', 'travel')""",
)
def _(gold):
    return reports.category_focus(gold, ["food", "travel"])


@report(
    "r20_roas_by_time_slot",
    """SELECT time_slot, round(avg(roas), 2) AS avg_roas FROM (
      SELECT unnest(active_time_slots) AS time_slot, roas FROM gold) GROUP BY 1""",
)
def _(gold):
    return reports.roas_by_time_slot(gold)


@report(
    "r20_roas_by_weekday",
    f"SELECT coalesce({_DAY}, 'Weekday') AS day_name, round(avg(roas), 2) AS avg_roas FROM gold GROUP BY 1",
)
def _(gold):
    return reports.roas_by_weekday(gold)


_CAMPAIGN = f"Ad_Reference_ID, ad_category, ad_type, {_r('total_ad_spend', 'total_ad_spend')}, {_r('total_revenue', 'total_revenue')}, {_r('roas', 'roas')}"
_CAMPAIGN_COLUMNS = [AD, "ad_category", "ad_type", "total_ad_spend", "total_revenue", "roas"]


@report("r21_top_campaigns", f"SELECT {_CAMPAIGN} FROM gold ORDER BY gold.roas DESC, Ad_Reference_ID LIMIT 5")
def _(gold):
    return reports.top_campaigns(gold).select(*_CAMPAIGN_COLUMNS)


@report(
    "r21_top_campaigns_per_category",
    f"""SELECT {_CAMPAIGN} FROM gold
    QUALIFY row_number() OVER (PARTITION BY ad_category ORDER BY gold.roas DESC, Ad_Reference_ID) <= 2""",
)
def _(gold):
    return reports.top_campaigns_per_category(gold).select(*_CAMPAIGN_COLUMNS)


@report(
    "r22_waste",
    f"""WITH c AS (SELECT *, (SELECT count(*) FROM gold WHERE roas < 1.8) > 0 AS any_poor FROM gold)
    SELECT {_CAMPAIGN} FROM c WHERE NOT any_poor OR c.roas < 1.8
    ORDER BY CASE WHEN any_poor THEN -round(c.total_ad_spend, 6) ELSE round(c.roas, 6) END, Ad_Reference_ID LIMIT 8""",
)
def _(gold):
    return reports.waste(gold).select(*_CAMPAIGN_COLUMNS)


@report(
    "r22_waste_per_category",
    f"""WITH c AS (SELECT *, bool_or(roas < 1.8) OVER (PARTITION BY ad_category) AS any_poor FROM gold)
    SELECT {_CAMPAIGN} FROM c WHERE NOT any_poor OR c.roas < 1.8
    QUALIFY row_number() OVER (PARTITION BY ad_category
      ORDER BY CASE WHEN any_poor THEN -round(c.total_ad_spend, 6) ELSE round(c.roas, 6) END, Ad_Reference_ID) <= 2""",
)
def _(gold):
    return reports.waste_per_category(gold).select(*_CAMPAIGN_COLUMNS)


@report(
    "r23_expensive_clicks",
    f"""SELECT Ad_Reference_ID, ad_category, {_r('cost_per_click', 'cost_per_click')}, {_r('roas', 'roas')}
    FROM gold ORDER BY gold.cost_per_click DESC, Ad_Reference_ID LIMIT 5""",
)
def _(gold):
    return reports.expensive_clicks(gold).select(AD, "ad_category", "cost_per_click", "roas")


def _breakdown(group: str) -> str:
    return f"""SELECT {group}, round(avg(roas), 3) AS roas, round(sum(total_ad_spend), 3) AS total_ad_spend,
      round(sum(total_revenue), 3) AS total_revenue, round(avg(conversion_rate), 3) AS conversion_rate"""


def _best_per_category(subject: str, source: str = "gold") -> str:
    return f"""SELECT ad_category, {subject}, {_r('roas', 'roas')}, {_r('total_revenue', 'total_revenue')} FROM (
      SELECT ad_category, {subject}, avg(roas) AS roas, sum(total_revenue) AS total_revenue FROM {source} GROUP BY 1, 2) g
    QUALIFY row_number() OVER (PARTITION BY ad_category ORDER BY g.roas DESC, {subject}) = 1"""


@report("r24_device_breakdown", f"{_breakdown('ad_device')} FROM gold GROUP BY 1")
def _(gold):
    return reports.breakdown(gold, "ad_device")


@report("r24_best_device_per_category", _best_per_category("ad_device"))
def _(gold):
    return reports.best_per_category(gold, "ad_device")


_EXPLODED = "(SELECT *, lower(trim(unnest(platforms_used))) AS platform FROM gold)"


@report("r25_platform_breakdown", f"{_breakdown('platform')} FROM {_EXPLODED} GROUP BY 1")
def _(gold):
    return reports.breakdown(reports.with_platform(gold), "platform")


@report("r25_best_platform_per_category", _best_per_category("platform", _EXPLODED))
def _(gold):
    return reports.best_per_category(reports.with_platform(gold), "platform")


@report(
    "r26_top_locations",
    f"""SELECT ad_location, {_r('avg(roas)', 'roas')}, {_r('sum(total_revenue)', 'total_revenue')}
    FROM gold GROUP BY 1 ORDER BY avg(gold.roas) DESC, ad_location LIMIT 5""",
)
def _(gold):
    return reports.top_locations(gold)


@report("r27_format_breakdown", f"{_breakdown('ad_type')} FROM gold GROUP BY 1")
def _(gold):
    return reports.breakdown(gold, "ad_type")


# ---- verification -----------------------------------------------------------------------------------

_BASE = "count(*) AS ad_count, round(avg(ctr) * 100, 2) AS avg_ctr_pct, round(avg(roas), 2) AS avg_roas"
_EXTRA = {
    "avg_conversion_pct": "round(avg(conversion_rate) * 100, 2)",
    "winning_ads": "CAST(sum(high_performance) AS BIGINT)",
    "win_rate_pct": "round(avg(high_performance) * 100, 2)",
    "avg_engagement": "round(avg(engagement_score), 2)",
}


def _verify(group: str | None, extra=(), expression: str | None = None) -> str:
    columns = ", ".join([_BASE, *[f"{_EXTRA[e]} AS {e}" for e in extra]])
    if group is None:
        return f"SELECT {columns} FROM gold"
    return f"SELECT {expression or group} AS {group}, {columns} FROM gold GROUP BY {expression or group}"


_ALL = list(_EXTRA)


@report("r28_overall", _verify(None, _ALL))
def _(gold):
    return reports.verification(gold, None, _ALL)


@report("r28_by_category", _verify("ad_category", _ALL))
def _(gold):
    return reports.verification(gold, "ad_category", _ALL)


@report("r28_by_type", _verify("ad_type", ["avg_conversion_pct", "avg_engagement"]))
def _(gold):
    return reports.verification(gold, "ad_type", ["avg_conversion_pct", "avg_engagement"])


@report("r28_by_lifecycle", _verify("ad_lifecycle_stage"))
def _(gold):
    return reports.verification(gold, "ad_lifecycle_stage")


@report("r28_by_season", _verify("season"))
def _(gold):
    return reports.verification(gold, "season")


@report("r28_by_location_type", _verify("location_type"))
def _(gold):
    return reports.verification(gold, "location_type")


@report(
    "r28_by_efficiency",
    _verify(
        "efficiency_level",
        expression="""CASE WHEN cost_efficiency_score > 0.4 THEN 'Excellent (>0.4)' WHEN cost_efficiency_score > 0.25
      THEN 'Good (0.25-0.4)' WHEN cost_efficiency_score > 0.15 THEN 'Average (0.15-0.25)' ELSE 'Poor (<0.15)' END""",
    ),
)
def _(gold):
    return reports.verification(gold, reports.efficiency_band())


@report(
    "r28_by_engagement",
    _verify(
        "engagement_level",
        expression="""CASE WHEN engagement_score > 0.7 THEN 'High (>0.7)' WHEN engagement_score > 0.5
      THEN 'Medium (0.5-0.7)' ELSE 'Low (<0.5)' END""",
    ),
)
def _(gold):
    return reports.verification(gold, reports.engagement_band())


@report(
    "r28_one_line",
    """SELECT 'GOLD LAYER' AS layer, count(*) AS total_rows, CAST(CAST(round(avg(roas), 2) AS DECIMAL(5,2)) AS DOUBLE) AS avg_roas,
      CAST(CAST(round(avg(ctr) * 100, 2) AS DECIMAL(5,2)) AS DOUBLE) AS avg_ctr_pct,
      CAST(sum(high_performance) AS BIGINT) AS winning_ads FROM gold""",
)
def _(gold):
    return reports.one_line_summary(gold)


@report(
    "r29_low_ctr",
    f"""SELECT Ad_Reference_ID, total_impressions, {_r('ctr', 'ctr')} FROM gold WHERE gold.ctr < 0.35
    ORDER BY total_impressions DESC, Ad_Reference_ID LIMIT 10""",
)
def _(gold):
    return reports.low_ctr_high_impressions(gold, 0.35).select(AD, "total_impressions", "ctr")


@report(
    "r29_low_roas",
    f"""SELECT Ad_Reference_ID, {_r('total_ad_spend', 'total_ad_spend')}, {_r('roas', 'roas')} FROM gold WHERE gold.roas < 1.5
    ORDER BY round(gold.total_ad_spend, 6) DESC, Ad_Reference_ID LIMIT 10""",
)
def _(gold):
    return reports.low_roas_high_spend(gold).select(AD, "total_ad_spend", "roas")


@report(
    "r30_filter_options",
    """SELECT 'ad_category' AS filter, ad_category AS value, count(*) AS n FROM gold GROUP BY 2
    UNION ALL SELECT 'ad_device', ad_device, count(*) FROM gold WHERE ad_device <> 'All-Devices' GROUP BY 2""",
)
def _(gold):
    return reports.filter_options(gold)


# ---- budget -------------------------------------------------------------------------------------------

_BUDGET = 100000.0


def _allocate(group: str, source: str, baseline: str = "history", name: str | None = None) -> str:
    share = (
        "CASE WHEN sum(total_ad_spend) OVER () = 0 THEN 1.0 / count(*) OVER () ELSE total_ad_spend / sum(total_ad_spend) OVER () END"
        if baseline == "history"
        else "1.0::DOUBLE / count(*) OVER ()"
    )
    return f"""SELECT *, round_even(baseline_budget * roas, 2) AS baseline_return,
      round_even(recommended_budget * roas, 2) AS optimized_return FROM (
      SELECT *, round_even(spend_share * {_BUDGET}, 2) AS baseline_budget, round_even(weight * {_BUDGET}, 2) AS recommended_budget FROM (
        SELECT *, {share} AS spend_share,
          CASE WHEN sum(roas) OVER () = 0 THEN 1.0 / count(*) OVER () ELSE roas / sum(roas) OVER () END AS weight
        FROM (SELECT {group} AS {name or group}, sum(total_ad_spend) AS total_ad_spend, avg(roas) AS roas
          FROM {source} GROUP BY {group})))"""


def _rounded(sql: str, key: str) -> str:
    numbers = [
        "total_ad_spend", "roas", "spend_share", "weight", "baseline_budget", "recommended_budget",
        "baseline_return", "optimized_return",
    ]
    return f"SELECT {key}, {', '.join(_r(n, n) for n in numbers)} FROM ({sql})"


_CHANNEL = _allocate(_PRIMARY, "gold", name="platform")
_DEVICE = _allocate("ad_device", "(SELECT * FROM gold WHERE ad_device <> 'All-Devices')")
_TYPE = _allocate("ad_type", "gold")


@report("b1_allocate_channel", _rounded(_CHANNEL, "platform"))
def _(gold):
    return budget.channel_mix(gold, _BUDGET)


@report("b1_allocate_type", _rounded(_TYPE, "ad_type"))
def _(gold):
    return budget.type_mix(gold, _BUDGET)


@report("b2_allocate_equal", _rounded(_allocate("ad_category", "gold", "equal"), "ad_category"))
def _(gold):
    return budget.allocate(gold, "ad_category", _BUDGET, baseline="equal")


@report(
    "b3_target_mix",
    f"""WITH s AS (SELECT ad_type, sum(total_ad_spend) AS total_ad_spend, avg(roas) AS roas FROM gold GROUP BY 1),
      w AS (SELECT *, sum(total_ad_spend) OVER () AS total, avg(roas) OVER () AS mean_roas,
        total_ad_spend / sum(total_ad_spend) OVER () AS share FROM s),
      r AS (SELECT *, share * pow(roas / mean_roas, 2.5) AS raw FROM w),
      t AS (SELECT *, round_even(raw / sum(raw) OVER () * 100, 1) AS target_pct, round_even(share * 100, 1) AS current_pct,
        row_number() OVER (ORDER BY roas DESC, ad_type) AS best, row_number() OVER (ORDER BY roas, ad_type DESC) AS worst FROM r)
    SELECT ad_type, {_r('total_ad_spend', 'total_ad_spend')}, {_r('roas', 'roas')}, target_pct, current_pct,
      {_r('total * target_pct / 100', 'target_budget')}, {_r('total_ad_spend * roas', 'current_revenue')},
      {_r('total * target_pct / 100 * roas', 'predicted_revenue')},
      {_r('total * target_pct / 100 * roas - total_ad_spend * roas', 'revenue_lift')},
      CASE WHEN best = 1 THEN 'Scale Spend (Top Performer)' WHEN worst = 1 THEN 'Reduce & Reallocate Spend'
        WHEN t.roas >= mean_roas THEN 'Maintain & Optimize' ELSE 'Monitor Performance' END AS action FROM t""",
)
def _(gold):
    return budget.target_mix(gold)


def _mixes(gold):
    return {
        "channel": budget.channel_mix(gold, _BUDGET),
        "device": budget.device_mix(gold, _BUDGET),
        "type": budget.type_mix(gold, _BUDGET),
    }


@report(
    "b4_impact",
    f"""SELECT {_r('avg(b)', 'avg_baseline')}, {_r('avg(o)', 'avg_optimized')}, {_r('avg(o) - avg(b)', 'avg_uplift')},
      {_r('CASE WHEN avg(b) > 0 THEN (avg(o) - avg(b)) / avg(b) * 100 ELSE 0 END', 'lift_pct')} FROM (
      SELECT sum(baseline_return) AS b, sum(optimized_return) AS o FROM ({_CHANNEL})
      UNION ALL SELECT sum(baseline_return), sum(optimized_return) FROM ({_DEVICE})
      UNION ALL SELECT sum(baseline_return), sum(optimized_return) FROM ({_TYPE}))""",
)
def _(gold):
    return budget.impact(_mixes(gold))


@report(
    "b5_best_segments",
    " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{name}' AS mix, {key} AS segment, {_r('x.roas', 'roas')} FROM ({sql}) x ORDER BY x.roas DESC, {key} LIMIT 1)"
        for name, key, sql in (
            ("channel", "platform", _CHANNEL),
            ("device", "ad_device", _DEVICE),
            ("type", "ad_type", _TYPE),
        )
    ),
)
def _(gold):
    return budget.best_segments(_mixes(gold))


@report("b6_device_mix", _rounded(_DEVICE, "ad_device"))
def _(gold):
    return budget.device_mix(gold, _BUDGET)


# ---- forecasts ------------------------------------------------------------------------------------------


def _case(code: str, values) -> str:
    return "CASE " + code + " " + " ".join(f"WHEN {i} THEN {v}::DOUBLE" for i, v in enumerate(values)) + " END"


_LOC = _case("loc", fixed.LOCATION_FACTOR)
_VIDEO = """CASE WHEN typ <> 0 THEN 1.0::DOUBLE WHEN ad_video_length BETWEEN 10 AND 20 THEN 1.08::DOUBLE
  WHEN ad_video_length > 20 AND ad_video_length <= 30 THEN 1.03::DOUBLE WHEN ad_video_length > 30 THEN 0.90::DOUBLE ELSE 1.0::DOUBLE END"""
_AFF = "least(greatest(1.0::DOUBLE + (category_age_affinity - 0.05::DOUBLE) * 1.5::DOUBLE, 0.90::DOUBLE), 1.10::DOUBLE)"
_RISK = "least(greatest(1.02::DOUBLE - (avg_ded_score - 0.12::DOUBLE) * 0.7::DOUBLE, 0.92::DOUBLE), 1.05::DOUBLE)"


def _falling(start: float, slope: float, floor: float) -> str:
    return f"greatest({floor}::DOUBLE, {start}::DOUBLE - cost_per_click * {slope}::DOUBLE)"


def _limited(expression: str, low: float, high: float, places: int) -> str:
    return f"round(least(greatest({expression}, {low}::DOUBLE), {high}::DOUBLE), {places})"


def _heuristic_sql(source: str) -> str:
    cat = {m: _case("cat", f) for m, f in fixed.CATEGORY_BASE.items()}
    typ = {m: _case("typ", f) for m, f in fixed.TYPE_FACTOR.items()}
    dev = {m: _case("dev", f) for m, f in fixed.DEVICE_FACTOR.items()}
    cost = _falling(1.08, 0.10, 0.88)
    ctr = " * ".join([cat["ctr"], typ["ctr"], dev["ctr"], _LOC, cost, _VIDEO, _AFF, _RISK])
    conv = " * ".join([cat["conversion"], typ["conversion"], dev["conversion"], _LOC, cost, _AFF, _RISK])
    roas = " * ".join([cat["roas"], typ["roas"], dev["ctr"], _LOC, _falling(1.08, 0.12, 0.88), _AFF, _RISK])
    return f"""SELECT *, round(least(greatest((pred_roas - 1.4::DOUBLE) / 2.2::DOUBLE, 0.10::DOUBLE), 0.95::DOUBLE), 2) AS win_probability,
      CAST(CASE WHEN pred_roas >= 2.75 THEN 1 ELSE 0 END AS BIGINT) AS win_class FROM (
      SELECT *, {_limited(ctr, 0.008, 0.032, 4)} AS pred_ctr, {_limited(conv, 0.010, 0.050, 4)} AS pred_conversion,
        {_limited(roas, 1.40, 3.60, 2)} AS pred_roas FROM (SELECT *, {_CODES} FROM {source}))"""


@report(
    "l27_heuristic_scores",
    f"SELECT Ad_Reference_ID, pred_ctr, pred_conversion, pred_roas, win_probability, win_class FROM ({_heuristic_sql('gold')})",
)
def _(gold):
    return scoring.heuristic(features.code_numbers(gold)).select(
        AD, "pred_ctr", "pred_conversion", "pred_roas", "win_probability", "win_class"
    )


def _calibrated(metric: str, raw: str) -> str:
    cat = _case("cat", fixed.CATEGORY_FACTOR[metric])
    typ, dev = _case("typ", fixed.TYPE_FACTOR[metric]), _case("dev", fixed.DEVICE_FACTOR[metric])
    if metric == "roas":
        base = f"CASE WHEN {raw} > 20 THEN {raw} / 10 ELSE {raw} END"
        parts = [base, cat, typ, dev, _LOC, _falling(1.10, 0.15, 0.85), _AFF, _RISK]
        return _limited(" * ".join(parts), 1.10, 4.50, 2)
    (low, high), typical, (floor, top) = scoring.RATE_RULES[metric]
    rate = f"CASE WHEN {raw} > 0.5 THEN {raw} / 100 ELSE {raw} END"
    base = f"CASE WHEN {rate} BETWEEN {low} AND {high} THEN {rate} ELSE {typical}::DOUBLE END"
    parts = [base, cat, typ, dev, _LOC, _falling(1.08, 0.10, 0.88)]
    if metric == "ctr":
        parts.append(_VIDEO)
    return _limited(" * ".join([*parts, _AFF, _RISK]), floor, top, 4)


_CALIBRATED = f"""SELECT Ad_Reference_ID, {_calibrated('ctr', 'ctr')} AS ctr, {_calibrated('conversion', 'conversion_rate')} AS conversion,
  {_calibrated('roas', 'roas')} AS roas FROM (SELECT *, {_CODES} FROM gold)"""


def _calibrate(gold):
    coded = features.code_numbers(gold)
    return coded.select(
        AD,
        scoring.calibrate("ctr", "ctr").alias("ctr"),
        scoring.calibrate("conversion", "conversion_rate").alias("conversion"),
        scoring.calibrate("roas", "roas").alias("roas"),
    )


@report("l28_calibrated_scores", _CALIBRATED)
def _(gold):
    return _calibrate(gold)


@report(
    "l29_win_probability",
    f"""SELECT Ad_Reference_ID, round(least(greatest((roas - 1.2::DOUBLE) / 2.3::DOUBLE, 0.15::DOUBLE), 0.95::DOUBLE), 2) AS win_probability,
      CAST(CASE WHEN roas >= 2.75 THEN 1 ELSE 0 END AS BIGINT) AS win_class FROM ({_CALIBRATED})""",
)
def _(gold):
    return _calibrate(gold).select(
        AD, scoring.win_probability("roas").alias("win_probability"), scoring.win_class("roas").alias("win_class")
    )


_DECISION = """CASE WHEN pred_roas >= 2.95 THEN 'approve' WHEN pred_roas >= 2.75 THEN 'caution' ELSE 'hold' END AS decision,
  array_to_string(list_filter([CASE WHEN ad_type = 'Video' AND ad_video_length > 30 THEN 'shorten video' END,
    CASE WHEN cost_per_click > 1.5 THEN 'lower bid' END, CASE WHEN pred_ctr < 0.02 THEN 'change format' END,
    CASE WHEN pred_conversion * 100 < 2 THEN 'improve landing page' END], lambda x: x IS NOT NULL), ',') AS tips"""


@report("l30_decisions", f"SELECT Ad_Reference_ID, {_DECISION} FROM ({_heuristic_sql('gold')})")
def _(gold):
    scored = scoring.heuristic(features.code_numbers(gold))
    return scoring.decide(scored).select(AD, "decision", "tips")


_SCENARIO_SOURCE = """(SELECT g.* EXCLUDE (ad_type, ad_device), t.ad_type, v.ad_device FROM gold g,
  (SELECT unnest(['Video', 'Image', 'Text', 'Carousel']) AS ad_type) t,
  (SELECT unnest(['Mobile', 'Desktop', 'Tablet', 'All-Devices']) AS ad_device) v)"""


@report(
    "l31_scenarios",
    f"""SELECT Ad_Reference_ID, ad_type, ad_device, pred_ctr, pred_conversion, pred_roas, {_DECISION},
      round(5000 * pred_roas, 2) AS est_revenue, CAST(floor(5000 / 0.75::DOUBLE * pred_ctr) AS BIGINT) AS est_clicks
    FROM ({_heuristic_sql(_SCENARIO_SOURCE)})""",
)
def _(gold):
    options = {
        "ad_type": ["Video", "Image", "Text", "Carousel"],
        "ad_device": ["Mobile", "Desktop", "Tablet", "All-Devices"],
    }
    scored = scoring.spend_forecast(scoring.scenarios(gold, options), 5000.0)
    return scored.select(
        AD, "ad_type", "ad_device", "pred_ctr", "pred_conversion", "pred_roas", "decision", "tips",
        "est_revenue", "est_clicks",
    )
