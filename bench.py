"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR  directory with the tables (default /root/testdata/sf0.1)
BENCH_CPUS    cores of the local session (default 8)
BENCH_COMPARE also time two pairs of alternatives, reported apart

The conformed and gold layers are built first and timed under their own names;
reports then read the stored layers, as they do in a scheduled run.  Results are
computed in full and thrown away (noop sink).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from adperf.operators import quality, tables, windows  # noqa: E402
from adperf.plans import catalogue, layers  # noqa: E402
from adperf.session import local_session  # noqa: E402
from adperf.sources.adapters import impressions  # noqa: E402

HEADLINE = [
    "silver_clicks",
    "a6_ad_rollup",
    "a6_volume_rollup",
    "q4_anomaly_report",
    "q17_click_profile",
    "w1_user_totals_volume",
    "w6_sessionize",
    "w6_sessionize_volume",
    "w4_platform_totals",
    "c1_exact_dedup",
    "s3_key_dedup",
    "a15_median_volume",
    "a16_correlation_matrix",
    "l18_auc_distinct_scores",
    "r1_owner_kpis",
    "r4_trend",
    "r28_by_category",
    "r22_waste_per_category",
    "b4_impact",
    "l31_scenarios",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return round(time.perf_counter() - start, 3)


def compare(spark, sf_dir: str) -> dict[str, float]:
    clicks = layers.bronze_clicks(spark, sf_dir)
    conditions = {r.name: r.condition for r in quality.CLICK_ANOMALIES if r.kind == "condition"}
    rows = impressions(spark, sf_dir).select("platform_source_cleaned", "order_value")
    w = Window.partitionBy("platform_source_cleaned")
    return {
        "rules_one_pass": timed(lambda: run(tables.conditional_counts(clicks, conditions))),
        "rules_one_job_each": timed(
            lambda: [clicks.filter(c).count() for c in conditions.values()]
        ),
        "platform_stats_window": timed(
            lambda: run(rows.withColumn("s", F.sum("order_value").over(w)))
        ),
        "platform_stats_aggregate_join": timed(
            lambda: run(
                windows.group_stats_onto_rows(
                    rows, ["platform_source_cleaned"], {"s": F.sum("order_value")}
                )
            )
        ),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    run(catalogue.QUERIES["a1_row_count"](spark, sf_dir))  # start the session

    seconds = {
        "build_silver_clicks": timed(lambda: layers.silver_clicks(spark, sf_dir)),
        "build_silver_catalog": timed(lambda: layers.silver_catalog(spark, sf_dir)),
        "build_gold": timed(lambda: layers.gold(spark, sf_dir)),
    }
    for name in HEADLINE:
        seconds[name] = timed(lambda: run(catalogue.QUERIES[name](spark, sf_dir)))
    result = {
        "metric": "adperf_headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    if os.environ.get("BENCH_COMPARE"):
        result["comparisons"] = compare(spark, sf_dir)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
