"""One batch: raw files to bronze, silver and gold tables, with audit, quality and export.

Each step reads the tables the step before has written, so a step can be run
again on its own after a failure.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adperf.operators import cleanse, quality, rollup
from adperf.session import configure
from adperf.sources import io, schemas


@dataclass(frozen=True)
class Names:
    """Table names of one installation."""

    schema: str

    def __getattr__(self, table: str) -> str:
        return f"{self.schema}.{table}"


def ingest(spark: SparkSession, clicks: DataFrame, catalog: DataFrame, names: Names, run: io.Run, sources=("clicks", "catalog")) -> None:
    """Raw frames with audit columns to bronze tables partitioned by ingestion date."""
    for df, table, source in ((clicks, names.bronze_clicks, sources[0]), (catalog, names.bronze_catalog, sources[1])):
        audited = io.with_ingestion_audit(io.require_rows(df), run, source)
        io.write_table(audited, table, partition_by=["ingestion_date"], evolve=True)


def inspect(spark: SparkSession, names: Names, run: io.Run) -> DataFrame:
    """Anomaly report of the bronze tables, stored and returned."""
    frames = {
        "clicks": io.read_table(spark, names.bronze_clicks).select(*_columns(schemas.RAW_CLICKS)),
        "catalog": io.read_table(spark, names.bronze_catalog).select(*_columns(schemas.RAW_CATALOG)),
    }
    report = quality.anomaly_report(frames, batch_id=run.batch_id, environment=run.environment)
    io.write_table(report, names.anomaly_report)
    return spark.table(names.anomaly_report)


def clean(spark: SparkSession, names: Names, run: io.Run, tiebreak: Sequence[str] = ()) -> None:
    """Bronze to silver tables."""
    clicks = cleanse.clean_clicks(io.read_table(spark, names.bronze_clicks), tiebreak, tiebreak)
    catalog = cleanse.clean_catalog(io.read_table(spark, names.bronze_catalog))
    io.write_table(
        io.with_processing_audit(clicks, run), names.silver_clicks, partition_by=["ingestion_date"]
    )
    io.write_table(io.with_processing_audit(catalog, run), names.silver_catalog)


def summarise(spark: SparkSession, names: Names, run: io.Run, draw_key: str | None = None) -> None:
    """Silver to the gold table, partitioned by category."""
    gold = rollup.ad_performance(
        io.read_table(spark, names.silver_clicks),
        io.read_table(spark, names.silver_catalog),
        as_of=run.run_ts[:10],
        draw_key=draw_key,
    )
    io.write_table(gold, names.fact_ad_performance, partition_by=["ad_category"])


def verify(spark: SparkSession, names: Names, run: io.Run) -> DataFrame:
    """Checks of the silver and gold tables; the score is stored."""
    gold = io.read_table(spark, names.fact_ad_performance)
    score = quality.quality_report(gold, run.run_ts, run.environment, run.version)
    io.append_log(score, names.gold_quality_report)
    frames = {
        "silver_clicks": spark.table(names.silver_clicks),
        "silver_catalog": spark.table(names.silver_catalog),
    }
    report = quality.run_rules(frames, quality.RESIDUAL_RULES + quality.SILVER_RULES)
    io.write_table(report, names.silver_quality_report)
    report = spark.table(names.silver_quality_report)
    quality.enforce(report)
    return report


def export(spark: SparkSession, names: Names, path: str, run: io.Run) -> DataFrame:
    """The gold table to dated parquet, read back and compared."""
    gold = io.read_table(spark, names.fact_ad_performance)
    io.export_partitioned(gold, path, "processing_date", run)
    outcome = io.reconcile(gold, io.read_parquet(spark, path), io.EXPORT_COLUMNS)
    io.append_log(
        outcome.withColumns({"path": F.lit(path), "batch_id": F.lit(run.batch_id)}), names.export_log
    )
    return outcome


def run_batch(
    spark: SparkSession,
    clicks: DataFrame,
    catalog: DataFrame,
    schema: str,
    run: io.Run,
    draw_key: str | None = None,
    export_path: str | None = None,
) -> None:
    """All steps; every step is one row of the batch log, a failed one with its reason before it raises.

    `draw_key` names a unique integer id of the click log, if it has one.
    """
    configure(spark)
    io.create_schema(spark, schema)
    names = Names(schema)
    steps = [
        ("bronze", names.bronze_clicks, lambda: ingest(spark, clicks, catalog, names, run)),
        ("anomalies", names.anomaly_report, lambda: inspect(spark, names, run)),
        ("silver", names.silver_clicks, lambda: clean(spark, names, run, (draw_key,) if draw_key else ())),
        ("gold", names.fact_ad_performance, lambda: summarise(spark, names, run, draw_key)),
        ("checks", names.silver_quality_report, lambda: verify(spark, names, run)),
    ]
    if export_path:
        steps.append(("export", names.export_log, lambda: export(spark, names, export_path, run)))
    for layer, table, step in steps:
        started = datetime.now()
        entry = {"batch_id": run.batch_id, "layer": layer, "table_name": table, "started_at": started, "environment": run.environment}
        try:
            step()
        except Exception as e:
            reason = f"{type(e).__name__}: {e}".splitlines()[0]
            io.log_run(spark, names.batch_log, **entry, finished_at=datetime.now(), status="FAILED", message=reason)
            io.log_version(
                spark, names.version_history, version_id=run.version, deployed_at=datetime.now(),
                description="Gold run", status="FAILED", environment=run.environment, git_commit=run.commit,
            )
            raise
        io.log_run(spark, names.batch_log, **entry, finished_at=datetime.now(), status="SUCCESS")
    io.log_version(
        spark, names.version_history, version_id=run.version, deployed_at=datetime.now(),
        description="Gold run", status="SUCCESS", environment=run.environment, git_commit=run.commit,
    )


def _columns(ddl: str) -> list[str]:
    return [part.strip().split(" ")[0] for part in ddl.split(",")]
