"""Queries: managed tables, fallbacks, guards, logs, splits and result tables, read back and compared."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adperf.ml import prep, train
from adperf.operators import quality
from adperf.plans import layers
from adperf.plans.q_models import _RESULTS, _SPLIT_SQL, AD, LABEL, _results
from adperf.plans.registry import query
from adperf.sources import io, schemas
from adperf.sources.adapters import table

_RUN_TS = "2024-02-15 06:00:00"


def _in_schema(spark: SparkSession, result: Callable[[str], DataFrame]) -> DataFrame:
    """Store what a function reads from tables of a schema of its own, and drop the schema."""
    schema = f"adperf_q_{layers.run_id()}"
    io.create_schema(spark, schema)
    try:
        return layers.stage(result(schema), "from_tables")
    finally:
        spark.sql(f"DROP SCHEMA {schema} CASCADE")


@query(
    "io2_table_scan",
    "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1",
)
def _(spark, d):
    """A managed table, partitioned by priority, scanned for one of them."""
    def run(schema):
        io.write_table(table(spark, d, "orders"), f"{schema}.orders", partition_by=["o_orderpriority"])
        rows = io.read_table(spark, f"{schema}.orders").filter("o_orderpriority = '1-URGENT'")
        return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))

    return _in_schema(spark, run)


@query("io5_fallback_chain", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(spark, d):
    """The first source that is there and has rows: not an absent path, a missing table or an empty frame."""
    events = io.first_available(
        lambda: spark.read.parquet(f"{d}/no_such_file.parquet"),
        lambda: io.read_table(spark, "no_such_table"),
        lambda: table(spark, d, "events").limit(0),
        lambda: table(spark, d, "events"),
    )
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "io6_literal_rows",
    """SELECT event_type, weight, count(*) AS n, round(count(*) * weight, 6) AS weighted FROM events
    JOIN (VALUES ('click', 1.0), ('purchase', 5.0), ('view', 0.1)) AS w(event_type, weight) USING (event_type) GROUP BY 1, 2""",
)
def _(spark, d):
    """A table of literals under a declared schema, joined to the events."""
    weights = spark.createDataFrame([("click", 1.0), ("purchase", 5.0), ("view", 0.1)], "event_type string, weight double")
    rows = table(spark, d, "events").join(weights, "event_type").groupBy("event_type", "weight").agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("weighted", F.col("n") * F.col("weight"))


@query(
    "io9_audit_append",
    """SELECT 'b' || (event_id % 3) AS batch_id, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1""",
)
def _(spark, d):
    """Three batches appended to one audit log; none replaces another."""
    def run(schema):
        for k in range(3):
            batch = table(spark, d, "events").filter(F.col("event_id") % 3 == k).select(F.lit(f"b{k}").alias("batch_id"), "event_id")
            io.append_log(batch, f"{schema}.audit")
        return spark.table(f"{schema}.audit").groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))

    return _in_schema(spark, run)


@query(
    "io10_overwrite_or_append",
    """SELECT 'kept' AS part, count(*) AS n FROM nation UNION ALL SELECT 'added', count(*) FROM supplier""",
)
def _(spark, d):
    """A table of another partitioning cannot be replaced by parts, so the rows are appended, and it is said."""
    def run(schema):
        name = f"{schema}.places"
        kept = table(spark, d, "nation").select(F.lit("kept").alias("part"), F.col("n_name").alias("name"))
        added = table(spark, d, "supplier").select(F.lit("added").alias("part"), F.col("s_name").alias("name"))
        io.write_table(kept, name)
        io.replace_or_append(added, name, ["part"])
        return spark.table(name).groupBy("part").agg(F.count(F.lit(1)).alias("n"))

    return _in_schema(spark, run)


@query("io14_csv_backup", "SELECT CAST(n_regionkey AS BIGINT) AS n_regionkey, count(*) AS n, count(DISTINCT n_name) AS names FROM nation GROUP BY 1")
def _(spark, d):
    """A small table as one CSV file, read back under its schema."""
    path = f"{layers.staging_root(spark)}/nation_backup_{layers.run_id()}"
    nation = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    io.write_csv_backup(nation, path)
    back = io.read_csv(spark, path, "n_nationkey long, n_name string, n_regionkey long")
    return back.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("n_name").alias("names"))


@query(
    "io16_io17_guards",
    """SELECT 'empty input' AS guard, true AS refused, count(*) AS n FROM events
    UNION ALL SELECT 'missing table', true, count(*) FROM events UNION ALL SELECT 'rows', false, count(*) FROM events""",
)
def _(spark, d):
    """Whether a run is refused: without rows, without its table, and with rows."""
    events = table(spark, d, "events")
    checks = {
        "empty input": lambda: io.require_rows(events.filter("event_id < 0 AND event_id > 0")),
        "missing table": lambda: io.require_table(spark, "no_such_table"),
        "rows": lambda: io.require_rows(events),
    }
    parts = []
    for name, check in checks.items():
        try:
            check()
            refused = False
        except io.MissingInput:
            refused = True
        parts.append(events.agg(F.lit(name).alias("guard"), F.lit(refused).alias("refused"), F.count(F.lit(1)).alias("n")))
    return reduce(DataFrame.unionByName, parts)


@query(
    "io18_schema_ddl",
    """SELECT 'nation' AS table_name, count(*) AS n, CAST(3 AS BIGINT) AS columns FROM nation
    UNION ALL SELECT 'region', count(*), 2 FROM region""",
)
def _(spark, d):
    """Tables of a new schema, listed and described; a dropped one is gone."""
    def run(schema):
        for name in ("nation", "region", "customer"):
            io.write_table(table(spark, d, name), f"{schema}.{name}")
        io.drop_table(spark, f"{schema}.customer")
        names = [r["tableName"] for r in io.list_tables(spark, schema).collect()]  # one name for a table
        parts = [
            spark.table(f"{schema}.{n}").agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(n).alias("table_name"), "n",
                F.lit(io.describe_table(spark, f"{schema}.{n}").filter("col_name <> '' AND col_name NOT LIKE '#%'").count()).alias("columns"))
            for n in names
        ]
        return reduce(DataFrame.unionByName, parts)

    return _in_schema(spark, run)


@query("io19_fallback_view", "SELECT r_name, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def _(spark, d):
    """A result that cannot be stored as a table is registered as a view, and read under the same name."""
    rows = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    counted = rows.groupBy("r_name").agg(F.count(F.lit(1)).alias("n"))
    name = io.table_or_view(counted, f"no_such_schema.by_region_{layers.run_id()}")
    return spark.table(name)


@query(
    "io23_run_log",
    """SELECT 'b1' AS batch_id, CAST((SELECT count(*) FROM clicks) + (SELECT count(*) FROM silver_clicks) AS BIGINT) AS rows_written,
      CAST(2 AS BIGINT) AS steps, CAST(1 AS BIGINT) AS failed""",
)
def _(spark, d):
    """One row for each step of a batch, a failed one included."""
    def run(schema):
        log = f"{schema}.batch_log"
        for layer, rows in (("bronze", layers.bronze_clicks(spark, d)), ("silver", layers.silver_clicks(spark, d))):
            io.log_run(spark, log, batch_id="b1", layer=layer, rows_written=rows.count(), status="SUCCESS")
        io.log_run(spark, log, batch_id="b1", layer="gold", status="FAILED", message="no space")
        rows = spark.table(log)
        states = rows.groupBy("batch_id").agg(
            F.count_if(F.col("status") == "SUCCESS").alias("steps"), F.count_if(F.col("status") == "FAILED").alias("failed"))
        return io.batch_summary(rows).select("batch_id", "rows_written").join(states, "batch_id")

    return _in_schema(spark, run)


@query(
    "q15_schema_check",
    """SELECT 'Watch_Duration' AS column_name, 'type' AS problem, 'double' AS expected, 'string' AS actual
    UNION ALL SELECT 'user_age', 'missing', 'int', NULL
    UNION ALL SELECT 'ingestion_date', 'extra', NULL, 'date' UNION ALL SELECT 'Event_ID', 'extra', NULL, 'bigint'""",
)
def _(spark, d):
    """Absent, added and differently typed columns of the raw log."""
    raw = layers.bronze_clicks(spark, d).drop("user_age").withColumn("Watch_Duration", F.col("Watch_Duration").cast("string"))
    return quality.schema_diff(raw, schemas.RAW_CLICKS)


@query(
    "q18_json_report",
    """SELECT 'clicks' AS source, count(*) AS n, count(*) - count(Ad_Type) AS null_types, count(*) - count(device) AS null_devices FROM clicks""",
)
def _(spark, d):
    """A profile written as one JSON report and read back under its schema."""
    path = f"{layers.staging_root(spark)}/report_{layers.run_id()}"
    profile = layers.bronze_clicks(spark, d).agg(
        F.count(F.lit(1)).alias("n"),
        F.create_map(F.lit("Ad_Type"), F.count_if(F.col("Ad_Type").isNull()), F.lit("device"), F.count_if(F.col("device").isNull())).alias("nulls"))
    io.export_text(profile.withColumn("source", F.lit("clicks")), path, "json")
    back = spark.read.schema("source string, n long, nulls map<string, long>").json(path)
    return back.select("source", "n", F.col("nulls.Ad_Type").alias("null_types"), F.col("nulls.device").alias("null_devices"))


@query(
    "q25_layer_health",
    """SELECT 'silver_clicks' AS layer, 'EXISTS' AS status, count(*) AS row_count FROM silver_clicks
    UNION ALL SELECT 'gold', 'EXISTS', count(*) FROM gold UNION ALL SELECT 'archive', 'MISSING', 0""",
)
def _(spark, d):
    """Which layers exist, and their rows."""
    def run(schema):
        io.write_table(layers.silver_clicks(spark, d), f"{schema}.silver_clicks")
        io.write_table(layers.gold(spark, d), f"{schema}.gold")
        health = quality.layer_health(spark, [f"{schema}.{n}" for n in ("silver_clicks", "gold", "archive")])
        return health.select(F.split_part("table_name", F.lit("."), F.lit(2)).alias("layer"), "status", "row_count")

    return _in_schema(spark, run)


@query(
    "l3_persisted_split",
    f"""SELECT split, count(*) AS n, CAST(sum(high_performance) AS BIGINT) AS wins, round(sum(roas), 6) AS roas FROM ({_SPLIT_SQL}) GROUP BY 1""",
)
def _(spark, d):
    """Train and test rows in a folder each, read back as one table."""
    path = f"{layers.staging_root(spark)}/split_{layers.run_id()}"
    train.save_split(prep.split(layers.model_frame(spark, d), LABEL, AD), path)
    return io.read_parquet(spark, path).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum(LABEL).alias("wins"), F.sum("roas").alias("roas"))


@query(
    "l21_results_table",
    f"""SELECT target, model, round(r2, 6) AS r2, v AS version, 'test' AS environment, '{_RUN_TS}' AS training_timestamp
    FROM ({_RESULTS}) x, (SELECT unnest(['v1', 'v2']) AS v)""",
)
def _(spark, d):
    """Results of two versions, appended with version, environment and time."""
    def run(schema):
        for version in ("v1", "v2"):
            train.save_results(_results(spark, d), f"{schema}.results", version, "test", _RUN_TS)
        return spark.table(f"{schema}.results").select("target", "model", "r2", "version", "environment", "training_timestamp")

    return _in_schema(spark, run)
