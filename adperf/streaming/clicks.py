"""Structured Streaming over the click log.

Streams read folders in which files arrive and write folders.  Each has a checkpoint of
its own; a stream that is started again goes on where it stopped, and what a crash left
half written is neither lost nor written twice: file sinks keep a log of their files,
and batch sinks write a folder that is named by the batch's number, which a batch that
is run again overwrites.

The watermark of ingestion is the time of arrival, which the sender cannot get wrong.
Windows go by the time of the event, so events dated beyond their arrival are set apart
(`on_time`): a single one from the future would move the watermark there and make all
that follows late.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from adperf.functions import fixed
from adperf.operators import cleanse, quality

EVENT_TIME = "Click_Timestamp_Standard"
ARRIVAL = "arrived_at"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def land(df: DataFrame, path: str, arrival: str, slices: int) -> list[Callable[[], None]]:
    """Steps that add the rows of a table to a folder in the order of their arrival, a slice each.

    A slice is an equal part of the time of arrival; rows without one come last.
    """
    at = F.unix_timestamp(F.col(arrival).cast("timestamp"))
    first, last = df.agg(F.min(at), F.max(at)).first()
    if first is None:
        first = last = 0
    width = (last - first) // slices + 1
    place = F.coalesce(F.floor((at - first) / width), F.lit(slices - 1))

    def step(i: int) -> Callable[[], None]:
        return lambda: df.filter(place == i).write.mode("append").parquet(path)

    return [step(i) for i in range(slices)]


def arriving(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Stream of a folder's files, oldest first."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


@dataclass(frozen=True)
class Outcome:
    """What a run of a stream did."""

    batches: int
    rows_in: int
    late_rows: int


def run_available(writer, checkpoint: str) -> Outcome:
    """Run a writer over all that has arrived, wait for it, and say what it did."""
    # the state can be larger than the memory of an executor
    spark = SparkSession.getActiveSession()
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    try:
        query: StreamingQuery = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    query.awaitTermination()
    progress = query.recentProgress
    late = sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])
    return Outcome(len({p["batchId"] for p in progress}), sum(p["numInputRows"] for p in progress), late)


# ---- ingestion ----------------------------------------------------------------------------


def conform(raw: DataFrame, key: Sequence[str], arrival: str, delay: str = "3 days") -> DataFrame:
    """Cleaned columns of the raw log, each event once.

    A copy is dropped if it arrives within `delay` of the first; the keys of that time
    are all that is kept as state.  What arrives later than `delay` behind the newest
    arrival is late and dropped; `Outcome.late_rows` counts it.
    """
    known = raw.withColumn(ARRIVAL, F.col(arrival).cast("timestamp")).withWatermark(ARRIVAL, delay)
    return cleanse.clean_click_columns(known.dropDuplicatesWithinWatermark(list(key)))


def ingest(
    conformed: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ("ingestion_date",), files: int = 4,
) -> Outcome:
    """Append conformed rows to a folder, each exactly once whatever is restarted.

    A micro-batch writes so many files for each of its partitions at most, not one for
    each partition and task: what reads the folder as a stream pays for files.
    """
    dealt = F.pmod(F.xxhash64(*[c for c in conformed.columns if c not in partition_by]), F.lit(files))
    writer = conformed.repartition(*partition_by, dealt).writeStream.format("parquet").option("path", path).partitionBy(*partition_by)
    return run_available(writer.outputMode("append"), checkpoint)


def settle(conformed: DataFrame, tiebreak: Sequence[str]) -> DataFrame:
    """The rules that need more than one row, over stored rows: gender fill and business key."""
    return cleanse.drop_business_duplicates(cleanse.fill_gender(conformed), cleanse.BUSINESS_KEY, tiebreak)


# ---- windows ------------------------------------------------------------------------------


def on_time(time: str = EVENT_TIME, arrival: str = "ingestion_date", ahead_days: int = 1) -> Column:
    """Events with a time that is not beyond the day of their arrival."""
    limit = F.date_add(F.col(arrival).cast("date"), ahead_days).cast("timestamp")
    return F.coalesce(F.col(time) < limit, F.lit(False))


def ctr_by_window(
    df: DataFrame, width: str, slide: str | None = None, by: Sequence[str] = (), time: str = EVENT_TIME,
    delay: str | None = None,
) -> DataFrame:
    """window_start, window_end, `by`, impressions, clicks and ctr; of a table, or of a stream with `delay`."""
    rows = df.withWatermark(time, delay) if delay else df
    counted = rows.groupBy(F.window(time, width, slide or width).alias("w"), *by).agg(
        F.count(F.lit(1)).alias("impressions"), F.sum("user_clicked_cleaned").alias("clicks"))
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "impressions",
        F.col("clicks").cast("long").alias("clicks"), (F.col("clicks") / F.col("impressions")).alias("ctr"))


def visits(
    df: DataFrame, user: str = "User_ID", time: str = EVENT_TIME, gap_seconds: int = fixed.SESSION_GAP_SECONDS,
    delay: str | None = None,
) -> DataFrame:
    """One row for each session of a user: first and last event, events and clicks.

    Events of a session are at most `gap_seconds` apart.  A stream emits a session once
    the watermark is `gap_seconds` beyond its last event.
    """
    rows = df.withWatermark(time, delay) if delay else df
    sessions = rows.groupBy(user, F.session_window(time, f"{gap_seconds} seconds").alias("w")).agg(
        F.count(F.lit(1)).alias("events"), F.sum("user_clicked_cleaned").cast("long").alias("clicks"))
    last = F.col("w.end") - F.make_dt_interval(secs=F.lit(gap_seconds))
    return sessions.select(user, F.col("w.start").alias("first_event"), last.alias("last_event"), "events", "clicks")


# ---- sinks by batch -------------------------------------------------------------------------


def into_batches(results: Callable[[DataFrame], dict[str, DataFrame]], path: str) -> Callable[[DataFrame, int], None]:
    """Sink that stores named results of each micro-batch under its number, replacing an earlier try."""

    def store(batch: DataFrame, number: int) -> None:
        batch.persist()  # read once for each result
        try:
            for name, result in results(batch).items():
                result.write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")
        finally:
            batch.unpersist()

    return store


def newest(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of rows stored by batch, the newest of each key."""
    values = [c for c in stored.columns if c not in (*keys, "batch")]
    return stored.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v")).select(*keys, "v.*")


def window_updates(counted: DataFrame, path: str, checkpoint: str) -> Outcome:
    """Store the windows that each micro-batch changed; `newest` gives them as they stand."""
    writer = counted.writeStream.outputMode("update").foreachBatch(into_batches(lambda b: {"windows": b}, path))
    return run_available(writer, checkpoint)


def quality_batches(
    raw: DataFrame, rules: Iterable[quality.Rule], table: str, path: str, checkpoint: str,
    sets: dict[str, Sequence[str]] | None = None,
) -> Outcome:
    """Counts of the row conditions of each micro-batch, in one pass over it.

    Counts add up over batches.  `sets` names column lists whose distinct values are
    stored as well: rules about groups do not add up, but are measured on these.
    """
    conditions = [r for r in rules if r.kind == "condition" and r.table == table]

    def measured(batch: DataFrame) -> dict[str, DataFrame]:
        counts = quality.run_rules({table: batch}, conditions).select(
            "table_name", "rule", F.col("observed").cast("long").alias("n"))
        return {"counts": counts} | {name: batch.select(*columns).distinct() for name, columns in (sets or {}).items()}

    return run_available(raw.writeStream.foreachBatch(into_batches(measured, path)), checkpoint)


def quality_totals(spark: SparkSession, path: str) -> DataFrame:
    """Counters over all batches."""
    stored = spark.read.parquet(f"{path}/counts")
    return stored.groupBy("table_name", F.col("rule").alias("anomaly_type")).agg(F.sum("n").alias("count"))
