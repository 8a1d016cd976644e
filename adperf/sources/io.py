"""Reading, writing, audit columns, run log, export and reconciliation."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adperf.sources import schemas


class MissingInput(RuntimeError):
    """A required table or file is absent or empty."""


# ---- readers ------------------------------------------------------------------------------


def read_csv(
    spark: SparkSession,
    path: str,
    ddl: str,
    corrupt: str = "_corrupt_record",
    multi_line: bool = True,
) -> DataFrame:
    """CSV with header under an explicit schema; rows that do not parse are kept apart.

    Quotes are escaped by doubling and fields may hold line breaks.  A malformed
    row keeps its text in the `corrupt` column instead of stopping the read.
    Files that may hold line breaks are read whole by one task each; say
    `multi_line=False` where they cannot, so that large files are split.
    """
    return (
        spark.read.schema(f"{ddl}, {corrupt} string")
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
        .csv(path)
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    require_table(spark, name)
    return spark.table(name)


def read_parquet(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    """One or more parquet paths or globs; partition folders become columns.

    `merge_schema` reads every footer first, for files of differing columns.
    """
    return spark.read.option("mergeSchema", merge_schema).parquet(*paths)


def _dated(root: str, parts: Sequence[str], day: Sequence[int]) -> str:
    return "/".join([root.rstrip("/"), *[f"{p}={v}" for p, v in zip(parts, day, strict=False)]])


def read_day(spark: SparkSession, root: str, day: date, parts: Sequence[str] | None = None, ddl: str | None = None) -> DataFrame:
    """One day's folder of a dated export; no other folder is listed.

    The parts stay columns, as integers.  Without a folder for the day there is nothing
    to read: `MissingInput`.
    """
    return read_matching(spark, root, _dated(root, parts or EXPORT_PARTS, (day.year, day.month, day.day)), parts, ddl)


def read_matching(
    spark: SparkSession, root: str, pattern: str, parts: Sequence[str] | None = None, ddl: str | None = None
) -> DataFrame:
    """The folders of a dated export that a glob matches, such as all days of a month."""
    try:
        return _typed(spark, root, parts, ddl).parquet(pattern)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise MissingInput(f"no files match {pattern}") from e
        raise


def read_between(
    spark: SparkSession, root: str, first: date, last: date, parts: Sequence[str] | None = None, ddl: str | None = None
) -> DataFrame:
    """The days from first to last of a dated export.

    The condition is on the parts alone, so it selects folders before any file is opened.
    """
    days = F.make_date(*[F.col(p) for p in parts or EXPORT_PARTS])
    return _typed(spark, root, parts, ddl).parquet(root).filter(days.between(F.lit(first), F.lit(last)))


def _typed(spark: SparkSession, root: str, parts: Sequence[str] | None, ddl: str | None):
    """Reader that knows where the parts begin and, with `ddl`, all types, so that no footer decides them."""
    reader = spark.read.option("basePath", root)
    if ddl is None:
        return reader
    return reader.schema(", ".join([ddl, *[f"{p} int" for p in parts or EXPORT_PARTS]]))


def union_all(*frames: DataFrame) -> DataFrame:
    """Frames of differing columns under one schema, absent columns null."""
    first, *rest = frames
    for df in rest:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


def first_available(*readers: Callable[[], DataFrame]) -> DataFrame:
    """The first reader that finds its source and some rows."""
    problems = []
    for reader in readers:
        try:
            return require_rows(reader())
        except (AnalysisException, MissingInput) as e:
            problems.append(str(e).splitlines()[0])
    raise MissingInput("no source available: " + "; ".join(problems))


# ---- guards -------------------------------------------------------------------------------


def require_table(spark: SparkSession, name: str) -> None:
    if not spark.catalog.tableExists(name):
        raise MissingInput(f"table {name} does not exist")


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise MissingInput("input has no rows")
    return df


def preview(df: DataFrame, order_by: Sequence[str], n: int = 10) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


# ---- audit columns ------------------------------------------------------------------------


@dataclass(frozen=True)
class Run:
    """One execution: the values audit columns and logs take."""

    batch_id: str
    run_ts: str
    environment: str = "dev"
    commit: str = ""
    version: str = ""


def with_ingestion_audit(df: DataFrame, run: Run, source: str | None = None) -> DataFrame:
    """Ingestion time, date, source file, batch, environment, commit and status.

    Without `source` the file name comes from the reader's file metadata.
    """
    ts = F.lit(run.run_ts).cast("timestamp")
    return df.withColumns(
        {
            "ingestion_timestamp": ts,
            "ingestion_date": ts.cast("date"),
            "source_file": F.lit(source) if source else F.col("_metadata.file_name"),
            "ingestion_batch_id": F.lit(run.batch_id),
            "environment": F.lit(run.environment),
            "git_commit": F.lit(run.commit),
            "processing_status": F.lit("INGESTED"),
        }
    )


def with_processing_audit(df: DataFrame, run: Run, status: str = "CLEANED") -> DataFrame:
    return df.withColumns(
        {
            "processing_timestamp": F.lit(run.run_ts).cast("timestamp"),
            "processing_batch_id": F.lit(run.batch_id),
            "processing_status": F.lit(status),
            "environment": F.lit(run.environment),
        }
    )


# ---- sinks --------------------------------------------------------------------------------


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    evolve: bool = False,
    bucket_by: tuple[int, str] | None = None,
) -> None:
    """Managed table.  `evolve` keeps columns of the old table the frame lacks, as nulls.

    Rows are grouped by the partition columns before the write, spread over
    several files each, so a partition of any size is written by many tasks.
    `bucket_by` (number, column) stores the rows hashed by a join key: tables
    bucketed alike are joined and grouped by it without a shuffle.
    """
    spark = df.sparkSession
    if evolve and spark.catalog.tableExists(name):
        have = set(df.columns)
        old = {f.name: f.dataType for f in spark.table(name).schema.fields if f.name not in have}
        df = df.withColumns({c: F.lit(None).cast(kind) for c, kind in old.items()})
    if bucket_by:
        writer = df.repartition(bucket_by[0], bucket_by[1]).write.bucketBy(*bucket_by)
    elif partition_by:
        writer = df.hint("rebalance", *partition_by).write
    else:
        writer = df.write
    writer = writer.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


class SchemaConflict(RuntimeError):
    """A frame does not fit the table it is written to."""


#: Types that hold all values of the ones after them.
_WIDENS = (("bigint", "int", "smallint", "tinyint"), ("double", "float", "int", "smallint", "tinyint"), ("float", "smallint", "tinyint"))


def _fits(into: T.DataType, given: T.DataType) -> bool:
    if into == given or isinstance(given, T.NullType):
        return True
    if isinstance(into, T.DecimalType) and isinstance(given, T.DecimalType):
        return into.scale >= given.scale and into.precision - into.scale >= given.precision - given.scale
    wide, narrow = into.simpleString(), given.simpleString()
    return any(wide == w and narrow in rest for w, *rest in _WIDENS)


def fitted(df: DataFrame, stored: T.StructType, evolve: bool) -> tuple[DataFrame, list[T.StructField]]:
    """(the frame with the stored columns in their order and types, then new ones; the new ones).

    Narrower types are widened to the stored ones.  A type that would lose values is a
    conflict; so are new and absent columns, unless `evolve`, which adds the former and
    fills the latter with nulls.
    """
    given = {f.name: f.dataType for f in df.schema.fields}
    known = {f.name: f.dataType for f in stored.fields}
    clashes = [
        f"{c}: {given[c].simpleString()} into {known[c].simpleString()}" for c in known if c in given and not _fits(known[c], given[c])]
    new = [f for f in df.schema.fields if f.name not in known]
    absent = [c for c in known if c not in given]
    if not evolve:
        clashes += [f"{f.name}: new" for f in new] + [f"{c}: absent" for c in absent]
    if clashes:
        raise SchemaConflict("; ".join(clashes))
    columns = [
        (F.col(f"`{c}`") if c in given else F.lit(None)).cast(kind).alias(c) for c, kind in known.items()]
    return df.select(*columns, *[F.col(f"`{f.name}`") for f in new]), new


@contextmanager
def _replacing_partitions(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def replace_partitions(df: DataFrame, name: str, partition_by: Sequence[str], fmt: str = "parquet", evolve: bool = False) -> None:
    """Replace those partitions of a table that the frame has rows of; all others stay, file by file.

    A day that is run again rewrites that day.  The first call makes the table.  Each
    partition is replaced as a whole when the job commits, so a lost executor costs a
    task and never half a partition.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        write_table(df, name, partition_by=partition_by, fmt=fmt)
        return
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if parts != list(partition_by):
        raise SchemaConflict(f"{name} is partitioned by {parts}, not {list(partition_by)}")
    stored = spark.table(name).schema
    shaped, new = fitted(df, stored, evolve)
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    with _replacing_partitions(spark):
        shaped.hint("rebalance", *parts).select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)


def replace_folders(df: DataFrame, path: str, partition_by: Sequence[str], evolve: bool = False) -> None:
    """The same for a folder of parquet files."""
    spark = df.sparkSession
    try:
        stored = spark.read.option("mergeSchema", evolve).parquet(path).schema
    except AnalysisException:
        stored = None  # the first write
    # parts are read back with types guessed from their names, so only the others are compared
    if stored is not None:
        body = T.StructType([f for f in stored.fields if f.name not in partition_by])
        shaped, _ = fitted(df.drop(*partition_by), body, evolve)
        df = df.select(*[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in shaped.schema.fields], *partition_by)
    writer = df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def replace_or_append(df: DataFrame, name: str, partition_by: Sequence[str]) -> str:
    """Replace the frame's partitions of a table; if it does not fit, append. Says which: `replaced` or `appended`.

    For tables whose layout is not one's own.  A frame whose types do not fit can be
    appended neither, and raises.
    """
    try:
        replace_partitions(df, name, partition_by)
    except SchemaConflict:
        shaped, _ = fitted(df, df.sparkSession.table(name).schema, evolve=False)
        append_log(shaped, name)
        return "appended"
    return "replaced"


def table_or_view(df: DataFrame, name: str) -> str:
    """Store a frame as a table; where there is no schema for it, register a view. The name to read it by."""
    try:
        write_table(df, name)
    except AnalysisException as e:
        if "SCHEMA_NOT_FOUND" not in str(e):
            raise
        view = name.split(".")[-1]
        df.createOrReplaceTempView(view)
        return view
    return name


def append_log(df: DataFrame, name: str) -> None:
    write_table(df, name, mode="append")


#: Columns an export adds: its parts and its stamps.
EXPORT_PARTS = ["export_year", "export_month", "export_day"]
EXPORT_COLUMNS = [*EXPORT_PARTS, "export_version", "export_environment"]


def export_partitioned(df: DataFrame, path: str, date_col: str, run: Run) -> None:
    """Snappy parquet by year, month and day of a date, stamped with version and environment.

    The parts are named `export_year`, `export_month`, `export_day`, so they do
    not replace a feature column called `month`.
    """
    parts = EXPORT_PARTS
    stamped = df.withColumns(
        {
            "export_year": F.year(date_col),
            "export_month": F.month(date_col),
            "export_day": F.dayofmonth(date_col),
            "export_version": F.lit(run.version),
            "export_environment": F.lit(run.environment),
        }
    )
    (
        stamped.hint("rebalance", *parts)
        .write.mode("overwrite")
        .option("compression", "snappy")
        .partitionBy(*parts)
        .parquet(path)
    )


def write_csv_backup(df: DataFrame, path: str) -> None:
    """One CSV file with header, for small tables only."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def export_text(df: DataFrame, path: str, fmt: str) -> None:
    """CSV (readable by `read_csv`) or JSON lines, one file per task."""
    if fmt == "csv":
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    elif fmt == "json":
        df.write.mode("overwrite").json(path)
    else:
        raise ValueError(f"unknown export format {fmt}")


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {schema}")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}")


# ---- verification -------------------------------------------------------------------------


def reconcile(source: DataFrame, target: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Rows, columns and an order-free content hash of both frames, and whether they agree.

    The target must have every column of the source and, beyond them, only those
    named in `extra`, such as the stamps of an export.
    """
    lost = [c for c in source.columns if c not in target.columns]
    added = [c for c in target.columns if c not in source.columns and c not in extra]
    columns = [c for c in source.columns if c in target.columns]

    def side(df: DataFrame, name: str, width: int) -> DataFrame:
        digest = F.sum(F.xxhash64(*[F.col(c) for c in columns]).cast("decimal(38,0)"))
        return df.agg(F.count(F.lit(1)).alias("row_count"), digest.alias("digest")).select(
            F.lit(name).alias("side"), "row_count", F.lit(width).alias("column_count"),
            F.col("digest").cast("string").alias("digest"),
        )

    both = side(source, "source", len(source.columns)).unionByName(
        side(target, "target", len(target.columns))
    )
    wide = both.agg(
        F.max(F.when(F.col("side") == "source", F.col("row_count"))).alias("source_rows"),
        F.max(F.when(F.col("side") == "target", F.col("row_count"))).alias("target_rows"),
        F.max(F.when(F.col("side") == "source", F.col("column_count"))).alias("source_columns"),
        F.max(F.when(F.col("side") == "target", F.col("column_count"))).alias("target_columns"),
        (F.min(F.coalesce("digest", F.lit("")))
         == F.max(F.coalesce("digest", F.lit("")))).alias("same_content"),
    )
    same = (F.col("source_rows") == F.col("target_rows")) & F.col("same_content")
    if lost or added:
        same = F.lit(False)
    return wide.withColumns({
        "lost_columns": F.lit(",".join(lost)), "status": F.when(same, "MATCH").otherwise("MISMATCH"),
    })


def file_report(spark: SparkSession, path: str) -> DataFrame:
    """Files, rows and bytes of a parquet folder."""
    per_file = (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return per_file.select(
        F.regexp_extract("file", r"([^/]+)$", 1).alias("file"), "bytes", "row_count"
    )


# ---- run log ------------------------------------------------------------------------------


def log_run(spark: SparkSession, name: str, **values) -> None:
    """Append one row to the batch log."""
    columns = [part.strip().split(" ")[0] for part in schemas.BATCH_LOG.split(",")]
    row = tuple(values.get(c) for c in columns)
    append_log(spark.createDataFrame([row], schemas.BATCH_LOG), name)


def log_version(spark: SparkSession, name: str, **values) -> None:
    """Append one row to the version history."""
    columns = [part.strip().split(" ")[0] for part in schemas.VERSION_HISTORY.split(",")]
    row = tuple(values.get(c) for c in columns)
    append_log(spark.createDataFrame([row], schemas.VERSION_HISTORY), name)


def latest_run(log: DataFrame, key: str = "layer", ts: str = "finished_at") -> DataFrame:
    """The newest log row per key, as an aggregate."""
    newest = F.max_by(F.struct(*[F.col(c) for c in log.columns]), F.col(ts)).alias("_row")
    return log.groupBy(key).agg(newest).select("_row.*")


def run_summary(history: DataFrame) -> DataFrame:
    """Per description: last run, runs, successes, failures."""
    return history.groupBy("description").agg(
        F.max("deployed_at").alias("last_run"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "SUCCESS").alias("success"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
    )


def batch_summary(log: DataFrame) -> DataFrame:
    """Per batch: last finish and rows written."""
    return log.groupBy("batch_id").agg(
        F.max("finished_at").alias("last_finished"), F.sum("rows_written").alias("rows_written")
    )
