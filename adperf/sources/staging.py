"""Intermediate tables in the shared folder the cluster names.

`spark.checkpoint.dir` says where; it must be reachable from all executors.  A
staged frame is a parquet table there: it cuts the lineage, survives the loss of
executors and can still be read by column.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables.

    Its name holds the application id; remove it when the application is done.
    Only a local session without the setting gets a temporary folder.
    """
    app = spark.sparkContext.applicationId
    base = spark.conf.get(_CONF, None) or spark.sparkContext.getConf().get(_CONF, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CONF} to a folder all executors can reach")
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="adperf-")
        base = _local_roots[app]
    return f"{base.rstrip('/')}/adperf-{app}"


def stage(df: DataFrame, name: str = "part") -> DataFrame:
    """Write the frame once and return the written table."""
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
