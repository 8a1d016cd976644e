"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}
SHUFFLE_PARTITION_BYTES = 200 * 1024**2


def shuffle_partitions(shuffle_bytes: int) -> int:
    """Partitions that keep a shuffle of this size at about 200 MB per task.

    Adaptive execution merges partitions that turn out small, so an estimate
    that is too high costs little; one that is too low spills.
    """
    return max(1, -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES))


def configure(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the settings that may be changed on a running session.

    `shuffle_bytes`, the size of the largest shuffle (the raw click log for
    cleaning), sets the number of shuffle partitions.
    """
    settings = dict(RUNTIME_CONF)
    if shuffle_bytes:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(shuffle_bytes))
    for key, value in settings.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(
    cores: str = "*",
    partitions: int = 8,
    checkpoint_dir: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session for tests and benchmarks on one machine.

    On a cluster the session comes from spark-submit; pass it to `configure`.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("adperf")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "12g")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
