"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # one key may hold a third of all rows: let AQE split such join partitions,
    # even when that costs one more exchange further up
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session the caller already owns."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def task_count(spark: SparkSession) -> int:
    """Partitions for rows that are few and small but expand or cost much each. An explicit
    number keeps adaptive execution from merging them by their size."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def local_session(cores: int | str = 8, memory: str = "8g", scratch: str | None = None) -> SparkSession:
    """A single-JVM session for tests and the benchmark; ``scratch`` is where intermediate tables go."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    if scratch:
        builder = builder.config("spark.checkpoint.dir", scratch)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
