"""Session settings the operators rely on.

``configure`` only touches runtime SQL settings, so it can be applied to a session
that a cluster already made. Shuffle width is left to the cluster: with AQE on, set
``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` high (about shuffle
bytes / 200 MB) and let Spark merge what turns out small.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Calendar days are cut in this zone (order dates, first-order dates).
    "spark.sql.session.timeZone": "UTC",
    # A malformed number must stop the load instead of turning into NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A key that holds a large share of the rows is split at run time, even when the
    # split costs one more exchange further down.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles a method above 8000 bytes of bytecode; wide projections are
    # faster split into small methods than fused into one that stays interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession, timezone: str = "UTC") -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", timezone)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Saves a round trip to the JVM for every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Small local files would all be broadcast, which leaves single-task stages.
        .config("spark.sql.autoBroadcastJoinThreshold", "1MB")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
