"""Session construction and the runtime settings every job relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings.  They are safe to apply to a session somebody else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings.

    Partition counts stay as the cluster set them; only a local session left at
    Spark's default gets one partition per core.
    """
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    local = spark.sparkContext.master.startswith("local")
    if local and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return spark


def build_session(app: str = "watchledger", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Build a session.  ``master`` is only given for local runs and tests."""
    builder = SparkSession.builder.appName(app)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
