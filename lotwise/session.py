"""Session settings every entry point of the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, name: str = "lotwise", folder: str | None = None
) -> SparkSession:
    """A single-JVM session for tests and benchmarks; clusters bring their own session.

    ``folder`` is where intermediate tables go (``spark.checkpoint.dir``); without it a temporary folder is used.
    """
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    if folder:
        builder = builder.config("spark.checkpoint.dir", folder)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
