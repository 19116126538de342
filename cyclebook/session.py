"""Session settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution sizes shuffles at run time and splits skewed join sides;
# the lookup tables stay below the automatic broadcast limit.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # HotSpot never compiles methods beyond 8,000 bytes; wide projections would run interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Rows of a columnar table that become wide texts are many times its bytes on disk: smaller splits keep the
# sorts of a task in memory.
WIDE_READS = {
    "spark.sql.codegen.hugeMethodLimit": SETTINGS["spark.sql.codegen.hugeMethodLimit"],
    "spark.sql.files.maxPartitionBytes": "8m",
}


def for_wide_rows(spark: SparkSession) -> None:
    """Settings of a session whose queries render narrow columns as wide text."""
    for key, value in WIDE_READS.items():
        spark.conf.set(key, value)


def local_session(cores: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """Single-machine session for tests and benchmarks."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("cyclebook")
               .config("spark.driver.memory", memory)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(partitions)))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
