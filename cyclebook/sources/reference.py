"""Calendar and classification rules as one bundle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclebook.operators.calendar import prepare_calendar
from cyclebook.operators.rules import prepare_rules
from cyclebook.schema import CALENDAR_TABLE, RULE_TABLES
from cyclebook.sources.conform import clean_names

# Lookup tables of up to this many bytes are broadcast; larger ones join by shuffle.
BROADCAST_BYTES = 32 << 20


@dataclass(frozen=True)
class Reference:
    """Prepared lookup tables the normalizers join to."""

    calendar: DataFrame
    rules: dict[str, DataFrame]


def reference_from_tables(calendar: DataFrame, rules: dict[str, DataFrame]) -> Reference:
    return Reference(prepare_calendar(calendar),
                     {broker: prepare_rules(t) for broker, t in rules.items()})


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """A reference table landed as CSV or Parquet, headers cleaned, with the order of its rows.

    Rows are ordered by file name, block and place in the block, however Spark packs the files.
    """
    if path.lower().endswith(".csv"):
        raw = spark.read.option("header", True).option("escape", '"').csv(path)
    else:
        raw = spark.read.parquet(path)
    names = clean_names(raw.columns)
    placed = raw.select("*", F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id()).alias("row_ord"))
    return placed.toDF(*names, "row_ord").withColumn("rule_ord", F.col("row_ord"))


def size_checked(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a lookup for broadcast if its files prove it small; else leave it as it is.

    The size is that of the scan, which Spark knows from the listing: no job runs. A small lookup
    is also kept in one partition, so preparing it needs no shuffle. Either way rows are the same.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df.coalesce(1)) if int(str(size)) <= max_bytes else df


def load_reference(spark: SparkSession, folder: str, fmt: str = "csv") -> Reference:
    """Read every lookup table of a folder, named after the workbook's sheets."""
    def table(name: str) -> DataFrame:
        return size_checked(read_lookup(spark, f"{folder}/{name}.{fmt}"))

    return reference_from_tables(table(CALENDAR_TABLE),
                                 {b: table(name) for b, name in RULE_TABLES.items()})
