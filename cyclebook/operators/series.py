"""Running totals, completion and interpolation over already aggregated series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running(part: Sequence[str], order: Sequence[str]):
    """Window from the first row of the partition to the current one."""
    spec = Window.partitionBy(*part) if part else Window.partitionBy(F.lit(0))
    return spec.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def complete_within(df: DataFrame, part: str, first: str, second: str, value: str,
                    carry: Sequence[str] = ()) -> DataFrame:
    """Every (first, second) pair of values that occur within the same ``part``; absent values are 0.

    Meant for aggregated series with one row per (part, first, second): the grid
    of a part is days x segments, which is the size of the answer. Each segment
    explodes the part's list of days, so nothing is joined. ``carry`` names
    columns that are constant within a part.
    """
    listed = df.withColumn(
        "__firsts", F.collect_set(first).over(Window.partitionBy(part)))
    per_second = listed.groupBy(part, second).agg(
        F.map_from_entries(F.collect_list(F.struct(first, value))).alias("__values"),
        F.first("__firsts").alias("__firsts"), *[F.first(c).alias(c) for c in carry])
    each = per_second.withColumn(first, F.explode("__firsts"))
    found = F.try_element_at("__values", F.col(first))
    return each.select(part, first, second, F.coalesce(found, F.lit(0.0)).alias(value), *carry)


def interpolate_to_grid(df: DataFrame, part: str, x: str, y: str,
                        low: Column, high: Column, step: float) -> DataFrame:
    """Piecewise linear values at low, low + step, .. high for every part.

    Beyond its first and last point a series is flat; parts with one point are
    skipped. Each point explodes only the grid positions up to its successor,
    so there is no range join.
    """
    w = Window.partitionBy(part).orderBy(x)
    seg = df.select(
        F.col(part), F.col(x).cast("double").alias("x0"), F.col(y).cast("double").alias("y0"),
        F.lead(F.col(x).cast("double")).over(w).alias("x1"),
        F.lead(F.col(y).cast("double")).over(w).alias("y1"),
        F.row_number().over(w).alias("point"),
        F.count(F.lit(1)).over(Window.partitionBy(part)).alias("points"),
        low.cast("double").alias("low"), high.cast("double").alias("high"),
    ).filter("points >= 2")

    def position(c: str) -> Column:
        return F.ceil((F.col(c) - F.col("low")) / F.lit(step)).cast("int")

    last = F.round((F.col("high") - F.col("low")) / F.lit(step), 0).cast("int")
    start = F.when(F.col("point") == 1, F.lit(0)).otherwise(position("x0"))
    stop = F.when(F.col("x1").isNull(), last).otherwise(position("x1") - 1)
    seg = seg.withColumns({"k0": start, "k1": stop}).filter("k1 >= k0")
    at = seg.withColumn("k", F.explode(F.sequence("k0", "k1"))).withColumn(
        "x", F.col("low") + F.col("k") * F.lit(step))
    slope = (F.col("x") - F.col("x0")) / (F.col("x1") - F.col("x0"))
    value = (F.when(F.col("x1").isNull() | (F.col("x") <= F.col("x0")), F.col("y0"))
             .otherwise(F.col("y0") + (F.col("y1") - F.col("y0")) * slope))
    return at.select(part, "x", value.alias("y"))
