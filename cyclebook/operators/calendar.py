"""Trade-cycle calendar: preparation, attachment and estimation of missing windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclebook.functions.text import as_col, blank_to_na
from cyclebook.operators.ranking import keep_first
from cyclebook.schema import DEFAULT_CLOSE_DAY, MAX_DELIVERY_MONTHS


def prepare_calendar(raw: DataFrame) -> DataFrame:
    """One row per delivery month; the first row of a month wins.

    ``row_ord`` gives the order; a table without it must be a single file (see ``read_lookup``).
    """
    if "row_ord" not in raw.columns:
        raw = raw.withColumn("row_ord", F.monotonically_increasing_id())
    dates = ("delivery_month", "trade_cycle_start", "trade_cycle_end")
    typed = raw.select(*[F.col(c).try_cast("date").alias(c) for c in dates],
                       blank_to_na("period_label").alias("period_label"), "row_ord")
    typed = typed.filter(F.col("delivery_month").isNotNull())
    return keep_first(typed, ["delivery_month"], [F.col("row_ord").asc()]).drop("row_ord")


def interval_flag(day: Column | str, start: Column | str, end: Column | str) -> Column:
    """Closed-interval test; null as soon as one of the three is null."""
    day, start, end = as_col(day), as_col(start), as_col(end)
    known = day.isNotNull() & start.isNotNull() & end.isNotNull()
    return F.when(known, (day >= start) & (day <= end))


def attach_trade_cycle(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Add window, ``period_label`` and ``in_trade_cycle`` by delivery month."""
    return df.join(calendar, "delivery_month", "left").withColumn(
        "in_trade_cycle", interval_flag("exec_date", "trade_cycle_start", "trade_cycle_end"))


def close_day(calendar: DataFrame) -> Column:
    """Median day of the month on which official cycles close, halves to even."""
    median = calendar.agg(
        F.bround(F.median(F.dayofmonth("trade_cycle_end")), 0).cast("int").alias("close_day"))
    return F.coalesce(median.scalar(), F.lit(DEFAULT_CLOSE_DAY))


def estimate_windows(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Windows for traded months the calendar lacks.

    A window opens on the first of the month before delivery and closes on the
    usual close day. Months without a trade inside their window are left out.
    """
    month = F.col("delivery_month")
    start = F.add_months(month, -1)
    missing = df.filter(month.isNotNull() & (F.col("trade_cycle_start").isNull()
                                             | F.col("trade_cycle_end").isNull()))
    days = missing.groupBy("delivery_month", "exec_date").agg(F.lit(1).alias("one"))
    windows = days.withColumns({"est_start": start, "est_close": close_day(calendar)}).withColumn(
        "est_end", F.date_add("est_start", F.col("est_close") - 1))
    return (windows.filter(F.col("exec_date").between(F.col("est_start"), F.col("est_end")))
            .groupBy("delivery_month")
            .agg(F.first("est_start").alias("est_start"), F.first("est_end").alias("est_end"))
            .join(calendar.select("delivery_month"), "delivery_month", "left_anti"))


def backfill_trade_cycle(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Fill windows missing from the calendar; official rows always win.

    The estimates hold one row per delivery month. That a month is given by its first day is
    checked, so there are at most ``MAX_DELIVERY_MONTHS`` of them whatever the number of trades,
    which bounds the broadcast.
    """
    estimates = estimate_windows(df, calendar)
    first = F.dayofmonth("delivery_month") == 1
    checked = F.when(first, F.col("delivery_month")).otherwise(F.raise_error(
        F.lit(f"delivery_month is no first of a month; more than {MAX_DELIVERY_MONTHS} could occur")).cast("date"))
    estimates = F.broadcast(estimates.withColumn("delivery_month", checked))
    filled = df.join(estimates, "delivery_month", "left").withColumns({
        "trade_cycle_start": F.coalesce("trade_cycle_start", "est_start"),
        "trade_cycle_end": F.coalesce("trade_cycle_end", "est_end"),
    }).drop("est_start", "est_end")
    return filled.withColumn(
        "in_trade_cycle", interval_flag("exec_date", "trade_cycle_start", "trade_cycle_end")
    ).select(*df.columns)
