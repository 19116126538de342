"""Volume development of whole cycles: position, share of total, bars and reference curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclebook.functions.measures import percent_bin
from cyclebook.operators.series import complete_within, interpolate_to_grid, running
from cyclebook.plans.filters import Months, in_months, index_components, recent_months

# Axis choices of the season view and the columns they stand for.
X_AXES = {"day": "trading_day_rank", "pct": "norm_pct"}
Y_AXES = {"daily_raw": "day_vol", "daily_pct": "day_pct",
          "cum_raw": "cum_vol", "cum_pct": "cum_pct"}


def season_xy(x: str, y: str) -> tuple[str, str]:
    return X_AXES["day" if x == "day" else "pct"], Y_AXES[y]


def _position_columns(out: DataFrame) -> DataFrame:
    """Calendar day and percent through the cycle from rank, day count and cycle start."""
    rank, n = F.col("trading_day_rank"), F.col("n_trading_days")
    return out.withColumns({
        "cycle_day": (F.datediff("exec_date", "cyc_start") + 1).cast("int"),
        "norm_pct": F.when(n > 1, (rank - 1) / (n - 1) * 100).otherwise(0.0),
    }).drop("cyc_start")


def _total_days(d: DataFrame) -> DataFrame:
    month = Window.partitionBy("delivery_month")
    days = d.groupBy("delivery_month", "exec_date").agg(
        F.sum("qty_m3").alias("day_vol"), F.min("trade_cycle_start").alias("cyc_start"))
    return days.withColumns({
        "trading_day_rank": F.row_number().over(month.orderBy("exec_date")),
        "n_trading_days": F.count(F.lit(1)).over(month).cast("int"),
        "total_vol": F.sum("day_vol").over(month)})


def _segment_days(d: DataFrame, by: str) -> DataFrame:
    """One row per day and segment of a month, zero volume included.

    What belongs to the month (its trading days, total and cycle start) is put
    on the aggregated rows first and carried along, so trades are read once. The
    lists hold the trading days of one cycle.
    """
    month = Window.partitionBy("delivery_month")
    base = d.groupBy("delivery_month", "exec_date", F.col(by).alias("seg")).agg(
        F.sum("qty_m3").alias("day_vol"), F.min("trade_cycle_start").alias("seg_start"))
    marked = base.withColumns({
        "total_vol": F.sum("day_vol").over(month),
        "cyc_start": F.min("seg_start").over(month),
        "days": F.array_sort(F.collect_set("exec_date").over(month))})
    grid = complete_within(marked.filter(F.col("seg").isNotNull()), "delivery_month", "exec_date",
                           "seg", "day_vol", carry=["total_vol", "cyc_start", "days"])
    return grid.filter(F.col("cyc_start").isNotNull()).withColumns({
        "trading_day_rank": F.array_position("days", F.col("exec_date")).cast("int"),
        "n_trading_days": F.size("days")}).drop("days")


def cycle_seasonality(trades: DataFrame, ig: str = "SW", definition: str = "comm",
                      grades: Sequence[str] | None = None, by: str | None = None) -> DataFrame:
    """Daily and running volume of each cycle, optionally per ``grade`` or ``broker``.

    Trades are aggregated to day level once; everything after works on days.
    """
    d = index_components(trades, ig, definition, grades)
    days = _total_days(d) if by is None else _segment_days(d, by)
    part = ["delivery_month"] if by is None else ["delivery_month", "seg"]
    out = _position_columns(days).withColumn(
        "cum_vol", F.sum("day_vol").over(running(part, ["exec_date"])))
    return out.withColumns({"day_pct": F.col("day_vol") / F.col("total_vol") * 100,
                            "cum_pct": F.col("cum_vol") / F.col("total_vol") * 100})


def seasonality_bars(season_seg: DataFrame, x: str = "day", y: str = "daily_raw",
                     months: Months = None, bin_width: float = 10,
                     max_months: int | None = None) -> DataFrame:
    """Stacked-bar values: daily measures add up within a bin, cumulative ones peak.

    All selected months, or with ``max_months`` the most recent ones of them.
    """
    xvar, yvar = season_xy(x, y)
    base = F.col(xvar).cast("double") if x == "day" else percent_bin("norm_pct", bin_width)
    value = F.max(yvar) if y.startswith("cum") else F.sum(yvar)
    bars = in_months(season_seg, months).groupBy(
        "delivery_month", base.alias("base"), "seg").agg(value.alias("val"))
    if max_months is not None:
        bars = recent_months(bars, max_months)
    return bars.orderBy("delivery_month", "base", "seg")


def season_curve(season: DataFrame, x: str = "day", y: str = "daily_raw",
                 stat: str = "mean", months: Months = None) -> DataFrame:
    """Mean or median curve over all cycles on a common grid; empty for a single cycle."""
    xvar, yvar = season_xy(x, y)
    shown = in_months(season, months).select("delivery_month", xvar, yvar)
    # Bounds and the number of cycles over the season's rows: a row for each day of a cycle.
    whole = Window.partitionBy(F.lit(0))
    ends = Window.partitionBy("delivery_month")
    marked = shown.withColumns({"first_x": F.min(xvar).over(ends), "last_x": F.max(xvar).over(ends)})
    per_cycle = marked.groupBy("delivery_month").agg(
        F.collect_list(F.struct(F.col(xvar).alias("x"), F.col(yvar).alias("y"))).alias("points"),
        F.first("first_x").alias("first_x"), F.first("last_x").alias("last_x"))
    # One row for each cycle meets here, so the single task stays small.
    per_cycle = per_cycle.withColumns({
        "low": F.min("first_x").over(whole), "high": F.max("last_x").over(whole),
        "cycles": F.count("delivery_month").over(whole)}).filter("cycles >= 2")
    rows = per_cycle.select("delivery_month", "low", "high", F.inline("points"))
    if xvar == "norm_pct":
        low, high, step = F.lit(0), F.lit(100), 2.5
    else:
        low, high, step = F.col("low"), F.col("high"), 1.0
    curves = interpolate_to_grid(rows, "delivery_month", "x", "y", low, high, step)
    middle = F.median("y") if stat == "median" else F.avg("y")
    return curves.groupBy("x").agg(middle.alias("y")).orderBy("x")
