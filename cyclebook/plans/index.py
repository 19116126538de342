"""Monthly indices, cycle development, contribution and in/out-of-cycle comparison.

Distinct brokers and grades are counted by aggregating per broker (and grade)
first and rolling up, so trades are shuffled only as partial sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclebook.functions.labels import month_label
from cyclebook.functions.measures import ratio, to_bbl, vwap
from cyclebook.operators.series import running
from cyclebook.plans.filters import (
    Months, component_trades, def_brokers, in_months, index_components, narrowed,
)
from cyclebook.schema import BROKERS

SERIES = ("comm", "1a", *BROKERS)


def _sums(df: DataFrame, *keys: str) -> DataFrame:
    """Partial sums every index is rolled up from."""
    return df.groupBy(*keys).agg(
        F.sum("qty_m3").alias("vol"),
        F.sum(F.col("price") * F.col("qty_m3")).alias("num"),
        F.count(F.lit(1)).alias("n"),
        F.min("exec_date").alias("first_day"),
        F.max("exec_date").alias("last_day"))


def monthly_index(trades: DataFrame, ig: str = "SW", definition: str = "comm",
                  grades: Sequence[str] | None = None, by_grade: bool = True) -> DataFrame:
    """VWAP, volume and participation per delivery month, optionally per grade."""
    keys = ["delivery_month", "grade"] if by_grade else ["delivery_month"]
    per_broker = _sums(index_components(trades, ig, definition, grades), *keys, "broker")
    return per_broker.groupBy(*keys).agg(
        ratio(F.sum("num"), F.sum("vol")).alias("vwap"),
        F.sum("vol").alias("vol_m3"),
        to_bbl(F.sum("vol")).alias("vol_bbl"),
        F.sum("n").alias("trades"),
        F.count("broker").alias("n_brokers"),
        F.array_join(F.array_sort(F.collect_list("broker")), ", ").alias("brokers"),
        F.min("first_day").alias("first_trade"),
        F.max("last_day").alias("last_trade"),
        F.lit(definition).alias("definition"),
    ).orderBy(*keys)


def cycle_daily(trades: DataFrame, dm: Months = None, ig: str = "SW", definition: str = "comm",
                grades: Sequence[str] | None = None) -> DataFrame:
    """Daily volume and VWAP with the accumulated index, per delivery month."""
    d = in_months(index_components(trades, ig, definition, grades), dm)
    daily = _sums(d, "delivery_month", "exec_date", "broker").groupBy(
        "delivery_month", "exec_date").agg(
        F.sum("vol").alias("day_vol"), F.sum("num").alias("day_num"),
        F.sum("n").alias("trades"), F.count("broker").alias("n_brokers"))
    w = running(["delivery_month"], ["exec_date"])
    return (
        daily.withColumn("day_vwap", F.col("day_num") / F.col("day_vol"))
        .withColumns({"cum_vol": F.sum("day_vol").over(w), "cum_num": F.sum("day_num").over(w),
                      "cum_trades": F.sum("trades").over(w)})
        .withColumn("cum_vwap", F.col("cum_num") / F.col("cum_vol"))
        .orderBy("delivery_month", "exec_date")
    )


def _contribution(d: DataFrame, by: str, inner: str | None) -> DataFrame:
    keys = ["delivery_month", by]
    sums = _sums(d, *keys, *([inner] if inner else []))
    measures = [F.sum("vol").alias("vol_m3"), F.sum("n").alias("trades"),
                ratio(F.sum("num"), F.sum("vol")).alias("vwap")]
    if inner:
        measures.append(F.count(inner).alias("n_brokers"))
    month = Window.partitionBy("delivery_month")
    return (sums.groupBy(*keys).agg(*measures)
            .withColumn("share", F.col("vol_m3") / F.sum("vol_m3").over(month))
            .orderBy("delivery_month", F.col("vol_m3").desc(), by))


def broker_contribution(trades: DataFrame, dm: Months = None, ig: str = "SW",
                        definition: str = "comm",
                        grades: Sequence[str] | None = None) -> DataFrame:
    """Volume, trades, VWAP and share of each broker within a month."""
    d = in_months(index_components(trades, ig, definition, grades), dm)
    return _contribution(d, "broker", None)


def grade_contribution(trades: DataFrame, dm: Months = None, ig: str = "SW",
                       definition: str = "comm",
                       grades: Sequence[str] | None = None) -> DataFrame:
    """The same per grade, with the number of brokers."""
    d = in_months(index_components(trades, ig, definition, grades), dm)
    return _contribution(d, "grade", "broker")


def broker_monthly_vwap(trades: DataFrame, ig: str = "SW",
                        grades: Sequence[str] | None = None) -> DataFrame:
    return (component_trades(trades, ig, grades).groupBy("delivery_month", "broker").agg(
        vwap("price", "qty_m3").alias("vwap"), F.sum("qty_m3").alias("vol_m3"),
        F.count(F.lit(1)).alias("trades")).orderBy("delivery_month", "broker"))


def monthly_compare(trades: DataFrame, ig: str = "SW",
                    grades: Sequence[str] | None = None) -> DataFrame:
    """VWAP of comm, 1a and every broker side by side, for months that have a comm index."""
    wide = monthly_compare_full(trades, ig, grades)
    return wide.filter(F.col("comm_trades").isNotNull()).select(
        "delivery_month", F.col("comm_vwap").alias("comm"), F.col("comm_vol_m3").alias("vol_m3"),
        F.col("comm_trades").alias("trades"), "n_brokers",
        *[F.col(f"{s}_vwap").alias(s) for s in SERIES[1:]]).orderBy("delivery_month")


def monthly_compare_full(trades: DataFrame, ig: str = "SW",
                         grades: Sequence[str] | None = None) -> DataFrame:
    """VWAP, volume and trades of all six series per month, in one pass.

    A series without trades in a month is null there.
    """
    sums = _sums(component_trades(trades, ig, grades, BROKERS), "delivery_month", "broker")
    columns = []
    for name in SERIES:
        mine = F.col("broker").isin(*def_brokers(name))
        vol, num = F.sum(F.when(mine, F.col("vol"))), F.sum(F.when(mine, F.col("num")))
        columns += [ratio(num, vol).alias(f"{name}_vwap"), vol.alias(f"{name}_vol_m3"),
                    F.sum(F.when(mine, F.col("n"))).alias(f"{name}_trades")]
    return sums.groupBy("delivery_month").agg(
        *columns, F.count("broker").alias("n_brokers")).orderBy("delivery_month")


def broker_vwap_wide(trades: DataFrame, ig: str = "SW",
                     grades: Sequence[str] | None = None) -> DataFrame:
    """Broker VWAPs pivoted to columns."""
    return (broker_monthly_vwap(trades, ig, grades).groupBy("delivery_month")
            .pivot("broker", list(BROKERS)).agg(F.first("vwap")).orderBy("delivery_month"))


def monthly_table(trades: DataFrame, ig: str = "SW",
                  grades: Sequence[str] | None = None) -> DataFrame:
    """Display form of the wide table."""
    wide = monthly_compare_full(trades, ig, grades)
    columns = [month_label("delivery_month").alias("Month")]
    for s in SERIES:
        columns += [F.bround(f"{s}_vwap", 3).alias(f"{s}_vwap"),
                    F.col(f"{s}_vol_m3").alias(f"{s}_vol"),
                    F.col(f"{s}_trades").alias(f"{s}_trd")]
    return wide.select(*columns)


def month_kpis(trades: DataFrame, dm: Months = None, ig: str = "SW", definition: str = "comm",
               grades: Sequence[str] | None = None) -> DataFrame:
    """Headline figures: one row per month, or a single row when ``dm`` is given.

    A given month without trades yields zeros and nulls.
    """
    d = in_months(index_components(trades, ig, definition, grades), dm)
    keys = ["delivery_month"] if dm is None else []
    # One row per broker and grade is left when the distinct counts are taken.
    rolled = _sums(d, *keys, "broker", "grade").groupBy(*keys).agg(
        ratio(F.sum("num"), F.sum("vol")).alias("index"),
        F.coalesce(F.sum("vol"), F.lit(0.0)).alias("vol_m3"),
        F.coalesce(to_bbl(F.sum("vol")), F.lit(0.0)).alias("vol_bbl"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("trades"),
        F.countDistinct("broker").alias("n_brokers"),
        F.countDistinct("grade").alias("n_grades"),
        F.min("first_day").alias("first"),
        F.max("last_day").alias("last"))
    return rolled.orderBy(*keys) if keys else rolled


def cycle_window(trades: DataFrame, dm: Months = None, ig: str = "SW") -> DataFrame:
    """Earliest start and latest end of the windows seen on a month's trades."""
    d = in_months(trades.filter(F.col("index_group") == ig), dm)
    keys = ["delivery_month"] if dm is None else []
    return d.groupBy(*keys).agg(F.min("trade_cycle_start").alias("cycle_start"),
                                F.max("trade_cycle_end").alias("cycle_end")).orderBy(*keys or ["cycle_start"])


def broker_share(trades: DataFrame, ig: str = "SW",
                 grades: Sequence[str] | None = None) -> DataFrame:
    return (component_trades(trades, ig, grades).groupBy("delivery_month", "broker")
            .agg(F.sum("qty_m3").alias("vol")).orderBy("delivery_month", "broker"))


def grade_mix(trades: DataFrame, ig: str = "SW",
              grades: Sequence[str] | None = None) -> DataFrame:
    return (component_trades(trades, ig, grades).groupBy("delivery_month", "grade")
            .agg(F.sum("qty_m3").alias("vol")).orderBy("delivery_month", "grade"))


def cycle_position():
    """Where a trade lies relative to its window."""
    unknown = (F.col("exec_date").isNull() | F.col("trade_cycle_start").isNull()
               | F.col("trade_cycle_end").isNull())
    return (F.when(F.coalesce(F.col("in_trade_cycle"), F.lit(False)), "In cycle")
            .when(unknown, "No TC match")
            .when(F.col("exec_date") < F.col("trade_cycle_start"), "Before cycle")
            .when(F.col("exec_date") > F.col("trade_cycle_end"), "After cycle")
            .otherwise("No TC match"))


def historic_cycle_compare(trades: DataFrame, ig: str = "SW",
                           grades: Sequence[str] | None = None,
                           brokers: Sequence[str] | None = None) -> DataFrame:
    """Volume and prices inside, before and after the cycle; trades without a month stay a group."""
    d = narrowed(trades.filter((F.col("index_group") == ig) & F.col("is_component")),
                 grades, brokers)
    return d.groupBy("delivery_month", cycle_position().alias("cycle")).agg(
        F.sum("qty_m3").alias("vol_m3"), F.avg("price").alias("avg_price"),
        vwap("price", "qty_m3").alias("vwap"), F.count(F.lit(1)).alias("trades"),
    ).orderBy(F.col("delivery_month").asc_nulls_last(), "cycle")
