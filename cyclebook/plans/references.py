"""Trades executed at a published index: volume and participation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclebook.plans.filters import Months, in_months, narrowed


def index_ref_trades(trades: DataFrame, ig: str = "SW", grades: Sequence[str] | None = None,
                     types: Sequence[str] | None = None, dm: Months = None) -> DataFrame:
    d = narrowed(trades.filter((F.col("index_group") == ig) & F.col("is_index_ref")), grades, None)
    if types is not None:
        d = d.filter(F.col("index_type").isin(list(types)))
    return in_months(d, dm)


def index_ref_monthly(trades: DataFrame, ig: str = "SW",
                      grades: Sequence[str] | None = None) -> DataFrame:
    return (index_ref_trades(trades, ig, grades).groupBy("delivery_month", "index_type")
            .agg(F.sum("qty_m3").alias("vol_m3"), F.count(F.lit(1)).alias("trades"))
            .orderBy(F.col("delivery_month").asc_nulls_last(), "index_type"))


def index_ref_by(trades: DataFrame, ig: str = "SW", grades: Sequence[str] | None = None,
                 dm: Months = None, by: str = "broker") -> DataFrame:
    """Volume per broker or grade with the sorted list of index types (five at most)."""
    return (index_ref_trades(trades, ig, grades, dm=dm).groupBy(by)
            .agg(F.sum("qty_m3").alias("vol_m3"), F.count(F.lit(1)).alias("trades"),
                 F.array_join(F.array_sort(F.collect_set("index_type")), ", ").alias("types"))
            .orderBy(F.col("vol_m3").desc_nulls_last(), by))


def index_ref_kpis(trades: DataFrame, ig: str = "SW", grades: Sequence[str] | None = None,
                   dm: Months = None) -> DataFrame:
    """One row of totals; sums over nothing are zero."""
    qty = F.col("qty_m3")
    in_cycle = F.coalesce(F.col("in_trade_cycle"), F.lit(False))
    per_broker = index_ref_trades(trades, ig, grades, dm=dm).groupBy("broker").agg(
        F.sum(qty).alias("vol"),
        F.sum(F.when(F.col("index_type") == "comm", qty)).alias("comm"),
        F.sum(F.when(F.col("index_type") == "1a", qty)).alias("a1"),
        F.count(F.lit(1)).alias("trades"),
        F.sum(F.when(in_cycle, qty)).alias("in_cycle"))
    totals = [F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("vol", "comm", "a1")]
    return per_broker.agg(
        *totals, F.coalesce(F.sum("trades"), F.lit(0)).alias("trades"),
        F.coalesce(F.sum("in_cycle"), F.lit(0.0)).alias("in_cycle"),
        F.count(F.lit(1)).alias("n_brokers"))


def index_ref_months(trades: DataFrame, ig: str = "SW") -> DataFrame:
    return (index_ref_trades(trades, ig).filter(F.col("delivery_month").isNotNull())
            .select("delivery_month").distinct().orderBy("delivery_month"))
