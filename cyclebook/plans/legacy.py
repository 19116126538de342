"""Older presentation layout and per-source index tables, kept for existing users."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclebook.functions import dates as D
from cyclebook.functions.measures import to_bbl, volume_bbl
from cyclebook.functions.text import clean_num, has_text, squish, ukey
from cyclebook.operators.ranking import keep_first
from cyclebook.plans.dataset import component_flag
from cyclebook.schema import BBL_PER_M3, PROVENANCE


def legacy_layout(trades: DataFrame) -> DataFrame:
    """21 named columns; location is the pipeline except for ICE, unknown windows count as outside."""
    clock = F.when(F.col("exec_hour").isNotNull(), F.substring(F.col("exec_datetime").cast("string"), 12, 8))
    location = F.when(F.col("broker") == "ICE", F.col("location")).otherwise(F.col("pipeline"))
    return trades.select(
        F.col("trade_id").alias("Trade ID"), F.col("exec_date").alias("Exec Date"),
        clock.alias("Exec Time"), F.col("instrument").alias("Instrument"),
        F.col("period").alias("Period"), F.col("qty_m3").alias("Qty"),
        F.col("unit_raw").alias("Unit"), F.col("price").alias("Price"),
        F.col("price_basis").alias("Price Basis"), location.alias("Location"),
        F.col("broker").alias("Broker"), F.col("in_index").alias("In Index?"),
        F.col("itf").alias("Index/Trade/Financial"),
        F.col("swap_leg_outright").alias("Swap/Leg/Outright"),
        F.col("index_group").alias("Index Group"), F.col("grade").alias("KeyID"),
        F.col("delivery_month").alias("period_delivery_month"),
        "trade_cycle_start", "trade_cycle_end",
        F.coalesce("in_trade_cycle", F.lit(False)).alias("Inside Trade Cycle?"),
        "source_file")


def vwap_input(trades: DataFrame, index_group: str | None = "SW",
               require_grade: bool = False) -> DataFrame:
    """In-cycle component trades of one group, or of all; a grade is not required.

    Rule sheets of that time wrote class and kind in any case.
    """
    kept = trades.filter(component_flag(require_grade, any_case=True)
                         & F.coalesce(F.col("in_trade_cycle"), F.lit(False)))
    return kept if index_group is None else kept.filter(ukey("index_group") == index_group)


def _price_range() -> list[Column]:
    return [F.min("price").alias("min_price"), F.max("price").alias("max_price")]


def vwap_by_cycle(trades: DataFrame, index_group: str | None = "SW",
                  with_bbl: bool = False) -> DataFrame:
    """VWAP by period and cycle with the price range; ``with_bbl`` adds barrels."""
    keys = ["period", "delivery_month", "trade_cycle_start", "trade_cycle_end", "index_group"]
    volume = [F.sum("qty_m3").alias("total_volume_m3_per_month")]
    if with_bbl:
        volume.append(to_bbl(F.sum("qty_m3")).alias("total_volume_bbl_per_month"))
    return vwap_input(trades, index_group).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trade_count"), *volume,
        (F.sum(F.col("price") * F.col("qty_m3")) / F.sum("qty_m3")).alias("vwap"),
        *_price_range()).orderBy("delivery_month", "index_group", "period")


def vwap_by_barrels(trades: DataFrame, index_group: str = "SW") -> DataFrame:
    """VWAP weighted by barrels after converting each trade's own unit."""
    bbl = volume_bbl("qty_m3", "unit_raw", "delivery_month")
    converted = vwap_input(trades, index_group).withColumn("bbl", bbl).filter("bbl > 0")
    return converted.groupBy("period", "delivery_month", "index_group").agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.sum("bbl").alias("total_volume_bbl"),
        (F.sum("bbl") / F.lit(BBL_PER_M3)).alias("total_volume_m3"),
        (F.sum(F.col("price") * F.col("bbl")) / F.sum("bbl")).alias("vwap"),
        *_price_range()).orderBy("delivery_month", "index_group", "period")


def latest_neon_by_number(raw: DataFrame) -> DataFrame:
    """Newest file first, then the highest numeric id; blank ids stay apart."""
    ids = raw.withColumn("trade_id", squish("trade_id"))
    order = [F.col("source_file_modified").desc_nulls_last(),
             clean_num("trade_id").desc_nulls_last(),
             F.col("source_file"), F.col("source_block"), F.col("source_row")]
    return keep_first(ids, ["trade_id"], order, ~has_text("trade_id"), PROVENANCE)


def latest_onex_by_sheet(raw: DataFrame, order: Sequence[str] = (
        "export_end", "source_file_modified", "source_file", "source_sheet")) -> DataFrame:
    """Export end, file age, file name and sheet, all descending; blank ids stay apart."""
    ids = raw.withColumns({"trade_id": F.nullif(squish("trade_id"), F.lit("")),
                           "export_end": D.export_end("source_file")})
    ranks = [F.col(c).desc_nulls_last() for c in order]
    return keep_first(ids, ["trade_id"], [*ranks, F.col("source_block"), F.col("source_row")],
                      F.col("trade_id").isNull(), PROVENANCE)
