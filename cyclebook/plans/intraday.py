"""Hour-of-day, time-of-day and candlestick profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclebook.functions.measures import minute_of_day, time_bucket, vwap
from cyclebook.functions.text import as_col
from cyclebook.operators.series import running
from cyclebook.plans.filters import Months, in_months, index_components, on_weekdays


def hourly_profile(trades: DataFrame, ig: str = "SW", definition: str = "comm",
                   grades: Sequence[str] | None = None, dms: Months = None,
                   in_cycle: bool = True) -> DataFrame:
    d = in_months(index_components(trades, ig, definition, grades, in_cycle), dms)
    return d.filter(F.col("exec_hour").isNotNull()).groupBy("exec_hour").agg(
        F.sum("qty_m3").alias("vol_m3"), F.count(F.lit(1)).alias("trades"),
        F.avg("price").alias("avg_price"), vwap("price", "qty_m3").alias("vwap"),
    ).orderBy("exec_hour")


def _timed(trades: DataFrame, ig: str, definition: str | None, grades: Sequence[str] | None,
           dms: Months, dows: Sequence[int] | None, in_cycle: bool, bucket_min: int) -> DataFrame:
    d = in_months(index_components(trades, ig, definition, grades, in_cycle), dms)
    d = on_weekdays(d.dropna(subset=["exec_hour", "exec_datetime"]), dows)
    return d.withColumn("tod", minute_of_day("exec_datetime", bucket_min))


def intraday_total(trades: DataFrame, ig: str = "SW", definition: str = "comm",
                   grades: Sequence[str] | None = None, dms: Months = None,
                   dows: Sequence[int] | None = None, in_cycle: bool = True,
                   bucket_min: int = 60) -> DataFrame:
    """Volume and prices per time-of-day bucket with the running session VWAP.

    At most 1,440 buckets reach the running sum, whatever the number of trades.
    """
    d = _timed(trades, ig, definition, grades, dms, dows, in_cycle, bucket_min)
    total = d.groupBy("tod").agg(
        F.sum("qty_m3").alias("vol_m3"), F.sum(F.col("price") * F.col("qty_m3")).alias("num"),
        F.count(F.lit(1)).alias("trades"), vwap("price", "qty_m3").alias("vwap"),
        F.avg("price").alias("avg_price"))
    w = running([], ["tod"])
    return total.withColumn("cum_vwap", F.sum("num").over(w) / F.sum("vol_m3").over(w)).orderBy("tod")


def intraday_byseg(trades: DataFrame, by: str, ig: str = "SW", definition: str = "comm",
                   grades: Sequence[str] | None = None, dms: Months = None,
                   dows: Sequence[int] | None = None, in_cycle: bool = True,
                   bucket_min: int = 60) -> DataFrame:
    """Volume per bucket and segment; rows without a segment are dropped."""
    d = _timed(trades, ig, definition, grades, dms, dows, in_cycle, bucket_min)
    return (d.filter(F.col(by).isNotNull()).groupBy("tod", F.col(by).alias("seg"))
            .agg(F.sum("qty_m3").alias("vol_m3"), F.count(F.lit(1)).alias("trades"))
            .orderBy("tod", "seg"))


def intraday_profile(trades: DataFrame, ig: str = "SW", definition: str = "comm",
                     grades: Sequence[str] | None = None, dms: Months = None,
                     dows: Sequence[int] | None = None, in_cycle: bool = True,
                     bucket_min: int = 60,
                     by: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Total and per-segment profile as a pair."""
    args = (ig, definition, grades, dms, dows, in_cycle, bucket_min)
    return (intraday_total(trades, *args),
            intraday_byseg(trades, by, *args) if by is not None else None)


PRICE_STEPS = 1_000_000  # prices are told apart by this fraction where nothing else orders them


def order_key(at: Column | str, place: Column | str) -> Column:
    """One number that orders by wall-clock instant and then by a whole number."""
    at = as_col(at)
    seconds = F.extract(F.lit("SECOND"), at).cast("decimal(8,6)")
    micros = (F.unix_date(at.cast("date")).cast("long") * 86_400_000_000
              + (F.hour(at) * 60 + F.minute(at)).cast("long") * 60_000_000
              + (seconds * 1_000_000).cast("long"))
    return (micros.cast("decimal(18,0)") * F.lit("1" + "0" * 20).cast("decimal(21,0)")
            + as_col(place).cast("long").cast("decimal(20,0)"))


def ohlc_profile(trades: DataFrame, ig: str = "SW", definition: str = "comm",
                 grades: Sequence[str] | None = None, dm: Months = None,
                 bucket: str | int = "day", in_cycle: bool = True,
                 ordinal: Column | str | None = None) -> DataFrame:
    """Open, high, low, close, volume and VWAP per grade and time bucket.

    Open and close follow the execution instant. Of trades at the same instant the whole number
    ``ordinal``, the row order of the source, decides; without it the lowest price opens and the
    highest closes. The order key has a fixed width, so candles are hash-aggregated in parts.
    """
    d = in_months(index_components(trades, ig, definition, grades, in_cycle), dm)
    d = d.dropna(subset=["exec_datetime", "price", "grade"])
    place = as_col(ordinal) if ordinal is not None else F.floor(F.col("price") * PRICE_STEPS)
    at = order_key("exec_datetime", place)
    return d.groupBy("grade", time_bucket("exec_datetime", bucket).alias("bkt")).agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"),
        F.min("price").alias("low"), F.max_by("price", at).alias("close"),
        F.sum("qty_m3").alias("volume"), F.count(F.lit(1)).alias("trades"),
        vwap("price", "qty_m3").alias("vwap"),
    ).orderBy("grade", "bkt")
