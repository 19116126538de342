"""Aggregates, unit conversion and buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cyclebook.functions.text import as_col, squish
from cyclebook.schema import BBL_PER_M3


def ratio(num: Column | str, vol: Column | str) -> Column:
    """num / vol where vol is positive, else null."""
    num, vol = as_col(num), as_col(vol)
    return F.when(vol > 0, num / vol)


def vwap(price: Column | str, qty: Column | str) -> Column:
    """Volume-weighted average price as an aggregate; null unless the volume is positive."""
    price, qty = as_col(price), as_col(qty)
    return ratio(F.sum(price * qty), F.sum(qty))


def to_bbl(qty_m3: Column | str) -> Column:
    return as_col(qty_m3) * F.lit(BBL_PER_M3)


def volume_bbl(qty: Column | str, unit: Column | str, delivery_month: Column | str) -> Column:
    """Barrels from a quantity and its unit text; daily barrels count every day of the month."""
    qty, text = as_col(qty), F.lower(squish(unit))
    days = F.dayofmonth(F.last_day(as_col(delivery_month)))
    return (F.when(text.rlike("m3|m³"), to_bbl(qty))
            .when(text.contains("bbl") & text.contains("d"), qty * days)
            .when(text.contains("bbl"), qty))


def neon_unit_label(itf: Column | str, index_key: Column | str) -> Column:
    contracts = (as_col(itf) == "Financial") | as_col(index_key).contains("ICE")
    return F.when(contracts, "contracts/month").otherwise("m3/day")


def minute_of_day(ts: Column | str, bucket_min: int) -> Column:
    """Start of the time-of-day bucket, in minutes after midnight."""
    ts = as_col(ts)
    minutes = F.hour(ts) * 60 + F.minute(ts)
    return (minutes - minutes % F.lit(bucket_min)).cast("int")


def time_bucket(ts: Column | str, bucket: str | int) -> Column:
    """Start of the day, or of the N-minute slot, holding a wall-clock instant."""
    ts = as_col(ts)
    if bucket == "day":
        return ts.cast("date").cast("timestamp_ntz")
    return F.window(ts, f"{int(bucket)} minutes").start


def percent_bin(pct: Column | str, width: float) -> Column:
    """Nearest multiple of ``width``, halves to even."""
    return F.bround(as_col(pct) / F.lit(float(width)), 0) * F.lit(float(width))
