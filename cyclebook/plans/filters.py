"""Trade selections the reports share."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclebook.schema import BROKERS, INDEX_DEFINITIONS

# One month, several, a scalar subquery, or None for every month.
Months = dt.date | str | Column | Sequence[dt.date | str] | None


def def_brokers(definition: str | None) -> tuple[str, ...]:
    """Brokers behind an index; a broker is its own index, anything unknown means all."""
    if definition in BROKERS:
        return (definition,)
    return tuple(INDEX_DEFINITIONS.get(definition, BROKERS))


def in_months(df: DataFrame, months: Months, column: str = "delivery_month") -> DataFrame:
    if months is None:
        return df
    if isinstance(months, Column):
        return df.filter(F.col(column) == months)
    if isinstance(months, (dt.date, str)):
        months = [months]
    return df.filter(F.col(column).isin([F.lit(m).cast("date") for m in months]))


def on_weekdays(df: DataFrame, days: Sequence[int] | None, column: str = "exec_date") -> DataFrame:
    """Keep the given weekdays, 1 = Monday .. 7 = Sunday."""
    return df if days is None else df.filter((F.weekday(column) + 1).isin(list(days)))


def narrowed(df: DataFrame, grades: Sequence[str] | None, brokers: Sequence[str] | None) -> DataFrame:
    if grades is not None:
        df = df.filter(F.col("grade").isin(list(grades)))
    if brokers is not None:
        df = df.filter(F.col("broker").isin(list(brokers)))
    return df


def component_trades(trades: DataFrame, ig: str = "SW", grades: Sequence[str] | None = None,
                     brokers: Sequence[str] | None = None, in_cycle: bool = True) -> DataFrame:
    """Component trades of an index group, in cycle or all."""
    flag = "is_component_in_cycle" if in_cycle else "is_component"
    return narrowed(trades.filter((F.col("index_group") == ig) & F.col(flag)), grades, brokers)


def index_components(trades: DataFrame, ig: str, definition: str | None,
                     grades: Sequence[str] | None, in_cycle: bool = True) -> DataFrame:
    return component_trades(trades, ig, grades, def_brokers(definition), in_cycle)


def available_grades(trades: DataFrame, ig: str = "SW") -> DataFrame:
    return (trades.filter((F.col("index_group") == ig) & F.col("grade").isNotNull())
            .select("grade").distinct().orderBy("grade"))


def available_months(trades: DataFrame, ig: str = "SW") -> DataFrame:
    return (component_trades(trades, ig).filter(F.col("delivery_month").isNotNull())
            .select("delivery_month").distinct().orderBy("delivery_month"))


def latest_month(trades: DataFrame, ig: str = "SW") -> Column:
    """Default month selection, as a scalar subquery."""
    return component_trades(trades, ig).agg(F.max("delivery_month").alias("dm")).scalar()


def recent_months(df: DataFrame, n: int) -> DataFrame:
    """Rows of the ``n`` most recent delivery months.

    Meant for tables that are aggregated by month, so that little is joined. The choice of the
    months reads the month column a second time.
    """
    months = (df.filter(F.col("delivery_month").isNotNull()).select("delivery_month").distinct()
              .orderBy(F.col("delivery_month").desc()).limit(n))
    return df.join(F.broadcast(months), "delivery_month", "left_semi")  # n rows at most
