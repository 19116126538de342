"""Display projections and the exports behind the download buttons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclebook.plans.filters import Months, narrowed
from cyclebook.plans.index import monthly_compare_full
from cyclebook.plans.quality import unparsed_month_trades
from cyclebook.plans.references import index_ref_trades
from cyclebook.sources.sinks import write_csv


def _named(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[
        (F.bround(source, 3) if source == "price" else F.col(source)).alias(name)
        for name, source in columns.items()])


def index_ref_view(trades: DataFrame, ig: str = "SW", grades: Sequence[str] | None = None,
                   dm: Months = None) -> DataFrame:
    return _named(index_ref_trades(trades, ig, grades, dm=dm), {
        "Broker": "broker", "Trade ID": "trade_id", "Date": "exec_date", "Type": "index_type",
        "Instrument": "instrument", "Grade": "grade", "Period": "period",
        "Deliv. month": "delivery_month", "Qty m³": "qty_m3", "Price diff": "price",
        "In cycle": "in_trade_cycle", "Price basis": "price_basis"})


def unparsed_view(trades: DataFrame) -> DataFrame:
    return _named(unparsed_month_trades(trades), {
        "Broker": "broker", "Trade ID": "trade_id", "Date": "exec_date", "Group": "index_group",
        "Grade": "grade", "Instrument": "instrument", "Period": "period", "Price": "price",
        "Qty m³": "qty_m3", "Source file": "source_file"})


def group_trades(trades: DataFrame, ig: str = "SW",
                 grades: Sequence[str] | None = None) -> DataFrame:
    return narrowed(trades.filter(F.col("index_group") == ig), grades, None)


def trades_view(trades: DataFrame, ig: str = "SW",
                grades: Sequence[str] | None = None) -> DataFrame:
    return _named(group_trades(trades, ig, grades), {
        "Broker": "broker", "Trade ID": "trade_id", "Date": "exec_date", "Hour": "exec_hour",
        "Instrument": "instrument", "Grade": "grade", "Class": "itf",
        "Type": "swap_leg_outright", "In idx": "in_index", "Period": "period",
        "Deliv. month": "delivery_month", "Price": "price", "Qty m³": "qty_m3",
        "In cycle": "in_trade_cycle", "Component": "is_component_in_cycle"})


def export_monthly(trades: DataFrame, path: str, ig: str = "SW",
                   grades: Sequence[str] | None = None) -> None:
    write_csv(monthly_compare_full(trades, ig, grades), path)


def export_index_refs(trades: DataFrame, path: str, ig: str = "SW",
                      grades: Sequence[str] | None = None, dm: Months = None) -> None:
    write_csv(index_ref_trades(trades, ig, grades, dm=dm), path)


def export_unparsed(trades: DataFrame, path: str) -> None:
    write_csv(unparsed_month_trades(trades), path)


def export_trades(trades: DataFrame, path: str, ig: str = "SW",
                  grades: Sequence[str] | None = None) -> None:
    write_csv(group_trades(trades, ig, grades), path)
