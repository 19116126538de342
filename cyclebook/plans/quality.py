"""Coverage, unmapped products, unparsed months and completeness checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclebook.functions import dates as D
from cyclebook.functions.text import has_text

# The raw column that dates a trade, and how it is read.
DATE_COLUMNS = {
    "ICE": ("local_datetime", D.ice_local_timestamp),
    "Modern": ("executed_timestamp", D.modern_timestamp),
    "Neon": ("trade_time", D.neon_timestamp),
    "OneX": ("exec_date", D.onex_date),
}


def qa_coverage(trades: DataFrame) -> DataFrame:
    """Per broker: date span, rows, SW rows, components, in-cycle components, unmapped rows."""
    return trades.groupBy("broker").agg(
        F.min("exec_date").alias("oldest"),
        F.max("exec_date").alias("latest"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("index_group") == "SW").alias("sw_rows"),
        F.count_if("is_component").alias("component_rows"),
        F.count_if("is_component_in_cycle").alias("component_in_cycle"),
        F.count_if(F.col("index_group").isNull()).alias("unmapped"),
    ).orderBy("broker")


def qa_unmapped(trades: DataFrame) -> DataFrame:
    """Products without an index group, most frequent first."""
    return (trades.filter(F.col("index_group").isNull())
            .groupBy("broker", "instrument", "price_basis")
            .agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(F.col("rows").desc(), "broker", "instrument", "price_basis"))


def qa_build(trades: DataFrame) -> DataFrame:
    return trades.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.current_timestamp().alias("built_at"), "n_rows")


def rejected_dates(raw: DataFrame, broker: str) -> DataFrame:
    """Per file of a raw export: texts in the execution date or time that no accepted layout fits.

    Such trades have no date and so are in no index. Blank cells are not rejected texts.
    """
    column, parse = DATE_COLUMNS[broker]
    bad = raw.filter(has_text(column) & parse(column).isNull())
    return bad.groupBy("source_file").agg(F.count(F.lit(1)).alias("rejected")).select(
        F.lit(broker).alias("broker"), F.lit(column).alias("column"), "source_file", "rejected")


def unparsed_month_trades(trades: DataFrame) -> DataFrame:
    """Graded physical trades whose period label gave no delivery month."""
    columns = ("broker", "trade_id", "exec_date", "index_group", "grade", "instrument",
               "period", "price", "qty_m3", "source_file")
    # The trade id closes the sort key so that one frequent label still splits.
    return (trades.filter((F.col("itf") == "Trade") & F.col("grade").isNotNull()
                          & F.col("delivery_month").isNull() & has_text("period"))
            .select(*columns).orderBy("broker", "period", "grade", "trade_id"))


def duplicate_check(raw: DataFrame, id_col: str) -> DataFrame:
    """Ids that occur more than once, most frequent first (older report)."""
    return (raw.filter(F.col(id_col).isNotNull()).groupBy(id_col)
            .agg(F.count(F.lit(1)).alias("duplicate_count"))
            .filter("duplicate_count > 1")
            .orderBy(F.col("duplicate_count").desc(), id_col))


def duplicate_summary(raw: DataFrame, id_col: str) -> DataFrame:
    """Rows, distinct ids, ids with copies, removable rows (older report).

    Rows without an id never count as copies. One pass: rows per id, then totals.
    """
    blank = F.col(id_col).isNull()
    per_id = raw.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before_dedup"),
        F.count(id_col).alias("unique_trade_ids"),
        F.count_if(~blank & (F.col("n") > 1)).alias("duplicated_trade_ids"),
        F.coalesce(F.sum(F.when(~blank, F.col("n") - 1)), F.lit(0)).alias("duplicate_rows_to_remove"))


def completeness_summary(layout: DataFrame) -> DataFrame:
    """Null counts of the presentation layout (older report)."""
    def missing(name: str):
        return F.count_if(F.col(f"`{name}`").isNull())

    return layout.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("`Trade ID`").isNull() | (F.col("`Trade ID`") == "")).alias("missing_trade_id"),
        missing("Exec Date").alias("missing_exec_date"),
        missing("Exec Time").alias("missing_exec_time"),
        missing("period_delivery_month").alias("missing_period_delivery_month"),
        missing("In Index?").alias("missing_in_index"),
        missing("Index/Trade/Financial").alias("missing_classification"),
        missing("Index Group").alias("missing_index_group"),
        missing("KeyID").alias("missing_key_id"),
        F.count_if(~F.col("`Inside Trade Cycle?`")).alias("outside_trade_cycle"))


def unmatched_rules(layout: DataFrame) -> DataFrame:
    """Distinct combinations for which some classification is missing (older report)."""
    keys = ["Instrument", "Price Basis", "Location", "Period", "In Index?",
            "Index/Trade/Financial", "Swap/Leg/Outright", "Index Group", "KeyID"]
    gap = (F.col("`In Index?`").isNull() | F.col("`Index/Trade/Financial`").isNull()
           | F.col("`Index Group`").isNull() | F.col("KeyID").isNull())
    return (layout.filter(gap).select(*[F.col(f"`{k}`") for k in keys]).distinct()
            .orderBy("Instrument", F.col("`Price Basis`"), "Location", "Period"))
