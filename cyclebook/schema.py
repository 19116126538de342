"""Table layouts and the fixed values shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (results depend on them) -----------------------------------
BBL_PER_M3 = 6.28981077
BROKERS = ("ICE", "Modern", "Neon", "OneX")
RULE_TABLES = {
    "ICE": "ICE_Rules",
    "Modern": "Modern_Rules",
    "Neon": "Marex_Rules",
    "OneX": "OneX_Rules",
}
CALENDAR_TABLE = "TC_Dates"
PREFERRED_TABLE = {"Modern": "Trade Report", "Neon": "Trades"}
INDEX_DEFINITIONS = {"comm": BROKERS, "1a": ("ICE", "OneX")}
DEFAULT_CLOSE_DAY = 15
LOWEST_PRIORITY = 999999.0
MONTH_CODES = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN",
               "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
TRUE_TOKENS = ("TRUE", "T", "YES", "Y", "1")
FALSE_TOKENS = ("FALSE", "F", "NO", "N", "0")

# Months written with a four-digit year number at most 12 x 10,000, so a table
# holding one row per delivery month stays a few megabytes whatever the trade
# volume. Joins against such a table may be broadcast outright.
MAX_DELIVERY_MONTHS = 120_000

TRADE_SCHEMA = T.StructType([
    T.StructField("broker", T.StringType()),
    T.StructField("trade_id", T.StringType()),
    T.StructField("exec_datetime", T.TimestampNTZType()),
    T.StructField("exec_date", T.DateType()),
    T.StructField("exec_hour", T.IntegerType()),
    T.StructField("instrument", T.StringType()),
    T.StructField("grade", T.StringType()),
    T.StructField("index_group", T.StringType()),
    T.StructField("itf", T.StringType()),
    T.StructField("swap_leg_outright", T.StringType()),
    T.StructField("in_index", T.BooleanType()),
    T.StructField("period", T.StringType()),
    T.StructField("delivery_month", T.DateType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("qty_m3", T.DoubleType()),
    T.StructField("unit_raw", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("pipeline", T.StringType()),
    T.StructField("price_basis", T.StringType()),
    T.StructField("trade_cycle_start", T.DateType()),
    T.StructField("trade_cycle_end", T.DateType()),
    T.StructField("in_trade_cycle", T.BooleanType()),
    T.StructField("source_file", T.StringType()),
])

ENRICHED_SCHEMA = T.StructType([
    *TRADE_SCHEMA.fields,
    T.StructField("exec_dow", T.StringType()),
    T.StructField("exec_dow_num", T.IntegerType()),
    T.StructField("qty_bbl", T.DoubleType()),
    T.StructField("is_component", T.BooleanType()),
    T.StructField("is_component_in_cycle", T.BooleanType()),
    T.StructField("is_index_ref", T.BooleanType()),
    T.StructField("index_type", T.StringType()),
])

CALENDAR_SCHEMA = T.StructType([
    T.StructField("delivery_month", T.DateType()),
    T.StructField("trade_cycle_start", T.DateType()),
    T.StructField("trade_cycle_end", T.DateType()),
    T.StructField("period_label", T.StringType()),
])

RULE_COLUMNS = (
    "broker", "raw_product", "raw_price_basis", "raw_index", "raw_location",
    "raw_pipeline", "raw_product_type", "raw_trade_type", "normalized_product",
    "y_n", "index_trade_financial", "swap", "index_group", "key_id",
    "rule_priority", "rule_id", "active", "notes",
)

# Columns each raw export must offer; absent ones are added as null text.
RAW_COLUMNS = {
    "ICE": ("deal_id", "is_cancelled", "parent_fin_assist", "market", "strip",
            "spread_parent_id", "local_datetime", "qty", "price", "hub_name",
            "trade_index"),
    "Modern": ("trade_number", "state", "credit_facilitation", "product",
               "price_basis", "executed_timestamp", "term", "trade_type",
               "in_index", "volume", "price", "unit_of_measure", "location",
               "pipeline_terminal"),
    "Neon": ("trade_id", "parent_trade_id", "trade_time", "product", "period",
             "location", "pipeline", "index", "qty", "price", "delivery_start",
             "delivery_end"),
    "OneX": ("trade_id", "exec_date", "exec_time", "instrument", "period",
             "qty", "unit", "price", "location", "pipeline", "buyer_pays",
             "buyer_receives", "swap_trade", "cancelled", "sleeved",
             "is_financial"),
}

# Where a raw row came from; the reader adds these and the version order uses them.
PROVENANCE = ("source_file", "source_file_modified", "source_block", "source_row")
# Numbers for the order of rows: over all sources, and in a file; tables may do without.
ROW_PLACES = ("row_ord", "source_line")
# -----------------------------------------------------------------------------
