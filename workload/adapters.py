"""Trades and raw exports expressed over the given tables.

Every definition is a list of column expressions, rendered once for Spark and
once for DuckDB. Each one covers all rows of its table. Prices are multiples of
1/8 and quantities whole numbers, so sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cyclebook.session import for_wide_rows
from workload.dialect import SPARK, SparkSQL

NBSP, EN_DASH = " ", "–"
CALENDAR_FIRST, CALENDAR_LAST = "1997-01-01", "2001-12-01"


def texts(*items: str | None) -> list[str]:
    return ["CAST(NULL AS STRING)" if i is None else f"'{i}'" for i in items]


PRICE = "(floor(l_extendedprice) % 161 - 80) / 8"
SHIP_DAY = "CAST(l_shipdate AS DATE)"
MINUTE = "(l_partkey * 7 + l_linenumber * 131) % 1440"
ID = "CAST(l_orderkey * 10 + l_linenumber AS STRING)"


def ship_month(d: SparkSQL) -> str:
    """Delivery month: one, two or no months after shipping."""
    shift = "CASE l_linenumber % 3 WHEN 1 THEN 1 WHEN 0 THEN 2 ELSE 0 END"
    return d.plus_months(d.month(SHIP_DAY), f"({shift})")


def provenance(d: SparkSQL, prefix: str) -> dict[str, str]:
    return {
        "source_file": f"'{prefix}_' || CAST(year(l_shipdate) AS STRING) || '.csv'",
        "source_file_modified": "l_shipdate",
        "source_block": "l_orderkey",
        "source_row": "l_partkey * 8 + l_linenumber",
        "source_line": "l_orderkey * 8 + l_linenumber",
    }


def trades_columns(d: SparkSQL) -> dict[str, str]:
    """Normalized trades, one per line item."""
    month = ship_month(d)
    broker = d.pick(texts("ICE", "Modern", "Neon", "OneX"), "l_suppkey % 4")
    dated = "NOT (l_quantity = 13 AND l_linenumber = 3)"
    return {
        "broker": broker,
        "trade_id": "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
        "exec_datetime": f"CASE WHEN {dated} THEN {d.plus_minutes('l_shipdate', MINUTE)} END",
        "exec_date": f"CASE WHEN {dated} THEN {SHIP_DAY} END",
        "exec_hour": f"CASE WHEN {dated} THEN CAST(floor(({MINUTE}) / 60) AS INT) END",
        "instrument": "'Product ' || CAST(l_partkey % 6 AS STRING)",
        "grade": "CASE WHEN l_partkey % 29 > 0 THEN"
                 " 'G' || CAST(l_partkey % 25 + 1 AS STRING) END",
        "swap_leg_outright": "CASE WHEN l_returnflag <> 'R' THEN 'Outright'"
                             " WHEN l_linestatus = 'F' THEN 'Leg' ELSE 'Swap' END",
        "in_index": "CASE WHEN l_tax = 0.08 THEN FALSE WHEN l_tax <> 0.07 THEN TRUE END",
        "period": f"CASE WHEN l_linenumber = 7 THEN 'Q3 98' ELSE {d.fmt(month, 'Mon-Y')} END",
        "delivery_month": f"CASE WHEN l_linenumber < 7 THEN {month} END",
        "price": f"CASE WHEN l_discount < 0.1 THEN {PRICE} END",
        "qty_m3": "CASE WHEN l_tax = 0.06 THEN 0.0e0 WHEN l_tax > 0 THEN l_quantity END",
        "unit_raw": d.pick(texts("m3", "bbl/day", "BBL", "m³"), "l_suppkey % 4"),
        "location": d.pick(texts("Edmonton", "Hardisty", "Cushing"), "l_suppkey % 3"),
        "pipeline": d.pick(texts("Rainbow", "Pembina", None), "l_partkey % 3"),
        "price_basis": d.pick(texts("WTI CMA", "1a", "Comm", "bi4 index", "XAPP comm"),
                              "l_suppkey % 5"),
        "source_file": f"lower({broker}) || '_' || CAST(year(l_shipdate) AS STRING) || '.csv'",
    }


PRODUCT_RULES = """
SELECT * FROM (VALUES
  ('Product 0', 'Trade', 'SW'), ('Product 1', 'Trade', 'SW'), ('Product 2', 'Index', 'sw '),
  ('Product 3', 'Trade', 'SYN'), ('Product 4', 'Financial', CAST(NULL AS STRING))
) AS r(instrument, itf, index_group)
"""


def calendar_sql(d: SparkSQL) -> str:
    """Windows from the first of the month before to the 12th-17th; 1999-06 has no dates."""
    start = d.plus_months("delivery_month", "-1")
    end = d.plus_days(start, "11 + month(delivery_month) % 6")
    known = "delivery_month <> DATE '1999-06-01'"
    return f"""SELECT delivery_month,
      CASE WHEN {known} THEN {start} END AS trade_cycle_start,
      CASE WHEN {known} THEN {end} END AS trade_cycle_end,
      CAST(NULL AS STRING) AS period_label
    FROM ({d.months(CALENDAR_FIRST, CALENDAR_LAST)}) AS m"""


def events_columns(d: SparkSQL) -> dict[str, str]:
    """Normalized trades with sub-second instants, one per event."""
    return {
        "broker": d.pick(texts("ICE", "Modern", "Neon", "OneX"), "user_id % 4"),
        "trade_id": "CAST(event_id AS STRING)",
        "exec_datetime": "ts",
        "exec_date": "CAST(ts AS DATE)",
        "exec_hour": "CAST(hour(ts) AS INT)",
        "instrument": "event_type",
        "grade": "event_type",
        "index_group": "'SW'",
        "itf": "'Trade'",
        "swap_leg_outright": "'Outright'",
        "in_index": "TRUE",
        "period": "'Feb-2024'",
        "delivery_month": "DATE '2024-02-01'",
        "price": "floor(value * 8) / 8",
        "qty_m3": d.json_number("props", "k"),
        "unit_raw": "'m3'",
        "location": "CAST(NULL AS STRING)",
        "pipeline": "CAST(NULL AS STRING)",
        "price_basis": "'WTI CMA'",
        "trade_cycle_start": "DATE '2024-01-01'",
        "trade_cycle_end": "DATE '2024-01-15'",
        "in_trade_cycle": "CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-15'",
        "source_file": "'events'",
    }


def ice_columns(d: SparkSQL) -> dict[str, str]:
    month = ship_month(d)
    strip = f"""CASE l_linenumber WHEN 7 THEN 'Q3 98'
        WHEN 5 THEN {d.fmt(month, 'MonY')} || '-' || {d.fmt(month, 'MonY')}
        ELSE {d.fmt(month, 'MonY')} END"""
    product = d.pick(texts("Sweet", f"sweet{NBSP} blend", "SYNTHETIC", "C5+",
                           f"Heavy {EN_DASH} Sour", "Unlisted"), "l_partkey % 6")
    hub = d.pick(texts("Edm", "Hardisty"), "l_suppkey % 2")
    at = d.plus_minutes("l_shipdate", MINUTE)
    return {
        "deal_id": ID,
        "is_cancelled": "CASE WHEN l_discount = 0.1 THEN 'Y' WHEN l_discount = 0.09 THEN ' yes '"
                        " WHEN l_discount = 0.08 THEN 'N' END",
        "parent_fin_assist": "CASE WHEN l_tax = 0.08 THEN 'FA-1' WHEN l_tax = 0.07 THEN '  ' END",
        "market": f"CASE WHEN l_partkey % 211 = 0 THEN NULL WHEN l_partkey % 50 = 0 THEN {product}"
                  f" ELSE {product} || '{NBSP} - ' || {hub} || ' - ' || {strip} END",
        "strip": strip,
        "spread_parent_id": "CASE WHEN l_returnflag = 'R' THEN 'S' || CAST(l_orderkey AS STRING)"
                            " WHEN l_linestatus = 'F' THEN ' ' END",
        "local_datetime": f"CASE WHEN l_quantity = 50 THEN 'n/a' WHEN l_quantity = 49 THEN"
                          f" {d.fmt(at, 'mdy')} ELSE {d.fmt(at, 'mdy hms')} END",
        "qty": f"'$' || {d.thousands('l_quantity * 100')}",
        "price": f"CASE WHEN l_discount = 0.07 THEN '(5)' ELSE CAST({PRICE} AS STRING) END",
        "hub_name": hub,
        "trade_index": d.pick(texts("WTI CMA", "1a", None), "l_partkey % 3"),
        "product_name": d.pick(texts("Outright", "wcs Spr", "Monthly"), "l_suppkey % 3"),
        "product_full_name": d.pick(texts("Full", None, "Full Spread", "x"), "l_partkey % 4"),
        **provenance(d, "ice"),
    }


def modern_columns(d: SparkSQL) -> dict[str, str]:
    """Needs ``orders`` for the state of a trade."""
    month = ship_month(d)
    at = d.plus_minutes("l_shipdate", MINUTE)
    return {
        "trade_number": ID,
        "state": "CASE o_orderstatus WHEN 'F' THEN 'Finalized' WHEN 'O' THEN ' FINALIZED '"
                 " ELSE 'Pending' END",
        "credit_facilitation": "CASE WHEN l_tax = 0.08 THEN 'TRUE' WHEN l_tax = 0.07 THEN 'no'"
                               " WHEN l_tax = 0.06 THEN 'maybe' END",
        "product": d.pick(texts("SW", "sw ", "Syn", "COND", f"SW{NBSP}", "C5"), "l_partkey % 6"),
        "price_basis": d.pick(texts("WTI CMA", "wti  cma", "COMM + WTI CMA", None),
                              "l_suppkey % 4"),
        "executed_timestamp": f"""CASE WHEN l_quantity = 50 THEN 'pending'
            WHEN l_linenumber % 3 = 0 THEN {d.fmt(at, 'ymd hms p')}
            WHEN l_linenumber % 3 = 1 THEN {d.fmt(at, 'ymd hms')}
            ELSE {d.fmt(at, 'ymd hm')} END""",
        "term": f"CASE WHEN l_linenumber = 7 THEN 'CAL 98' ELSE upper({d.fmt(month, 'Mon-Y')}) END",
        "trade_type": """CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'Outright'
            WHEN 'AO' THEN 'outright ' WHEN 'NF' THEN 'Spread' WHEN 'NO' THEN 'First  Leg'
            WHEN 'RF' THEN 'SECOND LEG' ELSE 'Block' END""",
        "in_index": d.pick(texts("TRUE", "t", "N", None, "1"), "l_suppkey % 5"),
        "volume": d.thousands("l_quantity * 100"),
        "price": f"'$' || CAST({PRICE} AS STRING)",
        "unit_of_measure": d.pick(texts("m3", "bbl/day", "bbl"), "l_suppkey % 3"),
        "location": d.pick(texts("Edmonton", "Hardisty"), "l_suppkey % 2"),
        "pipeline_terminal": d.pick(texts("Pembina", "Rainbow", None), "l_partkey % 3"),
        **provenance(d, "modern"),
    }


def neon_columns(d: SparkSQL) -> dict[str, str]:
    month = ship_month(d)
    at = d.plus_minutes("l_shipdate", MINUTE)
    return {
        "trade_id": f"CASE WHEN l_quantity = 1 THEN ' ' WHEN l_quantity = 2 THEN NULL"
                    f" ELSE 'N-' || {ID} END",
        "parent_trade_id": "CASE WHEN l_linenumber >= 5 THEN"
                           " 'N-' || CAST(l_orderkey * 10 + 1 AS STRING)"
                           " WHEN l_linenumber = 4 THEN ' ' END",
        "trade_time": f"""CASE WHEN l_quantity = 50 THEN 'late'
            WHEN l_linenumber % 3 = 0 THEN {d.fmt(at, 'ymd')}
            WHEN l_linenumber % 3 = 1 THEN {d.fmt(at, 'ymd hms')}
            ELSE {d.fmt(at, 'ymd hm')} END""",
        "product": d.pick(texts("SW", "sw", "SYN ", "C5"), "l_partkey % 4"),
        "index": d.pick(texts("WTI CMA", "wti cma", "Ice WTI", None, " "), "l_suppkey % 5"),
        "location": d.pick(texts("Edmonton", "Hardisty", None), "l_suppkey % 3"),
        "pipeline": d.pick(texts("Rainbow", "pembina", None, "Other"), "l_partkey % 7 % 4"),
        "period": f"CASE WHEN l_linenumber = 7 THEN 'MARCH 26' ELSE {d.fmt(month, 'Mon Y')} END",
        "delivery_start": f"CASE WHEN l_quantity < 40 THEN {d.fmt(month, 'ymd')} END",
        "delivery_end": "CAST(NULL AS STRING)",
        "qty": d.thousands("l_quantity * 100"),
        "price": f"CAST({PRICE} AS STRING)",
        **provenance(d, "neon"),
    }


def onex_columns(d: SparkSQL) -> dict[str, str]:
    """Coarse economics, so that equal trades occur."""
    day = d.month(SHIP_DAY)
    year = "CAST(year(l_shipdate) AS STRING)"
    return {
        "trade_id": f"CASE WHEN l_quantity = 1 THEN ' ' ELSE {ID} END",
        "exec_date": f"""CASE l_linenumber % 3 WHEN 0 THEN {d.fmt(day, 'ymd')}
            WHEN 1 THEN {d.fmt(day, 'mdy')} ELSE {d.serial(day)} END""",
        "exec_time": "CASE WHEN l_linestatus = 'F' THEN CASE l_linenumber % 3 WHEN 0 THEN"
                     " '9:15:22 AM' WHEN 1 THEN '09:15:22' ELSE '2:05 PM' END END",
        "instrument": d.pick(texts("SW Edmonton", f"sw{NBSP}{NBSP}Edmonton", "Syn Index", "C5+"),
                             "l_partkey % 4"),
        "period": f"CASE WHEN l_linenumber = 7 THEN 'Q3 98' ELSE"
                  f" {d.fmt(d.plus_months(day, '1'), 'Mon Y')} END",
        "qty": d.thousands("l_quantity % 5 * 1000"),
        "unit": d.pick(texts("m3", "M3 "), "l_suppkey % 2"),
        "price": "CAST(l_discount AS STRING)",
        "location": "'Edmonton'",
        "pipeline": d.pick(texts("Rainbow", "RAINBOW"), "l_partkey % 2"),
        "buyer_pays": "'WTI CMA'",
        "buyer_receives": "'SW'",
        "swap_trade": "CASE WHEN l_discount = 0 THEN 'Parent' WHEN l_discount = 0.01 THEN 'leg'"
                      " WHEN l_returnflag = 'N' THEN ' ' END",
        "cancelled": "CASE WHEN l_tax = 0.08 THEN 'Y' WHEN l_tax = 0.07 THEN 'no' END",
        "sleeved": "CASE l_returnflag WHEN 'R' THEN 'Y' WHEN 'N' THEN 'N' END",
        "is_financial": d.pick(texts("N", "Y"), "l_suppkey % 2"),
        **provenance(d, "onex"),
        "source_file": f"'onex_' || {year} || '-01-01_' || {year} || '-12-31.csv'",
        "source_sheet": d.pick(texts("Trades", "Late"), "l_linenumber % 2"),
    }


def dated_columns(d: SparkSQL) -> dict[str, str]:
    """The ship date as brokers write it: month names, two-digit years, year first or last."""
    day = "CAST(day(l_shipdate) AS STRING)"
    year = "CAST(year(l_shipdate) AS STRING)"
    name = f"substr({d.fmt(SHIP_DAY, 'Mon-Y')}, 1, 3)"
    month = "CAST(month(l_shipdate) AS STRING)"
    forms = [f"{day} || '-' || {name} || '-' || {year}", f"{name} || ' ' || {day} || ', ' || {year}",
             f"{year} || '-' || upper({name}) || '-' || {day}", f"{day} || ' ' || lower({name}) || ' ' || substr({year}, 3, 2)",
             f"CASE WHEN year(l_shipdate) % 100 > 12 THEN substr({year}, 3, 2) || '-' || {month} || '-' || {day}"
             f" ELSE {year} || '/' || {month} || '/' || {day} END", f"{month} || '/' || {day} || '/' || substr({year}, 3, 2)"]
    return {"id": ID, "text": d.pick([f"({f})" for f in forms], "l_partkey % 6"),
            "timed": d.pick([f"({f}) || ' 9:15:22 AM'" for f in forms], "l_suppkey % 6")}


RAW = {"ICE": ice_columns, "Modern": modern_columns, "Neon": neon_columns, "OneX": onex_columns}

_RULE_HEADER = ("raw_product, raw_price_basis, raw_index, raw_location, raw_pipeline, y_n,"
                " index_trade_financial, index_group, key_id, rule_priority, active, rule_ord")
_RULES = {
    "ICE": [
        ("Sweet - Edm", None, None, None, None, None, "Trade", "SW", "PCE", "2", "TRUE"),
        ("SWEET - Edm", None, None, None, None, "N", "Trade", "SW", "LOW", None, "yes"),
        ("sweet blend - EDM", None, None, None, None, "y", "Trade", "sw", "MSW", "1", None),
        ("Sweet - Hardisty", None, None, None, None, "N", "Trade", "SW", "PEM", "1", " "),
        ("synthetic - edm", None, None, None, None, None, "Trade", "SYN", "SYN", "1", "1"),
        ("Synthetic - Hardisty", None, None, None, None, None, "Index", "SYN", "NA", "1", "Y"),
        ("Heavy - Sour - Edm", None, None, None, None, None, "Trade", "SW", "HVY", "1", "TRUE"),
        ("Heavy - Sour - Hardisty", None, None, None, None, None, "Financial", None, "HVY", "1", "TRUE"),
        ("C5+ - Edm", None, None, None, None, "Y", "Trade", "SW", "C5", "1", "no"),
        (" ", None, None, None, None, "Y", "Trade", "SW", "X", "1", "TRUE"),
    ],
    "Modern": [
        ("SW", "WTI CMA", None, None, None, None, "Trade", "SW", None, "1", "TRUE"),
        ("SW", None, None, None, None, None, "Index", "OTHER", "PCE", "1", "TRUE"),
        ("SW", None, None, None, None, None, "Index", "LATE", "LATE", "1", "TRUE"),
        ("Syn", f"WTI{NBSP}CMA", None, None, None, None, "Trade", "SYN", "SYN", "bad", "TRUE"),
        ("SYN", "WTI CMA", None, None, None, None, "Index", "SYN", "SSP", "5", "TRUE"),
        ("C5", None, None, None, None, None, "Financial", "COND", "C5", "1", "unsure"),
    ],
    "Neon": [
        ("SW", "WTI CMA", None, None, "Rainbow", "Y", "Trade", None, None, "1", "TRUE"),
        ("SW", None, "wti cma", "Edmonton", None, None, "Trade", "SW", "PCE", "1", "TRUE"),
        ("SW", None, "WTI CMA", None, None, "N", "Trade", "SW", "MSW", "3", "TRUE"),
        ("sw", None, "WTI CMA", None, None, "N", "Index", "SW", "TWO", "2", "TRUE"),
        ("SW", None, None, None, None, None, "Index", "SW", "FALL", None, "TRUE"),
        ("SYN", None, None, None, None, "yes", "Trade", "SYN", "SYN", "1", "TRUE"),
    ],
    "OneX": [
        ("SW  Edmonton", None, None, None, None, "Y", "Trade", "SW", "PCE", "1", "TRUE"),
        ("Syn Index", None, None, None, None, None, "Index", "SYN", "SYN", "1", "TRUE"),
    ],
}


def rules_sql(broker: str) -> str:
    """Rule sheet as a VALUES list both engines read."""
    def cell(v):
        return "CAST(NULL AS STRING)" if v is None else f"'{v}'"

    rows = ",\n  ".join("(" + ", ".join([*map(cell, r), str(i)]) + ")"
                        for i, r in enumerate(_RULES[broker]))
    return f"SELECT * FROM (VALUES\n  {rows}\n) AS r({_RULE_HEADER})"


def select_list(columns: dict[str, str]) -> str:
    return ",\n  ".join(f"{expr} AS {name}" for name, expr in columns.items())


# --- Spark side ---------------------------------------------------------------

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def render(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    for_wide_rows(df.sparkSession)
    return df.selectExpr(*[f"{expr} AS `{name}`" for name, expr in columns.items()])


def calendar(spark: SparkSession) -> DataFrame:
    return spark.sql(calendar_sql(SPARK))


def raw_export(spark: SparkSession, sf_dir: str, broker: str) -> DataFrame:
    """The whole of ``lineitem`` as one broker's text export."""
    lines = table(spark, sf_dir, "lineitem")
    if broker == "Modern":
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
        lines = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"], "left")
    return render(lines, RAW[broker](SPARK))


def trades_without_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(PRODUCT_RULES)
    trades = render(table(spark, sf_dir, "lineitem"), trades_columns(SPARK))
    return trades.join(rules, "instrument", "left")


def event_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render(table(spark, sf_dir, "events"), events_columns(SPARK))
