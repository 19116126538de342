"""Flags and labels that make a normalized trade part of an index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclebook.functions.labels import weekday_label, weekday_number
from cyclebook.functions.measures import to_bbl
from cyclebook.functions.text import blank_to_na, derive_index_type, ukey
from cyclebook.operators.ordinal import ROW_ORDER
from cyclebook.schema import ENRICHED_SCHEMA


def component_flag(require_grade: bool = True, any_case: bool = False):
    """Physical trade that counts towards an index; strictly true or false.

    ``any_case`` compares class and kind without regard to case, as the older tables do.
    """
    kind, leg = F.col("itf"), F.col("swap_leg_outright")
    physical = ((F.upper(F.trim(kind)) == "TRADE") & (F.upper(F.trim(leg)) == "OUTRIGHT") if any_case
                else (kind == "Trade") & (leg == "Outright"))
    flag = (F.col("in_index") & physical
            & (F.col("qty_m3") > 0) & F.col("price").isNotNull())
    if require_grade:
        flag &= F.col("grade").isNotNull()
    return F.coalesce(flag, F.lit(False))


def enrich_combined(trades: DataFrame) -> DataFrame:
    cleaned = trades.withColumns({"index_group": ukey("index_group"),
                                  "grade": blank_to_na("grade")})
    return (
        cleaned.withColumns({
            "exec_dow": weekday_label("exec_date"),
            "exec_dow_num": weekday_number("exec_date"),
            "qty_bbl": to_bbl("qty_m3"),
            "is_component": component_flag(),
            "is_index_ref": F.coalesce(F.col("itf") == "Index", F.lit(False)),
        })
        .withColumns({
            "is_component_in_cycle":
                F.col("is_component") & F.coalesce(F.col("in_trade_cycle"), F.lit(False)),
            "index_type": F.when(F.col("is_index_ref"),
                                 derive_index_type("instrument", "price_basis")),
        })
        .select(*ENRICHED_SCHEMA.fieldNames(), *[c for c in trades.columns if c == ROW_ORDER])
    )
