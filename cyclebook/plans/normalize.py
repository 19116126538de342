"""Raw broker exports to the shared trade layout.

Each normalizer takes the raw text table (with provenance columns) and the
reference bundle. Raw rows are written to the scratch folder once, in buckets of the trade's id, and versions
are chosen there, so that they move no further; only ICE shuffles legs of spreads and OneX copies with a
sleeved one. OneX writes standing rows once more; what marks a row, as a parent or as one of several copies,
is a narrow set of keys that comes to the rows. Rules and calendar are small lookups. Tables that hold
the chosen versions already (``chosen``) are not asked again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclebook.functions import dates as D
from cyclebook.functions.text import (
    as_col, clean_num, has_text, is_yes, market_without_strip, parse_bool,
    parse_delivery_month, squish, ukey,
)
from cyclebook.operators.calendar import attach_trade_cycle
from cyclebook.operators.ordinal import ROW_ORDER
from cyclebook.operators.ranking import (
    OWN, KeepBy, collapse_copies, file_order, keep_first, keep_first_stored, key_hash, mark_rows, nulls_last,
    rank_within, split_by_flag,
)
from cyclebook.operators.rules import MODERN_TIERS, NEON_TIERS, ONE_TIER, match_tiers, neon_rules
from cyclebook.schema import PROVENANCE, RAW_COLUMNS
from cyclebook.sources.conform import add_missing_cols, coerce_schema, drop_blank_rows
from cyclebook.sources.reference import Reference
from cyclebook.sources.sinks import bucket_count, scratch, scratch_by


def row_order(raw: DataFrame) -> list[str]:
    """The number for the order of rows, where the raw table has it."""
    return [c for c in raw.columns if c == ROW_ORDER]


def false_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


# --- Latest version of a trade ------------------------------------------------

def latest_ice(raw: DataFrame, keep_by: KeepBy | None = None) -> DataFrame:
    if keep_by is not None:
        return keep_first_stored(raw, "deal_id", file_order(), keep_by, bucket_count(raw)).drop(OWN)
    return keep_first(raw, ["deal_id"], file_order())


def latest_modern(raw: DataFrame, keep_by: KeepBy | None = None) -> DataFrame:
    if keep_by is not None:
        return keep_first_stored(raw, "trade_number", file_order(), keep_by, bucket_count(raw)).drop(OWN)
    return keep_first(raw, ["trade_number"], file_order())


def latest_neon(raw: DataFrame, keep_by: KeepBy | None = None) -> DataFrame:
    """Blank ids are separate trades: each is a key of its own, the row's place."""
    ids = _neon_ids(raw)
    if keep_by is not None:
        return _stored_neon(ids, keep_by, bucket_count(raw)).drop(OWN)
    own = F.when(has_text("trade_id"), F.col("trade_id")).otherwise(_neon_place())
    return keep_first(ids.withColumn("own_key", own), ["own_key"], file_order()).drop("own_key")


def _neon_ids(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"trade_id": squish("trade_id"),
                            "parent_trade_id": F.nullif(squish("parent_trade_id"), F.lit(""))})


def _neon_place() -> Column:
    return F.concat_ws("\u0000", F.lit(""), *[F.col(c).cast("string") for c in PROVENANCE])


def _stored_neon(ids: DataFrame, keep_by: KeepBy, buckets: int) -> DataFrame:
    return keep_first_stored(ids, "trade_id", file_order(), keep_by, buckets, ~has_text("trade_id"), _neon_place())


def latest_onex(raw: DataFrame, keep_by: KeepBy | None = None) -> DataFrame:
    """The newest export range wins, then the newest file; blank ids are separate trades."""
    ids = raw.withColumns({"trade_id": F.nullif(squish("trade_id"), F.lit("")),
                           "export_end": D.export_end("source_file")})
    order, blank = [F.col("export_end").desc_nulls_last(), *file_order()], F.col("trade_id").isNull()
    if keep_by is not None:
        # As exact as a struct: nulls differ from empty texts.
        parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in PROVENANCE]
        place = F.concat_ws("\u0000", F.lit(""), *parts)
        return keep_first_stored(ids, "trade_id", order, keep_by, bucket_count(raw), blank, place).drop(OWN)
    return keep_first(ids, ["trade_id"], order, blank, PROVENANCE)


def _versions(broker: str, raw: DataFrame, chosen: bool, standing: Column | None = None) -> DataFrame:
    """The latest versions with the columns that a normalizer reads.

    A row that its status leaves out (not ``standing``) still competes with the other versions of its trade,
    but by its key and place alone: nothing else of it is stored, and it goes when versions are chosen.
    """
    rows = raw.select(*dict.fromkeys([*RAW_COLUMNS[broker], *PROVENANCE, *row_order(raw),
                                      *[c for c in raw.columns if c == "export_end"]]))
    if chosen:
        return rows if standing is None else rows.filter(standing)
    if standing is None:
        return LATEST[broker](rows, scratch_by(raw.sparkSession))
    bare = {*_STATUS[broker], _ID[broker], *PROVENANCE}
    marked = rows.withColumns({_STANDS: standing, **{
        c: F.when(standing, F.col(c)) for c in rows.columns if c not in bare}}).drop(*_STATUS[broker])
    return LATEST[broker](marked, scratch_by(raw.sparkSession)).filter(_STANDS).drop(_STANDS)


# --- Status filters -----------------------------------------------------------

_STANDS = "__stands"
_ID = {"ICE": "deal_id", "Modern": "trade_number", "OneX": "trade_id"}
_STATUS = {"ICE": ("is_cancelled", "parent_fin_assist"), "Modern": ("state", "credit_facilitation"),
           "OneX": ("cancelled",)}


def _ice_stands() -> Column:
    return ~is_yes("is_cancelled") & ~has_text("parent_fin_assist")


def _modern_stands() -> Column:
    return (ukey("state") == "FINALIZED") & ~false_if_null(parse_bool("credit_facilitation"))


def _onex_stands() -> Column:
    return ~false_if_null(parse_bool("cancelled"))


def ice_standing(df: DataFrame) -> DataFrame:
    return df.filter(_ice_stands())


def modern_standing(df: DataFrame) -> DataFrame:
    return df.filter(_modern_stands())


def onex_standing(df: DataFrame) -> DataFrame:
    return df.filter(_onex_stands())


# --- Swap / leg / outright ----------------------------------------------------

def ice_leg_kind(spread_parent_id: Column | str) -> Column:
    return F.when(has_text(spread_parent_id), "Leg").otherwise("Outright")


def ice_leg_kind_by_name(spread_parent_id: Column | str, *names: Column | str) -> Column:
    """Older reading: "SPR" in product, market or full name makes a swap."""
    named = F.lit(False)
    for name in names:
        named |= false_if_null(F.upper(squish(name)).contains("SPR"))
    return F.when(named, "Swap").otherwise(ice_leg_kind(spread_parent_id))


def modern_leg_kind(trade_type: Column | str) -> Column:
    """Unknown trade types pass through as they are."""
    key = ukey(trade_type)
    return (F.when(key == "SPREAD", "Swap")
            .when(key.isin("FIRST LEG", "SECOND LEG"), "Leg")
            .when(key == "OUTRIGHT", "Outright")
            .otherwise(as_col(trade_type)))


def neon_leg_kind(is_parent: Column | str, parent_trade_id: Column | str) -> Column:
    return (F.when(as_col(is_parent), "Swap")
            .when(as_col(parent_trade_id).isNotNull(), "Leg")
            .otherwise("Outright"))


def onex_leg_kind(swap_trade: Column | str) -> Column:
    key = ukey(swap_trade)
    return F.when(key == "PARENT", "Swap").when(key == "LEG", "Leg").otherwise("Outright")


# --- In-index flags -----------------------------------------------------------

def ice_in_index(y_n: str, itf: str, group: str, key_id: str) -> Column:
    implied = (F.col(y_n).isNull() & (F.col(itf) == "Trade")
               & F.col(group).isNotNull() & F.col(key_id).isNotNull())
    return is_yes(y_n) | false_if_null(implied)


def neon_in_index(y_n: Column | str, index: Column | str) -> Column:
    return F.coalesce(parse_bool(y_n), has_text(index))


# --- Structure between rows ---------------------------------------------------

def collapse_spreads(df: DataFrame, stored: bool = False) -> DataFrame:
    """One row per spread parent, the lowest deal id; rows without a parent all stay.

    Of ``stored`` rows, which are cheap to read twice, only those with a parent are moved.
    """
    if stored:
        legs = keep_first(df.filter(has_text("spread_parent_id")), ["spread_parent_id"],
                          [F.col("deal_id").asc_nulls_last()])
        return df.filter(~has_text("spread_parent_id")).unionByName(legs)
    return keep_first(df, ["spread_parent_id"], [F.col("deal_id").asc_nulls_last()],
                      ~has_text("spread_parent_id"), PROVENANCE)


def latest_with_parents(raw: DataFrame) -> DataFrame:
    """Latest Neon versions with ``is_parent``: the trade id occurs as some row's parent id.

    The raw rows lie in buckets of their ids in the session's scratch folder. The parent ids of the chosen
    ones, a narrow read, come to these buckets and mark the rows where they are. A blank id is no
    row's parent.
    """
    keep_by = scratch_by(raw.sparkSession)
    if keep_by is not None:
        buckets, parent = bucket_count(raw), F.col("parent_trade_id")
        rows = _stored_neon(_neon_ids(raw), keep_by, buckets)
        parents = rows.filter(parent.isNotNull()).select(parent.alias("__parent")).repartition(buckets, "__parent").distinct()
        marked = rows.join(parents, F.col(OWN) == F.col("__parent"), "left")
        return marked.withColumn("is_parent", F.col("__parent").isNotNull() & has_text("trade_id")).drop(OWN, "__parent")
    rows = latest_neon(raw).withColumns(key_hash(["trade_id"]))
    named = rows.filter(F.col("parent_trade_id").isNotNull()).select("parent_trade_id").distinct()
    ids = named.select(F.col("parent_trade_id").alias("trade_id")).withColumns(key_hash(["trade_id"]))
    keys = list(key_hash(["trade_id"]))
    return mark_rows(rows, keys, ids.select(*keys), "is_parent", False).drop(*keys)


ECONOMIC_KEYS = ("exec_date_clean", "exec_time_clean", "k_instrument", "k_period", "qty_m3",
                 "k_unit", "price_num", "k_pipeline", "k_buyer_pays", "k_buyer_receives",
                 "k_swap_trade")


def onex_economics(df: DataFrame) -> DataFrame:
    """Cleaned fields two copies of one trade agree on."""
    keys = ("instrument", "period", "unit", "pipeline", "buyer_pays", "buyer_receives",
            "swap_trade")
    return df.withColumns({
        "exec_date_clean": D.onex_date("exec_date"),
        "exec_time_clean": D.parse_clock("exec_time"),
        "qty_m3": clean_num("qty"),
        "price_num": clean_num("price"),
        "sleeved_bool": false_if_null(parse_bool("sleeved")),
        "is_financial_bool": parse_bool("is_financial"),
        "trade_id_num": clean_num("trade_id"),
        **{f"k_{k}": ukey(k) for k in keys},
    })


def copy_order() -> list[Column]:
    """Plain before sleeved, then the lowest id, then the version order of the rows."""
    newest = [-F.unix_date("export_end"),
              -F.unix_micros(F.col("source_file_modified").cast("timestamp"))]
    return [F.col("sleeved_bool"), *nulls_last(F.col("trade_id_num")),
            *nulls_last(newest[0]), *nulls_last(newest[1]),
            F.col("source_file"), F.col("source_block"), F.col("source_row")]


def _copy_keys(with_financial: bool) -> list[str]:
    return [*ECONOMIC_KEYS, "is_financial_bool"] if with_financial else list(ECONOMIC_KEYS)


def collapse_sleeves(df: DataFrame, with_financial: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep one of several equal trades when at least one of them is sleeved; of their columns, those named."""
    return collapse_copies(df, _copy_keys(with_financial), "sleeved_bool", copy_order(), scratch(df.sparkSession),
                           columns and [*columns, *_COPY_ORDER])


_AUDITED = ("trade_id", "exec_date", "exec_time", "instrument", "period", "qty", "unit", "price",
            "pipeline", "buyer_pays", "buyer_receives", "cancelled", "sleeved", "swap_trade", "is_financial")
_COPY_ORDER = ("sleeved_bool", "trade_id_num", "export_end", *PROVENANCE)  # what ``copy_order`` reads


def dropped_sleeves(df: DataFrame, with_financial: bool = True) -> DataFrame:
    """Audit of the rows ``collapse_sleeves`` removes, with their group's size and their rank.

    A group may hold any share of the rows: ranks come from one range partitioning. Only the audited
    columns and those of the order are kept and moved. Needs a scratch folder that all machines share.
    """
    keep = scratch(df.sparkSession)
    if keep is None:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    copies = split_by_flag(df, _copy_keys(with_financial), "sleeved_bool", keep,
                           [*_AUDITED, *_COPY_ORDER])[0]
    ranked = rank_within(copies, list(key_hash(["trade_id"])), copy_order(), "economic_keep_rank",
                         "economic_row_count", keep)
    return ranked.filter("economic_keep_rank > 1").select(
        *_AUDITED, "economic_row_count",
        F.lit(True).alias("group_has_sleeved_trade"), "economic_keep_rank", "source_file",
    ).orderBy("exec_date", "exec_time", "instrument", "period", "price", "qty", "trade_id")


_ONEX_READS = ("trade_id", "exec_date_clean", "exec_time_clean", "instrument", "k_instrument", "swap_trade", "period",
               "price_num", "qty_m3", "unit", "location", "pipeline", "buyer_pays", "source_file")


# --- The four sources ---------------------------------------------------------

def normalize_ice(raw: DataFrame, ref: Reference, chosen: bool = False) -> DataFrame:
    raw = add_missing_cols(raw, RAW_COLUMNS["ICE"])
    standing = _versions("ICE", raw, chosen, _ice_stands())
    market = market_without_strip("market")
    stored = chosen or scratch(raw.sparkSession) is not None
    one_leg = collapse_spreads(standing.withColumn("instrument", market).drop("market"), stored)
    ruled = match_tiers(one_leg.withColumn("product_key", ukey("instrument")),
                        ref.rules["ICE"], ONE_TIER)
    timed = ruled.withColumn("at", D.ice_local_timestamp("local_datetime"))
    out = timed.select(
        F.lit("ICE").alias("broker"),
        F.col("deal_id").alias("trade_id"),
        F.col("at").alias("exec_datetime"),
        D.ice_local_date("local_datetime").alias("exec_date"),
        F.hour("at").alias("exec_hour"),
        "instrument",
        F.col("r_key_id").alias("grade"),
        F.col("r_index_group").alias("index_group"),
        F.col("r_itf").alias("itf"),
        ice_leg_kind("spread_parent_id").alias("swap_leg_outright"),
        ice_in_index("r_y_n", "r_itf", "r_index_group", "r_key_id").alias("in_index"),
        F.col("strip").alias("period"),
        parse_delivery_month("strip").alias("delivery_month"),
        clean_num("price").alias("price"),
        clean_num("qty").alias("qty_m3"),
        F.lit("m3").alias("unit_raw"),
        F.col("hub_name").alias("location"),
        F.lit(None).cast("string").alias("pipeline"),
        F.col("trade_index").alias("price_basis"),
        "source_file", *row_order(raw))
    return coerce_schema(attach_trade_cycle(out, ref.calendar))


def normalize_modern(raw: DataFrame, ref: Reference, chosen: bool = False) -> DataFrame:
    raw = add_missing_cols(raw, RAW_COLUMNS["Modern"])
    standing = _versions("Modern", raw, chosen, _modern_stands())
    keyed = standing.withColumns({"product_key": ukey("product"),
                                  "price_basis_key": ukey("price_basis")})
    ruled = match_tiers(keyed, ref.rules["Modern"], MODERN_TIERS)
    timed = ruled.withColumn("at", D.modern_timestamp("executed_timestamp"))
    out = timed.select(
        F.lit("Modern").alias("broker"),
        F.col("trade_number").alias("trade_id"),
        F.col("at").alias("exec_datetime"),
        F.col("at").cast("date").alias("exec_date"),
        F.hour("at").alias("exec_hour"),
        F.col("product").alias("instrument"),
        F.col("r_key_id").alias("grade"),
        F.col("r_index_group").alias("index_group"),
        F.col("r_itf").alias("itf"),
        modern_leg_kind("trade_type").alias("swap_leg_outright"),
        false_if_null(parse_bool("in_index")).alias("in_index"),
        F.col("term").alias("period"),
        parse_delivery_month("term").alias("delivery_month"),
        clean_num("price").alias("price"),
        clean_num("volume").alias("qty_m3"),
        F.col("unit_of_measure").alias("unit_raw"),
        "location",
        F.col("pipeline_terminal").alias("pipeline"),
        "price_basis",
        "source_file", *row_order(raw))
    return coerce_schema(attach_trade_cycle(out, ref.calendar))


def normalize_neon(raw: DataFrame, ref: Reference, chosen: bool = False) -> DataFrame:
    """Chosen versions are chosen again, as their parents come to buckets of them."""
    raw = add_missing_cols(raw, RAW_COLUMNS["Neon"])
    flagged = latest_with_parents(raw.select(*RAW_COLUMNS["Neon"], *PROVENANCE, *row_order(raw)))
    keyed = flagged.withColumns({f"{c}_key": ukey(c)
                                 for c in ("product", "index", "location", "pipeline")})
    ruled = match_tiers(keyed, neon_rules(ref.rules["Neon"]), NEON_TIERS)
    timed = ruled.withColumn("at", D.neon_timestamp("trade_time"))
    out = timed.select(
        F.lit("Neon").alias("broker"),
        "trade_id",
        F.col("at").alias("exec_datetime"),
        F.col("at").cast("date").alias("exec_date"),
        F.hour("at").alias("exec_hour"),
        F.col("product").alias("instrument"),
        F.col("r_key_id").alias("grade"),
        F.col("r_index_group").alias("index_group"),
        F.col("r_itf").alias("itf"),
        neon_leg_kind("is_parent", "parent_trade_id").alias("swap_leg_outright"),
        neon_in_index("r_y_n", "index").alias("in_index"),
        "period",
        D.neon_delivery_month("period", "delivery_start").alias("delivery_month"),
        clean_num("price").alias("price"),
        clean_num("qty").alias("qty_m3"),
        F.lit("m3").alias("unit_raw"),
        "location",
        "pipeline",
        F.col("index").alias("price_basis"),
        "source_file", *row_order(raw))
    return coerce_schema(attach_trade_cycle(out, ref.calendar))


def normalize_onex(raw: DataFrame, ref: Reference, chosen: bool = False) -> DataFrame:
    raw = drop_blank_rows(add_missing_cols(raw, RAW_COLUMNS["OneX"]))
    standing = _versions("OneX", raw, chosen, _onex_stands())
    single = collapse_sleeves(onex_economics(standing), columns=[*_ONEX_READS, *row_order(raw)])
    ruled = match_tiers(single.withColumn("product_key", F.col("k_instrument")),
                        ref.rules["OneX"], ONE_TIER)
    day, clock = F.col("exec_date_clean"), F.col("exec_time_clean")
    out = ruled.select(
        F.lit("OneX").alias("broker"),
        "trade_id",
        D.at_clock(day, clock).alias("exec_datetime"),
        day.alias("exec_date"),
        F.hour(clock).alias("exec_hour"),
        "instrument",
        F.col("r_key_id").alias("grade"),
        F.col("r_index_group").alias("index_group"),
        F.col("r_itf").alias("itf"),
        onex_leg_kind("swap_trade").alias("swap_leg_outright"),
        false_if_null(parse_bool("r_y_n")).alias("in_index"),
        "period",
        parse_delivery_month("period").alias("delivery_month"),
        F.col("price_num").alias("price"),
        "qty_m3",
        F.col("unit").alias("unit_raw"),
        "location",
        "pipeline",
        F.col("buyer_pays").alias("price_basis"),
        "source_file", *row_order(raw))
    return coerce_schema(attach_trade_cycle(out, ref.calendar))


LATEST = {"ICE": latest_ice, "Modern": latest_modern, "Neon": latest_neon, "OneX": latest_onex}
NORMALIZERS = {"ICE": normalize_ice, "Modern": normalize_modern,
               "Neon": normalize_neon, "OneX": normalize_onex}
