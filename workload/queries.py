"""Registered queries: name -> (Spark callable, DuckDB SQL or None)."""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cyclebook.functions import dates as D
from cyclebook.functions import labels as LB
from cyclebook.functions import measures as M
from cyclebook.functions import text as X
from cyclebook.operators import calendar as C
from cyclebook.operators import rules as R
from cyclebook.plans import dataset, index, intraday, legacy, normalize, quality
from cyclebook.plans import filters, references, seasonality, store, views
from cyclebook.schema import CALENDAR_TABLE, PROVENANCE, ROW_PLACES, RULE_TABLES
from cyclebook.sources import files, lines, sinks
from cyclebook.sources.conform import drop_blank_rows, read_all_sheets, union_all
from cyclebook.sources.reference import Reference, load_reference, reference_from_tables
from workload import adapters as A
from workload import oracle as Q

CATALOG: dict[str, tuple] = {}


def register(name: str, fn, sql: str | None = None) -> None:
    CATALOG[name] = (fn, sql)


def star(spark: SparkSession, sf: str) -> DataFrame:
    """Enriched trades, one per line item; official windows only."""
    return dataset.enrich_combined(
        C.attach_trade_cycle(A.trades_without_cycle(spark, sf), A.calendar(spark)))


def events(spark: SparkSession, sf: str) -> DataFrame:
    return dataset.enrich_combined(A.event_trades(spark, sf))


def reference(spark: SparkSession, *brokers: str) -> Reference:
    """Calendar and rule sheets, a few rows each and so kept in one partition."""
    return reference_from_tables(
        A.calendar(spark).coalesce(1),
        {b: spark.sql(A.rules_sql(b)).coalesce(1) for b in brokers or A.RAW})


def on_star(name, fn, sql=None):
    register(name, lambda spark, sf: fn(star(spark, sf)), sql)


def on_events(name, fn, sql=None):
    register(name, lambda spark, sf: fn(events(spark, sf)), sql)


def on_raw(name, broker, fn, sql=None):
    register(name, lambda spark, sf: fn(A.raw_export(spark, sf, broker)), sql)


# --- Monthly index family -----------------------------------------------------

on_star("monthly_index", lambda t: index.monthly_index(t, by_grade=False),
        Q.monthly_index(Q.COMM, "comm", False))
on_star("monthly_index_by_grade", index.monthly_index, Q.monthly_index(Q.COMM, "comm", True))
on_star("monthly_index_1a", lambda t: index.monthly_index(t, definition="1a", by_grade=False),
        Q.monthly_index(Q.ONE_A, "1a", False))
on_star("monthly_index_syn_broker",
        lambda t: index.monthly_index(t, ig="SYN", definition="Modern", grades=["G3", "G9", "G14"]),
        Q.monthly_index("index_group = 'SYN' AND is_component_in_cycle AND broker = 'Modern'"
                        " AND grade IN ('G3','G9','G14')", "Modern", True))
on_star("monthly_compare", index.monthly_compare, Q.on_trades(
    """SELECT delivery_month, comm_vwap AS comm, comm_vol_m3 AS vol_m3, comm_trades AS trades,
       n_brokers, "1a_vwap" AS "1a", "ICE_vwap" AS "ICE", "Modern_vwap" AS "Modern",
       "Neon_vwap" AS "Neon", "OneX_vwap" AS "OneX" FROM wide""", Q.WIDE))
on_star("monthly_compare_full", index.monthly_compare_full,
        Q.on_trades("SELECT * FROM wide", Q.WIDE))
on_star("monthly_table", index.monthly_table, Q.on_trades(
    "SELECT strftime(delivery_month, '%b %Y') AS \"Month\", " + ", ".join(
        f'round_even("{s}_vwap", 3) AS "{s}_vwap", "{s}_vol_m3" AS "{s}_vol",'
        f' "{s}_trades" AS "{s}_trd"' for s in Q.SERIES) + " FROM wide", Q.WIDE))
on_star("broker_vwap_wide", index.broker_vwap_wide, Q.on_trades(
    "SELECT delivery_month, " + ", ".join(
        f"{Q.ratio(f'sum(price * qty_m3) FILTER (WHERE {c})', f'sum(qty_m3) FILTER (WHERE {c})')}"
        f' AS "{s}"' for s, c in list(Q.SERIES.items())[2:])
    + f" FROM t WHERE {Q.SW} GROUP BY delivery_month"))
on_star("cycle_daily", index.cycle_daily, Q.on_trades(Q.daily_select(), Q.DAILY))
on_star("cycle_daily_latest", lambda t: index.cycle_daily(t, filters.latest_month(t)),
        Q.on_trades(Q.daily_select(f"delivery_month = {Q.LAST_MONTH}"), Q.DAILY))
on_star("cycle_window", index.cycle_window, Q.on_trades(
    """SELECT delivery_month, min(trade_cycle_start) AS cycle_start,
       max(trade_cycle_end) AS cycle_end FROM t WHERE index_group = 'SW' GROUP BY 1"""))
on_star("month_kpis", index.month_kpis, Q.on_trades(Q.kpi_select(True)))
on_star("month_kpis_latest", lambda t: index.month_kpis(t, filters.latest_month(t)),
        Q.on_trades(Q.kpi_select(False)))
on_star("broker_contribution", index.broker_contribution, Q.contribution("broker"))
on_star("grade_contribution", index.grade_contribution,
        Q.contribution("grade", ", count(DISTINCT broker) AS n_brokers"))
on_star("broker_monthly_vwap", index.broker_monthly_vwap, Q.month_by(
    "broker", f"{Q.VWAP} AS vwap, sum(qty_m3) AS vol_m3, count(*) AS trades"))
on_star("broker_share", index.broker_share, Q.month_by("broker"))
on_star("grade_mix", index.grade_mix, Q.month_by("grade"))
on_star("historic_cycle_compare", index.historic_cycle_compare, Q.on_trades(
    f"""SELECT delivery_month, {Q.POSITION} AS cycle, sum(qty_m3) AS vol_m3,
        avg(price) AS avg_price, {Q.VWAP} AS vwap, count(*) AS trades
        FROM t WHERE index_group = 'SW' AND is_component GROUP BY 1, 2"""))

# --- Seasonality --------------------------------------------------------------


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six decimals: these values depend on the order floating-point sums are taken in."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


on_star("cycle_seasonality", seasonality.cycle_seasonality,
        Q.season_query("SELECT * FROM season"))
on_star("cycle_seasonality_by_seg", lambda t: seasonality.cycle_seasonality(t, by="grade"),
        Q.season_query("SELECT * FROM season", "grade"))
on_star("cycle_seasonality_by_broker", lambda t: seasonality.cycle_seasonality(t, by="broker"),
        Q.season_query("SELECT * FROM season", "broker"))
on_star("seasonality_bars", lambda t: rounded(seasonality.seasonality_bars(
    seasonality.cycle_seasonality(t, by="grade"), x="pct", y="daily_pct"), "val"),
    Q.bars("round_even(norm_pct / 10.0e0, 0) * 10.0e0", "round(sum(day_pct), 6)"))
on_star("seasonality_bars_cumulative", lambda t: seasonality.seasonality_bars(
    seasonality.cycle_seasonality(t, by="grade"), x="day", y="cum_raw"),
    Q.bars("CAST(trading_day_rank AS DOUBLE)", "max(cum_vol)"))
on_star("seasonality_bars_recent", lambda t: seasonality.seasonality_bars(
    seasonality.cycle_seasonality(t, by="grade"), x="day", y="cum_raw", max_months=8),
    Q.bars("CAST(trading_day_rank AS DOUBLE)", "max(cum_vol)", 8))
on_star("seasonality_curve_mean", lambda t: rounded(seasonality.season_curve(
    seasonality.cycle_seasonality(t), x="pct", y="cum_pct"), "y"),
    Q.curve("norm_pct", "cum_pct", f"round(avg({Q.AT}), 6)", Q.PCT_GRID))
on_star("seasonality_curve_median", lambda t: rounded(seasonality.season_curve(
    seasonality.cycle_seasonality(t), x="day", y="cum_raw", stat="median"), "y"),
    Q.curve("trading_day_rank", "cum_vol", f"round(median({Q.AT}), 6)", Q.DAY_GRID))
on_star("season_label", lambda t: t.filter(F.col("delivery_month").isNotNull()).groupBy(
    LB.season_of("delivery_month").alias("season")).agg(
        F.count(F.lit(1)).alias("trades"), F.sum("qty_m3").alias("vol_m3")),
    Q.on_trades("""SELECT CASE WHEN month(delivery_month) IN (12, 1, 2) THEN 'Winter'
      WHEN month(delivery_month) < 6 THEN 'Spring' WHEN month(delivery_month) < 9 THEN 'Summer'
      ELSE 'Fall' END AS season, count(*) AS trades, sum(qty_m3) AS vol_m3
      FROM t WHERE delivery_month IS NOT NULL GROUP BY 1"""))
on_star("recent_months", lambda t: filters.recent_months(
    filters.component_trades(t).groupBy("delivery_month").agg(F.count(F.lit(1)).alias("trades")), 8),
    Q.on_trades(f"""SELECT delivery_month, count(*) AS trades FROM t WHERE {Q.SW}
      AND delivery_month IN (SELECT DISTINCT delivery_month FROM t WHERE {Q.SW}
        AND delivery_month IS NOT NULL ORDER BY 1 DESC LIMIT 8) GROUP BY 1"""))

# --- Intraday -----------------------------------------------------------------

on_events("hourly_profile", lambda t: intraday.hourly_profile(t, in_cycle=False), Q.on_events(
    f"""SELECT exec_hour, sum(qty_m3) AS vol_m3, count(*) AS trades, avg(price) AS avg_price,
        {Q.VWAP} AS vwap FROM t WHERE is_component GROUP BY 1"""))
on_star("hourly_profile_star", intraday.hourly_profile, Q.on_trades(
    f"""SELECT exec_hour, sum(qty_m3) AS vol_m3, count(*) AS trades, avg(price) AS avg_price,
        {Q.VWAP} AS vwap FROM t WHERE {Q.COMM} AND exec_hour IS NOT NULL GROUP BY 1"""))
on_events("intraday_total", lambda t: intraday.intraday_total(t, in_cycle=False, bucket_min=15),
          Q.on_events(Q.intraday_total(15, "is_component")))
on_star("intraday_total_minute", lambda t: intraday.intraday_total(t, bucket_min=1),
        Q.on_trades(Q.intraday_total(1, Q.COMM)))
on_events("intraday_byseg", lambda t: intraday.intraday_byseg(t, "grade", bucket_min=30),
          Q.on_events(f"""SELECT {Q.tod(30)} AS tod, grade AS seg, sum(qty_m3) AS vol_m3,
            count(*) AS trades FROM t WHERE {Q.COMM} GROUP BY 1, 2"""))
on_star("intraday_by_broker", lambda t: intraday.intraday_byseg(t, "broker", bucket_min=60),
        Q.on_trades(f"""SELECT {Q.tod(60)} AS tod, broker AS seg, sum(qty_m3) AS vol_m3,
          count(*) AS trades FROM t WHERE {Q.COMM} AND exec_hour IS NOT NULL GROUP BY 1, 2"""))
on_events("weekday_filter", lambda t: intraday.intraday_total(
    t, dows=[1, 5, 7], in_cycle=False, bucket_min=5),
    Q.on_events(Q.intraday_total(5, "is_component AND isodow(exec_date) IN (1, 5, 7)")))
def event_row():
    return F.col("trade_id").cast("long")


def trade_row():
    order, line = (F.split_part("trade_id", F.lit("-"), F.lit(i)).cast("long") for i in (1, 2))
    return order * 8 + line


TRADE_ROW_SQL = "CAST(split_part(trade_id, '-', 1) AS BIGINT) * 8 + CAST(split_part(trade_id, '-', 2) AS BIGINT)"
on_events("ohlc_day", lambda t: intraday.ohlc_profile(t, ordinal=event_row()),
          Q.on_events(Q.ohlc("date_trunc('day', exec_datetime)::TIMESTAMP", "CAST(trade_id AS BIGINT)")))
on_events("ohlc_minutes", lambda t: intraday.ohlc_profile(t, bucket=30, ordinal=event_row()),
          Q.on_events(Q.ohlc("time_bucket(INTERVAL 30 MINUTE, exec_datetime)", "CAST(trade_id AS BIGINT)")))
on_star("ohlc_day_star", lambda t: intraday.ohlc_profile(t, ordinal=trade_row()),
    Q.on_trades(Q.ohlc("date_trunc('day', exec_datetime)::TIMESTAMP", TRADE_ROW_SQL)))
# Many trades at one instant and none with an id: the prices decide.
on_star("ohlc_equal_instants", lambda t: intraday.ohlc_profile(t.withColumns({
    "exec_datetime": F.col("exec_date").cast("timestamp_ntz"), "trade_id": F.lit(" ")})),
    Q.on_trades(Q.ohlc("CAST(exec_date AS TIMESTAMP)", "price").replace(
        "exec_datetime", "CAST(exec_date AS TIMESTAMP)")))

# --- Trades at a published index ----------------------------------------------

on_star("index_ref_trades", references.index_ref_trades,
        Q.on_trades(f"SELECT {Q.ENRICHED} FROM t WHERE {Q.REFS}"))
on_star("index_ref_types", lambda t: references.index_ref_monthly(
    references.index_ref_trades(t, grades=["G1", "G2", "G3"], types=["comm", "1a"])),
    Q.on_trades(f"""SELECT delivery_month, index_type, sum(qty_m3) AS vol_m3, count(*) AS trades
      FROM t WHERE {Q.REFS} AND grade IN ('G1','G2','G3') AND index_type IN ('comm','1a')
      GROUP BY 1, 2"""))
on_star("index_ref_view", views.index_ref_view,
        Q.on_trades(f"SELECT {Q.REF_VIEW} FROM t WHERE {Q.REFS}"))
on_star("index_ref_monthly", references.index_ref_monthly, Q.on_trades(
    f"""SELECT delivery_month, index_type, sum(qty_m3) AS vol_m3, count(*) AS trades
        FROM t WHERE {Q.REFS} GROUP BY 1, 2"""))
on_star("index_ref_by", references.index_ref_by, Q.ref_by("broker"))
on_star("index_ref_by_grade", lambda t: references.index_ref_by(t, by="grade"), Q.ref_by("grade"))
on_star("index_ref_kpis", references.index_ref_kpis, Q.on_trades(
    f"""SELECT coalesce(sum(qty_m3), 0) AS vol,
        coalesce(sum(qty_m3) FILTER (WHERE index_type = 'comm'), 0) AS comm,
        coalesce(sum(qty_m3) FILTER (WHERE index_type = '1a'), 0) AS a1, count(*) AS trades,
        coalesce(sum(qty_m3) FILTER (WHERE in_trade_cycle), 0) AS in_cycle,
        count(DISTINCT broker) AS n_brokers FROM t WHERE {Q.REFS}"""))
on_star("index_ref_months", references.index_ref_months, Q.on_trades(
    f"""SELECT DISTINCT delivery_month FROM t WHERE {Q.REFS} AND delivery_month IS NOT NULL"""))

# --- Quality and views --------------------------------------------------------

on_star("qa_coverage", quality.qa_coverage, Q.on_trades(
    """SELECT broker, min(exec_date) AS oldest, max(exec_date) AS latest, count(*) AS rows,
       count(*) FILTER (WHERE index_group = 'SW') AS sw_rows, count(*) FILTER (WHERE is_component) AS component_rows,
       count(*) FILTER (WHERE is_component_in_cycle) AS component_in_cycle,
       count(*) FILTER (WHERE index_group IS NULL) AS unmapped FROM t GROUP BY 1"""))
on_star("qa_unmapped", quality.qa_unmapped, Q.on_trades(
    """SELECT broker, instrument, price_basis, count(*) AS rows FROM t
       WHERE index_group IS NULL GROUP BY ALL"""))
on_star("qa_build", lambda t: quality.qa_build(t).select(
    "n_rows", F.col("built_at").isNotNull().alias("dated")),
    Q.on_trades("SELECT count(*) AS n_rows, TRUE AS dated FROM t"))
on_star("unparsed_months", quality.unparsed_month_trades, Q.on_trades(
    f"""SELECT broker, trade_id, exec_date, index_group, grade, instrument, period, price, qty_m3,
        source_file FROM t WHERE {Q.UNPARSED}"""))
on_star("unparsed_view", views.unparsed_view,
        Q.on_trades(f"SELECT {Q.UNPARSED_VIEW} FROM t WHERE {Q.UNPARSED}"))
on_star("available_grades", filters.available_grades, Q.on_trades(
    "SELECT DISTINCT grade FROM t WHERE index_group = 'SW' AND grade IS NOT NULL"))
on_star("available_months", filters.available_months, Q.on_trades(
    f"SELECT DISTINCT delivery_month FROM t WHERE {Q.SW} AND delivery_month IS NOT NULL"))
on_star("component_flags", lambda t: t, Q.on_trades(f"SELECT {Q.ENRICHED} FROM t"))
on_star("trades_view", views.trades_view,
        Q.on_trades(f"SELECT {Q.TRADES_VIEW} FROM t WHERE index_group = 'SW'"))

# --- Versions, structure, rules -----------------------------------------------

IDS = "source_file", "source_file_modified", "source_block", "source_row"
IDS_SQL = ", ".join(IDS)


def version_query(columns: str, broker: str, versions: str, more: str = "") -> str:
    return Q.with_(Q.raw(broker), versions, select=f"SELECT {columns} FROM v {more}")


on_raw("latest_version", "ICE", lambda r: normalize.latest_ice(r).select("deal_id", *IDS),
       version_query(f"deal_id, {IDS_SQL}", "ICE", Q.ice_versions()))
on_raw("latest_version_modern", "Modern",
       lambda r: normalize.latest_modern(r).select("trade_number", *IDS),
       version_query(f"trade_number, {IDS_SQL}", "Modern", Q.modern_versions()))
on_raw("latest_version_blank_ids", "Neon",
       lambda r: normalize.latest_neon(r).select("trade_id", "parent_trade_id", *IDS),
       version_query(f"trade_id, parent_trade_id, {IDS_SQL}", "Neon", Q.neon_versions()))
on_raw("latest_version_export", "OneX",
       lambda r: normalize.latest_onex(r).select("trade_id", "export_end", *IDS),
       version_query(f"trade_id, export_end, {IDS_SQL}", "OneX", Q.onex_versions()))
on_raw("latest_version_by_number", "Neon",
       lambda r: legacy.latest_neon_by_number(r).select("trade_id", *IDS),
       version_query(f"trade_id, {IDS_SQL}", "Neon", Q.neon_versions(
           order="source_file_modified DESC NULLS LAST,"
                 f" {Q.num('trade_id')} DESC NULLS LAST, source_file, source_block, source_row")))
on_raw("latest_version_by_sheet", "OneX",
       lambda r: legacy.latest_onex_by_sheet(r).select("trade_id", "source_sheet", *IDS),
       version_query(f"trade_id, source_sheet, {IDS_SQL}", "OneX", Q.onex_versions(
           order="export_end DESC NULLS LAST, source_file_modified DESC NULLS LAST,"
                 " source_file DESC, source_sheet DESC NULLS LAST, source_block, source_row")))
on_raw("parent_leg_flag", "Neon",
       lambda r: normalize.latest_with_parents(r).select(
           "trade_id", "parent_trade_id", "is_parent",
           normalize.neon_leg_kind("is_parent", "parent_trade_id").alias("kind"), *IDS),
       Q.with_(Q.raw("Neon"), Q.neon_versions(), Q.neon_flagged(""),
               select=f"""SELECT trade_id, parent_trade_id, is_parent, {Q.NEON_LEG} AS kind,
                 {IDS_SQL} FROM f"""))
on_raw("spread_collapse", "ICE",
       lambda r: normalize.collapse_spreads(
           normalize.ice_standing(normalize.latest_ice(r)).withColumn(
               "instrument", X.market_without_strip("market"))
       ).select("deal_id", "spread_parent_id", "instrument", *IDS),
       Q.with_(Q.raw("ICE"), Q.ice_versions(), Q.ONE_LEG,
               select=f"SELECT deal_id, spread_parent_id, instrument, {IDS_SQL} FROM one"))


def standing_onex(raw: DataFrame) -> DataFrame:
    return normalize.onex_economics(normalize.onex_standing(normalize.latest_onex(raw)))


SLEEVES = Q.with_(Q.raw("OneX"), Q.onex_versions(), Q.onex_economics(""),
                  select=f"""SELECT trade_id, sleeved_bool, price_num, qty_num AS qty_m3, {IDS_SQL}
                    FROM g WHERE NOT (copies > 1 AND has_sleeve AND rn > 1)""")
AUDIT = Q.with_(Q.raw("OneX"), Q.onex_versions(),
    Q.onex_economics("", (*Q.ECON, "is_financial_bool")),
    select="""SELECT trade_id, exec_date, exec_time, instrument, period, qty, unit, price, pipeline,
      buyer_pays, buyer_receives, cancelled, sleeved, swap_trade, is_financial,
      copies AS economic_row_count, has_sleeve AS group_has_sleeved_trade,
      rn AS economic_keep_rank, source_file FROM g WHERE copies > 1 AND has_sleeve AND rn > 1""")
on_raw("sleeve_collapse", "OneX",
       lambda r: normalize.collapse_sleeves(standing_onex(r)).select(
           "trade_id", "sleeved_bool", "price_num", "qty_m3", *IDS), SLEEVES)
on_raw("sleeve_dropped_audit", "OneX",
       lambda r: normalize.dropped_sleeves(standing_onex(r)), AUDIT)


def rule_query(broker: str, keys: dict[str, str]):
    """Rule outcome of every raw row."""
    def run(spark, sf, ref=None):
        raw = A.raw_export(spark, sf, broker)
        if broker == "ICE":
            raw = raw.withColumn("product", X.market_without_strip("market"))
        rules = (ref or reference(spark, broker)).rules[broker]
        tiers = {"ICE": R.ONE_TIER, "Modern": R.MODERN_TIERS, "Neon": R.NEON_TIERS}[broker]
        rules = R.neon_rules(rules) if broker == "Neon" else rules
        keyed = raw.withColumns({k: X.ukey(c) for k, c in keys.items()})
        return R.match_tiers(keyed, rules, tiers).select(
            *keys, "r_itf", "r_index_group", "r_key_id", "r_y_n", *IDS)

    def quoted(c):
        return '"index"' if c == "index" else c

    product = (f", regexp_replace(market, '{Q.SPACES}-{Q.SPACES}[^-]+$', '') AS product"
               if broker == "ICE" else "")
    key_list = ", ".join(f"{Q.key(quoted(c))} AS {k}" for k, c in keys.items())
    sql = Q.with_(Q.raw(broker), f"raw2 AS (SELECT * {product} FROM raw)",
                  f"k AS (SELECT *, {key_list} FROM raw2)", Q.ruled(broker, "k", "r"),
                  select=f"""SELECT {', '.join(keys)}, r_itf, r_index_group, r_key_id, r_y_n,
                    {IDS_SQL} FROM r""")
    return run, sql


RULES_1 = rule_query("ICE", {"product_key": "product"})
register("rule_match_1tier", *RULES_1)
register("rule_match_2tier", *rule_query(
    "Modern", {"product_key": "product", "price_basis_key": "price_basis"}))
register("rule_match_4tier", *rule_query(
    "Neon", {f"{c}_key": c for c in ("product", "index", "location", "pipeline")}))


def backfilled(spark: SparkSession, sf: str) -> DataFrame:
    cal = C.prepare_calendar(A.calendar(spark))
    trades = C.attach_trade_cycle(A.trades_without_cycle(spark, sf), cal)
    return C.backfill_trade_cycle(trades, cal).select(
        "trade_id", "exec_date", "delivery_month", "trade_cycle_start", "trade_cycle_end",
        "in_trade_cycle", "source_file", "price", "qty_m3")


register("cycle_backfill", backfilled, Q.with_(
    Q.UNTIMED, Q.backfill("cyc", "bf"),
    select="""SELECT trade_id, exec_date, delivery_month, trade_cycle_start, trade_cycle_end,
      in_trade_cycle, source_file, price, qty_m3 FROM bf"""))

# --- Status, kinds and flags over the raw exports -------------------------------


def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows every source keeps after its status filter, by source file."""
    kept = {"ICE": normalize.ice_standing, "Modern": normalize.modern_standing,
            "OneX": normalize.onex_standing}
    return union_all([
        fn(A.raw_export(spark, sf, b)).groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("broker", F.lit(b)) for b, fn in kept.items()])


register("status_filters", status_counts, Q.with_(
    Q.raw("ICE", "ri"), Q.raw("Modern", "rm"), Q.raw("OneX", "ro"),
    select=" UNION ALL ".join(
        f"SELECT source_file, count(*) AS rows, '{b}' AS broker FROM {r} WHERE {w} GROUP BY 1"
        for b, r, w in (("ICE", "ri", Q.ICE_STANDING), ("Modern", "rm", Q.MODERN_STANDING),
                        ("OneX", "ro", Q.ONEX_STANDING)))))
on_raw("swap_leg_kinds", "ICE", lambda r: r.select(
    "deal_id", *IDS, normalize.ice_leg_kind("spread_parent_id").alias("kind"),
    normalize.ice_leg_kind_by_name("spread_parent_id", "product_name", "market",
                                   "product_full_name").alias("kind_by_name")),
    Q.with_(Q.raw("ICE"), select=f"""SELECT deal_id, {IDS_SQL}, {Q.ICE_LEG} AS kind,
      CASE WHEN contains(upper(coalesce(product_name, '') || '|' || coalesce(market, '') || '|'
             || coalesce(product_full_name, '')), 'SPR') THEN 'Swap'
           ELSE {Q.ICE_LEG} END AS kind_by_name FROM raw"""))
on_raw("swap_leg_kinds_modern", "Modern", lambda r: r.select(
    "trade_number", *IDS, normalize.modern_leg_kind("trade_type").alias("kind"),
    normalize.false_if_null(X.parse_bool("in_index")).alias("in_index")),
    Q.with_(Q.raw("Modern"), select=f"""SELECT trade_number, {IDS_SQL}, {Q.MODERN_LEG} AS kind,
      coalesce({Q.flag('in_index')}, FALSE) AS in_index FROM raw"""))
on_raw("swap_leg_kinds_onex", "OneX", lambda r: r.select(
    "trade_id", *IDS, normalize.onex_leg_kind("swap_trade").alias("kind")),
    Q.with_(Q.raw("OneX"), select=f"SELECT trade_id, {IDS_SQL}, {Q.ONEX_LEG} AS kind FROM raw"))


def in_index_rules(spark: SparkSession, sf: str) -> DataFrame:
    ref = reference(spark, "ICE", "Neon", "OneX")
    ice = A.raw_export(spark, sf, "ICE").withColumn(
        "product_key", X.ukey(X.market_without_strip("market")))
    neon = A.raw_export(spark, sf, "Neon").withColumns(
        {f"{c}_key": X.ukey(c) for c in ("product", "index", "location", "pipeline")})
    onex = A.raw_export(spark, sf, "OneX").withColumn("product_key", X.ukey("instrument"))
    flags = {
        "ICE": R.match_tiers(ice, ref.rules["ICE"], R.ONE_TIER).select(
            normalize.ice_in_index("r_y_n", "r_itf", "r_index_group", "r_key_id").alias("in_index"), *IDS),
        "Neon": R.match_tiers(neon, R.neon_rules(ref.rules["Neon"]), R.NEON_TIERS).select(
            normalize.neon_in_index("r_y_n", "index").alias("in_index"), *IDS),
        "OneX": R.match_tiers(onex, ref.rules["OneX"], R.ONE_TIER).select(
            normalize.false_if_null(X.parse_bool("r_y_n")).alias("in_index"), *IDS),
    }
    return union_all([df.withColumn("broker", F.lit(b)) for b, df in flags.items()])


register("in_index_rules", in_index_rules, Q.with_(
    Q.raw("ICE", "ri"), Q.raw("Neon", "rn0"), Q.raw("OneX", "ro"),
    f"ki AS (SELECT *, {Q.key(f'''regexp_replace(market, '{Q.SPACES}-{Q.SPACES}[^-]+$', '')''')}"
    " AS product_key FROM ri)",
    "kn AS (SELECT *, " + ", ".join(
        f"{Q.key(c)} AS {c.strip(chr(34))}_key"
        for c in ("product", '"index"', "location", "pipeline")) + " FROM rn0)",
    f"ko AS (SELECT *, {Q.key('instrument')} AS product_key FROM ro)",
    Q.ruled("ICE", "ki", "xi", "i"), Q.ruled("Neon", "kn", "xn", "n"),
    Q.ruled("OneX", "ko", "xo", "o"),
    select=f"""SELECT {Q.ICE_IN_INDEX} AS in_index, {IDS_SQL}, 'ICE' AS broker FROM xi
      UNION ALL SELECT {Q.NEON_IN_INDEX}, {IDS_SQL}, 'Neon' FROM xn
      UNION ALL SELECT coalesce({Q.flag('r_y_n')}, FALSE), {IDS_SQL}, 'OneX' FROM xo"""))

# --- Scalar functions over whole tables -----------------------------------------

on_raw("parse_months", "ICE", lambda r: r.select(
    "strip", *IDS, X.parse_delivery_month("strip").alias("month"),
    X.parse_delivery_month("strip", strict="ICE").alias("strict_month")),
    Q.with_(Q.raw("ICE"), select=f"""SELECT strip, {IDS_SQL}, {Q.label_month('strip')} AS month,
      {Q.label_month('strip', '^([A-Z]{3})([0-9]{4}|[0-9]{2})$')} AS strict_month FROM raw"""))
on_raw("parse_months_modern", "Modern", lambda r: r.select(
    "term", *IDS, X.parse_delivery_month("term").alias("month"),
    X.parse_delivery_month("term", strict="Modern").alias("strict_month")),
    Q.with_(Q.raw("Modern"), select=f"""SELECT term, {IDS_SQL}, {Q.label_month('term')} AS month,
      {Q.label_month('term', '^([A-Z]{3})-([0-9]{4}|[0-9]{2})$')} AS strict_month FROM raw"""))
on_raw("parse_months_neon", "Neon", lambda r: r.select(
    "period", "delivery_start", *IDS,
    D.neon_delivery_month("period", "delivery_start").alias("month"),
    X.parse_delivery_month("period", strict="Neon").alias("strict_month")),
    Q.with_(Q.raw("Neon"), select=f"""SELECT period, delivery_start, {IDS_SQL},
      coalesce({Q.label_month('period')},
        CAST(date_trunc('month', TRY_CAST(delivery_start AS DATE)) AS DATE)) AS month,
      {Q.label_month('period', '^([A-Z]{3})[- ]?([0-9]{4}|[0-9]{2})$')} AS strict_month FROM raw"""))
on_raw("parse_period_words", "OneX", lambda r: r.select(
    "period", *IDS, X.parse_period_words("period").alias("month")),
    Q.with_(Q.raw("OneX"), select=f"""SELECT period, {IDS_SQL},
      CAST(TRY_STRPTIME('01 ' || period, '%d %b %Y') AS DATE) AS month FROM raw"""))
on_raw("clean_numbers", "ICE", lambda r: r.select(
    *IDS, X.clean_num("qty").alias("qty_m3"), X.clean_num("price").alias("price")),
    Q.with_(Q.raw("ICE"), select=f"""SELECT {IDS_SQL}, {Q.num('qty')} AS qty_m3,
      {Q.num('price')} AS price FROM raw"""))
on_raw("clean_keys", "ICE", lambda r: r.select(
    *IDS, X.ukey("market").alias("market_key"), X.blank_to_na("spread_parent_id").alias("parent"),
    X.market_without_strip("market").alias("instrument")),
    Q.with_(Q.raw("ICE"), select=f"""SELECT {IDS_SQL}, {Q.key('market')} AS market_key,
      {Q.blank('spread_parent_id')} AS parent,
      regexp_replace(market, '{Q.SPACES}-{Q.SPACES}[^-]+$', '') AS instrument FROM raw"""))
on_raw("parse_bools", "Modern", lambda r: r.select(
    *IDS, X.parse_bool("credit_facilitation").alias("credit"),
    X.parse_bool("in_index").alias("in_index"), X.is_yes("in_index").alias("is_yes")),
    Q.with_(Q.raw("Modern"), select=f"""SELECT {IDS_SQL}, {Q.flag('credit_facilitation')} AS credit,
      {Q.flag('in_index')} AS in_index, {Q.yes('in_index')} AS is_yes FROM raw"""))
on_raw("parse_timestamps", "Modern", lambda r: r.select(
    *IDS, D.modern_timestamp("executed_timestamp").alias("at"),
    D.permissive_timestamp("executed_timestamp").alias("at_permissive")),
    Q.with_(Q.raw("Modern"), select=f"""SELECT {IDS_SQL},
      coalesce(TRY_STRPTIME(executed_timestamp, '%Y-%m-%d %I:%M:%S %p'),
        TRY_STRPTIME(executed_timestamp, '%Y-%m-%d %H:%M:%S'),
        TRY_STRPTIME(executed_timestamp, '%Y-%m-%d %H:%M')) AS at,
      coalesce(TRY_STRPTIME(executed_timestamp, '%Y-%m-%d %I:%M:%S %p'),
        TRY_STRPTIME(executed_timestamp, '%Y-%m-%d %H:%M:%S')) AS at_permissive FROM raw"""))
def named_dates(spark: SparkSession, sf: str) -> DataFrame:
    texts = A.render(A.table(spark, sf, "lineitem"), A.dated_columns(A.SPARK))
    return texts.select("id", D.onex_date("text").alias("day"), D.permissive_timestamp("timed").alias("at"))


register("parse_named_dates", named_dates, f"""SELECT id, CAST(l_shipdate AS DATE) AS day,
  CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + INTERVAL 33322 SECOND AS at
  FROM (SELECT *, {A.ID.replace('STRING', 'VARCHAR')} AS id FROM lineitem)""")


def rejected(spark: SparkSession, sf: str) -> DataFrame:
    return union_all([quality.rejected_dates(A.raw_export(spark, sf, b), b) for b in A.RAW])


register("rejected_dates", rejected, Q.with_(
    Q.raw("ICE", "ri"), Q.raw("Modern", "rm"), Q.raw("Neon", "rn"),
    select=" UNION ALL ".join(
        f"SELECT '{b}' AS broker, '{c}' AS \"column\", source_file, count(*) AS rejected FROM {r}"
        f" WHERE {w} GROUP BY source_file" for b, c, r, w in (
            ("ICE", "local_datetime", "ri", "local_datetime = 'n/a' OR length(local_datetime) = 10"),
            ("Modern", "executed_timestamp", "rm", "executed_timestamp = 'pending'"),
            ("Neon", "trade_time", "rn", "trade_time = 'late'")))))
on_raw("parse_export_dates", "OneX", lambda r: r.select(
    *IDS, D.onex_date("exec_date").alias("day"), D.export_end("source_file").alias("export_end"),
    (F.hour(D.parse_clock("exec_time")) * 3600 + F.minute(D.parse_clock("exec_time")) * 60
     + F.second(D.parse_clock("exec_time"))).alias("clock_seconds")),
    Q.with_(
        Q.raw("OneX"), select=f"""SELECT {IDS_SQL},
          CASE WHEN regexp_matches(exec_date, '^[0-9]+$') THEN
            DATE '1899-12-30' + CAST(exec_date AS INT)
          ELSE CAST(coalesce(TRY_STRPTIME(exec_date, '%Y-%m-%d'),
            TRY_STRPTIME(exec_date, '%m/%d/%Y')) AS DATE) END AS day,
          CAST(regexp_extract(source_file, '_([0-9-]+)[.]csv', 1) AS DATE) AS export_end,
          CASE exec_time WHEN '2:05 PM' THEN 50700 WHEN '9:15:22 AM' THEN 33322
            WHEN '09:15:22' THEN 33322 END AS clock_seconds FROM raw"""))
on_star("labels", lambda t: index.monthly_index(t, by_grade=False).select(
    LB.month_label("delivery_month").alias("month"), LB.season_of("delivery_month").alias("season"),
    LB.fmt_diff("vwap").alias("index"), LB.fmt_int("vol_bbl").alias("bbl"),
    LB.fmt_m3("vol_m3").alias("m3"), LB.fmt_tod(F.col("trades") % 1440).alias("tod"),
    LB.weekday_label("first_trade").alias("dow")),
    Q.on_trades(f"""SELECT strftime(delivery_month, '%b %Y') AS month,
      CASE WHEN month(delivery_month) IN (12, 1, 2) THEN 'Winter'
        WHEN month(delivery_month) < 6 THEN 'Spring' WHEN month(delivery_month) < 9 THEN 'Summer'
        ELSE 'Fall' END AS season,
      printf('%+.2f', {Q.VWAP}) AS "index",
      format('{{:,}}', CAST(round_even(sum(qty_m3) * {Q.BBL}, 0) AS BIGINT)) AS bbl,
      format('{{:,}}', CAST(sum(qty_m3) AS BIGINT)) || ' m³' AS m3,
      printf('%02d:%02d', count(*) % 1440 // 60, count(*) % 60) AS tod,
      strftime(min(exec_date), '%a') AS dow FROM t WHERE {Q.COMM} GROUP BY delivery_month"""))

# --- Normalizers and the whole build --------------------------------------------

for _name, _broker in zip(Q.NORMALIZED, A.RAW):
    _fn, _tag = Q.NORMALIZED[_name]
    register(_name, lambda spark, sf, b=_broker: normalize.NORMALIZERS[b](
        A.raw_export(spark, sf, b), reference(spark, b)),
        Q.with_(Q.CALENDAR, _fn(_tag), select=f"SELECT {Q.NORMAL} FROM {_tag}n"))


def built(spark: SparkSession, sf: str, staging: str | None = None) -> DataFrame:
    sources = {b: A.raw_export(spark, sf, b) for b in A.RAW}
    return dataset.build_dataset(spark, sources, reference(spark), staging=staging)


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for what a query writes and reads back."""
    root = sinks.staging_folder(spark)
    if root is None:
        root = tempfile.mkdtemp(prefix="workload-")
        sinks.check_shared(spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


CSV_COLUMNS = ("deal_id", "is_cancelled", "market", "strip", "local_datetime", "qty", "price", "trade_index")


def csv_exports(spark: SparkSession, sf: str) -> DataFrame:
    """The ICE export written under two headers in another order, read back as one table."""
    raw, folder = A.raw_export(spark, sf, "ICE").select(*CSV_COLUMNS), run_folder(spark, "exports")
    titles = {c: c.replace("_", " ").title() for c in CSV_COLUMNS}
    for rows, names in ((raw.filter("deal_id LIKE '%1'"), CSV_COLUMNS),
                        (raw.filter("deal_id NOT LIKE '%1'"), CSV_COLUMNS[::-1])):
        rows.select(*[F.col(c).alias(titles[c]) for c in names]).write.mode("append").option("header", True).csv(folder)
    return files.read_csv_folder(spark, folder).select(*CSV_COLUMNS)


def put_lines(lines: DataFrame, header: str, folder: str) -> None:
    """The column ``line`` as it is, under a header line."""
    (lines.select(F.col("line").alias(header)).write.mode("append").option("header", True).option("sep", "\u0001")
     .option("quote", "\u0000").csv(folder))


RAGGED_COLUMNS = ("deal_id", "market", "qty", "price")
# What is wrong with a line: the last field is missing, one is too many, or a quote stays open.
RAGGED_KIND = ("CASE WHEN deal_id LIKE '%73' THEN 'too few fields' WHEN deal_id LIKE '%41' THEN 'too many fields'"
               " WHEN deal_id LIKE '%92' THEN 'broken quote' END")
RAGGED_LINE = ("deal_id || ',\"' || coalesce(market, '') || '\",\"' || qty || CASE WHEN deal_id LIKE '%73' THEN '\"'"
               " WHEN deal_id LIKE '%41' THEN '\",' || price || ',more' WHEN deal_id LIKE '%92' THEN '\",\"' || price"
               " ELSE '\",' || price END")


def ragged_exports(spark: SparkSession, sf: str) -> str:
    """The ICE export as CSV lines of which three in a hundred are malformed; the folder."""
    folder = run_folder(spark, "ragged")
    put_lines(A.raw_export(spark, sf, "ICE").select(F.expr(RAGGED_LINE).alias("line")), "Deal ID,Market,Qty,Price", folder)
    return folder


def three_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Three exports with headers of their own, one of them with an older name, read in one scan."""
    raw, folder = A.raw_export(spark, sf, "ICE"), run_folder(spark, "headers")
    layouts = (("1", "Deal ID,Price,Qty", "deal_id || ',' || price || ',\"' || qty || '\"'"),
               ("3", "Qty,gtcs,Deal ID", "'\"' || qty || '\",' || hub_name || ',' || deal_id"),
               ("[^13]", "Strip,Deal ID", "strip || ',' || deal_id"))
    for digit, header, line in layouts:
        put_lines(raw.filter(F.col("deal_id").rlike(digit + "$")).select(F.expr(line).alias("line")), header, folder)
    return files.read_csv_folder(spark, folder).select("deal_id", "price", "qty", "gtc_s", "strip")


def landed_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Two layouts landed as sheets of one source, with blank rows between, read back and cleaned."""
    folder = run_folder(spark, "sheets")
    for name, columns in (("Neon", ("trade_id", "product", "price")), ("OneX", ("trade_id", "price", "sleeved"))):
        rows = A.raw_export(spark, sf, name).select(*columns)
        blank = rows.select(*[F.lit(" ").alias(c) for c in columns])
        rows.unionByName(blank).write.parquet(f"{folder}/{name}")
    return drop_blank_rows(files.read_sheets(spark, folder, fmt="parquet")).select(
        "trade_id", "product", "price", "sleeved", "source_sheet")


def stored_build(spark: SparkSession, sf: str) -> DataFrame:
    """The build stored with its quality tables and loaded again."""
    folder = run_folder(spark, "build")
    sources = {b: A.raw_export(spark, sf, b) for b in A.RAW}
    dataset.build_dataset(spark, sources, reference(spark), folder)
    return dataset.load_combined(spark, folder, reference(spark), folder)


def store_versions(spark: SparkSession, sf: str) -> DataFrame:
    """A store before and after a second export, which adds deals and reprices others; both versions read."""
    folder = run_folder(spark, "store")
    data, ref = f"{folder}/exports", reference(spark, "ICE")
    with sinks.passing(spark):
        raw = normalize.latest_ice(A.raw_export(spark, sf, "ICE"), sinks.scratch_by(spark)).drop(*PROVENANCE, *ROW_PLACES)
        later = raw.filter("deal_id LIKE '%2'").unionByName(raw.filter("deal_id LIKE '%1'").withColumn("price", F.lit("7")))
        for rows in (raw.filter("deal_id NOT LIKE '%2'"), later):
            rows.write.mode("append").option("header", True).csv(f"{data}/ICE")
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")  # the other brokers have no folder
                store.update(spark, data, ref, f"{folder}/store")
    return union_all([store.load(spark, f"{folder}/store", v).withColumn("version", F.lit(v)) for v in (1, 2)]).drop("source_file")


def version_sql(number: int, tag: str, rows: str) -> tuple[str, str]:
    chain = Q.normalize_ice(tag).replace(f"FROM {tag}raw QUALIFY", f"FROM ({rows.format(f'{tag}raw')}) QUALIFY")
    return (",\n".join([chain, Q.backfill(f"{tag}n", f"{tag}b"), Q.enrich(f"{tag}b", f"{tag}e")]),
            f"SELECT * EXCLUDE (source_file), {number} AS version FROM (SELECT {Q.ENRICHED} FROM {tag}e)")


VERSION_1 = version_sql(1, "va", "SELECT * FROM {} WHERE deal_id NOT LIKE '%2'")
VERSION_2 = version_sql(2, "vb", "SELECT * REPLACE (CASE WHEN deal_id LIKE '%1' THEN '7' ELSE price END AS price) FROM {}")


def built_candles(spark: SparkSession, sf: str) -> DataFrame:
    """Candles of built tables, many trades at one instant: the order of the rows decides."""
    sources = {b: A.raw_export(spark, sf, b) for b in ("ICE", "OneX")}
    trades = dataset.build_dataset(spark, sources, reference(spark, *sources), row_order=True)
    return intraday.ohlc_profile(trades, definition="1a", ordinal="row_ord")


def with_line(chain: str) -> str:
    """A normalizer's relations that keep the place of a row in its file."""
    return chain.replace(" AS price_basis, source_file", " AS price_basis, source_file, source_line").replace(
        f"SELECT {Q.NORMAL} FROM (SELECT s.*", f"SELECT {Q.NORMAL}, source_line FROM (SELECT s.*")


CANDLES = Q.with_(
    Q.CALENDAR, with_line(Q.normalize_ice()), with_line(Q.normalize_onex()),
    "al AS (SELECT * FROM icn UNION ALL BY NAME SELECT * FROM oxn)", Q.backfill("al", "bf"), Q.enrich("bf"),
    select=Q.ohlc("date_trunc('day', exec_datetime)::TIMESTAMP", "broker, source_file DESC, source_line").replace(Q.COMM, Q.ONE_A))

FILE_ROWS = 10_000


def put_export(rows: DataFrame, folder: str) -> None:
    """CSV files of ``FILE_ROWS`` rows, the last one of the rest, written by many tasks.

    The rows are kept once, so that their places are the same whenever a task is repeated; those of one file
    come together by its number.
    """
    spark = rows.sparkSession
    kept = sinks.stage(rows, "rows", run_folder(spark, "kept"))
    placed = kept.select("*", F.col("_metadata.file_path").alias("_part"), F.col("_metadata.row_index").alias("_row"))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))  # one row for each task that wrote
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"))
    numbered = placed.join(F.broadcast(starts), "_part").withColumn(
        "_file", F.floor((F.col("_start") + F.col("_row")) / FILE_ROWS))
    (numbered.repartitionByRange("_file").select(*rows.columns).write.option("header", True)
     .option("maxRecordsPerFile", FILE_ROWS).csv(folder))
    sinks.drop_staged(kept)


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Files and bytes of two brokers' exports, counted without reading them."""
    folder = run_folder(spark, "inventory")
    put_export(A.raw_export(spark, sf, "ICE").select(*CSV_COLUMNS), f"{folder}/ICE")
    put_export(A.raw_export(spark, sf, "OneX").select("trade_id", "qty").filter("trade_id LIKE '%1'"), f"{folder}/OneX")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")  # the other brokers have no folder
        found = files.inventory_counts(files.source_inventory(spark, folder))
    return found.select("broker", "files", (F.col("bytes") > 0).alias("filled"), F.col("latest").isNotNull().alias("dated"))


def file_provenance(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by the file they were read from."""
    folder = run_folder(spark, "provenance")
    put_export(A.raw_export(spark, sf, "ICE").select(*CSV_COLUMNS), folder)
    rows = files.read_csv_folder(spark, folder).groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("source_file_modified").alias("ages"),
        F.countDistinct("source_block", "source_row").alias("places"))
    return rows.agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("rows"), F.max("n").alias("most"),
                    F.max("ages").alias("ages"), F.sum("places").alias("places"))


def preferred_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """A workbook's preferred sheet, and files of the folder that have no such sheet."""
    folder, raw = run_folder(spark, "sheets"), A.raw_export(spark, sf, "Modern").select("trade_number", "product", "volume")
    put_export(raw.filter("trade_number LIKE '%1'").withColumn("remark", F.lit("loose")), f"{folder}/Modern")
    put_export(raw.filter("trade_number NOT LIKE '%1'"), f"{folder}/Modern/Trade Report")
    return files.read_source(spark, f"{folder}/Modern", "Trade Report").select("trade_number", "product", "volume", "remark")


def exported(export, table):
    """A CSV export of a report read back with the report's types."""
    def run(trades: DataFrame) -> DataFrame:
        spark = trades.sparkSession
        folder = run_folder(spark, "export")
        export(trades, folder)
        return spark.read.schema(table(trades).schema).option("header", True).option("escape", '"').csv(folder)
    return run


def loaded_reference(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar and rule sheets written as CSV and loaded as one bundle, whose rules then classify every row."""
    folder = run_folder(spark, "reference")
    sheets = {CALENDAR_TABLE: A.calendar(spark), **{
        name: spark.sql(A.rules_sql(b)).orderBy("rule_ord").drop("rule_ord") for b, name in RULE_TABLES.items()}}
    for name, sheet in sheets.items():
        sheet.coalesce(1).write.option("header", True).csv(f"{folder}/{name}.csv")
    return RULES_1[0](spark, sf, load_reference(spark, folder))


CELL = "nullif(trim({0}), '') AS {0}".format
register("read_csv_exports", csv_exports, Q.with_(
    Q.raw("ICE"), select=f"SELECT {', '.join(map(CELL, CSV_COLUMNS))} FROM raw"))
register("read_three_headers", three_headers, Q.with_(
    Q.raw("ICE"), "d AS (SELECT *, right(deal_id, 1) AS digit FROM raw)",
    select="""SELECT deal_id, CASE WHEN digit = '1' THEN price END AS price,
      CASE WHEN digit IN ('1', '3') THEN qty END AS qty, CASE WHEN digit = '3' THEN hub_name END AS gtc_s,
      CASE WHEN digit NOT IN ('1', '3') THEN strip END AS strip FROM d"""))
register("rejected_lines", lambda spark, sf: lines.rejected_lines(spark, ragged_exports(spark, sf)).select("reason", "line"),
         Q.with_(Q.raw("ICE"), select=f"SELECT {RAGGED_KIND} AS reason, {RAGGED_LINE} AS line FROM raw"
                 f" WHERE {RAGGED_KIND} IS NOT NULL"))
register("reject_counts", lambda spark, sf: files.reject_counts(spark, ragged_exports(spark, sf)).agg(
    *[F.sum(c).alias(c) for c in ("lines", "too_few", "too_many", "broken")]),
    Q.with_(Q.raw("ICE"), f"k AS (SELECT {RAGGED_KIND} AS kind FROM raw)", select="""SELECT count(*) AS lines,
      count(*) FILTER (WHERE kind = 'too few fields') AS too_few,
      count(*) FILTER (WHERE kind = 'too many fields') AS too_many,
      count(*) FILTER (WHERE kind = 'broken quote') AS broken FROM k"""))
register("read_ragged", lambda spark, sf: files.read_csv_folder(
    spark, ragged_exports(spark, sf), max_rejects=0.05).filter("deal_id NOT LIKE '%92'").select(*RAGGED_COLUMNS),
    Q.with_(Q.raw("ICE"), select=f"""SELECT deal_id, {CELL('market')}, qty,
      CASE WHEN deal_id NOT LIKE '%73' THEN price END AS price FROM raw WHERE deal_id NOT LIKE '%92'"""))
register("read_landed_sheets", landed_sheets, Q.with_(
    Q.raw("Neon", "a"), Q.raw("OneX", "b"),
    select=f"""SELECT {CELL('trade_id')}, {CELL('product')}, {CELL('price')}, NULL::VARCHAR AS sleeved,
      'Neon' AS source_sheet FROM a UNION ALL
      SELECT {CELL('trade_id')}, NULL, {CELL('price')}, {CELL('sleeved')}, 'OneX' FROM b"""))
register("source_inventory", inventory, Q.with_(
    Q.raw("ICE"), Q.raw("OneX", "ox"), select=f"""SELECT 'ICE' AS broker,
      CAST(ceil(count(*) / {FILE_ROWS}.0) AS BIGINT) AS files, TRUE AS filled, TRUE AS dated FROM raw UNION ALL
      SELECT 'OneX', CAST(ceil(count(*) / {FILE_ROWS}.0) AS BIGINT), TRUE, TRUE FROM ox WHERE trade_id LIKE '%1'"""))
register("file_provenance", file_provenance, Q.with_(
    Q.raw("ICE"), select=f"""SELECT CAST(ceil(count(*) / {FILE_ROWS}.0) AS BIGINT) AS files, count(*) AS rows,
      least(count(*), {FILE_ROWS}) AS most, 1 AS ages, count(*) AS places FROM raw"""))
register("preferred_sheet", preferred_sheet, Q.with_(
    Q.raw("Modern"), select=f"""SELECT trade_number, nullif(trim(product, ' '), '') AS product, {CELL('volume')},
      CASE WHEN trade_number LIKE '%1' THEN 'loose' END AS remark FROM raw"""))
register("load_reference", loaded_reference, RULES_1[1])
on_star("export_monthly", exported(views.export_monthly, index.monthly_compare_full),
        Q.on_trades("SELECT * FROM wide", Q.WIDE))
on_star("export_index_refs", exported(views.export_index_refs, references.index_ref_trades),
        Q.on_trades(f"SELECT {Q.ENRICHED} FROM t WHERE {Q.REFS}"))
on_star("export_unparsed", exported(views.export_unparsed, quality.unparsed_month_trades), Q.on_trades(
    f"""SELECT broker, trade_id, exec_date, index_group, grade, instrument, period, price, qty_m3,
        source_file FROM t WHERE {Q.UNPARSED}"""))
on_star("export_trades", exported(views.export_trades, views.group_trades),
        Q.on_trades(f"SELECT {Q.ENRICHED} FROM t WHERE index_group = 'SW'"))
register("store_versions", store_versions, Q.with_(
    Q.CALENDAR, VERSION_1[0], VERSION_2[0], select=f"{VERSION_1[1]} UNION ALL {VERSION_2[1]}"))
register("built_candles", built_candles, CANDLES)
register("stored_build", stored_build, Q.with_(Q.BUILD, select=f"SELECT {Q.ENRICHED} FROM t"))
register("build_dataset", built, Q.with_(Q.BUILD, select=f"SELECT {Q.ENRICHED} FROM t"))
register("monthly_index_from_raw", lambda spark, sf: index.monthly_index(built(spark, sf)),
         Q.with_(Q.BUILD, select=f"""SELECT delivery_month, grade, {Q.VWAP} AS vwap,
           sum(qty_m3) AS vol_m3, sum(qty_m3) * {Q.BBL} AS vol_bbl, count(*) AS trades,
           count(DISTINCT broker) AS n_brokers,
           array_to_string(list_sort(list(DISTINCT broker)), ', ') AS brokers,
           min(exec_date) AS first_trade, max(exec_date) AS last_trade, 'comm' AS definition
           FROM t WHERE {Q.COMM} GROUP BY delivery_month, grade"""))

# --- Older reports ----------------------------------------------------------------


def untimed(spark: SparkSession, sf: str) -> DataFrame:
    return C.attach_trade_cycle(A.trades_without_cycle(spark, sf), A.calendar(spark))


def on_untimed(name, fn, sql):
    register(name, lambda spark, sf: fn(untimed(spark, sf)), sql)


on_untimed("vwap_minmax", legacy.vwap_by_cycle, Q.legacy_vwap(True))
on_untimed("vwap_all_groups", lambda t: legacy.vwap_by_cycle(t, None, with_bbl=True),
           Q.legacy_vwap(False, f", sum(qty_m3) * {Q.BBL} AS total_volume_bbl_per_month"))
on_untimed("vwap_bbl", lambda t: rounded(
    legacy.vwap_by_barrels(t), "total_volume_bbl", "total_volume_m3", "vwap"),
    Q.with_(Q.UNTIMED, f"x AS (SELECT *, {Q.TO_BBL} AS bbl FROM cyc)", select=f"""
      SELECT period, delivery_month, index_group, count(*) AS trade_count,
        round(sum(bbl), 6) AS total_volume_bbl, round(sum(bbl) / {Q.BBL}, 6) AS total_volume_m3,
        round(sum(price * bbl) / sum(bbl), 6) AS vwap, min(price) AS min_price,
        max(price) AS max_price FROM x WHERE {Q.LEGACY_INPUT}
        AND {Q.key('index_group')} = 'SW' AND bbl > 0 GROUP BY 1, 2, 3"""))
on_untimed("unit_label", lambda t: t.groupBy(
    M.neon_unit_label("itf", X.ukey("price_basis")).alias("unit"), "itf").agg(
        F.count(F.lit(1)).alias("rows")),
    Q.with_(Q.UNTIMED, select=f"""SELECT CASE WHEN itf = 'Financial'
      OR contains({Q.key('price_basis')}, 'ICE') THEN 'contracts/month' ELSE 'm3/day' END AS unit,
      itf, count(*) AS rows FROM cyc GROUP BY 1, 2"""))
on_untimed("legacy_layout", legacy.legacy_layout,
           Q.with_(Q.UNTIMED, Q.LAYOUT, select="SELECT * FROM lay"))
on_untimed("completeness_summary",
           lambda t: quality.completeness_summary(legacy.legacy_layout(t)),
           Q.with_(Q.UNTIMED, Q.LAYOUT, select="""SELECT count(*) AS rows,
      count(*) FILTER (WHERE "Trade ID" IS NULL OR "Trade ID" = '') AS missing_trade_id,
      count(*) FILTER (WHERE "Exec Date" IS NULL) AS missing_exec_date,
      count(*) FILTER (WHERE "Exec Time" IS NULL) AS missing_exec_time,
      count(*) FILTER (WHERE period_delivery_month IS NULL) AS missing_period_delivery_month,
      count(*) FILTER (WHERE "In Index?" IS NULL) AS missing_in_index,
      count(*) FILTER (WHERE "Index/Trade/Financial" IS NULL) AS missing_classification,
      count(*) FILTER (WHERE "Index Group" IS NULL) AS missing_index_group,
      count(*) FILTER (WHERE "KeyID" IS NULL) AS missing_key_id,
      count(*) FILTER (WHERE NOT "Inside Trade Cycle?") AS outside_trade_cycle FROM lay"""))
on_untimed("unmatched_rules", lambda t: quality.unmatched_rules(legacy.legacy_layout(t)),
           Q.with_(Q.UNTIMED, Q.LAYOUT, select="""SELECT DISTINCT "Instrument", "Price Basis",
      "Location", "Period", "In Index?", "Index/Trade/Financial", "Swap/Leg/Outright",
      "Index Group", "KeyID" FROM lay WHERE "In Index?" IS NULL
      OR "Index/Trade/Financial" IS NULL OR "Index Group" IS NULL OR "KeyID" IS NULL"""))
on_raw("duplicate_check", "OneX", lambda r: quality.duplicate_check(
    r.withColumn("trade_id", F.nullif(X.squish("trade_id"), F.lit(""))), "trade_id"),
    Q.with_(Q.raw("OneX"), select=f"""SELECT nullif({Q.sq('trade_id')}, '') AS trade_id,
      count(*) AS duplicate_count FROM raw GROUP BY 1
      HAVING count(*) > 1 AND nullif({Q.sq('trade_id')}, '') IS NOT NULL"""))
on_raw("duplicate_summary", "OneX", lambda r: quality.duplicate_summary(
    r.withColumn("trade_id", F.nullif(X.squish("trade_id"), F.lit(""))), "trade_id"),
    Q.with_(Q.raw("OneX"), f"i AS (SELECT nullif({Q.sq('trade_id')}, '') AS id FROM raw)",
            "n AS (SELECT id, count(*) AS n FROM i WHERE id IS NOT NULL GROUP BY 1)",
            select="""SELECT (SELECT count(*) FROM i) AS rows_before_dedup,
      count(*) AS unique_trade_ids, count(*) FILTER (WHERE n > 1) AS duplicated_trade_ids,
      CAST(sum(n - 1) AS BIGINT) AS duplicate_rows_to_remove FROM n"""))

# --- Unions -----------------------------------------------------------------------


def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Two raw layouts united by column name."""
    neon = A.raw_export(spark, sf, "Neon").select("trade_id", "product", "qty", "price")
    onex = A.raw_export(spark, sf, "OneX").select("price", "trade_id", "instrument", "sleeved")
    return read_all_sheets({"Neon": neon, "OneX": onex})


register("union_sources", union_sources, Q.with_(
    Q.raw("Neon", "a"), Q.raw("OneX", "b"),
    select="""SELECT trade_id, product, qty, price, NULL::VARCHAR AS instrument,
      NULL::VARCHAR AS sleeved, 'Neon' AS source_sheet FROM a UNION ALL
      SELECT trade_id, NULL, NULL, price, instrument, sleeved, 'OneX' FROM b"""))
