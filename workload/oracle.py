"""DuckDB SQL giving the expected result of every query that SQL can express."""

from __future__ import annotations

from workload.adapters import (
    PRODUCT_RULES, RAW, calendar_sql, events_columns, rules_sql, select_list, trades_columns,
)
from workload.dialect import DUCK

BBL = "6.28981077e0"
SPACES = r"[\s\x{00A0}]+"
MONTHS = "['JAN','FEB','MAR','APR','MAY','JUN','JUL','AUG','SEP','OCT','NOV','DEC']"


# --- Scalar expressions -------------------------------------------------------

def sq(x):
    return f"trim(regexp_replace({x}, '{SPACES}', ' ', 'g'))"


def text(x):
    return f"(coalesce({sq(x)}, '') <> '')"


def blank(x):
    return f"CASE WHEN upper({sq(x)}) NOT IN ('', 'NA') THEN {sq(x)} END"


def key(x):
    return f"nullif(upper(regexp_replace({sq(x)}, '[‐‑‒–—―]', '-', 'g')), '')"


def num(x):
    bare = sq(f"regexp_replace({x}, '[,$]', '', 'g')")
    pattern = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
    return f"CASE WHEN regexp_matches({bare}, '{pattern}') THEN TRY_CAST({bare} AS DOUBLE) END"


def flag(x):
    t = f"upper({sq(x)})"
    return (f"CASE WHEN {t} IN ('TRUE','T','YES','Y','1') THEN TRUE"
            f" WHEN {t} IN ('FALSE','F','NO','N','0') THEN FALSE END")


def yes(x):
    return f"coalesce({key(x)} IN ('Y','YES','TRUE','1'), FALSE)"


def label_month(x, pattern="([A-Z]{3})[- ]?([0-9]{4}|[0-9]{2})"):
    t = f"upper({sq(x)})"
    mon = f"nullif(list_position({MONTHS}, regexp_extract({t}, '{pattern}', 1)), 0)"
    yr = f"TRY_CAST(regexp_extract({t}, '{pattern}', 2) AS INT)"
    return f"TRY_CAST(make_date(CASE WHEN {yr} < 100 THEN 2000 + {yr} ELSE {yr} END, {mon}, 1) AS DATE)"


def between(day="exec_date", start="trade_cycle_start", end="trade_cycle_end"):
    return (f"CASE WHEN {day} IS NULL OR {start} IS NULL OR {end} IS NULL THEN NULL"
            f" ELSE {day} BETWEEN {start} AND {end} END")


def ratio(n, d):
    return f"CASE WHEN {d} > 0 THEN {n} / {d} END"


VWAP = ratio("sum(price * qty_m3)", "sum(qty_m3)")


# --- Shared relations ---------------------------------------------------------

def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


CALENDAR = f"cal AS ({calendar_sql(DUCK)})"


def enrich(source: str, out: str = "t") -> str:
    index_text = "upper(coalesce(instrument, '') || ' ' || coalesce(price_basis, ''))"
    return f"""{out}_a AS (
  SELECT * REPLACE ({key('index_group')} AS index_group, {blank('grade')} AS grade) FROM {source}
), {out}_b AS (
  SELECT *, strftime(exec_date, '%a') AS exec_dow, CAST(isodow(exec_date) AS INT) AS exec_dow_num,
    qty_m3 * {BBL} AS qty_bbl,
    coalesce(in_index AND itf = 'Trade' AND swap_leg_outright = 'Outright' AND grade IS NOT NULL
             AND qty_m3 > 0 AND price IS NOT NULL, FALSE) AS is_component,
    coalesce(itf = 'Index', FALSE) AS is_index_ref
  FROM {out}_a
), {out} AS (
  SELECT *, is_component AND coalesce(in_trade_cycle, FALSE) AS is_component_in_cycle,
    CASE WHEN is_index_ref THEN CASE
      WHEN contains({index_text}, 'BI4') THEN 'Bi4' WHEN contains({index_text}, 'XAPP') THEN 'XAPP'
      WHEN contains({index_text}, 'COMM') THEN 'comm' WHEN contains({index_text}, '1A') THEN '1a'
      ELSE 'other' END END AS index_type
  FROM {out}_b
)"""


NORMAL = """broker, trade_id, exec_datetime, exec_date, exec_hour, instrument, grade, index_group,
 itf, swap_leg_outright, in_index, period, delivery_month, price, qty_m3, unit_raw, location,
 pipeline, price_basis, trade_cycle_start, trade_cycle_end, in_trade_cycle, source_file"""
ENRICHED = NORMAL + """, exec_dow, exec_dow_num, qty_bbl, is_component, is_component_in_cycle,
 is_index_ref, index_type"""

UNTIMED = f"""{CALENDAR}, rules AS ({PRODUCT_RULES}),
base AS (SELECT {select_list(trades_columns(DUCK))} FROM lineitem),
cyc AS (SELECT base.*, rules.itf, rules.index_group, cal.trade_cycle_start, cal.trade_cycle_end,
  {between()} AS in_trade_cycle
  FROM base LEFT JOIN rules USING (instrument) LEFT JOIN cal USING (delivery_month))"""
TRADES = UNTIMED + ",\n" + enrich("cyc")
EVENTS = f"ev AS (SELECT {select_list(events_columns(DUCK))} FROM events),\n" + enrich("ev")

SW = "index_group = 'SW' AND is_component_in_cycle"
COMM = f"{SW} AND broker IN ('ICE','Modern','Neon','OneX')"
ONE_A = f"{SW} AND broker IN ('ICE','OneX')"
LAST_MONTH = f"(SELECT max(delivery_month) FROM t WHERE {SW})"


def on_trades(select: str, *more: str) -> str:
    return with_(TRADES, *more, select=select)


def on_events(select: str, *more: str) -> str:
    return with_(EVENTS, *more, select=select)


# --- Monthly index family -----------------------------------------------------

def monthly_index(where, definition, by_grade):
    keys = "delivery_month, grade" if by_grade else "delivery_month"
    return on_trades(f"""SELECT {keys}, {VWAP} AS vwap, sum(qty_m3) AS vol_m3,
      sum(qty_m3) * {BBL} AS vol_bbl, count(*) AS trades, count(DISTINCT broker) AS n_brokers,
      array_to_string(list_sort(list(DISTINCT broker)), ', ') AS brokers,
      min(exec_date) AS first_trade, max(exec_date) AS last_trade, '{definition}' AS definition
    FROM t WHERE {where} GROUP BY {keys}""")


SERIES = {"comm": "TRUE", "1a": "broker IN ('ICE','OneX')",
          **{b: f"broker = '{b}'" for b in ("ICE", "Modern", "Neon", "OneX")}}


def compare_columns():
    out = []
    for s, cond in SERIES.items():
        f = f"FILTER (WHERE {cond})"
        out.append(f"""{ratio(f'sum(price * qty_m3) {f}', f'sum(qty_m3) {f}')} AS "{s}_vwap",
        sum(qty_m3) {f} AS "{s}_vol_m3",
        nullif(count(*) {f}, 0) AS "{s}_trades" """)
    return ", ".join(out)


WIDE = f"""wide AS (SELECT delivery_month, {compare_columns()}, count(DISTINCT broker) AS n_brokers
  FROM t WHERE {COMM} GROUP BY delivery_month)"""

DAILY = f"""daily AS (SELECT delivery_month, exec_date, sum(qty_m3) AS day_vol,
    sum(price * qty_m3) AS day_num, count(*) AS trades, count(DISTINCT broker) AS n_brokers
  FROM t WHERE {COMM} GROUP BY ALL)"""


def daily_select(where="TRUE"):
    w = "OVER (PARTITION BY delivery_month ORDER BY exec_date)"
    return f"""SELECT *, day_num / day_vol AS day_vwap, sum(day_vol) {w} AS cum_vol,
      sum(day_num) {w} AS cum_num, CAST(sum(trades) {w} AS BIGINT) AS cum_trades,
      sum(day_num) {w} / sum(day_vol) {w} AS cum_vwap FROM daily WHERE {where}"""


def kpi_select(group):
    keys = "delivery_month, " if group else ""
    tail = "GROUP BY delivery_month" if group else ""
    where = COMM if group else f"{COMM} AND delivery_month = {LAST_MONTH}"
    return f"""SELECT {keys}{VWAP} AS "index", coalesce(sum(qty_m3), 0.0e0) AS vol_m3,
      coalesce(sum(qty_m3) * {BBL}, 0.0e0) AS vol_bbl, count(*) AS trades,
      count(DISTINCT broker) AS n_brokers, count(DISTINCT grade) AS n_grades,
      min(exec_date) AS first, max(exec_date) AS last FROM t WHERE {where} {tail}"""


def contribution(by, extra=""):
    return on_trades(f"""SELECT delivery_month, {by}, sum(qty_m3) AS vol_m3, count(*) AS trades,
      {VWAP} AS vwap {extra},
      sum(qty_m3) / sum(sum(qty_m3)) OVER (PARTITION BY delivery_month) AS share
    FROM t WHERE {COMM} GROUP BY delivery_month, {by}""")


def month_by(by, measures="sum(qty_m3) AS vol"):
    return on_trades(f"SELECT delivery_month, {by}, {measures} FROM t WHERE {SW} GROUP BY ALL")


POSITION = """CASE WHEN coalesce(in_trade_cycle, FALSE) THEN 'In cycle'
  WHEN exec_date IS NULL OR trade_cycle_start IS NULL OR trade_cycle_end IS NULL THEN 'No TC match'
  WHEN exec_date < trade_cycle_start THEN 'Before cycle'
  WHEN exec_date > trade_cycle_end THEN 'After cycle' ELSE 'No TC match' END"""


# --- Seasonality --------------------------------------------------------------

POSITIONS = f"""d AS (SELECT * FROM t WHERE {COMM}),
days AS (SELECT delivery_month, exec_date, sum(qty_m3) AS vol, min(trade_cycle_start) AS s
  FROM d GROUP BY ALL),
pos0 AS (SELECT delivery_month, exec_date, vol,
  CAST(datediff('day', s, exec_date) + 1 AS INT) AS cycle_day,
  CAST(row_number() OVER (PARTITION BY delivery_month ORDER BY exec_date) AS INT) AS trading_day_rank,
  CAST(count(*) OVER (PARTITION BY delivery_month) AS INT) AS n_trading_days,
  sum(vol) OVER (PARTITION BY delivery_month) AS total_vol FROM days),
pos AS (SELECT *, CASE WHEN n_trading_days > 1 THEN
  CAST(trading_day_rank - 1 AS DOUBLE) / (n_trading_days - 1) * 100 ELSE 0.0e0 END AS norm_pct
  FROM pos0)"""


def season(by=None):
    """Relation ``season`` after POSITIONS."""
    if by is None:
        source, part = "SELECT * EXCLUDE (vol), vol AS day_vol FROM pos", "delivery_month"
    else:
        source = f"""SELECT p.* EXCLUDE (vol), g.seg,
            coalesce(v.day_vol, 0.0e0) AS day_vol
          FROM (SELECT * FROM (SELECT DISTINCT delivery_month, exec_date FROM d WHERE {by} IS NOT NULL)
                JOIN (SELECT DISTINCT delivery_month, {by} AS seg FROM d WHERE {by} IS NOT NULL)
                USING (delivery_month)) g
          JOIN pos p USING (delivery_month, exec_date)
          LEFT JOIN (SELECT delivery_month, exec_date, {by} AS seg, sum(qty_m3) AS day_vol
                     FROM d GROUP BY ALL) v USING (delivery_month, exec_date, seg)"""
        part = "delivery_month, seg"
    return f"""s0 AS ({source}),
s1 AS (SELECT *, sum(day_vol) OVER (PARTITION BY {part} ORDER BY exec_date) AS cum_vol FROM s0),
season AS (SELECT *, day_vol / total_vol * 100 AS day_pct, cum_vol / total_vol * 100 AS cum_pct FROM s1)"""


def season_query(select, by=None):
    return on_trades(select, POSITIONS, season(by))


def bars(base, value, newest=None):
    recent = (f"""WHERE delivery_month IN (SELECT DISTINCT delivery_month FROM season
                               ORDER BY 1 DESC LIMIT {newest})""" if newest else "")
    return season_query(f"""SELECT delivery_month, {base} AS base, seg, {value} AS val FROM season
      {recent} GROUP BY ALL""", "grade")


def curve(x, y, stat, grid):
    return on_trades(f"""SELECT g.x, {stat} AS y FROM grid g JOIN seg ON
        (g.x >= seg.x0 OR first) AND (g.x < seg.x1 OR seg.x1 IS NULL)
      GROUP BY g.x""", POSITIONS, season(),
        f"""seg AS (SELECT * FROM (SELECT delivery_month, CAST({x} AS DOUBLE) AS x0, {y} AS y0,
          CAST(lead({x}) OVER w AS DOUBLE) AS x1, lead({y}) OVER w AS y1,
          row_number() OVER w = 1 AS first, count(*) OVER (PARTITION BY delivery_month) AS n
          FROM season WINDOW w AS (PARTITION BY delivery_month ORDER BY {x})) WHERE n >= 2)""",
        f"grid AS ({grid})")


AT = "CASE WHEN x1 IS NULL OR x <= x0 THEN y0 ELSE y0 + (y1 - y0) * ((x - x0) / (x1 - x0)) END"
PCT_GRID = "SELECT CAST(unnest(generate_series(0, 40)) AS DOUBLE) * 2.5e0 AS x"
DAY_GRID = """SELECT CAST(unnest(generate_series((SELECT min(trading_day_rank) FROM season),
  (SELECT max(trading_day_rank) FROM season))) AS DOUBLE) AS x"""


# --- Intraday -----------------------------------------------------------------

def tod(minutes):
    return f"CAST((hour(exec_datetime) * 60 + minute(exec_datetime)) // {minutes} * {minutes} AS INT)"


def intraday_total(minutes, where):
    return f"""SELECT *, sum(num) OVER w / sum(vol_m3) OVER w AS cum_vwap FROM (
      SELECT {tod(minutes)} AS tod, sum(qty_m3) AS vol_m3, sum(price * qty_m3) AS num,
        count(*) AS trades, {VWAP} AS vwap, avg(price) AS avg_price FROM t
      WHERE {where} AND exec_hour IS NOT NULL AND exec_datetime IS NOT NULL GROUP BY 1)
    WINDOW w AS (ORDER BY tod)"""


def ohlc(bucket, tie):
    order = f"ORDER BY exec_datetime, {tie}"
    return f"""SELECT grade, {bucket} AS bkt, first(price {order}) AS open, max(price) AS high,
      min(price) AS low, last(price {order}) AS close, sum(qty_m3) AS volume,
      count(*) AS trades, {VWAP} AS vwap
    FROM t WHERE {COMM} AND exec_datetime IS NOT NULL GROUP BY grade, 2"""


# --- Normalizers --------------------------------------------------------------

FILE_ORDER = "source_file_modified DESC NULLS LAST, source_file, source_block, source_row"


def raw(broker, out="raw"):
    source = "lineitem" if broker != "Modern" else \
        "lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"
    return f"{out} AS (SELECT {select_list(RAW[broker](DUCK))} FROM {source})"


def rules(broker, out="ru"):
    token = f"upper({sq('active')})"
    keys = ", ".join(f"{key(c)} AS {c}_key" for c in
                     ("raw_product", "raw_price_basis", "raw_index", "raw_location", "raw_pipeline"))
    return f"""{out} AS (SELECT * FROM (SELECT rule_ord, {keys}, {blank('key_id')} AS key_id,
      {blank('index_group')} AS index_group, {blank('index_trade_financial')} AS itf,
      {blank('y_n')} AS y_n, coalesce(TRY_CAST(rule_priority AS DOUBLE), 999999) AS prio,
      CASE WHEN NOT {text('active')} THEN TRUE ELSE {token} IN ('TRUE','YES','Y','1') END AS on_
    FROM ({rules_sql(broker)})) WHERE on_ AND raw_product_key IS NOT NULL)"""


def tier(source, keys, absent, out):
    where = " AND ".join([f"{k} IS NOT NULL" for k in keys] + [f"{k} IS NULL" for k in absent])
    return f"""{out} AS (SELECT * FROM {source} WHERE {where}
      QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY prio, rule_ord) = 1)"""


P, B, I, L, PL = ("raw_product_key", "raw_price_basis_key", "raw_index_key", "raw_location_key",
                  "raw_pipeline_key")
TIERS = {
    "ICE": [([P], [])], "OneX": [([P], [])],
    "Modern": [([P, B], []), ([P], [B])],
    "Neon": [([P, I, PL], []), ([P, I, L], [PL]), ([P, I], [PL, L]), ([P], [I, L, PL])],
}


def ruled(broker, source, out, tag=""):
    """``out``: source rows with r_itf, r_index_group, r_key_id and r_y_n."""
    ctes, joins = [rules(broker, f"{tag}ru")], []
    table = f"{tag}ru"
    if broker == "Neon":
        ctes.append(f"{tag}rn AS (SELECT * REPLACE (coalesce({I}, {B}) AS {I}) FROM {tag}ru)")
        table = f"{tag}rn"
    for i, (keys, absent) in enumerate(TIERS[broker]):
        ctes.append(tier(table, keys, absent, f"{tag}t{i}"))
        on = " AND ".join(f"x.{k.removeprefix('raw_')} = {tag}t{i}.{k}" for k in keys)
        joins.append(f"LEFT JOIN {tag}t{i} ON {on}")
    outs = ", ".join(
        f"coalesce({', '.join(f'{tag}t{i}.{c}' for i in range(len(TIERS[broker])))}) AS r_{c}"
        for c in ("itf", "index_group", "key_id", "y_n"))
    ctes.append(f"{out} AS (SELECT x.*, {outs} FROM {source} x {' '.join(joins)})")
    return ",\n".join(ctes)


def with_cycle(source, out):
    return f"""{out} AS (SELECT {NORMAL} FROM (SELECT s.*, cal.trade_cycle_start,
      cal.trade_cycle_end, {between()} AS in_trade_cycle
      FROM {source} s LEFT JOIN cal USING (delivery_month)))"""


ICE_STANDING = f"NOT {yes('is_cancelled')} AND NOT {text('parent_fin_assist')}"
MODERN_STANDING = (f"{key('state')} = 'FINALIZED' AND NOT"
                   f" coalesce({flag('credit_facilitation')}, FALSE)")
ONEX_STANDING = f"NOT coalesce({flag('cancelled')}, FALSE)"
ICE_LEG = f"CASE WHEN {text('spread_parent_id')} THEN 'Leg' ELSE 'Outright' END"
MODERN_LEG = f"""CASE {key('trade_type')} WHEN 'SPREAD' THEN 'Swap' WHEN 'FIRST LEG' THEN 'Leg'
  WHEN 'SECOND LEG' THEN 'Leg' WHEN 'OUTRIGHT' THEN 'Outright' ELSE trade_type END"""
NEON_LEG = """CASE WHEN is_parent THEN 'Swap' WHEN parent_trade_id IS NOT NULL THEN 'Leg'
  ELSE 'Outright' END"""
ONEX_LEG = f"""CASE {key('swap_trade')} WHEN 'PARENT' THEN 'Swap' WHEN 'LEG' THEN 'Leg'
  ELSE 'Outright' END"""
ICE_IN_INDEX = f"""({yes('r_y_n')} OR coalesce(r_y_n IS NULL AND r_itf = 'Trade'
  AND r_index_group IS NOT NULL AND r_key_id IS NOT NULL, FALSE))"""
NEON_IN_INDEX = f"""coalesce({flag('r_y_n')}, {text('"index"')})"""


def ice_versions(out="v", source="raw"):
    return f"""{out} AS (SELECT * FROM {source} QUALIFY row_number() OVER (
      PARTITION BY deal_id ORDER BY {FILE_ORDER}) = 1)"""


def modern_versions(out="v", source="raw"):
    return f"""{out} AS (SELECT * FROM {source} QUALIFY row_number() OVER (
      PARTITION BY trade_number ORDER BY {FILE_ORDER}) = 1)"""


def neon_versions(out="v", source="raw", order=FILE_ORDER):
    return f"""{out} AS (SELECT * FROM (SELECT * REPLACE ({sq('trade_id')} AS trade_id,
        nullif({sq('parent_trade_id')}, '') AS parent_trade_id) FROM {source})
      QUALIFY coalesce(trade_id, '') = '' OR row_number() OVER (
        PARTITION BY trade_id ORDER BY {order}) = 1)"""


def onex_versions(out="v", source="raw", order=f"export_end DESC NULLS LAST, {FILE_ORDER}"):
    day = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
    return f"""{out} AS (SELECT * FROM (SELECT * REPLACE (nullif({sq('trade_id')}, '') AS trade_id),
        TRY_CAST(regexp_extract(source_file, '({day})_({day})', 2) AS DATE) AS export_end
        FROM {source})
      QUALIFY trade_id IS NULL OR row_number() OVER (PARTITION BY trade_id ORDER BY {order}) = 1)"""


ONE_LEG = f"""one AS (SELECT *, regexp_replace(market,
    '{SPACES}-{SPACES}[^-]+$', '') AS instrument FROM v WHERE {ICE_STANDING}
  QUALIFY NOT {text('spread_parent_id')} OR row_number() OVER (
    PARTITION BY spread_parent_id ORDER BY deal_id) = 1)"""


def normalize_ice(tag="ic"):
    one = ONE_LEG.replace("FROM v ", f"FROM {tag}v ").replace("one AS", f"{tag}one AS")
    at = f"TRY_STRPTIME({sq('local_datetime')}, '%m/%d/%Y %H:%M:%S')"
    day = f"CAST(TRY_STRPTIME(left({sq('local_datetime')}, 10), '%m/%d/%Y') AS DATE)"
    return ",\n".join([
        raw("ICE", f"{tag}raw"), ice_versions(f"{tag}v", f"{tag}raw"), one,
        f"{tag}k AS (SELECT *, {key('instrument')} AS product_key FROM {tag}one)",
        ruled("ICE", f"{tag}k", f"{tag}r", tag),
        f"""{tag}s AS (SELECT 'ICE' AS broker, deal_id AS trade_id, {at} AS exec_datetime,
          {day} AS exec_date, CAST(hour({at}) AS INT) AS exec_hour, instrument, r_key_id AS grade,
          r_index_group AS index_group, r_itf AS itf, {ICE_LEG} AS swap_leg_outright,
          {ICE_IN_INDEX} AS in_index, strip AS period, {label_month('strip')} AS delivery_month,
          {num('price')} AS price, {num('qty')} AS qty_m3, 'm3' AS unit_raw, hub_name AS location,
          CAST(NULL AS VARCHAR) AS pipeline, trade_index AS price_basis, source_file
          FROM {tag}r)""",
        with_cycle(f"{tag}s", f"{tag}n")])


def normalize_modern(tag="mo"):
    x = sq("executed_timestamp")
    at = (f"coalesce(TRY_STRPTIME({x}, '%Y-%m-%d %I:%M:%S %p'),"
          f" TRY_STRPTIME({x}, '%Y-%m-%d %H:%M:%S'), TRY_STRPTIME({x}, '%Y-%m-%d %H:%M'))")
    return ",\n".join([
        raw("Modern", f"{tag}raw"), modern_versions(f"{tag}v", f"{tag}raw"),
        f"""{tag}k AS (SELECT *, {key('product')} AS product_key,
          {key('price_basis')} AS price_basis_key FROM {tag}v WHERE {MODERN_STANDING})""",
        ruled("Modern", f"{tag}k", f"{tag}r", tag),
        f"""{tag}s AS (SELECT 'Modern' AS broker, trade_number AS trade_id, {at} AS exec_datetime,
          CAST({at} AS DATE) AS exec_date, CAST(hour({at}) AS INT) AS exec_hour,
          product AS instrument, r_key_id AS grade, r_index_group AS index_group, r_itf AS itf,
          {MODERN_LEG} AS swap_leg_outright, coalesce({flag('in_index')}, FALSE) AS in_index,
          term AS period, {label_month('term')} AS delivery_month, {num('price')} AS price,
          {num('volume')} AS qty_m3, unit_of_measure AS unit_raw, location,
          pipeline_terminal AS pipeline, price_basis, source_file FROM {tag}r)""",
        with_cycle(f"{tag}s", f"{tag}n")])


def neon_flagged(tag):
    return f"""{tag}p AS (SELECT DISTINCT parent_trade_id AS named FROM {tag}v WHERE parent_trade_id IS NOT NULL),
{tag}f AS (SELECT {tag}v.*, named IS NOT NULL AS is_parent FROM {tag}v LEFT JOIN {tag}p ON trade_id = named)"""


def normalize_neon(tag="ne"):
    def stamp(c):
        x = sq(c)
        return (f"coalesce(TRY_STRPTIME({x}, '%Y-%m-%d %H:%M:%S'),"
                f" TRY_STRPTIME({x}, '%Y-%m-%d %H:%M'), TRY_STRPTIME({x}, '%Y-%m-%d'))")
    at = stamp("trade_time")
    start = f"CAST(date_trunc('month', {stamp('delivery_start')}) AS DATE)"
    return ",\n".join([
        raw("Neon", f"{tag}raw"), neon_versions(f"{tag}v", f"{tag}raw"), neon_flagged(tag),
        f"""{tag}k AS (SELECT *, {key('product')} AS product_key, {key('"index"')} AS index_key,
          {key('location')} AS location_key, {key('pipeline')} AS pipeline_key FROM {tag}f)""",
        ruled("Neon", f"{tag}k", f"{tag}r", tag),
        f"""{tag}s AS (SELECT 'Neon' AS broker, trade_id, {at} AS exec_datetime,
          CAST({at} AS DATE) AS exec_date, CAST(hour({at}) AS INT) AS exec_hour,
          product AS instrument, r_key_id AS grade, r_index_group AS index_group, r_itf AS itf,
          {NEON_LEG} AS swap_leg_outright, {NEON_IN_INDEX} AS in_index, period,
          coalesce({label_month('period')}, {start}) AS delivery_month, {num('price')} AS price,
          {num('qty')} AS qty_m3, 'm3' AS unit_raw, location, pipeline,
          "index" AS price_basis, source_file FROM {tag}r)""",
        with_cycle(f"{tag}s", f"{tag}n")])


ECON = ("day", "clock", "k_instrument", "k_period", "qty_num", "k_unit", "price_num", "k_pipeline",
        "k_buyer_pays", "k_buyer_receives", "k_swap_trade")
COPY_ORDER = """sleeved_bool, id_num NULLS LAST, export_end DESC NULLS LAST,
  source_file_modified DESC, source_file, source_block, source_row"""


def onex_economics(tag, econ=ECON):
    d, c = sq("exec_date"), sq("exec_time")
    keys = ", ".join(f"{key(k)} AS k_{k}" for k in ("instrument", "period", "unit", "pipeline",
                                                   "buyer_pays", "buyer_receives", "swap_trade"))
    return f"""{tag}c AS (SELECT *, CASE WHEN regexp_matches({d}, '^[0-9]+$') THEN
        DATE '1899-12-30' + CAST({d} AS INT)
        ELSE CAST(coalesce(TRY_STRPTIME({d}, '%Y-%m-%d'), TRY_STRPTIME({d}, '%m/%d/%Y')) AS DATE)
        END AS day,
      CAST(coalesce(TRY_STRPTIME({c}, '%I:%M:%S %p'), TRY_STRPTIME({c}, '%I:%M %p'),
        TRY_STRPTIME({c}, '%H:%M:%S'), TRY_STRPTIME({c}, '%H:%M')) AS TIME) AS clock,
      {num('qty')} AS qty_num, {num('price')} AS price_num, {num('trade_id')} AS id_num,
      coalesce({flag('sleeved')}, FALSE) AS sleeved_bool,
      {flag('is_financial')} AS is_financial_bool, {keys} FROM {tag}v WHERE {ONEX_STANDING}),
    {tag}g AS (SELECT *, count(*) OVER w AS copies, max(sleeved_bool) OVER w AS has_sleeve,
      row_number() OVER (PARTITION BY {', '.join(econ)} ORDER BY {COPY_ORDER}) AS rn
      FROM {tag}c WINDOW w AS (PARTITION BY {', '.join(econ)}))"""


def normalize_onex(tag="ox"):
    return ",\n".join([
        raw("OneX", f"{tag}raw"), onex_versions(f"{tag}v", f"{tag}raw"), onex_economics(tag),
        f"""{tag}k AS (SELECT *, k_instrument AS product_key FROM {tag}g
          WHERE NOT (copies > 1 AND has_sleeve AND rn > 1))""",
        ruled("OneX", f"{tag}k", f"{tag}r", tag),
        f"""{tag}s AS (SELECT 'OneX' AS broker, trade_id,
          coalesce(day + clock, CAST(day AS TIMESTAMP)) AS exec_datetime,
          day AS exec_date, CAST(hour(clock) AS INT) AS exec_hour, instrument, r_key_id AS grade,
          r_index_group AS index_group, r_itf AS itf, {ONEX_LEG} AS swap_leg_outright,
          coalesce({flag('r_y_n')}, FALSE) AS in_index, period,
          {label_month('period')} AS delivery_month, price_num AS price, qty_num AS qty_m3,
          unit AS unit_raw, location, pipeline, buyer_pays AS price_basis, source_file
          FROM {tag}r)""",
        with_cycle(f"{tag}s", f"{tag}n")])


NORMALIZED = {"normalize_ice": (normalize_ice, "ic"), "normalize_modern": (normalize_modern, "mo"),
              "normalize_neon": (normalize_neon, "ne"), "normalize_onex": (normalize_onex, "ox")}


def backfill(source, out):
    """``out``: source with estimated windows for traded months the calendar lacks."""
    return f"""{out}_c AS (SELECT CAST(coalesce(round_even(median(day(trade_cycle_end)), 0), 15) AS INT)
      AS close_day FROM cal),
    {out}_w AS (SELECT delivery_month, CAST(delivery_month - INTERVAL 1 MONTH AS DATE) AS s,
      CAST(delivery_month - INTERVAL 1 MONTH AS DATE)
        + CAST((SELECT close_day FROM {out}_c) - 1 AS INT) AS e
      FROM (SELECT DISTINCT delivery_month FROM {source} WHERE delivery_month IS NOT NULL
            AND (trade_cycle_start IS NULL OR trade_cycle_end IS NULL)
            AND delivery_month NOT IN (SELECT delivery_month FROM cal))),
    {out}_k AS (SELECT * FROM {out}_w w WHERE EXISTS (SELECT 1 FROM {source} x
      WHERE x.delivery_month = w.delivery_month AND x.exec_date BETWEEN w.s AND w.e)),
    {out}_j AS (SELECT x.* REPLACE (coalesce(trade_cycle_start, s) AS trade_cycle_start,
      coalesce(trade_cycle_end, e) AS trade_cycle_end)
      FROM {source} x LEFT JOIN {out}_k k USING (delivery_month)),
    {out} AS (SELECT * REPLACE ({between()} AS in_trade_cycle) FROM {out}_j)"""


BUILD = ",\n".join([
    CALENDAR, *[fn(tag) for fn, tag in NORMALIZED.values()],
    "al AS (" + " UNION ALL BY NAME ".join(
        f"SELECT {NORMAL} FROM {tag}n" for _, tag in NORMALIZED.values()) + ")",
    backfill("al", "bf"), enrich("bf")])


# --- Older reports ------------------------------------------------------------

LAYOUT_COLUMNS = """trade_id AS "Trade ID", exec_date AS "Exec Date",
  CASE WHEN exec_hour IS NOT NULL THEN strftime(exec_datetime, '%H:%M:%S') END AS "Exec Time",
  instrument AS "Instrument", period AS "Period", qty_m3 AS "Qty", unit_raw AS "Unit",
  price AS "Price", price_basis AS "Price Basis",
  CASE WHEN broker = 'ICE' THEN location ELSE pipeline END AS "Location", broker AS "Broker",
  in_index AS "In Index?", itf AS "Index/Trade/Financial",
  swap_leg_outright AS "Swap/Leg/Outright", index_group AS "Index Group", grade AS "KeyID",
  delivery_month AS period_delivery_month, trade_cycle_start, trade_cycle_end,
  coalesce(in_trade_cycle, FALSE) AS "Inside Trade Cycle?", source_file"""
LAYOUT = f"lay AS (SELECT {LAYOUT_COLUMNS} FROM cyc)"
LEGACY_INPUT = """in_index AND itf = 'Trade' AND swap_leg_outright = 'Outright' AND qty_m3 > 0
  AND price IS NOT NULL AND in_trade_cycle"""
UNIT = f"lower({sq('unit_raw')})"
TO_BBL = f"""CASE WHEN regexp_matches({UNIT}, 'm3|m³') THEN qty_m3 * {BBL}
  WHEN contains({UNIT}, 'bbl') AND contains({UNIT}, 'd') THEN qty_m3 * day(last_day(delivery_month))
  WHEN contains({UNIT}, 'bbl') THEN qty_m3 END"""


def legacy_vwap(group, extra=""):
    where = f"AND {key('index_group')} = 'SW'" if group else ""
    return with_(UNTIMED, select=f"""SELECT period, delivery_month, trade_cycle_start,
      trade_cycle_end, index_group, count(*) AS trade_count,
      sum(qty_m3) AS total_volume_m3_per_month {extra},
      sum(price * qty_m3) / sum(qty_m3) AS vwap, min(price) AS min_price, max(price) AS max_price
    FROM cyc WHERE {LEGACY_INPUT} {where} GROUP BY period, delivery_month, trade_cycle_start,
      trade_cycle_end, index_group""")


def view(columns):
    return ", ".join(f"""{'round_even(price, 3)' if src == 'price' else src} AS "{name}" """
                     for name, src in columns)


REF_VIEW = view([("Broker", "broker"), ("Trade ID", "trade_id"), ("Date", "exec_date"),
                 ("Type", "index_type"), ("Instrument", "instrument"), ("Grade", "grade"),
                 ("Period", "period"), ("Deliv. month", "delivery_month"), ("Qty m³", "qty_m3"),
                 ("Price diff", "price"), ("In cycle", "in_trade_cycle"),
                 ("Price basis", "price_basis")])
TRADES_VIEW = view([("Broker", "broker"), ("Trade ID", "trade_id"), ("Date", "exec_date"),
                    ("Hour", "exec_hour"), ("Instrument", "instrument"), ("Grade", "grade"),
                    ("Class", "itf"), ("Type", "swap_leg_outright"), ("In idx", "in_index"),
                    ("Period", "period"), ("Deliv. month", "delivery_month"), ("Price", "price"),
                    ("Qty m³", "qty_m3"), ("In cycle", "in_trade_cycle"),
                    ("Component", "is_component_in_cycle")])
UNPARSED = """itf = 'Trade' AND grade IS NOT NULL AND delivery_month IS NULL
  AND coalesce(trim(period), '') <> ''"""
UNPARSED_VIEW = view([("Broker", "broker"), ("Trade ID", "trade_id"), ("Date", "exec_date"),
                      ("Group", "index_group"), ("Grade", "grade"), ("Instrument", "instrument"),
                      ("Period", "period"), ("Price", "price"), ("Qty m³", "qty_m3"),
                      ("Source file", "source_file")])
REFS = "index_group = 'SW' AND is_index_ref"


def ref_by(by):
    return on_trades(f"""SELECT {by}, sum(qty_m3) AS vol_m3, count(*) AS trades,
      array_to_string(list_sort(list(DISTINCT index_type)), ', ') AS types
      FROM t WHERE {REFS} GROUP BY {by}""")
