import datetime as dt

import pytest
from pyspark.sql import functions as F

from cyclebook.plans import dataset, filters, index, intraday, quality, references, seasonality
from cyclebook.schema import BROKERS, TRADE_SCHEMA
from cyclebook.sources.conform import add_missing_cols, coerce_schema
from tests.conftest import SF, by
from workload.queries import events, star

D = dt.date


@pytest.fixture(scope="module")
def trades(spark):
    cached = star(spark, SF).cache()
    yield cached
    cached.unpersist()


@pytest.fixture(scope="module")
def ticks(spark):
    cached = events(spark, SF).cache()
    yield cached
    cached.unpersist()


@pytest.fixture(scope="session")
def small(spark):
    """Enriched trades from a few given columns; the rest makes a component trade."""
    base = {"broker": "ICE", "index_group": "SW", "itf": "Trade", "in_index": True, "grade": "G",
            "swap_leg_outright": "Outright", "price": 1.0, "qty_m3": 1.0, "in_trade_cycle": True,
            "delivery_month": "2026-07-01", "exec_date": "2026-06-03",
            "trade_cycle_start": "2026-06-01", "trade_cycle_end": "2026-06-15"}

    def make(*rows):
        names = list(dict.fromkeys([*base, *(k for r in rows for k in r)]))
        types = ", ".join(f"{n} " + {"price": "double", "qty_m3": "double", "in_index": "boolean",
                                     "in_trade_cycle": "boolean", "exec_hour": "int"}.get(n, "string")
                          for n in names)
        df = spark.createDataFrame([tuple({**base, **r}.get(n) for n in names) for r in rows], types)
        return dataset.enrich_combined(coerce_schema(add_missing_cols(df, TRADE_SCHEMA.fieldNames())))
    return make


def test_component_edges(small):
    t = small({}, {"qty_m3": 0.0}, {"price": None}, {"grade": " "}, {"in_index": None},
              {"itf": None}, {"in_trade_cycle": None}, {"itf": "Index", "instrument": "bi4 comm"})
    got = [(r.is_component, r.is_component_in_cycle, r.is_index_ref, r.index_type)
           for r in t.collect()]
    no = (False, False, False, None)
    assert got == [(True, True, False, None), no, no, no, no, no, (True, False, False, None),
                   (False, False, True, "Bi4")]


def test_definitions():
    assert filters.def_brokers("1a") == ("ICE", "OneX")
    assert filters.def_brokers("Neon") == ("Neon",)
    assert filters.def_brokers("nothing") == BROKERS == filters.def_brokers(None)


def test_broker_volumes_add_up(trades):
    comm = by(index.monthly_index(trades, by_grade=False), "delivery_month", "vol_m3")
    shares = index.broker_contribution(trades)
    summed = by(shares.groupBy("delivery_month").agg(F.sum("vol_m3").alias("v"),
                                                     F.sum("share").alias("s")), "delivery_month", "v", "s")
    assert {m: v for m, (v, _) in summed.items()} == comm
    assert all(abs(s - 1) < 1e-9 for _, s in summed.values())


def test_cumulative_index_ends_at_the_monthly_one(trades):
    monthly = by(index.monthly_index(trades, by_grade=False), "delivery_month", "vwap")
    daily = index.cycle_daily(trades)
    last = by(daily.groupBy("delivery_month").agg(F.max_by("cum_vwap", "exec_date").alias("v")),
              "delivery_month", "v")
    assert last == pytest.approx(monthly)
    tod = intraday.intraday_total(trades).collect()
    total = filters.component_trades(trades).filter(F.col("exec_hour").isNotNull()).agg(
        (F.sum(F.col("price") * F.col("qty_m3")) / F.sum("qty_m3"))).first()[0]
    assert tod[-1].cum_vwap == pytest.approx(total)


def test_candles_are_consistent(ticks):
    for bucket in ("day", 60, 5):
        c = intraday.ohlc_profile(ticks, bucket=bucket)
        assert c.filter("low > least(open, close) or high < greatest(open, close)"
                        " or vwap < low - 1e-9 or vwap > high + 1e-9").count() == 0
        assert c.agg(F.sum("trades")).first()[0] == filters.component_trades(ticks).count()


def test_same_instant_follows_the_tie(small):
    t = small(*[{"exec_datetime": "2026-06-03 10:00:00", "trade_id": str(i), "price": float(p)}
                for i, p in enumerate((5, 7, 6))])
    row = intraday.ohlc_profile(t, ordinal=F.col("trade_id").cast("long")).first()
    assert (row.open, row.high, row.low, row.close) == (5.0, 7.0, 5.0, 6.0)


def test_equal_instants_and_blank_ids_are_stable(small):
    t = small(*[{"exec_datetime": f"2026-06-03 10:00:0{i % 2}", "trade_id": " ", "price": float(p)}
                for i, p in enumerate((5, 7, 6, 9, -8, 7))])
    for n in (1, 2, 5):
        profile = intraday.ohlc_profile(t.repartition(n))
        row = profile.first()
        assert (row.open, row.high, row.low, row.close) == (-8.0, 9.0, -8.0, 9.0)
    assert "SortAggregate" not in profile._jdf.queryExecution().executedPlan().toString()


def test_order_key_is_exact_over_all_years(spark):
    rows = [("0001-01-01 00:00:00.000001", 0), ("0001-01-01 00:00:00.000002", -5), ("1969-12-31 23:59:59.999999", 9),
            ("1970-01-01 00:00:00", -(1 << 62)), ("1970-01-01 00:00:00", 1 << 62), ("2026-03-08 02:30:00", 1),
            ("9999-12-31 23:59:59.999999", 1)]
    t = spark.createDataFrame(rows, "t string, o long").select(F.col("t").cast("timestamp_ntz").alias("t"), "o")
    keys = [r.k for r in t.select(intraday.order_key("t", "o").alias("k")).collect()]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


def test_positions_cover_all_components(trades):
    compare = index.historic_cycle_compare(trades)
    rows = trades.filter("index_group = 'SW' and is_component").count()
    assert compare.agg(F.sum("trades")).first()[0] == rows
    assert {r.cycle for r in compare.collect()} == {
        "In cycle", "Before cycle", "After cycle", "No TC match"}


def test_wide_tables_agree(trades):
    wide = index.monthly_compare_full(trades).collect()
    pivot = {r.delivery_month: r for r in index.broker_vwap_wide(trades).collect()}
    for r in wide:
        assert all(r[f"{b}_vwap"] == pivot[r.delivery_month][b] for b in BROKERS)
        assert sum(r[f"{b}_trades"] or 0 for b in BROKERS) == r.comm_trades


def test_kpis_of_an_empty_month(trades):
    row = index.month_kpis(trades, D(2050, 1, 1)).first().asDict()
    assert row == {"index": None, "vol_m3": 0.0, "vol_bbl": 0.0, "trades": 0, "n_brokers": 0,
                   "n_grades": 0, "first": None, "last": None}
    one = index.month_kpis(trades, filters.latest_month(trades)).collect()
    assert len(one) == 1 and one[0].trades > 0
    refs = references.index_ref_kpis(trades, dm=D(2050, 1, 1)).first().asDict()
    assert set(refs.values()) == {0}


def test_month_and_list_selections(trades):
    months = [r[0] for r in filters.available_months(trades).collect()]
    assert index.cycle_daily(trades, months[0]).select("delivery_month").distinct().count() == 1
    assert filters.in_months(trades, months[:2]).select("delivery_month").distinct().count() == 2
    g = [r[0] for r in filters.available_grades(trades).limit(2).collect()]
    assert {r.grade for r in index.monthly_index(trades, grades=g).collect()} <= set(g)
    assert index.monthly_index(trades, ig="NONE").count() == 0


def test_season_of_one_trading_day(small):
    t = small({}, {"delivery_month": "2026-08-01", "exec_date": "2026-07-02"},
              {"delivery_month": "2026-08-01", "exec_date": "2026-07-05", "broker": "Neon"})
    s = seasonality.cycle_seasonality(t)
    assert by(s, "exec_date", "cycle_day", "trading_day_rank", "norm_pct", "cum_pct") == {
        D(2026, 6, 3): (3, 1, 0.0, 100.0), D(2026, 7, 2): (32, 1, 0.0, 50.0),
        D(2026, 7, 5): (35, 2, 100.0, 100.0)}
    curve = by(seasonality.season_curve(s, "pct", "cum_pct"), "x", "y")
    assert curve[0.0] == 50.0 and curve[50.0] == 75.0 and len(curve) == 41   # one cycle skipped
    one = filters.in_months(s, D(2026, 8, 1))
    assert seasonality.season_curve(one, "pct", "cum_pct").count() == 0      # needs two cycles
    seg = seasonality.cycle_seasonality(t, by="broker")
    assert sorted((str(r.exec_date), r.seg, r.day_vol, r.cum_vol) for r in seg.collect()) == [
        ("2026-06-03", "ICE", 1.0, 1.0), ("2026-07-02", "ICE", 1.0, 1.0),
        ("2026-07-02", "Neon", 0.0, 0.0), ("2026-07-05", "ICE", 0.0, 1.0),
        ("2026-07-05", "Neon", 1.0, 1.0)]
    everything = seasonality.seasonality_bars(seg, "day", "daily_raw")
    assert {str(r.delivery_month) for r in everything.collect()} == {"2026-07-01", "2026-08-01"}
    bars = seasonality.seasonality_bars(seg, "day", "daily_raw", max_months=1).collect()
    assert {str(r.delivery_month) for r in bars} == {"2026-08-01"}


def test_weekdays_and_segments(small):
    t = small(*[{"exec_date": f"2026-06-0{d}", "exec_datetime": f"2026-06-0{d} 10:0{d}:00",
                 "exec_hour": 10} for d in range(1, 8)])
    total = intraday.intraday_total(t, dows=[1, 7], bucket_min=1)
    assert [(r.tod, r.trades) for r in total.collect()] == [(601, 1), (607, 1)]
    assert intraday.intraday_profile(t)[1] is None
    assert intraday.intraday_profile(t, by="broker", bucket_min=60)[1].first().trades == 7
    assert intraday.hourly_profile(t).first().exec_hour == 10


def test_unparsed_and_unmapped(small):
    t = small({"delivery_month": None, "period": "Q3 25"}, {"delivery_month": None, "period": " "},
              {"delivery_month": None, "period": "Q3 25", "grade": None}, {"index_group": None})
    assert [r.period for r in quality.unparsed_month_trades(t).collect()] == ["Q3 25"]
    assert quality.qa_unmapped(t).first().rows == 1


def test_empty_dataset(spark):
    empty = dataset.enrich_combined(dataset.normalize_all(spark, {}, None))
    assert index.monthly_index(empty).count() == 0
    assert index.month_kpis(empty, D(2026, 7, 1)).first().trades == 0
    assert seasonality.season_curve(seasonality.cycle_seasonality(empty)).count() == 0
    assert quality.qa_coverage(empty).count() == 0
