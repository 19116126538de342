import datetime as dt

from cyclebook.plans import legacy, normalize
from cyclebook.schema import TRADE_SCHEMA
from cyclebook.sources.reference import reference_from_tables
from tests.conftest import EARLY, LATE, by

JUL, AT = dt.date(2026, 7, 1), dt.datetime(2026, 6, 3, 9, 15, 22)


def make_ref(calendar_rows, rule_rows, broker, *rules):
    cal = calendar_rows(("2026-07-01", "2026-06-01", "2026-06-15"))
    return reference_from_tables(cal, {broker: rule_rows(*rules)})


def ice_row(**kw):
    return {"deal_id": "1001", "is_cancelled": "N", "market": "SW CR - Edm - Jul26",
            "strip": "Jul26", "local_datetime": "06/03/2026 09:15:22", "qty": "1,000",
            "price": "-3.25", "hub_name": "Edmonton", "trade_index": "WTI CMA", **kw}


def test_ice(raw_rows, calendar_rows, rule_rows):
    ref = make_ref(calendar_rows, rule_rows, "ICE",
                   {"raw_product": "sw cr  – edm", "index_trade_financial": "Trade",
                    "index_group": "SW", "key_id": "PCE"})
    raw = raw_rows(
        "ICE", ice_row(), ice_row(deal_id="2", _modified=EARLY),
        ice_row(deal_id="2", is_cancelled="Y", _modified=LATE),        # newest is cancelled
        ice_row(deal_id="3", parent_fin_assist="FA"), ice_row(deal_id="4", parent_fin_assist=" "),
        ice_row(deal_id="7", spread_parent_id="S"), ice_row(deal_id="6", spread_parent_id="S"),
        ice_row(deal_id="5", spread_parent_id="S", is_cancelled="yes"),
        ice_row(deal_id="8", spread_parent_id=""), ice_row(deal_id="9", strip="Q3 26"),
        ice_row(deal_id="10", market=None, local_datetime="06/20/2026"))
    out = normalize.normalize_ice(raw, ref)
    assert out.schema.simpleString() == TRADE_SCHEMA.simpleString()
    rows = {r.trade_id: r.asDict() for r in out.collect()}
    assert sorted(rows, key=int) == ["4", "6", "8", "9", "10", "1001"]
    assert rows["1001"] == {
        "broker": "ICE", "trade_id": "1001", "exec_datetime": AT, "exec_date": AT.date(),
        "exec_hour": 9, "instrument": "SW CR - Edm", "grade": "PCE", "index_group": "SW",
        "itf": "Trade", "swap_leg_outright": "Outright", "in_index": True, "period": "Jul26",
        "delivery_month": JUL, "price": -3.25, "qty_m3": 1000.0, "unit_raw": "m3",
        "location": "Edmonton", "pipeline": None, "price_basis": "WTI CMA",
        "trade_cycle_start": dt.date(2026, 6, 1), "trade_cycle_end": dt.date(2026, 6, 15),
        "in_trade_cycle": True, "source_file": "a.csv"}
    assert rows["6"]["swap_leg_outright"] == "Leg"
    assert rows["9"]["delivery_month"] is None and rows["9"]["in_trade_cycle"] is None
    last = rows["10"]
    assert last["exec_datetime"] is None and last["exec_date"] == dt.date(2026, 6, 20)
    assert last["in_trade_cycle"] is False and last["in_index"] is False


def test_many_blank_spread_parents_all_stay(raw_rows, calendar_rows, rule_rows):
    ref = make_ref(calendar_rows, rule_rows, "ICE")
    raw = raw_rows("ICE", *[ice_row(deal_id=str(i), spread_parent_id=[None, "", "  "][i % 3])
                            for i in range(60)])
    assert normalize.normalize_ice(raw, ref).count() == 60


def modern_row(**kw):
    return {"trade_number": "1", "state": "Finalized", "credit_facilitation": "FALSE",
            "product": "SW", "price_basis": "WTI CMA",
            "executed_timestamp": "2026-06-03 09:15:22 AM", "term": "JUL-26",
            "trade_type": "Outright", "in_index": "TRUE", "volume": "500", "price": "-3.10",
            "unit_of_measure": "m3", "location": "Edmonton", "pipeline_terminal": "Pembina", **kw}


def test_modern(raw_rows, calendar_rows, rule_rows):
    ref = make_ref(calendar_rows, rule_rows, "Modern",
                   {"raw_product": "SW", "raw_price_basis": "WTI CMA", "index_group": "SW",
                    "index_trade_financial": "Trade"},
                   {"raw_product": "SW", "key_id": "PCE", "index_group": "OTHER"})
    raw = raw_rows("Modern", modern_row(), modern_row(trade_number="2", state="Pending"),
                   modern_row(trade_number="3", credit_facilitation="yes"),
                   modern_row(trade_number="4", credit_facilitation=None, trade_type="First Leg",
                              in_index=None, price_basis="COMM + WTI CMA"),
                   modern_row(trade_number="5", trade_type="Block", state=" FINALIZED"),
                   modern_row(trade_number="6", trade_type="spread"),
                   modern_row(trade_number="7", _modified=EARLY),
                   modern_row(trade_number="7", state="Void", _modified=LATE),
                   modern_row(trade_number="8", state=None))
    out = by(normalize.normalize_modern(raw, ref), "trade_id", "grade", "index_group", "itf",
             "swap_leg_outright", "in_index", "exec_hour", "pipeline")
    assert out == {
        "1": ("PCE", "SW", "Trade", "Outright", True, 9, "Pembina"),
        "4": ("PCE", "OTHER", None, "Leg", False, 9, "Pembina"),
        "5": ("PCE", "SW", "Trade", "Block", True, 9, "Pembina"),
        "6": ("PCE", "SW", "Trade", "Swap", True, 9, "Pembina")}


def neon_row(**kw):
    return {"trade_id": "N-7", "trade_time": "2026-06-03 09:15", "product": "SW",
            "index": "WTI CMA", "location": "Edmonton", "pipeline": "Rainbow",
            "period": "Jul 26", "delivery_start": "2026-07-01", "qty": "300", "price": "-2.95", **kw}


def test_neon(raw_rows, calendar_rows, rule_rows):
    ref = make_ref(calendar_rows, rule_rows, "Neon",
                   {"raw_product": "SW", "raw_index": "WTI CMA", "raw_pipeline": "rainbow",
                    "y_n": "N", "index_trade_financial": "Trade", "index_group": "SW"},
                   {"raw_product": "SW", "raw_index": "WTI CMA", "key_id": "PCE"})
    raw = raw_rows("Neon", neon_row(), neon_row(trade_id="N-8", parent_trade_id="N-9"),
                   neon_row(trade_id="N-9", pipeline="x", period="Q3 26"),
                   neon_row(trade_id=" "), neon_row(trade_id=None, index=" "), neon_row(trade_id=""),
                   neon_row(trade_id="N-7", price="9", _modified=LATE))
    out = normalize.normalize_neon(raw, ref)
    rows = {r.trade_id: r for r in out.collect() if r.trade_id}
    blanks = [r for r in out.collect() if not r.trade_id]
    assert len(blanks) == 3 and all(r.swap_leg_outright == "Outright" for r in blanks)
    assert rows["N-7"].price == 9.0 and rows["N-7"].in_index is False
    assert (rows["N-7"].grade, rows["N-7"].index_group) == ("PCE", "SW")
    assert rows["N-8"].swap_leg_outright == "Leg" and rows["N-9"].swap_leg_outright == "Swap"
    assert rows["N-9"].delivery_month == JUL and rows["N-9"].in_index is True
    assert sorted(r.in_index for r in blanks) == [False, False, False]


def onex_row(**kw):
    return {"trade_id": "900", "exec_date": "2026-06-03", "exec_time": "9:15:22 AM",
            "instrument": "SW Edmonton", "period": "Jul 26", "qty": "400", "unit": "m3",
            "price": "-3.00", "location": "Edmonton", "pipeline": "Rainbow",
            "buyer_pays": "WTI CMA", "buyer_receives": "SW", "cancelled": "N", "sleeved": "N", **kw}


def test_onex(raw_rows, calendar_rows, rule_rows):
    ref = make_ref(calendar_rows, rule_rows, "OneX",
                   {"raw_product": "SW Edmonton", "index_trade_financial": "Trade",
                    "index_group": "SW", "key_id": "PCE", "y_n": "Y"})
    june = "onex_2026-06-01_2026-06-30.csv"
    may = "onex_2026-05-01_2026-05-31.csv"
    raw = raw_rows(
        "OneX", onex_row(price="1", _file=may, _modified=LATE), onex_row(_file=june),
        onex_row(trade_id="901", exec_time=None, swap_trade="Parent"),
        onex_row(trade_id="902", exec_date="46176", exec_time="14:05", swap_trade="leg"),
        onex_row(trade_id="903", cancelled="Y"),
        {}, {"qty": "  "},
        onex_row(trade_id="20", price="5", sleeved="Y"), onex_row(trade_id="3", price="5"),
        onex_row(trade_id="30", price="6", sleeved="Y"), onex_row(trade_id="4", price="6", sleeved="Y"),
        onex_row(trade_id="50", price="7"), onex_row(trade_id="51", price="7"),
        onex_row(trade_id="60", price="8", exec_time=None, sleeved="Y"),
        onex_row(trade_id="61", price="8", exec_time="bad"),
        onex_row(trade_id=None, price="9"), onex_row(trade_id=" ", price="9"))
    out = normalize.normalize_onex(raw, ref)
    rows = {r.trade_id: r for r in out.collect() if r.trade_id}
    assert sorted(rows, key=int) == ["3", "4", "50", "51", "61", "900", "901", "902"]
    assert sum(r.trade_id is None for r in out.collect()) == 2
    assert rows["900"].price == -3.0 and rows["900"].source_file == june
    assert rows["900"].exec_datetime == AT and rows["900"].in_index
    assert rows["901"].exec_datetime == dt.datetime(2026, 6, 3) and rows["901"].exec_hour is None
    assert rows["901"].swap_leg_outright == "Swap" and rows["902"].swap_leg_outright == "Leg"
    assert rows["902"].exec_datetime == dt.datetime(2026, 6, 3, 14, 5)


def test_sleeve_audit_is_the_complement(raw_rows):
    rows = [onex_row(trade_id=str(i) if i % 5 else None, price=str(i % 3),
                     sleeved="Y" if i % 7 == 0 else None, is_financial="Y" if i % 2 else "N")
            for i in range(120)]
    econ = normalize.onex_economics(normalize.latest_onex(raw_rows("OneX", *rows)))
    for financial in (False, True):
        kept = normalize.collapse_sleeves(econ, financial)
        audit = normalize.dropped_sleeves(econ, financial).collect()
        assert kept.count() + len(audit) == econ.count()
        assert all(r.economic_row_count > 1 and r.economic_keep_rank > 1 for r in audit)


def test_sleeve_audit_keeps_no_other_columns(raw_rows, monkeypatch):
    """What is written and moved are the audited columns and those of the order, not the cleaned keys."""
    kept, write = {}, normalize.scratch

    def watched(spark):
        keep = write(spark)

        def run(df, name):
            kept[name] = df.columns
            return keep(df, name)
        return run

    monkeypatch.setattr(normalize, "scratch", watched)
    raw = raw_rows("OneX", *(onex_row(trade_id=str(i), sleeved="Y" if i == 2 else None) for i in range(6)))
    audit = normalize.dropped_sleeves(normalize.onex_economics(normalize.latest_onex(raw)))
    assert by(audit, "trade_id", "economic_keep_rank") == {"1": 2, "3": 3, "4": 4, "5": 5, "2": 6}
    assert not [c for c in kept["copies"] if c.startswith("k_") or c in ("location", "qty_m3", "price_num")]


def test_older_versions(raw_rows):
    neon = raw_rows("Neon", neon_row(trade_id="5"), neon_row(trade_id="5", price="1", _modified=LATE),
                    neon_row(trade_id=" "), neon_row(trade_id=None))
    assert legacy.latest_neon_by_number(neon).count() == 3
    onex = raw_rows("OneX", onex_row(source_sheet="A", price="1"),
                    onex_row(source_sheet="B", price="2"), onex_row(trade_id=None, source_sheet="A"))
    kept = by(legacy.latest_onex_by_sheet(onex), "trade_id", "price")
    assert kept == {"900": "2", None: "-3.00"}


def test_older_ice_kind(spark):
    df = spark.createDataFrame([("1", "wcs spr", "S"), ("2", None, "S"), ("3", None, " ")],
                               "i string, n string, p string")
    assert by(df.select("i", normalize.ice_leg_kind_by_name("p", "n").alias("k")), "i", "k") == {
        "1": "Swap", "2": "Leg", "3": "Outright"}


def test_versions_and_parents_are_found_where_the_rows_lie(spark, raw_rows, calendar_rows, rule_rows):
    """Raw rows are stored by their id; only narrow parent ids and the legs of spreads are shuffled."""
    neon = [{"trade_id": "p", "price": "1"}, {"trade_id": "c", "parent_trade_id": "p", "price": "2"},
            {"trade_id": " ", "price": "3"}, {"trade_id": " ", "price": "4"},
            {"trade_id": "c", "parent_trade_id": "gone", "price": "5", "_modified": LATE}]
    flagged = normalize.latest_with_parents(raw_rows("Neon", *neon))
    assert sorted((r.price, r.is_parent) for r in flagged.collect()) == [("1", False), ("3", False), ("4", False), ("5", False)]
    assert by(normalize.latest_with_parents(raw_rows("Neon", *neon[:4])), "price", "is_parent") == {
        "1": True, "2": False, "3": False, "4": False}
    plan = flagged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "hashpartitioning(__own" not in plan and "hashpartitioning(own_key" not in plan
    ref = make_ref(calendar_rows, rule_rows, "ICE", {"raw_product": "sw cr - edm", "index_trade_financial": "Trade"})
    rows = [ice_row(deal_id="1", price="1"), ice_row(deal_id="1", price="2", is_cancelled="Y", _modified=LATE),
            ice_row(deal_id="2", price="3", is_cancelled="Y"), ice_row(deal_id="2", price="4", _modified=LATE),
            ice_row(deal_id="4", price="6", spread_parent_id="S"), ice_row(deal_id="3", price="5", spread_parent_id="S"),
            ice_row(deal_id="5", price="7")]
    out = normalize.normalize_ice(raw_rows("ICE", *rows), ref)
    assert by(out, "trade_id", "price") == {"2": 4.0, "3": 5.0, "5": 7.0}
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "hashpartitioning(deal_id" not in plan and "__apart" not in plan.split("hashpartitioning(spread_parent_id")[1].split(")")[0]
