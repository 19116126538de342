import datetime as dt

import pytest
from pyspark.sql import functions as F

from cyclebook.functions import labels, measures, text
from tests.conftest import by

NBSP = " "


def check(df, expr, expected):
    got = by(df.select("x", expr.alias("y")), "x", "y")
    assert got == expected


def test_squish_and_blank(text_table):
    check(text_table(f" a{NBSP}{NBSP} b\t\n c "), text.squish("x"), {f" a{NBSP}{NBSP} b\t\n c ": "a b c"})
    check(text_table("", "  ", "NA", "na", "x y", None), text.blank_to_na("x"),
          {"": None, "  ": None, "NA": None, "na": None, "x y": "x y", None: None})


def test_key(text_table):
    check(text_table("Sw  Edm", f"sw{NBSP}edm", "Sw – Edm", "  ", "NA", None), text.ukey("x"),
          {"Sw  Edm": "SW EDM", f"sw{NBSP}edm": "SW EDM", "Sw – Edm": "SW - EDM",
           "  ": None, "NA": "NA", None: None})


def test_numbers(text_table):
    good = {"$1,234.50": 1234.5, " 5 ": 5.0, "1e3": 1000.0, "-.5": -0.5, "+7.": 7.0}
    bad = {"": None, "(5)": None, "abc": None, "1d": None, "inf": None, "nan": None,
           "1e999": None, None: None}
    check(text_table(*good, *bad), text.clean_num("x"), {**good, **bad})


def test_flags(text_table):
    check(text_table("t", "Yes", " 1 ", "0", "N", "maybe", "", None), text.parse_bool("x"),
          {"t": True, "Yes": True, " 1 ": True, "0": False, "N": False, "maybe": None,
           "": None, None: None})
    check(text_table(" yes ", "T", None), text.is_yes("x"), {" yes ": True, "T": False, None: False})


JULY = dt.date(2026, 7, 1)


def test_months(text_table):
    good = {k: JULY for k in ("Jul26", "JUL-26", "Jul 26", "jul-2026", "Jul26-Sep26", " jul  26 ")}
    bad = {k: None for k in ("Q3 25", "MARCH 26", "CAL26", "", "26", None)}
    check(text_table(*good, *bad), text.parse_delivery_month("x"), {**good, **bad})


@pytest.mark.parametrize("source, good, bad", [
    ("ICE", ["Jul26", "JUL2026"], ["Jul-26", "Jul 26", "Jul26-Sep26", "Jul026"]),
    ("Modern", ["JUL-26", "Jul-2026"], ["Jul26", "Jul 26"]),
    ("Neon", ["Jul26", "Jul-26", "Jul 2026"], ["xJul26", "Jul 26 x"]),
])
def test_strict_months(text_table, source, good, bad):
    check(text_table(*good, *bad), text.parse_delivery_month("x", strict=source),
          {**{g: JULY for g in good}, **{b: None for b in bad}})


def test_period_words(text_table):
    check(text_table("Jul 26", "July 2026", "jul-26", "Jul 95", "Julio 26", "Q3 25"),
          text.parse_period_words("x"),
          {"Jul 26": JULY, "July 2026": JULY, "jul-26": JULY, "Jul 95": dt.date(1995, 7, 1),
           "Julio 26": None, "Q3 25": None})


def test_market(text_table):
    check(text_table("SW CR - Edm - Jul26", "SW - Edm", "SW-Edm", "A - Jul26-Sep26", None),
          text.market_without_strip("x"),
          {"SW CR - Edm - Jul26": "SW CR - Edm", "SW - Edm": "SW", "SW-Edm": "SW-Edm",
           "A - Jul26-Sep26": "A - Jul26-Sep26", None: None})


def test_index_type(spark):
    rows = [("BI4 COMM", None), ("x", "XAPP"), (None, "comm"), ("1a", ""), (None, None)]
    df = spark.createDataFrame(rows, "i string, p string")
    got = [r[0] for r in df.select(text.derive_index_type("i", "p")).collect()]
    assert got == ["Bi4", "XAPP", "comm", "1a", "other"]


def test_labels(spark):
    df = spark.createDataFrame([(0.125,), (-0.375,), (1.005,), (1234.5,), (-0.001,), (None,)],
                               "x double")
    assert [r[0] for r in df.select(labels.fmt_diff("x")).collect()] == [
        "+0.12", "-0.38", "+1.00", "+1234.50", "-0.00", "—"]
    assert [r[0] for r in df.select(labels.fmt_int("x")).collect()][3] == "1,234"
    assert [r[0] for r in df.select(labels.fmt_m3("x")).collect()] == [
        "0 m³", "0 m³", "1 m³", "1,234 m³", "0 m³", "—"]
    days = spark.sql("select explode(sequence(date'2026-06-01', date'2026-06-07')) d")
    got = days.select(labels.weekday_label("d"), labels.weekday_number("d")).collect()
    assert [tuple(r) for r in got] == list(zip("Mon Tue Wed Thu Fri Sat Sun".split(), range(1, 8)))
    one = spark.range(1).select(
        labels.fmt_tod(F.lit(599)).alias("t"), labels.weekday_label(F.lit(None).cast("date")).alias("n"),
        labels.month_label(F.lit("2026-07-01").cast("date")).alias("m")).first()
    assert tuple(one) == ("09:59", None, "Jul 2026")
    months = spark.sql("select explode(sequence(date'2026-01-01', date'2026-12-01', interval 1 month)) d")
    assert [r[0] for r in months.select(labels.season_of("d")).collect()] == (
        ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"])


def test_measures(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 0.0)], "p double, q double")
    assert df.agg(measures.vwap("p", "q")).first()[0] is None
    assert df.limit(0).agg(measures.vwap("p", "q")).first()[0] is None
    units = spark.createDataFrame(
        [("M3",), ("m³ / month",), ("bbl/day",), ("BBL",), ("t",)], "u string")
    got = [r[0] for r in units.select(measures.volume_bbl(
        F.lit(10.0), "u", F.lit("2026-02-01").cast("date"))).collect()]
    assert got == [62.8981077, 62.8981077, 280.0, 10.0, None]
    labels_ = spark.createDataFrame([("Financial", "X"), ("Trade", "ICE WTI"), ("Trade", None)],
                                    "i string, k string")
    assert [r[0] for r in labels_.select(measures.neon_unit_label("i", "k")).collect()] == [
        "contracts/month", "contracts/month", "m3/day"]


def test_buckets(spark):
    df = spark.sql("select explode(array(timestamp_ntz'2026-06-03 09:59:59',"
                   " timestamp_ntz'2026-06-03 10:00:00', timestamp_ntz'2026-06-03 00:00:00',"
                   " timestamp_ntz'2026-06-03 23:59:00')) t")
    expected = {1: [599, 600, 0, 1439], 5: [595, 600, 0, 1435], 15: [585, 600, 0, 1425],
                30: [570, 600, 0, 1410], 60: [540, 600, 0, 1380]}
    for minutes, values in expected.items():
        assert [r[0] for r in df.select(measures.minute_of_day("t", minutes)).collect()] == values
    half = [r[0] for r in df.select(measures.time_bucket("t", 30)).collect()]
    assert half[0] == dt.datetime(2026, 6, 3, 9, 30) and half[3] == dt.datetime(2026, 6, 3, 23, 30)
    assert {r[0] for r in df.select(measures.time_bucket("t", "day")).collect()} == {
        dt.datetime(2026, 6, 3)}
    bins = spark.createDataFrame([(25.0,), (35.0,), (36.0,)], "p double")
    assert [r[0] for r in bins.select(measures.percent_bin("p", 10)).collect()] == [20.0, 40.0, 40.0]
