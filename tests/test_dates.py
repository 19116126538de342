import datetime as dt

from pyspark.sql import functions as F

from cyclebook.functions import dates
from tests.test_text import check

AT = dt.datetime(2026, 6, 3, 9, 15, 22)
MIN = dt.datetime(2026, 6, 3, 9, 15)
DAY = dt.datetime(2026, 6, 3)


def test_ice(text_table):
    check(text_table("06/03/2026 09:15:22", "06-03-2026 09:15:22", "06/03/2026", "n/a", None),
          dates.ice_local_timestamp("x"),
          {"06/03/2026 09:15:22": AT, "06-03-2026 09:15:22": AT, "06/03/2026": None,
           "n/a": None, None: None})
    check(text_table("06/03/2026", "13/40/2026", "06/03/2026 9"), dates.ice_local_date("x"),
          {"06/03/2026": AT.date(), "13/40/2026": None, "06/03/2026 9": AT.date()})


def test_modern(text_table):
    evening = AT + dt.timedelta(hours=12)
    check(text_table("2026-06-03 09:15:22 AM", "2026-06-03 9:15:22 pm", "2026-06-03 09:15:22",
                     "2026/6/3 09:15", "2026-06-03 12:05:00 AM", "2026-06-03 12:05:00 PM",
                     "2026-06-03", "2026-06-03 14:05:00 PM", "2026-06-03 9:15 AM", "x"),
          dates.modern_timestamp("x"),
          {"2026-06-03 09:15:22 AM": AT, "2026-06-03 9:15:22 pm": evening,
           "2026-06-03 09:15:22": AT, "2026/6/3 09:15": MIN,
           "2026-06-03 12:05:00 AM": dt.datetime(2026, 6, 3, 0, 5),
           "2026-06-03 12:05:00 PM": dt.datetime(2026, 6, 3, 12, 5),
           "2026-06-03": None, "2026-06-03 14:05:00 PM": None, "2026-06-03 9:15 AM": None,
           "x": None})


def test_neon(text_table):
    check(text_table("2026-06-03T09:15:22", "2026-06-03 09:15", "2026-06-03", "2026-02-30",
                     "2026-06-03 09:15:22 AM", "2026-06-03 25:00"),
          dates.neon_timestamp("x"),
          {"2026-06-03T09:15:22": AT, "2026-06-03 09:15": MIN, "2026-06-03": DAY,
           "2026-02-30": None, "2026-06-03 09:15:22 AM": None, "2026-06-03 25:00": None})


def test_permissive(text_table):
    check(text_table("2026-06-03 09:15:22", "06/03/2026 09:15:22 AM", "25/06/2026",
                     "2026-06-03 09:15:22.5", "2026-06-03 09:15"),
          dates.permissive_timestamp("x"),
          {"2026-06-03 09:15:22": AT, "06/03/2026 09:15:22 AM": AT,
           "25/06/2026": dt.datetime(2026, 6, 25),
           "2026-06-03 09:15:22.5": AT.replace(microsecond=500000), "2026-06-03 09:15": None})


def test_onex(text_table):
    check(text_table("2026-06-03", "06/03/2026", "25/06/2026", "46176", "46176.75", "20260603",
                     "6/3/26", "1/2/99", "99999999999", "20269999", "", None),
          dates.onex_date("x"),
          {"2026-06-03": DAY.date(), "06/03/2026": DAY.date(), "25/06/2026": dt.date(2026, 6, 25),
           "46176": DAY.date(), "46176.75": DAY.date(), "20260603": DAY.date(),
           "6/3/26": DAY.date(), "1/2/99": dt.date(1999, 1, 2), "99999999999": None,
           "20269999": None, "": None, None: None})
    june = DAY.date()
    named = {"03-Jun-2026": june, "3 June 2026": june, "Jun 3, 2026": june, "JUNE 3rd 2026": june, "2026-Jun-03": june,
             "2026 jun. 3": june, "3-Jun-26": june, "03jun2026": june, "31-Feb-2026": None, "03-Foo-2026": None,
             "Jun 2026": None, "26-06-03": june, "06/03/68": dt.date(2068, 6, 3), "06/03/69": dt.date(1969, 6, 3),
             "06/03/70": dt.date(1970, 6, 3), "68-06-03": dt.date(2068, 6, 3), "69-06-03": dt.date(1969, 6, 3),
             "25/06/68": dt.date(2068, 6, 25), "25/06/69": dt.date(1969, 6, 25), "1-Jan-69": dt.date(1969, 1, 1)}
    check(text_table(*named), dates.onex_date("x"), named)
    clock = {"9:15:22 AM": (9, 15, 22), "9:15 PM": (21, 15, 0), "14:05:01": (14, 5, 1),
             "14:05": (14, 5, 0), "12:00 AM": (0, 0, 0), "12:30 PM": (12, 30, 0)}
    check(text_table(*clock, "25:00", "13:00 AM", "noon", None), dates.parse_clock("x"),
          {**{k: dt.datetime(1970, 1, 1, *v) for k, v in clock.items()},
           "25:00": None, "13:00 AM": None, "noon": None, None: None})


def test_month_names_in_timestamps(text_table):
    at = {"03-Jun-2026 09:15:22": AT, "Jun 3, 2026 9:15:22 AM": AT, "2026-Jun-03T09:15:22": AT, "3 June 2026": DAY,
          "03-Jun-2026 25:00:00": None, "03-Jun-2026 noon": None}
    check(text_table(*at), dates.permissive_timestamp("x"), at)
    check(text_table("2026-Jun-03 09:15", "26-06-03 09:15:22", "03-Jun-2026 09:15"), dates.neon_timestamp("x"),
          {"2026-Jun-03 09:15": MIN, "26-06-03 09:15:22": AT, "03-Jun-2026 09:15": None})


def test_export_end(text_table):
    check(text_table("onex_2026-06-01_2026-06-30.csv", "onex.csv", "a_2026-06-01_2026-99-30.csv"),
          dates.export_end("x"),
          {"onex_2026-06-01_2026-06-30.csv": dt.date(2026, 6, 30), "onex.csv": None,
           "a_2026-06-01_2026-99-30.csv": None})


def test_session_zone_does_not_matter(spark, text_table):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Edmonton")
        # 02:30 does not exist that day in the zone; the wall clock is kept
        check(text_table("2026-03-08 02:30:00"), dates.neon_timestamp("x"),
              {"2026-03-08 02:30:00": dt.datetime(2026, 3, 8, 2, 30)})
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_shapes_leave_every_layout_to_its_pattern(text_table, monkeypatch):
    """The cheap look at a text's first characters never changes what is parsed."""
    days = ["2026-06-03", "2026/6/3", "2026.06.03", "26-06-03", "69-1-2", "13-1-2", "12-1-2", "06/03/2026", "6.3.2026", "31/12/99",
            "1/2/03", "45000", "45000.5", "20260603", "3-Jun-2026", "Jun 3, 2026", "2026-JUN-3", "", "-", "/2/3", "2026-13-40",
            "2026-6", "1-2", "12345-1-1", "99-99-99", "x2026-06-03", "2026x06x03", "٢٠٢٦-06-03"]
    clocks = ["", " 9:15", " 09:15:22", "T23:59:59.123456", " 12:00 AM", " 12:01:02 pm", "  1:02 PM", " 25:00", " 7", " 9:15x", " 9:15:22\tam"]
    texts = [lead + d + c for d in days for c in clocks for lead in ("", " ", "\u00a0", "\t")]
    table = text_table(None, *texts)

    def parsed():
        orders = ("ymd", "mdy", "dmy")
        columns = [dates.parse_date("x", orders), dates.parse_date("x", ("mdy",)), dates.onex_date("x"), dates.modern_timestamp("x"),
                   dates.neon_timestamp("x"), dates.permissive_timestamp("x"), dates.ice_local_timestamp("x"), dates.ice_local_date("x"),
                   dates.parse_clock("x")]
        return [sorted(map(str, table.select("x", c.alias("c")).collect())) for c in columns]

    looked = parsed()
    monkeypatch.setattr(dates, "_may_fit", lambda c, pattern: F.lit(True))
    assert parsed() == looked


def test_a_text_is_looked_at_once_for_each_order(spark):
    """The cost of a date is a few patterns, however many layouts and clocks are accepted."""
    for column, most in ((dates.parse_date("x", ("ymd", "mdy", "dmy")), 6), (dates.modern_timestamp("x"), 6),
                         (dates.permissive_timestamp("x"), 12), (dates.onex_date("x"), 8)):
        assert str(column).count("regexp_replace(") <= most


def test_years_of_two_digits_and_halves_of_a_day(text_table):
    table = text_table("31/12/68 12:15:01 AM", "1.2.69 12:15:01 pm", "13-1-2 1:15:01 PM", "5 Mar 69 11:59:59 AM", "31-12/32 x")
    at = [str(r["at"]) for r in table.select("x", dates.permissive_timestamp("x").alias("at")).orderBy("x").collect()]
    assert at == ["1969-01-02 12:15:01", "2013-01-02 13:15:01", "None", "2068-12-31 00:15:01", "1969-03-05 11:59:59"]
