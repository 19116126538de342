import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cyclebook.operators import calendar, ranking, rules, series
from tests.conftest import by

D = dt.date


def test_keep_first_keeps_exempt_rows(spark):
    df = spark.createDataFrame(
        [("a", 2), ("a", 1), ("b", 5), (None, 1), (None, 2), ("", 3), ("", 4)], "k string, v int")
    blank = F.coalesce("k", F.lit("")) == ""
    kept = ranking.keep_first(df, ["k"], [F.col("v").asc()], blank, ["v"])
    assert sorted((r.k or "", r.v) for r in kept.collect()) == [
        ("", 1), ("", 2), ("", 3), ("", 4), ("a", 1), ("b", 5)]
    assert kept.columns == ["k", "v"]
    again = ranking.keep_first(kept, ["k"], [F.col("v").asc()], blank, ["v"])
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, kept.collect()), key=str)


def test_collapse_copies(spark):
    rows = [("x", None, False, 1), ("x", None, True, 2),      # null keys equal: plain stays
            ("y", 1, True, 9), ("y", 1, True, 4),             # two sleeved: lowest id
            ("z", 1, False, 1), ("z", 1, False, 2),           # two plain: both
            ("w", 1, True, 7),                                # single sleeved
            ("v", 1, False, 3), ("v", 1, False, 1), ("v", 1, True, 0)]  # lowest plain only
    df = spark.createDataFrame(rows, "a string, b int, s boolean, id int")
    kept = ranking.collapse_copies(df, ["a", "b"], "s", [F.col("s"), F.col("id")])
    assert sorted((r.a, r.id) for r in kept.collect()) == [
        ("v", 1), ("w", 7), ("x", 1), ("y", 4), ("z", 1), ("z", 2)]


def test_rank_within_equals_window(spark, keep):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "a", "a", "b", None, f"k{i}"]), rng.randrange(9), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, v int, t int").repartition(7)
    got = ranking.rank_within(df, ["k"], [F.col("v").desc(), F.col("t")], "rn", "n", keep)
    w = Window.partitionBy("k")
    want = df.withColumns({"rn": F.row_number().over(w.orderBy(F.col("v").desc(), "t")).cast("long"), "n": F.count("*").over(w)})
    assert sorted(map(str, got.select("k", "v", "t", "rn", "n").collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("most, joins", [(1, "SortMergeJoin"), (2, "BroadcastHashJoin")])
def test_few_keys_are_ranked_without_a_shuffle(spark, keep, monkeypatch, most, joins):
    monkeypatch.setattr(ranking, "MAX_MARKS", most)
    df = spark.createDataFrame([(i % 2, i) for i in range(20)], "k int, v int")
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = ranking.rank_within(df, ["k"], [F.col("v")], "rn", "n", keep)
        plan = got._jdf.queryExecution().sparkPlan().toString()
        assert {(r["v"], r["rn"], r["n"]) for r in got.collect()} == {(i, i // 2 + 1, 10) for i in range(20)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    assert ("SortMergeJoin" in plan) == (joins == "SortMergeJoin")


def test_numbered_is_one_sort_over_all_rows(spark, keep):
    df = spark.range(10_000).selectExpr("id * 7919 % 10007 AS v").repartition(9)
    rows = ranking.numbered(df, [F.col("v").desc()], "at", keep).orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(10_000))
    assert all(a.v > b.v for a, b in zip(rows, rows[1:]))


def test_key_hash_tells_nulls_and_places_apart(spark):
    values = [None, "", "a", "b", "ab", "\u0000"]
    df = spark.createDataFrame([(x, y, z) for x in values for y in values for z in (None, 0.0, 1.5)], "x string, y string, z double")
    for part in ranking.key_hash(["x", "y", "z"]).values():
        assert df.select(part).distinct().count() == df.count()
    signed = spark.createDataFrame([(0.0,), (-0.0,)], "z double")
    assert signed.select(*ranking.key_hash(["z"]).values()).distinct().count() == 1


@pytest.mark.parametrize("most, hint", [(500_000, "BroadcastHashJoin"), (10, "ShuffledHashJoin")])
def test_marks_are_broadcast_up_to_a_bound(spark, monkeypatch, most, hint):
    monkeypatch.setattr(ranking, "MAX_MARKS", most)
    df, marks = spark.range(2000).withColumnRenamed("id", "k"), spark.range(0, 2000, 40).withColumnRenamed("id", "k")
    out = ranking.mark_rows(df, ["k"], marks, "hit", True)
    assert hint in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.k for r in out.filter("hit").collect()) == list(range(0, 2000, 40)) and out.count() == 2000


def test_interval_flag(spark):
    df = spark.createDataFrame(
        [(1, D(2026, 6, 1), D(2026, 6, 1), D(2026, 6, 15)),
         (2, D(2026, 6, 15), D(2026, 6, 1), D(2026, 6, 15)),
         (3, D(2026, 6, 16), D(2026, 6, 1), D(2026, 6, 15)),
         (4, None, D(2026, 6, 1), D(2026, 6, 15)),
         (5, D(2026, 6, 16), None, D(2026, 6, 15))], "i int, d date, s date, e date")
    assert by(df.select("i", calendar.interval_flag("d", "s", "e").alias("f")), "i", "f") == {
        1: True, 2: True, 3: False, 4: None, 5: None}


def test_calendar_first_row_wins(calendar_rows):
    cal = calendar.prepare_calendar(calendar_rows(
        ("2026-07-01", "2026-06-01", "2026-06-15"), ("2026-07-01", "2026-06-02", "2026-06-16"),
        (None, "2026-06-02", "2026-06-16"), ("2026-08-01", "bad", None)))
    assert by(cal, "delivery_month", "trade_cycle_start", "trade_cycle_end") == {
        D(2026, 7, 1): (D(2026, 6, 1), D(2026, 6, 15)), D(2026, 8, 1): (None, None)}


def trades(spark, *rows):
    return spark.createDataFrame(rows, "id int, delivery_month date, exec_date date")


def test_backfill(spark, calendar_rows):
    # close days 14 and 15: median 14.5, half-even 14
    cal = calendar.prepare_calendar(calendar_rows(
        ("2026-07-01", "2026-06-01", "2026-06-14"), ("2026-08-01", "2026-07-01", "2026-07-15"),
        ("2026-09-01", None, None)))
    df = calendar.attach_trade_cycle(trades(
        spark, (1, D(2026, 7, 1), D(2026, 6, 14)), (2, D(2024, 3, 1), D(2024, 2, 14)),
        (3, D(2024, 3, 1), D(2024, 2, 15)), (4, D(2024, 5, 1), D(2024, 4, 20)),
        (5, D(2026, 9, 1), D(2026, 8, 3)), (6, None, D(2024, 2, 3)), (7, D(2024, 3, 1), None)), cal)
    filled = by(calendar.backfill_trade_cycle(df, cal), "id", "trade_cycle_start",
                "trade_cycle_end", "in_trade_cycle")
    feb = (D(2024, 2, 1), D(2024, 2, 14))
    assert filled == {1: (D(2026, 6, 1), D(2026, 6, 14), True), 2: (*feb, True), 3: (*feb, False),
                      4: (None, None, None), 5: (None, None, None), 6: (None, None, None),
                      7: (*feb, None)}


def test_backfill_default_close_day(spark, calendar_rows):
    cal = calendar.prepare_calendar(calendar_rows(("2026-07-01", None, None)))
    df = calendar.attach_trade_cycle(trades(spark, (1, D(2024, 3, 1), D(2024, 2, 15))), cal)
    row = calendar.backfill_trade_cycle(df, cal).first()
    assert row.trade_cycle_end == D(2024, 2, 15) and row.in_trade_cycle


def test_rules_active_and_priority(rule_rows):
    prepared = rules.prepare_rules(rule_rows(
        {"raw_product": "A", "active": "", "rule_priority": "2", "key_id": "two"},
        {"raw_product": "a ", "active": "yes", "rule_priority": "1", "key_id": "one"},
        {"raw_product": "B", "active": "N", "key_id": "off"},
        {"raw_product": "C", "active": "maybe", "key_id": "off"},
        {"raw_product": "D", "active": None, "rule_priority": "x", "key_id": "NA"},
        {"raw_product": "D", "active": "TRUE", "key_id": "later"},
        {"raw_product": " ", "active": "TRUE", "key_id": "no product"}))
    best = rules.tier_table(prepared, ["raw_product_key"], [], "t")
    assert by(best, "t_raw_product_key", "t_key_id") == {"A": "one", "D": None}
    assert by(prepared, "raw_product_key", "rule_priority")["D"] == 999999.0


def test_tiers_coalesce_per_column(spark, rule_rows):
    table = rules.neon_rules(rules.prepare_rules(rule_rows(
        {"raw_product": "SW", "raw_index": "WTI", "raw_pipeline": "P", "index_trade_financial": "Trade"},
        {"raw_product": "SW", "raw_price_basis": "WTI", "key_id": "K3", "index_group": "SW"},
        {"raw_product": "SW", "key_id": "K4", "y_n": "N"})))
    df = spark.createDataFrame(
        [("SW", "WTI", None, "P"), ("SW", "X", None, "P"), ("Z", None, None, None)],
        "product_key string, index_key string, location_key string, pipeline_key string")
    got = [tuple(r) for r in rules.match_tiers(df, table, rules.NEON_TIERS).orderBy(
        "product_key", "index_key").select("r_itf", "r_index_group", "r_key_id", "r_y_n").collect()]
    assert got == [("Trade", "SW", "K3", "N"), (None, None, "K4", "N"), (None, None, None, None)]
    plan = rules.match_tiers(df, table, rules.NEON_TIERS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


def test_complete_within(spark):
    df = spark.createDataFrame(
        [("m1", 1, "a", 5.0), ("m1", 2, "b", 6.0), ("m2", 1, "a", 7.0)], "m string, d int, s string, v double")
    got = sorted(map(tuple, series.complete_within(df, "m", "d", "s", "v").collect()))
    assert got == [("m1", 1, "a", 5.0), ("m1", 1, "b", 0.0), ("m1", 2, "a", 0.0),
                   ("m1", 2, "b", 6.0), ("m2", 1, "a", 7.0)]


def test_interpolation_matches_numpy(spark):
    rng = random.Random(3)
    data, rows = {}, []
    for part in range(12):
        n = rng.randrange(1, 9)
        xs = sorted(rng.sample(range(0, 41), n))
        xs = [x * 2.5 if part % 2 else x / 3 for x in xs]
        data[part] = [(x, rng.uniform(-5, 5)) for x in xs]
        rows += [(part, x, y) for x, y in data[part]]
    df = spark.createDataFrame(rows, "p int, a double, b double")
    got = series.interpolate_to_grid(df, "p", "a", "b", F.lit(0), F.lit(100), 2.5).collect()
    grid = np.arange(0, 100.1, 2.5)
    for part, points in data.items():
        mine = sorted((r.x, r.y) for r in got if r.p == part)
        if len(points) < 2:
            assert mine == []
            continue
        want = np.interp(grid, *zip(*points))
        assert [x for x, _ in mine] == list(grid)
        assert np.allclose([y for _, y in mine], want)


def test_hot_key_with_a_third_of_the_rows(spark, keep):
    """One key, and one group of copies, holds a third of the rows."""
    n = 60_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id",
        (F.col("id") % 30 == 0).alias("s"), (n - F.col("id")).cast("double").alias("v"))
    newest = ranking.keep_first(df, ["k"], [F.col("id").desc()])
    assert newest.count() == 1 + n * 2 // 3
    assert newest.filter("k = 0").first().id == n - 3

    single = ranking.collapse_copies(df, ["k"], "s", [F.col("s"), F.col("v")], keep)
    assert single.count() == 1 + n * 2 // 3
    assert single.filter("k = 0").first().id == n - 3

    ranks = ranking.rank_within(df, ["k"], [F.col("s"), F.col("v"), F.col("id")], "rn", "n", keep).filter("k = 0")
    facts = ranks.agg(F.count("rn"), F.countDistinct("rn"), F.min("rn"), F.max("rn")).first()
    assert tuple(facts) == (n // 3, n // 3, 1, n // 3)
    last = ranks.orderBy(F.col("rn").desc()).first()
    assert (last.s, last.id) == (True, 0)


def test_copies_are_split_without_sorting_the_rest(spark):
    df = spark.range(20_000).selectExpr(
        "IF(id % 3 > 0, 'hot', 'k' || id) AS k", "CAST(id AS STRING) AS v", "id = 4 OR id % 3000 = 0 AS s")
    out = ranking.collapse_copies(df, ["k"], "s", [F.col("s"), F.col("v")])
    rows = out.collect()
    assert sum(r.k == "hot" for r in rows) == 1
    assert len(rows) == 1 + df.filter("k != 'hot'").count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan


def test_estimates_need_first_days(spark, calendar_rows):
    rows = spark.sql("SELECT DATE '2026-07-02' AS delivery_month, DATE '2026-06-03' AS exec_date, CAST(NULL AS DATE) AS"
                     " trade_cycle_start, CAST(NULL AS DATE) AS trade_cycle_end, FALSE AS in_trade_cycle")
    cal = calendar.prepare_calendar(calendar_rows(("2026-08-01", "2026-07-01", "2026-07-15")))
    with pytest.raises(Exception, match="no first of a month"):
        calendar.backfill_trade_cycle(rows, cal).collect()


def test_stored_rows_are_chosen_without_a_shuffle(spark, tmp_path, monkeypatch):
    from cyclebook.sources import sinks
    rows = [(k, n, i) for i, (k, n) in enumerate([("a", 1), ("a", 2), (None, 1), (None, 3), ("", 1), ("", 2), ("b", 1), ("b", 5),
                                                  ("b", 4), ("c", None)])]
    df = spark.createDataFrame(rows, "k string, n int, at int")
    blank, order = F.coalesce(F.col("k") == "", F.lit(False)), [F.col("n").desc_nulls_last()]
    want = {tuple(r) for r in ranking.keep_first(df, ["k"], order, blank, ["at"]).select(*df.columns).collect()}

    def keep_by(table, name, key, buckets):
        return sinks.stage_by(table, name, str(tmp_path), key, buckets)

    for hot in (10, 2, 1):  # with 1, null, "a" and "b" are hot
        monkeypatch.setattr(ranking, "HOT_ROWS", hot)
        got = ranking.keep_first_stored(df, "k", order, keep_by, 3, blank, F.concat(F.lit("\u0000"), F.col("at")))
        assert sorted(map(str, (tuple(r) for r in got.select(*df.columns).collect()))) == sorted(map(str, want)), hot
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("Exchange" in plan) == (hot < 3), hot
        assert ("row_number(), 1, Partial" in plan) == (hot < 3) and "SelectedBucketsCount: 3 out of 3" in plan
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("versions_")]


def test_files_are_ranked_without_moving_rows(spark):
    from cyclebook.operators.ordinal import with_row_order
    df = spark.createDataFrame([(f"f{i % 3}", dt.datetime(2026, 6, 1 + i % 3), 0, i) for i in range(9)],
                               "source_file string, source_file_modified timestamp, source_block long, source_row long")
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = with_row_order(df)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
