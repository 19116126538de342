"""The physical plans that have to hold at scale."""

import pytest

from tests.conftest import SF
from workload.queries import CATALOG


def plan(spark, name):
    return CATALOG[name][0](spark, SF)._jdf.queryExecution().executedPlan().toString()


WRITERS = ("read_csv_exports", "read_landed_sheets", "stored_build")


@pytest.mark.parametrize("name", [n for n in CATALOG if n not in WRITERS])
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert bad not in text


@pytest.mark.parametrize("name", [
    "latest_version", "latest_version_modern", "latest_version_blank_ids", "latest_version_export",
    "spread_collapse"])
def test_versions_are_cut_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert text.count("row_number(), 1, Partial") >= 1


def test_lookups_are_broadcast_and_scans_pruned(spark):
    text = plan(spark, "monthly_index")
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    assert "l_orderkey" not in text and "l_comment" not in text
    assert "partial_sum" in text


def test_flags_push_down_to_a_stored_table(spark, tmp_path):
    from cyclebook.plans.index import broker_share
    from cyclebook.schema import ENRICHED_SCHEMA
    from cyclebook.sources.sinks import read_table, write_grouped

    write_grouped(CATALOG["component_flags"][0](spark, SF), str(tmp_path / "t"), "index_group")
    stored = read_table(spark, str(tmp_path / "t"), ENRICHED_SCHEMA)
    text = broker_share(stored)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(index_group" in text
    assert "EqualTo(is_component_in_cycle,true)" in text
    assert "ReadSchema: struct<broker:string,delivery_month:date,qty_m3:double," in text


def test_reports_read_their_trades_once(spark):
    """Scans are counted in the plan that ran: those behind reused exchanges are not run again."""
    for name in ("seasonality_curve_mean", "seasonality_curve_median", "cycle_seasonality_by_seg", "ohlc_day_star"):
        df = CATALOG[name][0](spark, SF)
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert text.count("FileScan parquet") == 1, name


def test_copies_and_candles_do_not_sort_to_aggregate(spark):
    for name in ("sleeve_collapse", "ohlc_day", "ohlc_equal_instants"):
        assert "SortAggregate" not in plan(spark, name), name
    assert "Window" not in plan(spark, "seasonality_bars_recent").split("HashAggregate")[0]


def test_exports_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    import csv

    from workload import queries

    monkeypatch.setattr(queries, "FILE_ROWS", 10)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        queries.put_export(spark.range(95).repartition(5), str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted((tmp_path / "out").glob("*.csv"))
    rows = [[int(r["id"]) for r in csv.DictReader(f.open())] for f in files]
    assert sorted(map(len, rows)) == [5] + [10] * 9 and sorted(sum(rows, [])) == list(range(95))
    assert len({f.name.split("-")[1] for f in files}) > 1


def test_a_computed_choice_computes_one_item(spark):
    from workload.dialect import SPARK

    row = spark.range(1).selectExpr(SPARK.pick(["upper('a')", "CAST(raise_error('computed') AS STRING)"], "id") + " AS x")
    assert row.first()["x"] == "A"


def test_wide_rows_are_read_in_small_splits(spark):
    from workload import adapters

    key = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(key, "128m")
    adapters.raw_export(spark, SF, "ICE")
    assert spark.conf.get(key) == "8m" and spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
