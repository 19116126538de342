import datetime as dt
import gzip
import os
import re
import warnings

import pytest

from cyclebook.operators.rules import ONE_TIER, match_tiers
from cyclebook.plans import dataset, store, views
from cyclebook.schema import ENRICHED_SCHEMA, TRADE_SCHEMA
from cyclebook.sources import conform, files, lines, reference, sinks
from tests.test_normalize import ice_row, onex_row


def put(path, text, modified=None, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)
    if modified:
        os.utime(path, (modified, modified))


def test_clean_names():
    assert conform.clean_names(["Deal ID", "dealId", "Trade #", "% Done", "", "1st", "Qty (m³)"]) == [
        "deal_id", "deal_id_2", "trade_number", "percent_done", "x", "x1st", "qty_m"]


def test_aliases_and_missing(spark):
    df = conform.rename_aliases(spark.createDataFrame([("1",)], "gtcs string"))
    df = conform.add_missing_cols(df, ["gtc_s", "other"])
    assert df.columns == ["gtc_s", "other"] and tuple(df.first()) == ("1", None)


def test_csv_folder_aligns_by_name(spark, tmp_path):
    put(tmp_path / "a.csv", "Deal ID,Qty,Price\n1,\"1,000\",-3.25\n2, NA ,\n", 1_700_000_000)
    put(tmp_path / "b file.CSV", "﻿Price,Extra,Deal ID\n9,x,3\n", 1_700_000_100)
    put(tmp_path / "notes.txt", "ignored\n")
    df = files.read_csv_folder(spark, str(tmp_path))
    rows = {r.deal_id: r for r in df.collect()}
    assert rows["1"].qty == "1,000" and rows["1"].price == "-3.25" and rows["1"].extra is None
    assert rows["2"].qty is None and rows["2"].price is None
    assert rows["3"].price == "9" and rows["3"].extra == "x" and rows["3"].qty is None
    assert rows["1"].source_file == "a.csv" and rows["3"].source_file == "b file.CSV"
    assert rows["3"].source_file_modified > rows["1"].source_file_modified
    assert [f.dataType.simpleString() for f in df.schema.fields if f.name in
            ("deal_id", "qty", "price", "extra")] == ["string"] * 4


def test_unreadable_and_missing_files(spark, tmp_path):
    put(tmp_path / "good.csv", "a\n1\n")
    put(tmp_path / "empty.csv", "")
    (tmp_path / "bad.csv").write_bytes(gzip.compress(b"a\n1\n"))
    with pytest.raises(files.UnreadableExport, match="bad.csv"):
        files.read_csv_folder(spark, str(tmp_path))
    with pytest.warns(UserWarning, match="Skipping"):
        df = files.read_csv_folder(spark, str(tmp_path), skip_unreadable=True)
    assert [r.a for r in df.collect()] == ["1"]
    skipped = {r.path.rpartition("/")[2]: r.reason for r in files.skipped_files(spark, str(tmp_path)).collect()}
    assert skipped == {"bad.csv": "no header"}
    with pytest.warns(UserWarning, match="not found"):
        assert files.read_csv_folder(spark, str(tmp_path / "none")) is None
    with pytest.warns(UserWarning, match="not found"):
        assert files.read_parquet_folder(spark, str(tmp_path / "none")) is None


def test_damaged_parquet_fails_loudly(spark, tmp_path):
    folder = tmp_path / "p"
    spark.createDataFrame([("1",)], "a string").coalesce(1).write.parquet(str(folder))
    (folder / "bad.parquet").write_bytes(b"PAR1 this is no table PAR1")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        files.read_parquet_folder(spark, str(folder)).collect()


def test_headers_are_read_without_python_or_paths(spark, tmp_path):
    for i in range(4):
        put(tmp_path / f"{i}.csv", f"gtcs,x\n{i},a\n")
    df = files.read_csv_folder(spark, str(tmp_path))
    assert df.columns[:2] == ["gtc_s", "x"] and df.count() == 4       # alias of an older header
    plan = lines.survey(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "SortAggregate" not in plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "Join" not in plan


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_three_headers_and_a_blank_first_line_are_one_scan(spark, tmp_path):
    put(tmp_path / "a.csv", "Deal ID,Qty\n1,10\n")
    put(tmp_path / "b.csv", "\n \nQty,Deal ID,Note\n20,2,\"x, \"\"y\"\"\"\n")
    put(tmp_path / "c.csv", "﻿gtcs,Deal ID\nq,3\n\n r ,4\n")
    df = files.read_csv_folder(spark, str(tmp_path))
    rows = sorted((r.deal_id, r.qty, r.note, r.gtc_s, r.source_file) for r in df.collect())
    assert rows == [("1", "10", None, None, "a.csv"), ("2", "20", 'x, "y"', None, "b.csv"),
                    ("3", None, None, "q", "c.csv"), ("4", None, None, "r", "c.csv")]
    plan = plan_of(files.read_csv_folder(spark, str(tmp_path)))
    assert plan.count("FileScan text") == 1 and plan.count("from_csv") == 1 and plan.count("BroadcastHashJoin") == 1
    assert "Exchange hash" not in plan and "Python" not in plan


def test_a_folder_of_very_many_files_keeps_its_survey_on_the_executors(spark, tmp_path, monkeypatch):
    for i in range(4):
        put(tmp_path / f"{i}.csv", f"{'a,b' if i % 2 else 'b,a'}\n{i},x\n")
    monkeypatch.setattr(lines, "MAX_MAPPED_FILES", 3)
    df = files.read_csv_folder(spark, str(tmp_path))
    assert sorted((r.a, r.b) for r in df.collect()) == [("1", "x"), ("3", "x"), ("x", "0"), ("x", "2")]
    assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()


RAGGED = ("Deal ID,Qty,Note\n1,2,a\n2,3\n3,4,b,c\n\n4,5,\"open\n5,\"6,6\",d\n6,7\" pipe,e\nDeal ID,Qty,Note\n"
          "7,8,\"a\"b\n8,9,\n")


def test_malformed_lines_are_listed_with_file_and_number(spark, tmp_path):
    put(tmp_path / "r.csv", RAGGED)
    put(tmp_path / "good.csv", "x\n1\n2\n")
    got = sorted(map(tuple, lines.rejected_lines(spark, str(tmp_path)).collect()))
    assert got == [("r.csv", 3, "too few fields", "2,3"), ("r.csv", 4, "too many fields", "3,4,b,c"),
                   ("r.csv", 6, "broken quote", '4,5,"open'), ("r.csv", 9, "repeated header", "Deal ID,Qty,Note"),
                   ("r.csv", 10, "broken quote", '7,8,"a"b')]
    counts = {r.source_file: r[1:] for r in files.reject_counts(spark, str(tmp_path)).collect()}
    assert counts == {"r.csv": (9, 1, 1, 2), "good.csv": (2, 0, 0, 0)}


def test_too_many_malformed_lines_are_an_error(spark, tmp_path):
    put(tmp_path / "r.csv", RAGGED)
    with pytest.raises(lines.MalformedExport, match="4 of 9 lines"):
        files.read_csv_folder(spark, str(tmp_path))
    kept = files.read_csv_folder(spark, str(tmp_path), max_rejects=0.5)
    rows = {r.deal_id: (r.qty, r.note) for r in kept.collect()}
    assert rows["2"] == ("3", None) and rows["3"] == ("4", "b") and rows["5"] == ("6,6", "d") and len(rows) == 8
    assert rows["6"] == ('7" pipe', "e") and rows["8"] == ("9", None)
    whole = files.read_csv_folder(spark, str(tmp_path), max_rejects=None, keep_rejects=False)
    assert sorted(r.deal_id for r in whole.collect()) == ["1", "5", "6", "8"]


def test_line_numbers_in_files_of_several_blocks(spark, tmp_path):
    text = "id,v\n" + "".join(f"{i},{'x' * (i % 50)}\n" if i % 40 else f"{i}\n" for i in range(1, 2001))
    put(tmp_path / "big.csv", text)
    put(tmp_path / "other.csv", text)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        got = lines.rejected_lines(spark, str(tmp_path)).collect()
        assert lines.raw_lines(spark, str(tmp_path)).select("block").distinct().count() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert sorted((r.source_file, r.line_number, r.line) for r in got) == sorted(
        (f, i + 1, str(i)) for f in ("big.csv", "other.csv") for i in range(40, 2001, 40))


def test_rejects_take_one_scan_besides_the_count_of_blocks(spark, tmp_path):
    put(tmp_path / "r.csv", RAGGED)
    put(tmp_path / "b.csv", "\n \nid,v\n1,2\nid,v\n\n3\nid,v\n")
    put(tmp_path / "c.csv", "id,v\n1,2\n")
    got = lines.rejected_lines(spark, str(tmp_path))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation ?\[.*\] text", plan)) == 2
    rows = sorted(tuple(r) for r in got.collect() if r.source_file != "r.csv")
    assert rows == [("b.csv", 5, "repeated header", "id,v"), ("b.csv", 7, "too few fields", "3"),
                    ("b.csv", 8, "repeated header", "id,v")]


def test_latin_letters_of_other_encodings(spark, tmp_path):
    put(tmp_path / "l.csv", "Name,Ort\nJürgen,Zürich\n", encoding="latin-1")
    put(tmp_path / "u.csv", "Name,Ort\nRené,Genève\n")
    rows = sorted((r.name, r.ort) for r in files.read_csv_folder(spark, str(tmp_path)).collect())
    assert rows == [("Jürgen", "Zürich"), ("René", "Genève")]


def test_quoted_line_breaks(spark, tmp_path):
    put(tmp_path / "a.csv", 'a,b\n1,"x\ny"\n')
    put(tmp_path / "b.csv", "b,a\n2,3\n")
    rows = sorted((r.a, r.b) for r in files.read_csv_folder(spark, str(tmp_path), multi_line=True).collect())
    assert rows == [("1", "x\ny"), ("3", "2")]


def test_all_sheets_of_a_source(spark, tmp_path):
    put(tmp_path / "b" / "x.csv", "a\n0\n")
    put(tmp_path / "b" / "First" / "x.csv", "a\n1\n")
    put(tmp_path / "b" / "Second Sheet" / "x.csv", "b,a\n7,2\n")
    rows = files.read_sheets(spark, str(tmp_path / "b")).collect()
    assert sorted((r.source_sheet, r.a, r.b) for r in rows) == [
        ("", "0", None), ("First", "1", None), ("Second Sheet", "2", "7")]


def test_inventory(spark, tmp_path):
    put(tmp_path / "ICE" / "a.csv", "a\n")
    put(tmp_path / "ICE" / "b.XLSX", "x")
    put(tmp_path / "ICE" / "c.txt", "x")
    put(tmp_path / "OneX" / "d.xls", "x")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        found = files.source_inventory(spark, str(tmp_path))
    assert sorted((r.broker, r.file_name) for r in found.collect()) == [
        ("ICE", "a.csv"), ("ICE", "b.XLSX"), ("OneX", "d.xls")]
    assert [(r.broker, r.files) for r in files.inventory_counts(found).collect()] == [
        ("ICE", 2), ("OneX", 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_preferred_sheet_and_parquet(spark, tmp_path):
    put(tmp_path / "m" / "x.csv", "a\nfirst\n")
    put(tmp_path / "m" / "Trade Report" / "x.csv", "a\nreport\n")
    folder = str(tmp_path / "m")
    assert [r.a for r in files.read_source(spark, folder, "Trade Report").collect()] == ["report"]
    put(tmp_path / "m" / "root.csv", "a\nalone\n")             # a file without that sheet
    assert sorted(r.a for r in files.read_source(spark, folder, "Trade Report").collect()) == ["alone", "report"]
    (tmp_path / "m" / "root.csv").unlink()
    assert files.read_source(spark, folder, "Trades").first().a == "first"
    spark.createDataFrame([(7, " "), (8, " NA ")], "`Trade ID` int, x string").write.parquet(
        str(tmp_path / "p"))
    rows = files.read_source(spark, str(tmp_path / "p"), fmt="parquet").orderBy("trade_id").collect()
    assert [(r.trade_id, r.x) for r in rows] == [("7", None), ("8", "NA")]


def test_blank_rows_union_and_schema(spark):
    df = spark.createDataFrame([(" ", None, "f"), ("a", None, "f")],
                               "x string, y string, source_file string")
    assert conform.drop_blank_rows(df).count() == 1
    sheets = conform.read_all_sheets({"s1": df.select("x"), "s2": df.select("y", "x")})
    assert sorted(sheets.columns) == ["source_sheet", "x", "y"] and sheets.count() == 4
    odd = spark.createDataFrame([("x", "2026-01-01")], "price string, exec_date string")
    typed = conform.coerce_schema(conform.add_missing_cols(odd, TRADE_SCHEMA.fieldNames()))
    assert typed.schema == TRADE_SCHEMA
    assert typed.first().price is None and typed.first().exec_date == dt.date(2026, 1, 1)
    assert conform.empty_table(spark).schema == TRADE_SCHEMA


def write_reference(folder):
    put(folder / "TC_Dates.csv", "Delivery Month,Trade Cycle Start,Trade Cycle End,Period Label\n"
        "2026-07-01,2026-06-01,2026-06-15,Jul\n,,,\n2026-07-01,2026-01-01,2026-01-02,dup\n")
    header = "Raw Product,Y N,Index Trade Financial,Index Group,Key ID,Rule Priority,Active\n"
    put(folder / "ICE_Rules.csv", header + "SW CR - Edm,,Trade,sw,PCE,,TRUE\n")
    put(folder / "OneX_Rules.csv", header + "SW Edmonton,Y,Trade,SW,PCE,1,\n")
    for name in ("Modern_Rules", "Marex_Rules"):
        put(folder / f"{name}.csv", header + "none,,,,,,\n")


def test_load_reference_is_broadcast(spark, tmp_path):
    write_reference(tmp_path)
    ref = reference.load_reference(spark, str(tmp_path))
    assert [tuple(r) for r in ref.calendar.select("delivery_month", "period_label").collect()] == [
        (dt.date(2026, 7, 1), "Jul")]
    big = spark.createDataFrame([("SW CR - EDM",), ("x",)], "product_key string")
    joined = match_tiers(big, ref.rules["ICE"], ONE_TIER)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
        long = reference.size_checked(spark.range(50).withColumnRenamed("id", "k"), max_bytes=399)
        other = spark.range(5).withColumnRenamed("id", "k").join(long, "k")
        assert "Broadcast" not in other._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert {r.product_key: r.r_key_id for r in joined.collect()} == {"SW CR - EDM": "PCE", "x": None}


def csv_text(rows):
    names = list(dict.fromkeys(k for r in rows for k in r))
    lines = [",".join(names)]
    for r in rows:
        lines.append(",".join('"' + (r.get(n) or "") + '"' for n in names))
    return "\n".join(lines) + "\n"


def test_build_cache_and_exports(spark, tmp_path):
    data, lookup, cache = tmp_path / "data", tmp_path / "ref", str(tmp_path / "cache")
    write_reference(lookup)
    put(data / "ICE" / "old.csv", csv_text([ice_row(deal_id="1", price="1"), ice_row(deal_id="2")]),
        1_700_000_000)
    put(data / "ICE" / "new.csv", csv_text([ice_row(deal_id="1", price="2"),
                                            ice_row(deal_id="3", strip="Q3 26")]), 1_700_000_100)
    put(data / "OneX" / "onex_2026-06-01_2026-06-30.csv", csv_text([onex_row(exec_date="2025-05-03", period="Jun 25")]))
    ref = reference.load_reference(spark, str(lookup))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        built = dataset.load_combined(spark, str(data), ref, cache)
    assert built.schema.simpleString() == ENRICHED_SCHEMA.simpleString()
    rows = {(r.broker, r.trade_id): r for r in built.collect()}
    assert len(rows) == 4
    assert rows["ICE", "1"].price == 2.0 and rows["ICE", "1"].source_file == "new.csv"
    assert rows["ICE", "1"].index_group == "SW" and rows["ICE", "1"].is_component_in_cycle
    assert rows["ICE", "1"].exec_dow == "Wed" and rows["ICE", "1"].qty_bbl == 6289.81077
    june = rows["OneX", "900"]                       # window estimated from the close day
    assert (june.trade_cycle_start, june.trade_cycle_end) == (dt.date(2025, 5, 1), dt.date(2025, 5, 15))
    coverage = store.report(spark, cache, "qa_coverage")
    assert [(r.broker, r.rows) for r in coverage.orderBy("broker").collect()] == [("ICE", 3), ("OneX", 1)]
    assert store.report(spark, cache, "qa_build").first().n_rows == 4

    put(data / "ICE" / "later.csv", csv_text([ice_row(deal_id="77")]))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert dataset.load_combined(spark, str(data), ref, cache).count() == 5      # noticed
        assert dataset.load_combined(spark, str(data), ref, cache, rebuild=True).count() == 5
    assert store.load(spark, cache, 1).count() == 4 and store.head(spark, cache).number == 3

    trades = store.load(spark, cache)
    for name, export in (("monthly", views.export_monthly), ("refs", views.export_index_refs),
                         ("unparsed", views.export_unparsed), ("trades", views.export_trades)):
        export(trades, str(tmp_path / name))
    def lines(name):
        return spark.read.option("header", True).csv(str(tmp_path / name)).count()
    assert (lines("monthly"), lines("refs"), lines("unparsed"), lines("trades")) == (2, 0, 1, 5)


def test_stage_goes_where_it_is_told(spark, tmp_path):
    table = spark.range(3)
    assert sinks.stage(table, "t", None) is table
    staged = sinks.stage(table, "t", str(tmp_path))
    assert staged.count() == 3 and str(tmp_path) in staged.inputFiles()[0]
    sinks.drop_staged(staged)
    path = staged.schema[0].metadata["staged"]
    assert spark.read.parquet(path).count() == 0
    sinks.drop_staged(table)


def test_local_staging_is_refused_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn", "spark.checkpoint.dir": "/mnt/shared"}.get(key, default)

    class Session:
        conf = Conf()

    sinks.check_shared(Session, "s3a://lake/tmp")
    sinks.check_shared(Session, "/mnt/shared/x")
    for folder in ("/tmp/x", "file:/tmp/x"):
        with pytest.raises(ValueError, match="not shared"):
            sinks.check_shared(Session, folder)


def test_grouped_write_keeps_null_groups(spark, tmp_path):
    df = spark.createDataFrame([("SW", 1), (None, 2), ("SYN", 3)], "index_group string, v int")
    sinks.write_grouped(df, str(tmp_path / "t"), "index_group")
    back = sinks.read_table(spark, str(tmp_path / "t"))
    assert sorted((str(r.index_group), r.v) for r in back.collect()) == [
        ("None", 2), ("SW", 1), ("SYN", 3)]
    assert sinks.read_table(spark, str(tmp_path / "none")) is None


def test_grouped_writes_move_no_row(spark, tmp_path):
    df = spark.range(0, 12, numPartitions=3).selectExpr("cast(id % 2 as string) as index_group", "id")
    sinks.write_grouped(df, str(tmp_path / "t"), "index_group")
    names = [f.name for f in (tmp_path / "t").rglob("*.parquet")]
    assert len(names) == 6 and all(n.endswith("zstd.parquet") for n in names)  # each of three tasks has both groups
    assert spark.read.parquet(str(tmp_path / "t")).count() == 12


def test_scratch_tables_pass_with_the_build_that_made_them(spark, tmp_path):
    df = spark.range(10)
    with sinks.passing(spark):
        gone = sinks.stage(df, "gone", str(tmp_path))
        placed, spread = sinks.stage_by(df, "gone", str(tmp_path), "id", 2)
        kept = sinks.stage(df, "kept", str(tmp_path), lasting=True)
        assert placed.count() == spread.count() == gone.count() == 10
    assert kept.count() == 10
    held = {p.name.split("-")[0]: sum(f.stat().st_size for f in p.rglob("part-*")) for p in tmp_path.iterdir()}
    assert len(list(tmp_path.iterdir())) == 3 and held["gone"] < 1000
