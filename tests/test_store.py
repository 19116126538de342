import os
import warnings

import pytest

from cyclebook.plans import dataset, store
from cyclebook.plans.intraday import ohlc_profile
from cyclebook.sources import reference
from cyclebook.sources.lines import MalformedExport
from tests.test_normalize import ice_row, onex_row
from tests.test_sources import csv_text, put, write_reference


@pytest.fixture
def lake(spark, tmp_path):
    """Exports, lookups and a store; ``update`` brings the store up to date."""
    write_reference(tmp_path / "ref")
    ref = reference.load_reference(spark, str(tmp_path / "ref"))

    class Lake:
        data, path = tmp_path / "data", str(tmp_path / "store")

        def update(self, **options):
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                return store.update(spark, str(self.data), ref, self.path, **options)

        def ids(self, version=None):
            rows = store.load(spark, self.path, version).collect()
            return sorted((r.broker, r.trade_id, r.price) for r in rows)

    lake = Lake()
    lake.ref = ref
    put(lake.data / "ICE" / "a.csv", csv_text([ice_row(deal_id=str(i), price="1") for i in range(6)]), 1_700_000_000)
    put(lake.data / "OneX" / "onex_2026-06-01_2026-06-30.csv", csv_text([onex_row()]), 1_700_000_000)
    return lake


def test_versions_stay_readable_and_only_touched_buckets_are_written(spark, lake):
    assert lake.update().number == 1 and lake.update().number == 1            # nothing new
    first = lake.ids()
    put(lake.data / "ICE" / "b.csv", csv_text([ice_row(deal_id="3", price="9"), ice_row(deal_id="70", price="2")]), 1_700_000_100)
    changed = sorted((r.broker, os.path.basename(r.path), r.change) for r in store.changes(spark, lake.path, str(lake.data)).collect()) \
        if not warnings.simplefilter("ignore") else []
    assert changed == [("ICE", "b.csv", "added")]
    two = lake.update()
    assert two.number == 2 and lake.ids(1) == first
    now = lake.ids()
    assert ("ICE", "3", 9.0) in now and ("ICE", "70", 2.0) in now and len(now) == len(first) + 1
    parts = spark.read.parquet(f"{lake.path}/parts/{two.build}").collect()
    new = {r.bucket for r in parts if r.build == two.build}
    assert 1 <= len(new) <= 2 and len({r.bucket for r in parts if r.broker == "ICE"}) > 2
    assert {r.broker: r.build == two.build for r in spark.read.parquet(f"{lake.path}/trades_of/{two.build}").collect()} == {
        "ICE": True, "OneX": False}                                           # OneX kept its trades


def test_an_older_file_that_comes_late_does_not_win(spark, lake):
    lake.update()
    put(lake.data / "ICE" / "old.csv", csv_text([ice_row(deal_id="2", price="8")]), 1_600_000_000)
    lake.update()
    assert ("ICE", "2", 1.0) in lake.ids()


def test_a_changed_or_removed_file_is_read_again(spark, lake):
    lake.update()
    put(lake.data / "ICE" / "b.csv", csv_text([ice_row(deal_id="3", price="9")]), 1_700_000_100)
    lake.update()
    os.remove(lake.data / "ICE" / "b.csv")
    assert lake.update().number == 3 and ("ICE", "3", 1.0) in lake.ids()
    put(lake.data / "ICE" / "a.csv", csv_text([ice_row(deal_id="50", price="4")]), 1_700_000_500)
    lake.update()
    assert [r for r in lake.ids() if r[0] == "ICE"] == [("ICE", "50", 4.0)]
    assert ("ICE", "3", 9.0) in lake.ids(2)


def test_incremental_versions_equal_a_rebuild(spark, lake):
    lake.update()
    for k in range(3):
        put(lake.data / "ICE" / f"n{k}.csv", csv_text([
            ice_row(deal_id=str(i), price=str(k), spread_parent_id="S1" if i % 4 == k else "") for i in range(k, 30, 2)]),
            1_700_000_100 + k)
        put(lake.data / "OneX" / f"onex_2026-07-0{k + 1}_2026-07-3{k % 2}.csv", csv_text(
            [onex_row(trade_id=str(900 + k), sleeved="Y" if k else "N"), onex_row(trade_id=" ")]), 1_700_000_100 + k)
        lake.update()
    grown = sorted(map(str, store.load(spark, lake.path, row_order=True).collect()))
    lake.update(rebuild=True)
    assert sorted(map(str, store.load(spark, lake.path, row_order=True).collect())) == grown
    assert store.versions(spark, lake.path).count() == 5


def test_an_unpublished_build_is_not_seen(spark, lake, monkeypatch):
    lake.update()
    put(lake.data / "ICE" / "b.csv", csv_text([ice_row(deal_id="71")]))
    with monkeypatch.context() as m:
        m.setattr(store, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            lake.update()
    assert store.head(spark, lake.path).number == 1 and ("ICE", "71", 1.5) not in lake.ids()
    assert lake.update().number == 2 and any(r[1] == "71" for r in lake.ids())


def test_of_two_builds_of_one_version_the_first_stands(spark, lake):
    one = lake.update()
    with pytest.raises(store.StoreConflict):
        store._publish(spark, lake.path, 1, "late", "update", 0)
    assert store.head(spark, lake.path) == one
    with pytest.raises(ValueError, match="no version 7"):
        store.load(spark, lake.path, 7)


def test_rejects_are_counted_by_version(spark, lake):
    lake.update()
    good = csv_text([ice_row(deal_id=str(i)) for i in range(300, 500)])
    put(lake.data / "ICE" / "r.csv", good + "only,two\n", 1_700_000_100)
    lake.update()
    rows = {(r.broker, r.source_file): (r.lines, r.too_few) for r in store.report(spark, lake.path, "qa_rejects").collect()}
    assert rows == {("ICE", "a.csv"): (6, 0), ("ICE", "r.csv"): (201, 1), ("OneX", "onex_2026-06-01_2026-06-30.csv"): (1, 0)}
    put(lake.data / "ICE" / "bad.csv", "Deal ID,Price\n1\n2\n")
    with pytest.raises(MalformedExport):
        lake.update()
    assert store.head(spark, lake.path).number == 2
    assert lake.update(max_rejects=None).number == 3


def test_built_candles_open_and_close_in_row_order(spark, lake):
    """Equal instants: the newest file first, then the order of its lines."""
    same = dict(local_datetime="06/03/2026 09:15:22")
    put(lake.data / "ICE" / "a.csv", csv_text([ice_row(deal_id=str(i), price=p, **same) for i, p in enumerate("5193")]), 1_700_000_000)
    put(lake.data / "ICE" / "z.csv", csv_text([ice_row(deal_id=str(10 + i), price=p, **same) for i, p in enumerate("726")]), 1_700_000_900)
    lake.update()
    trades = store.load(spark, lake.path, row_order=True).filter("broker = 'ICE'")
    order = [r.trade_id for r in trades.orderBy("row_ord").collect()]
    assert order == ["10", "11", "12", "0", "1", "2", "3"]
    candle = ohlc_profile(trades, ordinal="row_ord").first()
    assert (candle.open, candle.close, candle.high, candle.low) == (7.0, 3.0, 9.0, 1.0)


def test_the_store_of_an_empty_folder(spark, tmp_path, lake):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        empty = dataset.load_combined(spark, str(tmp_path / "nothing"), lake.ref, str(tmp_path / "s2"))
    assert empty.count() == 0 and store.head(spark, str(tmp_path / "s2")).number == 1


def test_a_build_leaves_no_rows_in_the_scratch_folder(spark, lake, tmp_path, monkeypatch):
    from cyclebook.sources import sinks
    scratch = tmp_path / "scratch"
    scratch.mkdir()
    monkeypatch.setattr(sinks, "scratch_folder", lambda session: str(scratch))
    assert lake.update().number == 1
    tables = list(scratch.iterdir())
    assert {t.name.split("-")[0] for t in tables} == {"versions", "copies"}
    assert sum(t.name.startswith("versions") for t in tables) == 2  # one for each source: chosen versions are not chosen again
    assert all(spark.read.parquet(str(t)).count() == 0 for t in tables)
    assert len(lake.ids()) == 7
