"""Build of the combined, enriched trade table and its quality reports."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cyclebook.operators.ordinal import ROW_ORDER, with_row_order
from cyclebook.plans import store
from cyclebook.plans.enrich import component_flag, enrich_combined
from cyclebook.plans.normalize import NORMALIZERS
from cyclebook.schema import BROKERS, TRADE_SCHEMA
from cyclebook.sources.conform import empty_table, union_all
from cyclebook.sources.reference import Reference
from cyclebook.sources.sinks import passing, scratch_folder, stage

__all__ = ["build_dataset", "component_flag", "enrich_combined", "load_combined", "normalize_all"]


def normalize_all(spark: SparkSession, sources: dict[str, DataFrame], ref: Reference,
                  row_order: bool = False) -> DataFrame:
    """Union of the normalized sources that are present."""
    parts = [_normalized(b, sources[b], ref, row_order) for b in BROKERS if b in sources]
    return union_all(parts) if parts else empty_table(spark, TRADE_SCHEMA)


def _normalized(broker: str, raw: DataFrame, ref: Reference, row_order: bool) -> DataFrame:
    raw = with_row_order(raw, BROKERS.index(broker)) if row_order else raw.drop(ROW_ORDER)
    return NORMALIZERS[broker](raw, ref)


def build_dataset(spark: SparkSession, sources: dict[str, DataFrame], ref: Reference,
                  cache_dir: str | None = None, staging: str | None = None, row_order: bool = False) -> DataFrame:
    """Normalize, unite, backfill and enrich.

    The backfill reads the normalized union twice, so that is written first and the normalizers run
    once: with ``cache_dir`` to the store, whose next version the build becomes, else to ``staging`` or the
    session's scratch folder. Only a cluster without any shared folder computes it twice. With
    ``row_order`` a column numbers the rows in the order they were read, for candles.
    """
    if cache_dir is not None:
        def made(broker: str) -> Callable[[], DataFrame]:
            return lambda: _normalized(broker, sources[broker], ref, True)

        store.publish_build(spark, cache_dir, uuid.uuid4().hex, {b: made(b) for b in BROKERS if b in sources}, ref)
        return store.load(spark, cache_dir, row_order=row_order)
    folder = staging or scratch_folder(spark)
    if folder is None:
        return store.combine([normalize_all(spark, sources, ref, row_order)], ref)
    with passing(spark):
        combined = stage(normalize_all(spark, sources, ref, row_order), "normalized", folder, lasting=True)
    return store.combine([combined], ref)


def load_combined(spark: SparkSession, data_dir: str, ref: Reference, cache_dir: str,
                  rebuild: bool = False, fmt: str = "csv", skip_unreadable: bool = False,
                  row_order: bool = False) -> DataFrame:
    """The stored table, brought up to date with the exports that are there now.

    New exports alone are read; without a change the stored version is returned as it is. ``rebuild``
    reads everything again.
    """
    if store.update(spark, data_dir, ref, cache_dir, fmt, rebuild, skip_unreadable) is None:
        build_dataset(spark, {}, ref, cache_dir)
    return store.load(spark, cache_dir, row_order=row_order)
