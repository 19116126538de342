"""Versioned store of built trades.

A build writes into folders of its own name and is published by one row of an append-only log, so
readers of an earlier version are never disturbed and a build that breaks off is never seen. The
version also keeps the list of ingested files, the latest version of each trade in buckets of its id, and
the normalized trades of each source. An update compares that list with the files that are there now:
new exports alone are read, only buckets that hold one of their ids are chosen and written again, the
others stay where an earlier build wrote them, and sources without a change keep their trades. A file
that changed or went away makes its source be read again as a whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclebook.functions.text import has_text, squish
from cyclebook.operators.calendar import backfill_trade_cycle
from cyclebook.operators.ordinal import ROW_ORDER, with_row_order
from cyclebook.plans.enrich import enrich_combined
from cyclebook.plans.normalize import LATEST, NORMALIZERS
from cyclebook.plans.quality import qa_build, qa_coverage, qa_unmapped
from cyclebook.schema import BROKERS, ENRICHED_SCHEMA, PREFERRED_TABLE, PROVENANCE
from cyclebook.sources.conform import empty_table, union_all
from cyclebook.sources.files import (
    GLOBS, list_broker_files, read_parquet_folder, read_surveyed, reject_counts,
)
from cyclebook.sources.lines import MAX_REJECTS, surveyed
from cyclebook.sources.sinks import check_shared, passing, read_table, scratch_by, write_grouped, write_table

BUCKETS = 32  # of latest versions, by id; so many folders are listed without a job
_LOG = "version long, build string, builder string, files long, created timestamp"
_FILES = "broker string, path string, file_name string, modified timestamp, length long"
_PARTS = "broker string, bucket int, build string"
_SOURCES = "broker string, build string"
_IDS = {"ICE": "deal_id", "Modern": "trade_number", "Neon": "trade_id", "OneX": "trade_id"}
_STORED = T.StructType([*ENRICHED_SCHEMA.fields, T.StructField(ROW_ORDER, T.LongType())])
_SAME = ["broker", "path", "modified", "length"]


class StoreConflict(RuntimeError):
    """Another build published the same version first."""


class Version(NamedTuple):
    number: int
    build: str


def versions(spark: SparkSession, store: str) -> DataFrame:
    """``version, build, builder, files, created`` of the published versions; of two builds of one version the first."""
    log = read_table(spark, f"{store}/log", spark.createDataFrame([], _LOG).schema)
    if log is None:
        return spark.createDataFrame([], _LOG)
    return log.groupBy("version").agg(F.min(F.struct("created", "build", "builder", "files")).alias("first")).select(
        "version", "first.build", "first.builder", "first.files", "first.created")


def head(spark: SparkSession, store: str, version: int | None = None) -> Version | None:
    """The newest published version, or the one asked for."""
    found = versions(spark, store)
    if version is not None:
        found = found.filter(F.col("version") == version)
    row = found.orderBy(F.col("version").desc()).first()
    if row is None and version is not None:
        raise ValueError(f"{store} has no version {version}")
    return Version(row["version"], row["build"]) if row else None


def _publish(spark: SparkSession, store: str, number: int, build: str, builder: str, files: int) -> Version:
    row = spark.range(1).select(F.lit(number).cast("long").alias("version"), F.lit(build).alias("build"),
                                F.lit(builder).alias("builder"), F.lit(files).cast("long").alias("files"),
                                F.current_timestamp().alias("created"))
    row.coalesce(1).write.mode("append").parquet(f"{store}/log")
    seen = head(spark, store, number)
    if seen.build != build:
        raise StoreConflict(f"version {number} of {store} was published by build {seen.build}")
    return seen


def load(spark: SparkSession, store: str, version: int | None = None, row_order: bool = False) -> DataFrame | None:
    """The enriched trades of a version, the newest by default; None where nothing is published.

    ``row_order`` adds the number that candles order equal instants by.
    """
    at = head(spark, store, version)
    if at is None:
        return None
    table = read_table(spark, f"{store}/combined/{at.build}", _STORED)
    return table if row_order else table.drop(ROW_ORDER)


def report(spark: SparkSession, store: str, name: str, version: int | None = None) -> DataFrame | None:
    """A quality table of a version: ``qa_coverage``, ``qa_unmapped``, ``qa_build`` or ``qa_rejects``."""
    at = head(spark, store, version)
    return read_table(spark, f"{store}/{name}/{at.build}") if at else None


def _listing(spark: SparkSession, data_dir: str, fmt: str) -> DataFrame:
    """Files of all sources: those of the preferred sheet and the others of the folder that it has no file for."""
    parts = []
    for broker in BROKERS:
        folder, sheet = f"{data_dir}/{broker}", PREFERRED_TABLE.get(broker)
        own = list_broker_files(spark, folder, GLOBS[fmt])
        if sheet:
            preferred = list_broker_files(spark, f"{folder}/{sheet}", GLOBS[fmt], quiet=True)
            own = preferred.unionByName(own.join(preferred.select("file_name"), "file_name", "left_anti"))
        parts.append(own.withColumn("broker", F.lit(broker)))
    return union_all(parts).select("broker", "path", "file_name", "modified", "length")


def _stored(spark: SparkSession, store: str, name: str, ddl: str, at: Version | None) -> DataFrame:
    if at is None:
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(f"{store}/{name}/{at.build}")


def changes(spark: SparkSession, store: str, data_dir: str, fmt: str = "csv") -> DataFrame:
    """``broker, path, change`` (added, gone) since the newest version; a changed file is both."""
    known, listed = _stored(spark, store, "files", _FILES, head(spark, store)), _listing(spark, data_dir, fmt)
    added, gone = listed.join(known, _SAME, "left_anti"), known.join(listed, _SAME, "left_anti")
    return added.select("broker", "path", F.lit("added").alias("change")).unionAll(
        gone.select("broker", "path", F.lit("gone").alias("change")))


def _bucket(broker: str) -> Column:
    """Bucket of a raw row: of its id, or of its place where it has none and competes with no row."""
    key = F.col(_IDS[broker])
    if broker in ("Neon", "OneX"):
        key = F.when(has_text(_IDS[broker]), squish(key)).otherwise(F.concat_ws("/", *[F.col(c).cast("string") for c in PROVENANCE]))
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _latest(spark: SparkSession, store: str, broker: str, parts: Sequence) -> DataFrame | None:
    """The stored latest versions of a source in these (bucket, build) parts."""
    builds: dict[str, list[int]] = {}
    for bucket, build in parts:
        builds.setdefault(build, []).append(bucket)
    tables = [spark.read.parquet(f"{store}/latest/{build}/{broker}").filter(F.col("bucket").isin(buckets))
              for build, buckets in sorted(builds.items())]
    return union_all(tables) if tables else None


def update(spark: SparkSession, data_dir: str, ref, store: str, fmt: str = "csv", rebuild: bool = False,
           skip_unreadable: bool = False, max_rejects: float | None = MAX_REJECTS) -> Version | None:
    """Publish a version with the exports that are there now; without a change the newest version stays.

    ``rebuild`` reads everything again. Returns None where nothing was ever published or exported.
    """
    check_shared(spark, store)
    newest = head(spark, store)
    at = None if rebuild else newest
    listed = spark.createDataFrame(_listing(spark, data_dir, fmt).toArrow())  # the driver's own listing, taken once
    known = _stored(spark, store, "files", _FILES, at)
    added, gone = listed.join(known, _SAME, "left_anti"), known.join(listed, _SAME, "left_anti")
    new = _by_broker(added)
    lost = {r["broker"] for r in gone.select("broker").distinct().collect()}
    if not new and not lost:
        return newest
    whole = _by_broker(listed.filter(F.col("broker").isin(sorted(lost)))) if lost else {}
    build = uuid.uuid4().hex
    parts: dict[str, list[tuple[int, str]]] = {b: [] for b in BROKERS}
    for r in _stored(spark, store, "parts", _PARTS, at).orderBy("broker", "bucket").collect():
        parts[r["broker"]].append((r["bucket"], r["build"]))
    trades = {r["broker"]: r["build"] for r in _stored(spark, store, "trades_of", _SOURCES, at).collect()}
    counts = []
    for broker in sorted(lost | set(new)):
        if broker in lost:
            parts[broker] = []
        raw, rejects = _read_new(spark, whole.get(broker, []) if broker in lost else new[broker], listed, broker, fmt,
                                 skip_unreadable, max_rejects)
        counts += rejects
        if raw is not None:
            with passing(spark):
                parts[broker] = _rewrite_touched(spark, store, build, broker, raw, parts[broker])
        latest = _latest(spark, store, broker, parts[broker])
        trades.pop(broker, None)
        if latest is not None:
            ordered = with_row_order(latest.drop("bucket"), BROKERS.index(broker))
            with passing(spark):
                write_table(NORMALIZERS[broker](ordered, ref, chosen=True), f"{store}/trades/{build}/{broker}")
            trades[broker] = build
    old = report(spark, store, "qa_rejects", at.number) if at else None
    if old is not None:
        reread = listed.filter(F.col("broker").isin(sorted(lost))).select("broker", "file_name").unionAll(
            added.select("broker", "file_name"))
        same = listed.select("broker", "file_name").exceptAll(reread).withColumnRenamed("file_name", "source_file")
        counts.append(old.join(same, ["broker", "source_file"], "left_semi"))
    table = union_all(counts) if counts else None
    return _publish_trades(spark, store, build, trades, parts, listed, ref, "update", table)


def _by_broker(files: DataFrame) -> dict[str, list[str]]:
    paths: dict[str, list[str]] = {}
    for r in files.select("broker", "path").orderBy("broker", "path").collect():
        paths.setdefault(r["broker"], []).append(r["path"])
    return paths


def _read_new(spark, paths, listed, broker, fmt, skip_unreadable, max_rejects) -> tuple[DataFrame | None, list[DataFrame]]:
    """The rows of these files, and of CSV files the number of malformed lines."""
    if not paths:
        return None, []
    if fmt != "csv":
        return read_parquet_folder(spark, paths), []
    files = surveyed(spark, paths)
    counts = reject_counts(spark, paths, files).withColumn("broker", F.lit(broker))
    own = listed.filter(F.col("broker") == broker)
    return read_surveyed(spark, paths, files, own, False, skip_unreadable, max_rejects), [counts]


def _rewrite_touched(spark, store, build, broker, raw, parts) -> list[tuple[int, str]]:
    """Choose versions again in the buckets that the new rows fall into; the others stay as they are."""
    touched = {r["bucket"] for r in raw.select(_bucket(broker).alias("bucket")).distinct().collect()}
    old = _latest(spark, store, broker, [p for p in parts if p[0] in touched])
    rows = raw if old is None else union_all([old.drop("bucket"), raw])
    latest = LATEST[broker](rows, scratch_by(spark)).withColumn("bucket", _bucket(broker))
    write_grouped(latest, f"{store}/latest/{build}/{broker}", "bucket")
    return sorted([p for p in parts if p[0] not in touched] + [(b, build) for b in touched])


def combine(tables: Sequence[DataFrame], ref) -> DataFrame:
    """Union of normalized trades, with estimated windows for months the calendar lacks, and all flags."""
    return enrich_combined(backfill_trade_cycle(union_all(tables), ref.calendar))


def publish_build(spark: SparkSession, store: str, build: str, sources: dict[str, Callable[[], DataFrame]], ref) -> Version:
    """A version made of normalized tables that no file of the store's listing stands for.

    They are made one after the other, and what one leaves in the scratch folder goes before the next.
    """
    check_shared(spark, store)
    for broker, made in sources.items():
        with passing(spark):
            write_table(made(), f"{store}/trades/{build}/{broker}")
    listed = spark.createDataFrame([], _FILES)
    return _publish_trades(spark, store, build, dict.fromkeys(sources, build), {}, listed, ref, "build", None)


def _publish_trades(spark, store, build, trades, parts, listed, ref, builder, rejects) -> Version:
    """Write the combined table and its quality reports from stored trades, then publish them.

    The normalized trades are read, not made again: two columns for the estimated windows, and once
    as a whole.
    """
    write_table(listed, f"{store}/files/{build}")
    rows = [(b, k, w) for b, own in parts.items() for k, w in own]
    write_table(spark.createDataFrame(rows, _PARTS).coalesce(1), f"{store}/parts/{build}")
    write_table(spark.createDataFrame(sorted(trades.items()), _SOURCES).coalesce(1), f"{store}/trades_of/{build}")
    tables = [read_table(spark, f"{store}/trades/{w}/{b}") for b, w in sorted(trades.items())]
    tables = [t for t in tables if t is not None] or [empty_table(spark).withColumn(ROW_ORDER, F.lit(None).cast("long"))]
    write_grouped(combine(tables, ref), f"{store}/combined/{build}", "index_group")
    stored = read_table(spark, f"{store}/combined/{build}", _STORED)
    for name, make in (("qa_coverage", qa_coverage), ("qa_unmapped", qa_unmapped), ("qa_build", qa_build)):
        write_table(make(stored), f"{store}/{name}/{build}")
    if rejects is not None:
        write_table(rejects, f"{store}/qa_rejects/{build}")
    last = head(spark, store)
    return _publish(spark, store, last.number + 1 if last else 1, build, builder, listed.count())
