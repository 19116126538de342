"""Raw broker exports as text tables with provenance columns.

Nothing is dropped silently: a damaged file fails the read, a file that offers no header is an error
unless the caller asks to skip it, which warns and can be listed by ``skipped_files``, and lines that do
not fit their header are listed by ``rejected_lines`` and an error beyond a share.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclebook.schema import BROKERS, PREFERRED_TABLE
from cyclebook.sources.conform import clean_names, read_all_sheets, rename_aliases, union_all
from cyclebook.sources.lines import (
    CSV_GLOB, MAX_REJECTS, Header, Source, cell, check_rejects, file_name, headers, literal, read_lines, survey, surveyed,
)

EXPORT_GLOB = "*.{[cC][sS][vV],[xX][lL][sS],[xX][lL][sS][xX]}"
PARQUET_GLOB = "*.[pP][aA][rR][qQ][uU][eE][tT]"
GLOBS = {"csv": CSV_GLOB, "parquet": PARQUET_GLOB}
SHOWN = 5  # files named in a message

_LISTING = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("length", T.LongType()),
])


class UnreadableExport(ValueError):
    """A listed file would contribute nothing."""


def _missing(err: AnalysisException) -> bool:
    return err.getCondition() == "PATH_NOT_FOUND"


def list_broker_files(spark: SparkSession, folder: str, glob: str = EXPORT_GLOB,
                      recursive: bool = False, quiet: bool = False) -> DataFrame:
    """Files of a folder by extension, any letter case. A missing folder is empty, with a warning.

    Only the listing is read: file contents are pruned from the scan.
    """
    try:
        found = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                 .option("recursiveFileLookup", recursive).load(folder))
    except AnalysisException as err:
        if not _missing(err):
            raise
        if not quiet:
            warnings.warn(f"Broker folder not found: {folder}", stacklevel=2)
        return spark.createDataFrame([], _LISTING)
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"),
                        F.col("modificationTime").alias("modified"), "length")


def source_inventory(spark: SparkSession, data_dir: str,
                     brokers: Sequence[str] = BROKERS) -> DataFrame:
    """Export files of every broker folder, tagged with the broker."""
    return union_all([list_broker_files(spark, f"{data_dir}/{b}").withColumn("broker", F.lit(b))
                      for b in brokers])


def inventory_counts(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("broker").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
        F.max("modified").alias("latest")).orderBy("broker")


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    return list_broker_files(spark, folder, CSV_GLOB, quiet=True)


def _skipped(listed: DataFrame, files: DataFrame, found: Sequence[Header]) -> DataFrame:
    bad = files.filter(F.col("mark").isin([h.mark for h in found if h.names is None]))
    return listed.join(bad, "file_name", "left_semi").select("path", F.lit("no header").alias("reason"))


def skipped_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, reason`` of the CSV files that contribute nothing; empty files are not listed at all."""
    files = surveyed(spark, folder)
    return _skipped(_listed(spark, folder), files, headers(spark, folder, files))


def reject_counts(spark: SparkSession, folder: Source, files: DataFrame | None = None) -> DataFrame:
    """``source_file, lines, too_few, too_many, broken`` of each CSV file: its malformed lines by kind."""
    return (survey(spark, folder) if files is None else files).withColumnRenamed("file_name", "source_file").drop("mark", "fields")


def _with_provenance(df: DataFrame) -> DataFrame:
    """Name and age of the file, and the row's position in it."""
    return df.select(
        "*",
        file_name().alias("source_file"),
        F.col("_metadata.file_modification_time").alias("source_file_modified"),
        F.col("_metadata.file_block_start").alias("source_block"),
        F.monotonically_increasing_id().alias("source_row"))


def _cell(name: str, missing: Sequence[str]):
    return cell(F.col(f"`{name}`").cast("string"), missing)


def _read_records(spark: SparkSession, folder: str, files: DataFrame, found: Sequence[Header], one: bool) -> DataFrame:
    """The same for records whose quoted fields may hold line breaks: each header reads the folder.

    It keeps the files it belongs to by a semi-join on the file's name. Spark fits each record to the
    header, short ones with nulls and long ones cut.
    """
    parts = []
    for h in found:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in h.names])
        raw = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
               .option("escape", '"').option("multiLine", True).option("pathGlobFilter", CSV_GLOB).csv(folder))
        part = _with_provenance(raw)
        if not one:
            own = files.filter(F.col("mark") == h.mark).select(F.col("file_name").alias("source_file"))
            part = part.join(own, "source_file", "left_semi").select(*part.columns)
        parts.append(part.withColumns({n: _cell(n, ("", "NA")) for n in h.names}))
    return union_all(parts)


def read_csv_folder(spark: SparkSession, folder: str, multi_line: bool = False,
                    skip_unreadable: bool = False, quiet: bool = False,
                    max_rejects: float | None = MAX_REJECTS, keep_rejects: bool = True) -> DataFrame | None:
    """All CSV exports of a folder as text, aligned by column name, from one scan.

    A survey of the folder comes first (see ``lines``): the driver sees the distinct headers and the
    number of malformed lines, and more than the share ``max_rejects`` of them is an error. Files
    with other headers are told apart by a broadcast of file names. A file whose first line is no text
    is an error, or with ``skip_unreadable`` a warning. With ``multi_line`` quoted fields may hold line
    breaks; then lines are no records, rejects are not looked for and each header reads the folder.
    Returns None without files.
    """
    listed = list_broker_files(spark, folder, CSV_GLOB, quiet=quiet)
    if not listed.take(1):
        return None
    return read_surveyed(spark, folder, surveyed(spark, folder), listed, multi_line, skip_unreadable,
                         max_rejects, keep_rejects)


def read_surveyed(spark: SparkSession, folder: Source, files: DataFrame, listed: DataFrame, multi_line: bool = False,
                  skip_unreadable: bool = False, max_rejects: float | None = MAX_REJECTS,
                  keep_rejects: bool = True) -> DataFrame | None:
    """The table of a folder, or of listed paths, whose survey is there."""
    found = headers(spark, folder, files)
    if any(h.names is None for h in found):
        skipped = _skipped(listed, files, found).orderBy("path").take(SHOWN)
        names = ", ".join(r["path"] for r in skipped)
        if not skip_unreadable:
            raise UnreadableExport(f"Unreadable exports: {names}")
        warnings.warn(f"Skipping unreadable files: {names}", stacklevel=2)
    readable = [h for h in found if h.names]
    if not readable:
        return None
    one = len(found) == 1
    if multi_line:
        return _read_records(spark, folder, files, readable, one)
    check_rejects(folder, readable, max_rejects)
    return read_lines(spark, folder, files, readable, one, keep_rejects)


def read_parquet_folder(spark: SparkSession, folder: Source, quiet: bool = False) -> DataFrame | None:
    """The same for sheets landed as Parquet; every column becomes text, and NA stays text."""
    paths = [folder] if isinstance(folder, str) else [literal(p) for p in folder]
    try:
        raw = (spark.read.option("mergeSchema", True).option("pathGlobFilter", PARQUET_GLOB)
               .parquet(*paths))
    except AnalysisException as err:
        if not _missing(err) and err.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        if not quiet:
            warnings.warn(f"Broker folder not found: {folder}", stacklevel=2)
        return None
    names = clean_names(raw.columns)
    tagged = _with_provenance(raw.select("*", F.col("_metadata.row_index").alias("source_line")))
    return rename_aliases(tagged.toDF(*names, *tagged.columns[len(names):]).withColumns(
        {n: _cell(n, ("",)) for n in names}))


def _read_folder(spark: SparkSession, folder: str, fmt: str, multi_line: bool,
                 skip_unreadable: bool, quiet: bool = False) -> DataFrame | None:
    if fmt == "csv":
        return read_csv_folder(spark, folder, multi_line, skip_unreadable, quiet)
    return read_parquet_folder(spark, folder, quiet)


def read_source(spark: SparkSession, folder: str, prefer_table: str | None = None,
                fmt: str = "csv", multi_line: bool = False,
                skip_unreadable: bool = False) -> DataFrame | None:
    """One broker's raw table.

    A workbook lands as one file in a sub-folder per sheet. Files are chosen one by one: a file
    of the sub-folder ``prefer_table`` takes the place of the one with its name in the folder
    itself, and all other files of the folder are read as well.
    """
    preferred = _read_folder(spark, f"{folder}/{prefer_table}", fmt, multi_line,
                             skip_unreadable, quiet=True) if prefer_table else None
    if preferred is None:
        return _read_folder(spark, folder, fmt, multi_line, skip_unreadable)
    plain = _read_folder(spark, folder, fmt, multi_line, skip_unreadable, quiet=True)
    if plain is None:
        return preferred
    taken = list_broker_files(spark, f"{folder}/{prefer_table}", GLOBS[fmt]).select(
        F.col("file_name").alias("source_file"))
    return union_all([preferred, plain.join(taken, "source_file", "left_anti").select(*plain.columns)])


def read_sheets(spark: SparkSession, folder: str, fmt: str = "csv", multi_line: bool = False,
                skip_unreadable: bool = False) -> DataFrame | None:
    """All sheets of a source: every sub-folder with files, united and tagged ``source_sheet``.

    Files of the folder itself are a sheet with an empty name.
    """
    listed = list_broker_files(spark, folder, GLOBS[fmt], recursive=True)
    inside = F.element_at(F.split("path", "/"), -2)
    sheets = [r[0] for r in listed.select(inside).distinct().collect()]
    own = folder.rstrip("/").rpartition("/")[2]
    tables = {}
    for sheet in sorted(sheets):
        name, path = ("", folder) if sheet == own else (sheet, f"{folder}/{sheet}")
        table = _read_folder(spark, path, fmt, multi_line, skip_unreadable)
        if table is not None:
            tables[name] = table
    return read_all_sheets(tables) if tables else None


def read_sources(spark: SparkSession, data_dir: str, fmt: str = "csv", multi_line: bool = False,
                 skip_unreadable: bool = False) -> dict[str, DataFrame]:
    """Raw tables of all brokers that have any files."""
    tables = {b: read_source(spark, f"{data_dir}/{b}", PREFERRED_TABLE.get(b), fmt, multi_line,
                             skip_unreadable)
              for b in BROKERS}
    return {b: t for b, t in tables.items() if t is not None}
