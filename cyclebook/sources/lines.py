"""CSV exports line by line: one survey of a folder, one scan for any mixture of headers, rejects.

The survey counts the lines of every file by their number of fields and finds its first line that
is not blank, its header. Reading then parses each line once by position and names the fields
by the header of the line's file. A line that is not UTF-8 is taken for Latin-1.

A malformed line has fewer or more fields than its header, a quote that does not close, or repeats
the header. It is a reject: listed with file and line number, counted, and an error beyond a
stated share. Short lines are read with nulls and long ones without their additional fields, unless
the caller leaves rejects out.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cyclebook.sources.conform import HEADER_ALIASES, clean_names

CSV_GLOB = "*.[cC][sS][vV]"
MAX_REJECTS = 0.01  # share of a folder's lines that may be malformed
MAX_MAPPED_FILES = 100_000  # files whose survey the driver keeps; Spark's own listing holds more for each

_QUOTED = r'"(?:[^"]|"")*+"'
_FIELD = rf'(?:{_QUOTED}|[^",][^,]*+)?'
_WELL_FORMED = rf'^{_FIELD}(?:,{_FIELD})*+$'
_OPTIONS = {"escape": '"', "mode": "PERMISSIVE"}


class MalformedExport(ValueError):
    """Too many lines of a folder do not fit their header."""


class Header(NamedTuple):
    """A header line of a folder; ``names`` is None where it is no text."""

    mark: int
    text: str
    names: list[str] | None
    file: str
    files: int
    lines: int
    rejects: int


def file_name() -> Column:
    """Name of the file a row comes from, as it is listed; Spark gives it in URL form."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


Source = str | Sequence[str]  # a folder, or paths of files whose names differ


def literal(path: str) -> str:
    """A path in which no character is a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def raw_lines(spark: SparkSession, folder: Source, blank: bool = False) -> DataFrame:
    """``line, file_name, block, place`` and ``modified`` of every line; blank lines only where asked for."""
    text = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(
        F.decode(F.col("value").cast("binary"), "ISO-8859-1"))
    paths = folder if isinstance(folder, str) else [literal(p) for p in folder]
    lines = spark.read.option("pathGlobFilter", CSV_GLOB).text(paths).select(
        text.alias("line"), file_name().alias("file_name"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.col("_metadata.file_modification_time").alias("modified"))
    return lines if blank else lines.filter(has_line())


def has_line() -> Column:
    """Whether ``line`` is not blank."""
    return F.trim(F.replace("line", F.lit("﻿"))) != ""


def field_count(line: Column) -> Column:
    """Fields of a line; commas inside quoted fields do not separate."""
    plain = F.when(line.contains('"'), F.regexp_replace(line, rf"(^|,){_QUOTED}", "$1")).otherwise(line)
    return F.length(plain) - F.length(F.replace(plain, F.lit(","))) + 1


def broken_quote(line: Column) -> Column:
    return line.contains('"') & ~line.rlike(_WELL_FORMED)


def survey(spark: SparkSession, folder: Source) -> DataFrame:
    """``file_name, mark, fields, lines, too_few, too_many, broken`` of each CSV file with text.

    ``mark`` is a hash of the header and ``lines`` counts the lines after it. All aggregates are
    numbers, so one hash aggregation does it, partial in every task; a file gives a row for each
    number of fields that occurs in it, however many lines it has.
    """
    line = F.col("line")
    head = F.when(F.col("block") == 0, F.col("place"))
    kinds = raw_lines(spark, folder).groupBy(
        "file_name", field_count(line).alias("fields"), broken_quote(line).alias("broken")).agg(
        F.count(F.lit(1)).alias("n"), F.min(head).alias("first"), F.min_by(F.xxhash64("line"), head).alias("mark"))
    by_file = Window.partitionBy("file_name").orderBy(F.col("first").asc_nulls_last())
    told = kinds.withColumns({"own": F.first("fields").over(by_file), "mark": F.first("mark").over(by_file),
                              "n": F.col("n") - (F.row_number().over(by_file) == 1).cast("int")})

    def lines_that(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    whole = ~F.col("broken")
    return told.groupBy("file_name", "mark", F.col("own").alias("fields")).agg(
        F.sum("n").alias("lines"), lines_that(whole & (F.col("fields") < F.col("own"))).alias("too_few"),
        lines_that(whole & (F.col("fields") > F.col("own"))).alias("too_many"),
        lines_that(F.col("broken")).alias("broken"))


def surveyed(spark: SparkSession, folder: Source) -> DataFrame:
    """The survey as a table of the driver, so that it runs once; of very many files it stays a plan."""
    files = survey(spark, folder)
    few = files.limit(MAX_MAPPED_FILES + 1).toArrow()
    return files if few.num_rows > MAX_MAPPED_FILES else spark.createDataFrame(few, files.schema)


def _header_line(spark: SparkSession, folder: Source, name: str, mark: int) -> str:
    """The header itself, from one of its files."""
    path = [f"{folder}/{name}"] if isinstance(folder, str) else [p for p in folder if p.rpartition("/")[2] == name]
    return raw_lines(spark, path).filter(F.xxhash64("line") == mark).first()["line"]


def _aliased(names: list[str]) -> list[str]:
    """Known header variants under their one name."""
    for target, variants in HEADER_ALIASES.items():
        for variant in variants:
            if variant in names and target not in names:
                names[names.index(variant)] = target
    return names


def headers(spark: SparkSession, folder: Source, files: DataFrame) -> list[Header]:
    """Distinct headers of a surveyed folder; the driver sees these, not the files."""
    bad = F.col("too_few") + F.col("too_many") + F.col("broken")
    rows = files.groupBy("mark").agg(
        F.min("file_name").alias("file"), F.count(F.lit(1)).alias("files"), F.sum("lines").alias("lines"),
        F.sum(bad).alias("rejects")).orderBy("mark").collect()
    found = []
    for r in rows:
        text = _header_line(spark, folder, r["file"], r["mark"])
        readable = not re.search("[\x00-\x08\x0e-\x1f�]", text)
        names = _aliased(clean_names(next(csv.reader([text.lstrip("﻿")])))) if readable else None
        found.append(Header(r["mark"], text, names, r["file"], r["files"], r["lines"], r["rejects"]))
    return found


def check_rejects(folder: Source, found: Sequence[Header], max_rejects: float | None) -> None:
    lines, bad = (sum(h[k] for h in found if h.names) for k in (5, 6))
    if max_rejects is not None and bad > max_rejects * lines:
        where = folder if isinstance(folder, str) else ", ".join(folder[:5])
        raise MalformedExport(f"{bad} of {lines} lines in {where} do not fit their header, more than {max_rejects:.1%};"
                              " see rejected_lines")


def _by_header(found: Sequence[Header], value) -> Column:
    """``value(header)`` for the header of the row's file."""
    first, *rest = found
    out = value(first)
    for h in rest:
        out = F.when(F.col("mark") == h.mark, value(h)).otherwise(out)
    return out


def marked_lines(spark: SparkSession, folder: Source, files: DataFrame, found: Sequence[Header]) -> DataFrame:
    """The lines of the files with these headers, with ``mark`` where there are several."""
    lines = raw_lines(spark, folder)
    own = files.filter(F.col("mark").isin([h.mark for h in found])).select("file_name", "mark")
    if sum(h.files for h in found) <= MAX_MAPPED_FILES:
        own = F.broadcast(own)
    return lines.join(own, "file_name")


def cell(text: Column, missing: Sequence[str]) -> Column:
    """Trimmed text; null for the markers of a missing cell."""
    text = F.trim(text)
    return F.when(~text.isin(*missing), text)


def read_lines(spark: SparkSession, folder: Source, files: DataFrame, found: Sequence[Header], one: bool,
               keep_rejects: bool = True) -> DataFrame:
    """The table of all files with these headers from one scan, aligned by column name.

    Each line is parsed once by position. ``one`` says that the folder has no other header, so that no
    file needs to be told apart.
    """
    lines = raw_lines(spark, folder).withColumn("mark", F.lit(found[0].mark)) if one else \
        marked_lines(spark, folder, files, found)
    lines = lines.filter(F.col("line") != _by_header(found, lambda h: F.lit(h.text)))
    if not keep_rejects:
        width = _by_header(found, lambda h: F.lit(len(h.names)))
        lines = lines.filter((field_count(F.col("line")) == width) & ~broken_quote(F.col("line")))
    width = max(len(h.names) for h in found)
    ddl = ", ".join(f"c{i} STRING" for i in range(width))
    parsed = lines.withColumn("parsed", F.from_csv("line", ddl, _OPTIONS))
    names = list(dict.fromkeys(n for h in found for n in h.names))

    def column(name: str) -> Column:
        place = lambda h: F.col(f"parsed.c{h.names.index(name)}") if name in h.names else F.lit(None).cast("string")
        return cell(_by_header(found, place), ("", "NA")).alias(name)

    return parsed.select(*map(column, names), F.col("file_name").alias("source_file"),
                         F.col("modified").alias("source_file_modified"), F.col("block").alias("source_block"),
                         F.col("place").alias("source_row"))


def rejected_lines(spark: SparkSession, folder: Source) -> DataFrame:
    """``source_file, line_number, reason, line`` of the malformed lines, the file's first line being 1.

    A line's number is its place in its block plus the lines of the blocks before; nothing is sorted
    but the blocks of a file. The lines are read once for the rejects and once to count the blocks, whose
    first one also says where the file's own header is.
    """
    files = surveyed(spark, folder)
    found = [h for h in headers(spark, folder, files) if h.names]
    if not found:
        return spark.createDataFrame([], "source_file string, line_number long, reason string, line string")
    lines = marked_lines(spark, folder, files, found)
    width, line = _by_header(found, lambda h: F.lit(len(h.names))), F.col("line")
    header = line == _by_header(found, lambda h: F.lit(h.text))
    fields = field_count(line)
    reason = (F.when(header, "repeated header").when(broken_quote(line), "broken quote")
              .when(fields < width, "too few fields").otherwise("too many fields"))
    blocks = raw_lines(spark, folder, blank=True).groupBy("file_name", "block").agg(
        F.min("place").alias("start"), F.count(F.lit(1)).alias("n"), F.min(F.when(has_line(), F.col("place"))).alias("first"))
    earlier = Window.partitionBy("file_name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file_name", "block", "start", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                           F.when(F.col("block") == 0, F.col("first")).alias("own_header"))
    # All lines are only asked whether they fit; the few that do not are told why.
    bad = lines.filter(header | broken_quote(line) | (fields != width))
    number = F.col("before") + F.col("place") - F.col("start") + 1
    placed = bad.join(blocks, ["file_name", "block"]).filter(~F.col("place").eqNullSafe(F.col("own_header")))
    return placed.select(F.col("file_name").alias("source_file"), number.alias("line_number"), reason.alias("reason"), "line")
