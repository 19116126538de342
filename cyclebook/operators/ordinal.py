"""One whole number for the order in which rows were read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclebook.schema import ROW_PLACES

ROW_ORDER, LINE = ROW_PLACES
# A broker's files, then the rows of a file: 2 + 20 + 41 bits.
FILES, LINES = 1 << 20, 1 << 41
MAX_BROADCAST_FILES = 100_000
_INDEX_BITS = 33  # of a row id of Spark's: the row's place in its partition


def place_in_file(block: Column, row: Column) -> Column:
    """A number that grows along a file: the block's first byte plus the row's place in its partition.

    A block that another block of its file follows fills a partition of its own, so its rows are
    counted from zero and are no more than its bytes.
    """
    return block + row.bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))


def with_row_order(raw: DataFrame, source: int = 0) -> DataFrame:
    """``raw`` with the fixed-width number ``row_ord``: by source, newest file first, place in the file.

    Files are ranked by age, then by name; there is a row for each file, as in Spark's own listing, and so few
    are broadcast: the rows do not move.
    ``source_line`` is the place of a row in its file where the table has it. More than 2^20 files of a
    source or 2^41 bytes of a file are an error.
    """
    if ROW_ORDER in raw.columns:
        return raw
    files = raw.groupBy("source_file").agg(F.max("source_file_modified").alias("modified"))
    newest = Window.orderBy(F.col("modified").desc_nulls_last(), "source_file")
    ranks = files.select(F.col("source_file").alias("__file"), (F.row_number().over(newest) - 1).cast("long").alias("__rank"))
    line = F.col(LINE) if LINE in raw.columns else place_in_file(F.col("source_block"), F.col("source_row"))
    fits = (F.col("__rank") < FILES) & line.between(0, LINES - 1)
    number = F.lit(source * FILES * LINES) + F.col("__rank") * LINES + line
    checked = F.when(fits, number).otherwise(F.raise_error(F.lit("row order does not fit 63 bits")).cast("long"))
    return raw.join(F.broadcast(ranks), raw["source_file"].eqNullSafe(ranks["__file"])).withColumn(ROW_ORDER, checked).drop("__file", "__rank")
