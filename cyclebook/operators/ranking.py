"""Newest-version, first-per-key and duplicate-copy operators.

All of them stay balanced when one key holds a large share of the rows:
``row_number() == 1`` is cut to one row per key and task before the shuffle
(Spark's window group limit), rows that must not compete with each other get a
key of their own, and group facts come from partial aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OWN = "__own"  # a row's key in a bucketed table
HOT_ROWS = 1_000_000
_RANK, _APART, _FIRST, _FACT = "__rank", "__apart", "__first", "__fact_"
_KEY = ["__key_a", "__key_b"]
MAX_MARKS = 500_000  # fixed-width keys that are broadcast: some 30 MB
_PART_BITS = 33  # of monotonically_increasing_id: the row's place in its partition

Keep = Callable[[DataFrame, str], DataFrame]  # writes a table to a shared folder and reads it again
KeepBy = Callable[[DataFrame, str, str, int], tuple[DataFrame, DataFrame]]  # the same in buckets of a key, and without


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
               apart: Column | None = None, row_id: Sequence[str] = ()) -> DataFrame:
    """First row of every key in the given order.

    Rows for which ``apart`` holds are all kept. Each becomes a key of its own,
    told apart by the ``row_id`` columns, so blank keys neither collapse nor
    gather in one task and a repeated task sends every row the same way.
    """
    if apart is not None:
        df = df.withColumn(_APART, F.when(apart, F.struct(*row_id)))
        keys = [*keys, _APART]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, rank).filter(F.col(_RANK) == 1).drop(_RANK, _APART)


def keep_first_stored(df: DataFrame, key: str, order: Sequence[Column], keep_by: KeepBy, buckets: int,
                      apart: Column | None = None, place: Column | None = None) -> DataFrame:
    """``keep_first`` of one key column over rows that are written once, in ``buckets`` buckets of the key.

    No row is shuffled. Rows for which ``apart`` holds are told apart by ``place``. The result also has the
    key or place as ``OWN``: a join by it moves the other side alone. The rows of a key with more
    than ``HOT_ROWS`` would fill one task; they are read in splits and each task cuts them to one.
    """
    apart = F.lit(False) if apart is None else apart
    own = F.col(key) if place is None else F.when(apart, place).otherwise(F.col(key))
    keyed = df.withColumns({OWN: own, _APART: apart, key: F.when(apart, F.col(key))})
    placed, spread = keep_by(keyed, "versions", OWN, buckets)
    hot = [r[0] for r in placed.groupBy(OWN).count().filter(F.col("count") > HOT_ROWS).select(OWN).collect()]
    chosen = _first_of(placed, order)
    if hot:
        among = F.coalesce(F.col(OWN).isin([k for k in hot if k is not None]), F.lit(None in hot))
        chosen = _first_of(placed.filter(~among), order).unionByName(_first_of(spread.filter(among), order))
    return chosen.withColumn(key, F.when(F.col(_APART), F.col(key)).otherwise(F.col(OWN))).drop(_APART)


def _first_of(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(OWN, _APART).orderBy(*order))
    return rows.withColumn(_RANK, rank).filter(F.col(_RANK) == 1).drop(_RANK)


def file_order() -> list[Column]:
    """Newest file first, then the order in which the rows were read."""
    return [F.col("source_file_modified").desc_nulls_last(), F.col("source_file").asc(),
            F.col("source_block").asc(), F.col("source_row").asc()]


def null_safe_equal(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[l].eqNullSafe(right[r]) for l, r in pairs])


def key_hash(columns: Sequence[str]) -> dict[str, Column]:
    """A fixed-width 128-bit key of the columns, nulls and their places included, as two whole numbers.

    Two rows that differ share it with a chance of 2^-128; shuffles, joins and aggregates on it move and
    compare two numbers instead of all texts.
    """
    nulls = F.lit(0)
    for i, c in enumerate(columns):
        nulls = nulls + F.when(F.col(c).isNull(), 1 << i).otherwise(0)
    return {_KEY[0]: F.xxhash64(nulls, *columns), _KEY[1]: F.xxhash64(F.lit("2"), *columns, nulls)}


def mark_rows(df: DataFrame, keys: Sequence[str], marks: DataFrame, name: str, counted: bool) -> DataFrame:
    """``df`` with ``name``: whether its keys are among the distinct keys of ``marks``.

    Where counting them is cheap (``counted``), up to ``MAX_MARKS`` fixed-width keys are broadcast, so that no
    row moves; more, or uncounted ones, meet the rows in a shuffled hash join, whose row side Spark
    may split.
    """
    few = counted and marks.limit(MAX_MARKS + 1).count() <= MAX_MARKS
    flagged = marks.select(*[F.col(k).alias(_FACT + k) for k in keys], F.lit(True).alias(name))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(_FACT + k) for k in keys])
    out = df.join(flagged.hint("broadcast" if few else "shuffle_hash"), same, "left")
    return out.withColumn(name, F.coalesce(name, F.lit(False))).drop(*[_FACT + k for k in keys])


def split_by_flag(df: DataFrame, keys: Sequence[str], flag: str, keep: Keep | None = None,
                  columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows whose key has a flagged row, and the others, both with a 128-bit key.

    Where ``columns`` names what is needed later, nothing else is written or moved. With ``keep`` the rows
    are written once, equal ones of a task next to each other, and read again: their narrow keys for the
    flagged set, and the rows themselves, of which none is shuffled as long as the set is small. Without
    it all of it is computed anew for each.
    """
    keyed = df.withColumns(key_hash(keys))
    if columns is not None:
        keyed = keyed.select(*dict.fromkeys([*columns, flag]), *_KEY)
    if keep is not None:
        keyed = keep(keyed.sortWithinPartitions(*_KEY), "copies")
    marks = keyed.filter(flag).select(*_KEY).distinct()
    marked = mark_rows(keyed, _KEY, marks, _FIRST, keep is not None)
    return marked.filter(_FIRST).drop(_FIRST), marked.filter(~F.col(_FIRST)).drop(_FIRST)


def collapse_copies(df: DataFrame, keys: Sequence[str], flag: str,
                    order: Sequence[Column], keep: Keep | None = None,
                    columns: Sequence[str] | None = None) -> DataFrame:
    """Of rows equal on ``keys`` keep one when any of them carries ``flag``; of their columns, those named.

    Groups without a flagged row keep every row and are never ranked or moved. ``order`` decides the
    survivor of the others; each task cuts a group to its first row before they meet.
    """
    copies, rest = split_by_flag(df, keys, flag, keep, columns)
    return keep_first(copies, _KEY, order).unionByName(rest).drop(*_KEY)


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank: str, size: str,
                keep: Keep) -> DataFrame:
    """``row_number()`` and row count per key, for keys of any size.

    All rows are numbered in the order of (keys, order), which spreads a key over as many tasks as its
    rows need; a key's ranks begin at its first number. Up to ``MAX_MARKS`` keys are broadcast to the
    rows, more meet them in a shuffle.
    """
    placed = numbered(df, [*[F.col(k) for k in keys], *order], rank, keep)
    firsts = keep(placed.groupBy(*[F.col(k).alias(_FACT + k) for k in keys]).agg(
        F.min(rank).alias("__from"), F.count(F.lit(1)).alias(size)), "firsts")
    if firsts.limit(MAX_MARKS + 1).count() <= MAX_MARKS:
        firsts = F.broadcast(firsts)
    same = null_safe_equal(placed, firsts, [(k, _FACT + k) for k in keys])
    return (placed.join(firsts, same).withColumn(rank, F.col(rank) - F.col("__from") + 1)
            .drop("__from", *[_FACT + k for k in keys]))


def numbered(df: DataFrame, order: Sequence[Column], name: str,
             keep: Keep) -> DataFrame:
    """``df`` with ``name``, each row's place from 0 in one total order.

    One range partitioning by ``order`` and a sort inside the partitions; then the sizes of the
    partitions before are added. There is one size for each partition, which bounds the broadcast.
    Equal rows may swap places. ``keep`` writes a table and reads it again (``stage``), because a range
    partitioning that ran twice could cut elsewhere.
    """
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = keep(sorted_.withColumn(name, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(name, _PART_BITS)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"))
    inside = F.col(name).bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    return (placed.withColumn("__part", part).join(F.broadcast(offsets), "__part")
            .withColumn(name, F.col("__offset") + inside).drop("__part", "__offset"))


def nulls_last(c: Column) -> list[Column]:
    """Sort parts that put nulls behind every value."""
    return [c.isNull(), c]
