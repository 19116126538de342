"""Result writers. Every sink stays a distributed write."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


CODEC = "zstd"  # of stored and scratch tables: some two thirds of the bytes of Spark's default
MAX_BUCKETS, BUCKET_ROWS = 128, 50_000  # of a scratch table laid out by a key; a task writes a file for each bucket


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", CODEC).parquet(path)


def write_grouped(df: DataFrame, path: str, *parts: str) -> None:
    """Parquet partitioned by ``parts``, few values such as index groups or buckets.

    Each task writes a file for every value that it holds, so a group that holds most rows is spread as the
    rows are and no row is moved.
    """
    df.write.mode("overwrite").option("compression", CODEC).partitionBy(*parts).parquet(path)


def staging_folder(spark: SparkSession) -> str | None:
    """The folder of ``spark.checkpoint.dir``, for callers that want their staging there."""
    return spark.conf.get("spark.checkpoint.dir", None)


_local_scratch: list[str] = []


def scratch_folder(spark: SparkSession) -> str | None:
    """The session's staging folder; where one machine runs everything, a temporary one will do."""
    named = staging_folder(spark)
    if named is None and spark.conf.get("spark.master", "local").split("[")[0] == "local":
        if not _local_scratch:
            _local_scratch.append(tempfile.mkdtemp(prefix="cyclebook-"))
        return _local_scratch[0]
    return named


def scratch(spark: SparkSession) -> Callable[[DataFrame, str], DataFrame] | None:
    """Writes a table to the scratch folder and reads it again; None where there is no such folder."""
    folder = scratch_folder(spark)
    return None if folder is None else lambda df, name: stage(df, name, folder)


def scratch_by(spark: SparkSession) -> Callable[[DataFrame, str, str, int], tuple[DataFrame, DataFrame]] | None:
    """The same, laid out in buckets of a key column; see ``stage_by``."""
    folder = scratch_folder(spark)
    return None if folder is None else lambda df, name, key, buckets: stage_by(df, name, folder, key, buckets)


_passing: list[list[str]] = []


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Removes the scratch tables written inside, for callers that have stored what is made of them."""
    _passing.append([])
    try:
        yield
    finally:
        for path in _passing.pop():
            _empty(spark, path)


def _empty(spark: SparkSession, path: str) -> None:
    spark.range(0).coalesce(1).write.mode("overwrite").parquet(path)


def _new_path(name: str, folder: str, lasting: bool) -> str:
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _passing and not lasting:
        _passing[-1].append(path)
    return path


def check_shared(spark: SparkSession, folder: str) -> None:
    """Refuse a folder that is local to each machine of a cluster.

    A plain path or ``file:`` is only shared where one machine runs everything, or where it is the
    folder that the cluster itself names as shared.
    """
    named = staging_folder(spark)
    local = folder.startswith(("file:", "/")) and not (named and folder.startswith(named))
    if local and spark.conf.get("spark.master", "local").split("[")[0] not in ("local", "local-cluster"):
        raise ValueError(f"{folder} is not shared by the machines of this cluster")


def stage(df: DataFrame, name: str, folder: str | None, lasting: bool = False) -> DataFrame:
    """Materialize a table that is read more than once, to spare its recomputation.

    It goes to a new table in the shared ``folder``; ``drop_staged`` removes what it holds, and so does the
    end of ``passing`` unless it is ``lasting``. Without a folder the table stays lazy: slower, but just as right.
    """
    if folder is None:
        return df
    spark = df.sparkSession
    check_shared(spark, folder)
    path = _new_path(name, folder, lasting)
    df.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path).withMetadata(df.columns[0], {"staged": path})


def bucket_count(df: DataFrame) -> int:
    """Buckets for the rows of a table; counting them reads none of its columns."""
    return min(df.count() // BUCKET_ROWS + 1, MAX_BUCKETS)


def stage_by(df: DataFrame, name: str, folder: str, key: str, buckets: int) -> tuple[DataFrame, DataFrame]:
    """A table in buckets of the column ``key``, and the same rows without that layout.

    Windows and joins by the key find its rows together and move none. Stored by columns, rows take about a
    quarter of what a shuffle writes. Its name in the catalog goes again at once; the files stay.
    """
    spark = df.sparkSession
    check_shared(spark, folder)
    path, table = _new_path(name, folder, False), f"{name}_{uuid.uuid4().hex}"
    (df.write.format("parquet").option("compression", CODEC).option("path", path)
     .bucketBy(buckets, key).saveAsTable(table))
    placed = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return placed, spark.read.schema(placed.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Remove the rows of a staged table once nothing reads it; lazy tables are left alone."""
    path = df.schema[0].metadata.get("staged")
    if path:
        df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """A stored table, or None when it does not exist."""
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        table = reader.parquet(path)
    except AnalysisException as err:
        if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return table.select(*schema.fieldNames()) if schema is not None else table
