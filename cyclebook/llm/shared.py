"""What the operators share: the shared folder, staged tables, files and Arrow batches.

Staged tables cut lineage and are read by more than one step. They live in the folder that
the session names in ``spark.checkpoint.dir``, which every executor can reach, so a lost
executor costs a task and never a table.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ROWS = 2048  # rows whose Python values a task holds at a time
# Batches of whole texts are held by the executor and by its Python worker, some at a time and in both directions.
SMALL_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(ROWS),
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}

_local_root: list[str] = []


def for_whole_texts(spark: SparkSession) -> None:
    """Settings of a session that sends whole texts to Python workers in several steps."""
    for key, value in SMALL_BATCHES.items():
        spark.conf.set(key, value)


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a one-machine session may do without."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="cyclebook-"))
    return _local_root[0]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apart(df: DataFrame, *own: str) -> DataFrame:
    """``df`` with all columns but ``own`` under names that no operator uses; ``toDF`` gives the old ones back."""
    return df.toDF(*[c if c in own else f"__column_{i}" for i, c in enumerate(df.columns)])


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file name as Spark writes it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def write_file(uri: str, parts: Iterable[bytes]) -> None:
    system, path = filesystem(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        for part in parts:
            out.write(part)


def open_file(uri: str) -> pa.NativeFile:
    system, path = filesystem(uri)
    return system.open_input_file(path)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; null counts as empty."""
    return column.fill_null("").cast(pa.binary()).to_pylist()


def texts(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def schema_of(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl) if hasattr(T, "_parse_datatype_string") else \
        T.StructType.fromDDL(ddl)


def add_columns(df: DataFrame, ddl: str,
                compute: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """``df`` with the columns of ``ddl``, which ``compute`` makes from each Arrow batch.

    A column of ``df`` that has the name of a new one is replaced by it.
    """
    new = schema_of(ddl)
    clash = {n.lower() for n in new.names}
    base = df.drop(*[c for c in df.columns if c.lower() in clash])
    schema = T.StructType(base.schema.fields + new.fields)
    names = schema.names

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                yield pa.RecordBatch.from_arrays([*part.columns, *compute(part)], names=names)

    return base.mapInArrow(run, schema)
