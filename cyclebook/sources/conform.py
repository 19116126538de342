"""Bring tables of varying shape to a known one."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclebook.functions.text import has_text
from cyclebook.schema import PROVENANCE, ROW_PLACES, TRADE_SCHEMA

# Older spellings of one header, per target name.
HEADER_ALIASES = {"gtc_s": ("gtcs", "g_t_c_s")}


def clean_name(header: str) -> str:
    """snake_case form of one header."""
    text = header.lstrip("﻿").strip().replace("'", "").replace('"', "")
    text = text.replace("%", "_percent_").replace("#", "_number_")
    text = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", text)
    text = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", text)
    text = re.sub(r"[^0-9A-Za-z]+", "_", text).strip("_").lower()
    if not text:
        return "x"
    return f"x{text}" if text[0].isdigit() else text


def clean_names(headers: Sequence[str]) -> list[str]:
    """snake_case headers; repeats get ``_2``, ``_3`` and so on."""
    seen: dict[str, int] = {}
    out = []
    for name in map(clean_name, headers):
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out


def rename_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]] = HEADER_ALIASES) -> DataFrame:
    """Give known header variants their one name."""
    for target, variants in aliases.items():
        for variant in variants:
            if variant in df.columns and target not in df.columns:
                df = df.withColumnRenamed(variant, target)
    return df


def add_missing_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    absent = {c: F.lit(None).cast("string") for c in cols if c not in df.columns}
    return df.withColumns(absent) if absent else df


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Drop rows that are blank in every data column (provenance does not count)."""
    data = [c for c in df.columns if c not in (*PROVENANCE, *ROW_PLACES, "source_sheet", "broker")]
    return df.filter(reduce(lambda a, b: a | b, [has_text(f"`{c}`") for c in data]))


def coerce_schema(df: DataFrame, schema: T.StructType = TRADE_SCHEMA) -> DataFrame:
    """Exactly the columns of ``schema``, in order and typed; bad values become null.

    The number for the order of rows stays behind them where the table has it.
    """
    kept = [c for c in ROW_PLACES[:1] if c in df.columns and c not in schema.fieldNames()]
    return df.select(*[
        (F.col(f.name) if df.schema[f.name].dataType == f.dataType
         else F.col(f.name).try_cast(f.dataType)).alias(f.name)
        for f in schema.fields], *kept)


def empty_table(spark: SparkSession, schema: T.StructType = TRADE_SCHEMA) -> DataFrame:
    return spark.createDataFrame([], schema)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column absent from a part is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_all_sheets(sheets: Mapping[str, DataFrame]) -> DataFrame:
    """Union the tables of one source, tagged with their ``source_sheet``."""
    return union_all([df.withColumn("source_sheet", F.lit(name)) for name, df in sheets.items()])
