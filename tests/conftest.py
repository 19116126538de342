import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T  # noqa: E402

from cyclebook.schema import RAW_COLUMNS, RULE_COLUMNS  # noqa: E402
from cyclebook.session import local_session  # noqa: E402
from cyclebook.sources import sinks  # noqa: E402

SF = "/root/testdata/sf0.001"
EARLY, LATE = dt.datetime(2026, 6, 1), dt.datetime(2026, 6, 30)


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="4g", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def keep(tmp_path):
    """Writes a table and reads it again."""
    return lambda df, name: sinks.stage(df, name, str(tmp_path))


@pytest.fixture(scope="session")
def text_table(spark):
    """One text column ``x`` with the given values."""
    def make(*values):
        return spark.createDataFrame([(v,) for v in values], "x string")
    return make


@pytest.fixture(scope="session")
def raw_rows(spark):
    """Raw export rows of one broker; unnamed columns are null."""
    def make(broker, *rows):
        names = list(dict.fromkeys([*RAW_COLUMNS[broker], *(k for r in rows for k in r
                                                            if not k.startswith("_"))]))
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names] + [
            T.StructField("source_file", T.StringType()),
            T.StructField("source_file_modified", T.TimestampType()),
            T.StructField("source_block", T.LongType()),
            T.StructField("source_row", T.LongType())])
        data = [tuple(r.get(n) for n in names)
                + (r.get("_file", "a.csv"), r.get("_modified", EARLY), 0, i)
                for i, r in enumerate(rows)]
        return spark.createDataFrame(data, schema)
    return make


@pytest.fixture(scope="session")
def rule_rows(spark):
    def make(*rows):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in RULE_COLUMNS])
        return spark.createDataFrame([tuple(r.get(c) for c in RULE_COLUMNS) for r in rows], schema)
    return make


@pytest.fixture(scope="session")
def calendar_rows(spark):
    def make(*rows):
        return spark.createDataFrame(
            [(*r, None) for r in rows],
            "delivery_month string, trade_cycle_start string, trade_cycle_end string,"
            " period_label string")
    return make


def by(df, key, *columns):
    """Rows as {key: tuple of columns}."""
    return {r[key]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]]
            for r in df.collect()}
