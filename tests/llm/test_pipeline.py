import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from __spark_entry__ import oracle_sql, queries
from cyclebook.llm import decontaminate, pii, quality, simhash
from cyclebook.llm.queries import QUERIES
from tests.conftest import SF
from workload.compare import connect, differences

ALL = [(k, sql) for k, (_, sql) in QUERIES.items()]


def test_each_operator_has_one_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert "pipeline" in queries() and "pipeline" not in oracle_sql()


@pytest.mark.parametrize("name", [k for k, sql in ALL if sql])
def test_queries_equal_their_sql(spark, name):
    fn, sql = QUERIES[name]
    assert differences(fn(spark, SF), connect(SF), sql) == []


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in C.STAGES:
        out.append(C.staged(stage(spark, out[-1], SF), name))
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_call_the_operators_in_order(stages, spark):
    docs, good, single, clean, masked, coded = stages
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination",
                                        "personal_data", "sentencepiece"]
    for df in (good, single, clean, masked):
        assert df.schema == docs.schema
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert ids(good) == ids(quality.sample_keys(docs, labels).filter("kept"))
    groups = simhash.near_duplicates(good)
    assert ids(single) == ids(groups.filter("doc_id = component_id"))
    hits = decontaminate.benchmark_hits(single, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert ids(clean) == ids(hits.filter(F.size("hit_spans") == 0))
    assert ids(masked) == ids(clean) == ids(coded)
    assert masked.filter("text like '%[email]%'").count() > 0
    assert pii.personal_data(masked).filter("n_email + n_ip + n_card + n_phone > 0").count() == 0
    assert coded.filter("decoded != text").count() == 0


def test_stages_send_few_texts_at_a_time(stages, spark):
    """A batch of a stage's Python workers has few megabytes, however many rows that is."""
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "bytes"])

    wide = spark.range(0, 6000, 1, 1).select(F.lit("x" * 4000).alias("text"))
    found = wide.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r.rows for r in found) == 6000 and max(r.bytes for r in found) < 5_000_000
    slim = spark.range(0, 6000, 1, 1).mapInArrow(sizes, "rows long, bytes long").collect()
    assert max(r.rows for r in slim) <= 2048


CLASHING = ["__id", "__hash", "__w", "__spans", "__place", "__gone", "__salt", "__row", "__text", "sample_key", "log_weight", "low",
            "rows", "fingerprint", "component_id", "old_spans", "old_items", "__old", "y", "terms", "block"]


@pytest.mark.parametrize("name", [n for n, _ in C.STAGES])
def test_stages_on_odd_rows_and_clashing_columns(spark, name):
    """Nulls, empty and long texts, repeated rows and ids; other columns come through as they are."""
    words = " ".join(f"w{i % 977}" for i in range(40_000))
    rows = [(None, None), (None, "a b c"), (1, None), (2, ""), (3, "mail a.b@c.de or 10.1.2.3 now"), (3, "mail a.b@c.de or 10.1.2.3 now"),
            (3, "other text of that id"), (4, words), (5, words + " end"), (6, "plain words here"), (7, " \t\n")]
    table = spark.createDataFrame([(*r, *range(len(CLASHING))) for r in rows],
                                  "doc_id long, text string, " + ", ".join(f"`{c}` int" for c in CLASHING))
    stage = dict(C.STAGES)[name]
    out = stage(spark, table, SF)
    assert out.columns[:len(table.columns)] == table.columns
    got = out.collect()
    assert all(tuple(r[c] for c in CLASHING) == tuple(range(len(CLASHING))) for r in got)
    assert {r.doc_id for r in got} <= {r[0] for r in rows}
    if name != "quality_classifier":
        assert sum(r.doc_id is None for r in got) == 2 and any(r.doc_id == 6 for r in got)
    if name == "personal_data":
        assert sorted(r.text or "" for r in got if r.doc_id == 3) == ["mail [email] or [ip] now"] * 2 + ["other text of that id"]
    if name == "simhash_near_dedup":
        assert sorted(r.doc_id for r in got if r.doc_id) == [1, 3, 4, 6]


@pytest.mark.parametrize("name", [n for n, _ in C.STAGES])
def test_stages_on_an_empty_table(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert dict(C.STAGES)[name](spark, docs, SF).count() == 0


def test_run_is_the_last_stage(stages, spark):
    row = lambda df: sorted(map(str, df.collect()))
    assert row(C.run(spark, SF)) == row(stages[-1])
