"""Every query against its SQL, over whole tables."""

import oracle
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as spark_entry
from msgstream.plans import registry

SF = f"{oracle.TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.duck(SF)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_matches_sql(spark, duck, name):
    columns, rows = oracle.spark_rows(registry.QUERIES[name](spark, SF))
    expected_columns, expected = oracle.duck_rows(duck, registry.ORACLES[name])
    assert columns == expected_columns
    assert rows == expected
    if name != "global_count_of_none":
        assert rows


def test_all_of_them_are_registered():
    assert registry.QUERIES.keys() <= spark_entry.queries().keys()
    assert registry.QUERIES.keys() == registry.ORACLES.keys()


def test_entry(spark):
    result = spark_entry.entry(spark)
    assert result.columns == ["window_start", "word", "count"]
    assert not result.isEmpty()


@pytest.mark.parametrize("name", ["word_count_4s_dedup", "word_totals", "stream_word_count", "job_drain", "read_max_records"])
def test_tables_of_many_files(spark, duck, folder, name):
    """A table may be a folder of files; streams then take all of them in."""
    path = folder("tables")
    for table in ("events", "documents"):
        spark.read.parquet(f"{SF}/{table}.parquet").repartition(9).write.parquet(f"{path}/{table}.parquet")
    rows = oracle.spark_rows(registry.QUERIES[name](spark, path))
    assert rows == oracle.duck_rows(duck, registry.ORACLES[name])


def test_streamed_words_of_far_apart_ids(spark, tmp_path):
    """Ids 700 days of seconds apart, in more files than three batches read."""
    rows = [(i if i >= 20 else 60_480_000 + i, f"word{i} both", "de", f"source{i:02d}", 10) for i in range(40)]
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    pq.write_table(pa.table({n: [r[i] for r in rows] for i, n in enumerate(names)}), f"{tmp_path}/documents.parquet")
    columns, found = oracle.spark_rows(spark_entry.queries()["stream_word_count"](spark, str(tmp_path)))
    assert (columns, found) == oracle.duck_rows(oracle.duck(str(tmp_path)), spark_entry.oracle_sql()["stream_word_count"])
