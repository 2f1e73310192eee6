"""Queries of this subpackage against their SQL, and the pipeline against its operators one by one."""

import oracle
import pytest

import __spark_entry__ as spark_entry
import corpus_pipeline
from msgstream.llm import linededup, mixing, neardup, registry
from msgstream.llm.common import table

SF = f"{oracle.TESTDATA}/sf0.001"


@pytest.mark.parametrize("name", list(registry.ORACLES))
def test_query_matches_sql(spark, name):
    columns, rows = oracle.spark_rows(registry.QUERIES[name](spark, SF))
    assert (columns, rows) == oracle.duck_rows(oracle.duck(SF), registry.ORACLES[name])


def test_every_query_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*registry.QUERIES, "pipeline"} <= spark_entry.queries().keys()


def test_pipeline_stage_by_stage(spark):
    docs = table(spark, SF, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]
    stage = dict(corpus_pipeline.STAGES)
    toxic = {r.doc_id for r in registry.op10_toxicity_chain(spark, SF).collect() if r.rejected}
    one = stage["toxicity"](spark, docs, SF).cache()
    assert {r.doc_id for r in docs.select("doc_id").collect()} - {r.doc_id for r in one.collect()} == toxic
    two = stage["line_dedup"](spark, one, SF).cache()
    assert sorted((r.doc_id, r.text) for r in two.collect()) == sorted(
        (r.doc_id, r.text) for r in linededup.without_boilerplate(one).collect()
    )
    three = stage["near_dedup"](spark, two, SF).cache()
    judged = neardup.near_duplicates(two).collect()
    assert sorted(r.doc_id for r in three.collect()) == sorted(r.doc_id for r in judged if r.kept)
    four = stage["mixing"](spark, three, SF).cache()
    copies = {r.doc_id: r.copies for r in mixing.mixture(three).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in four.groupBy("doc_id").count().collect()} == copies
    assert all(df.columns == docs.columns for df in (one, two, three, four))
    five = stage["packing"](spark, four, SF)
    tokens = {r.doc_id: r.doc_tokens for r in five.collect()}
    assert tokens.keys() == copies.keys()
    whole = sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "doc_tokens").distinct().collect()))
    assert whole == sorted(tokens.items())
    for df in (one, two, three, four):
        df.unpersist()


def test_stages_take_empty_tables(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []
