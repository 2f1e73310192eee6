"""Tables whose extra columns have the names that operators use inside."""

import pytest
from conftest import text
from pyspark.sql import functions as F

from msgstream.llm import linededup, mixing, neardup, surrogates, toxicity

LINE = "a line of more than twenty characters, on many sites"
INSIDE = {
    "mixed": ["copies", "size", "_id", "_size", "_source", "_words", "_copy", "target", "source_size", "bucket", "mass", "extra0"],
    "one_of_each": ["hi", "lo", "_gone", "_text", "_n", "kept", "key", "words", "component_id", "n_shingles", "id"],
    "without_boilerplate": ["gone", "_key", "_key2", "_mine", "line", "at", "key", "first_id", "site", "lines_removed", "extra3"],
    "replaced": ["_known", "_key", "_shown", "kind", "canonical", "entity", "surrogate", "at", "key", "entities", "doc_id"],
    "accepted": ["p_toxic", "p_low_quality", "rejected", "toxic", "quality", "key", "tokens", "fold", "n", "c0"],
}


@pytest.fixture
def operators(spark):
    labels = spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(40)], "doc_id long, quality int, toxic int")
    return {
        "mixed": mixing.mixed,
        "one_of_each": neardup.one_of_each,
        "without_boilerplate": linededup.without_boilerplate,
        "replaced": surrogates.replaced,
        "accepted": lambda docs: toxicity.accepted(docs, labels),
    }


@pytest.mark.parametrize("name", list(INSIDE))
def test_extra_columns_come_through(spark, operators, name):
    """The same rows as without the extra columns, each with its own values in them."""
    rows = [(i, f"{text(i % 30, 40)}\n{LINE} Mr John Smith, a{i}@b.org", f"s{i % 6}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    names = [n for n in INSIDE[name] if n not in docs.columns]
    extra = docs.withColumns({n: F.concat(F.lit(f"{n} of "), F.col("doc_id")) for n in names})
    plain, found = operators[name](docs), operators[name](extra)
    made = [c for c in plain.columns if c not in docs.columns]
    kept = [n for n in names if n not in made]
    assert sorted(found.columns) == sorted([*docs.columns, *kept, *made])
    order = ["doc_id", "text", "source", *made]
    assert sorted(map(tuple, found.select(order).collect())) == sorted(map(tuple, plain.select(order).collect()))
    for row in found.select("doc_id", *kept).collect():
        assert list(row)[1:] == [f"{n} of {row.doc_id}" for n in kept]
