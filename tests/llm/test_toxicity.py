import random

import pytest
from conftest import words

from msgstream.llm import registry, toxicity
from msgstream.llm.common import table

SF = "/root/testdata/sf0.01"
STEMS = ["zorgl", "blarf"]


def corpus(n, seed):
    """(doc_id, text, toxic, low quality): toxic texts hold an inflected stem, poor ones many marks."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        own = words(seed * 1000 + i, rng.randint(20, 60))
        toxic, poor = i % 5 == 0, i % 7 == 0
        for _ in range(3 * toxic):
            own.insert(rng.randrange(len(own)), rng.choice(STEMS) + rng.choice(["a", "en", "schaft", "ing", "ó"]))
        if poor:
            own += ["lorem", "ipsum"] * 3
        rows.append((i, " ".join(own), int(toxic), int(not poor)))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t, f"src{i % 3}", "odd") for i, t, _, _ in rows], "doc_id long, text string, source string, rejected string")
    labels = spark.createDataFrame([(i, q, t) for i, _, t, q in rows], "doc_id long, quality int, toxic int")
    return docs, labels


def test_unseen_documents(spark):
    seen, unseen = corpus(400, 1), corpus(150, 2)
    chain = toxicity.fit_chain(*frames(spark, seen))
    wrong = [r for r in unseen if (chain.probabilities(r[1])[1] >= chain.threshold) != r[2]]
    poor = [r for r in unseen if (chain.probabilities(r[1])[0] >= 0.5) == r[3]]
    assert len(wrong) <= 2 and len(poor) <= 2
    assert chain.categories == ["low_quality", "toxic"] and len(chain.models[1].earlier) == 1


def test_query_finds_labelled_toxic_documents(spark):
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    rows = registry.op10_toxicity_chain(spark, SF).collect()
    assert len(rows) == table(spark, SF, "documents").count()
    wrong = sum(r.rejected != labels[r.doc_id] for r in rows if r.doc_id in labels)
    assert wrong <= 0.01 * len(labels)
    assert all(0 <= r.p_toxic <= 1 and 0 <= r.p_low_quality <= 1 for r in rows)


def test_odd_rows(spark):
    rows = corpus(200, 3)
    docs, labels = frames(spark, rows)
    odd = spark.createDataFrame(
        [(900, None, None, "x"), (901, "", "s", "x"), (902, "123 !!", "s", "x"), (None, "zorgla blarfen and a zorglschaft of blarfing", "s", "x"), (903, "word " * 60_000, "s", "x"), (0, rows[0][1], "s", "x")],
        docs.schema,
    )
    labels = labels.union(spark.createDataFrame([(None, 1, 1), (5, None, None), (5, 1, 0), (99999, 1, 1)], labels.schema))
    judged = toxicity.judged(docs.union(odd), labels)
    assert judged.columns == ["doc_id", "text", "source", "p_low_quality", "p_toxic", "rejected"]
    result = [r for r in judged.collect() if r.doc_id is None or r.doc_id >= 900]
    assert {r.doc_id: r.rejected for r in result} == {900: False, 901: False, 902: False, None: True, 903: False}
    kept = toxicity.accepted(docs.union(odd), labels)
    assert kept.columns == docs.columns and kept.count() == judged.where("not rejected").count()


@pytest.mark.parametrize("toxic", [None, 0, 1])
def test_labels_of_one_class_or_none(spark, toxic):
    docs, labels = frames(spark, corpus(30, 4))
    labels = labels.selectExpr("doc_id", "1 AS quality", f"{toxic} AS toxic") if toxic is not None else labels.limit(0)
    rows = toxicity.judged(docs, labels).collect()
    assert {(r.p_low_quality, r.p_toxic) for r in rows} == {(0.0, float(toxic or 0))}
    assert {r.rejected for r in rows} == {bool(toxic)}
    assert toxicity.judged(docs.limit(0), labels).collect() == []


def test_the_task_that_fits_gets_places_in_the_vocabulary_only(spark, monkeypatch):
    docs, labels = frames(spark, corpus(60, 5))
    columns, sort = [], type(docs).sortWithinPartitions
    monkeypatch.setattr(type(docs), "sortWithinPartitions", lambda self, *by, **more: columns.append(dict(self.dtypes)) or sort(self, *by, **more))
    toxicity.fit_chain(docs, labels, size=20)
    assert columns and all("array<string>" not in kinds.values() and kinds["held"] == "array<int>" for kinds in columns)


def test_places_are_those_of_the_tokens_in_the_vocabulary(spark):
    rows = [(1, ["a", "c", "z"]), (2, []), (3, ["x"]), (4, ["b", "c"])]
    df = spark.createDataFrame(rows, "fold int, tokens array<string>").coalesce(1)
    assert [tuple(r) for r in toxicity._with_places(df, ["a", "b", "c"]).collect()] == [(1, [0, 2]), (2, []), (3, []), (4, [1, 2])]
