import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from msgstream.llm import mixing, registry
from msgstream.llm.common import table

SF = "/root/testdata/sf0.001"


def targets(sizes):
    """Shares by weight, ceilings at three times a source's size, the excess shared again until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    result, open_ones, left = {}, set(order), float(sum(sizes.values()))
    while open_ones:
        total = sum(weight[s] for s in open_ones)
        above = {s for s in open_ones if left * weight[s] / total > 3 * sizes[s]}
        if not above:
            return result | {s: left * weight[s] / total for s in open_ones}
        for s in above:
            result[s] = 3.0 * sizes[s]
            left -= result[s]
        open_ones -= above
    return result


def check(rows, sources, near):
    sizes, taken = {}, {}
    for r in rows:
        source = sources[r.doc_id]
        sizes[source] = sizes.get(source, 0) + r["size"]
        taken[source] = taken.get(source, 0) + r.taken
        assert r["size"] == 0 or (r.taken % r["size"] == 0 and r.taken <= 3 * r["size"])
    wanted = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[sources[r.doc_id]]
        assert r.target == pytest.approx(wanted[sources[r.doc_id]])
    for source, target in wanted.items():
        assert taken[source] == pytest.approx(target, rel=near, abs=30)
    assert sum(wanted.values()) == pytest.approx(sum(sizes.values()))


def test_query(spark):
    rows = registry.op4_pivotal_mixing(spark, SF).collect()
    docs = table(spark, SF, "documents")
    assert len(rows) == docs.count()
    check(rows, dict(docs.select("doc_id", "source").collect()), 0.1)
    assert sorted(rows) == sorted(registry.op4_pivotal_mixing(spark, SF).collect())


def test_words_are_counted_whole(spark):
    texts = ["", " ", "a", " a  b\t\nc ", " x y z", None, "a\x0bb\x0cc\rd"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(mixing.word_count(F.col("text"))).collect()] == [0, 0, 1, 3, 2, 0, 4]


def test_odd_rows(docs):
    rows = [(1, "a b c", "z"), (2, None, "z"), (3, "", None), (None, "x y", "z"), (4, "p q r s", None), (4, "p q r s", None)]
    result = mixing.mixture(docs(rows)).collect()
    assert sorted((r.doc_id or 0, r["size"]) for r in result) == [(0, 2), (1, 3), (2, 0), (3, 0), (4, 4), (4, 4)]
    assert all(r.taken <= 3 * r["size"] for r in result)
    assert mixing.mixture(docs([])).collect() == []
    only = mixing.mixture(docs([(1, None, "a")])).collect()[0]
    assert (only.target, only.taken) == (0.0, 0)


def test_tree_of_many_groups(docs):
    """Small groups, so that residuals go up several levels; a third of all rows is one source."""
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(1, 60), "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(1500)]
    mix = mixing.copies(mixing.sized(docs(rows).drop("size")), fan=16).collect()
    sizes, taken, target = {}, {}, {}
    for r in mix:
        sizes[r.source] = r.source_size
        target[r.source] = r.target
        taken[r.source] = taken.get(r.source, 0) + r.copies * r["size"]
    for source, wanted in targets(sizes).items():
        assert target[source] == pytest.approx(wanted)
        assert taken[source] == pytest.approx(wanted, rel=0.02)


def test_pivot_keeps_sum_and_expectation():
    room = np.array([5.0, 3.0, 8.0, 2.0, 1.0, 4.0])
    mass, total = room * 0.3, np.zeros(6)
    for seed in range(4000):
        rounded, left = mixing.pivot(mass, room, np.random.default_rng(seed))
        assert rounded.sum() == pytest.approx(mass.sum())
        assert all(x in (0.0, r) or i == left for i, (x, r) in enumerate(zip(rounded, room, strict=True)))
        total += rounded
    assert total / 4000 == pytest.approx(mass, abs=0.2)


def test_mixed_documents_keep_their_columns(docs):
    given = docs([(i, "some words here", f"s{i % 4}") for i in range(40)])
    mixed = mixing.mixed(given)
    assert mixed.columns == given.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    expected = {r.doc_id: r.copies for r in mixing.mixture(given).collect() if r.copies}
    assert counts == expected
