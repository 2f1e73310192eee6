import hashlib

import numpy as np
import pytest
from conftest import text, words

from msgstream.llm import phrases, registry
from msgstream.llm.common import table

SF = "/root/testdata/sf0.001"


def brute(rows):
    """Rows by id from the largest, NULL last, then by text; each followed by the next, the last by the first."""
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    result = []
    for k, (doc_id, own) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        half = len(own) // 2
        changed = own[: len(own) - half] + following[:half]
        a, b, c = phrases.sketches([own]) + phrases.sketches([changed]) + phrases.sketches([following])
        digest = hashlib.sha256(changed.encode()).hexdigest()
        result.append(
            (doc_id, len(own), digest, phrases.shown(a), phrases.shown(b), phrases.likeness(a, b), phrases.likeness(a, c))
        )
    return sorted(result, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    result = registry.op2_locally_consistent_parsing(spark, SF)
    assert found(result) == brute(rows)
    alike = result.selectExpr("avg(near_edited)", "avg(near_next)").first()
    assert alike[0] > 0.4 and alike[1] < 0.05


@pytest.mark.parametrize("ranges", [2, 5, 40])
def test_neighbours_over_ranges(docs, ranges):
    rows = [(i * i, text(i, 5 + i % 40)) for i in range(60)]
    assert found(phrases.fingerprints(docs(rows), ranges)) == brute(rows)


def test_odd_rows(docs):
    rows = [(1, None), (2, ""), (3, "a"), (4, "ab"), (5, "aaaaaaa" * 50), (5, "same id"), (6, "é中🙂" * 40), (7, text(1, 20_000))]
    rows += [(8, "again"), (8, "again"), (None, "no id"), (None, "nor here"), (-5, "below")]
    assert found(phrases.fingerprints(docs(rows), 4)) == brute(rows)
    assert phrases.fingerprints(docs([])).collect() == []
    (one,) = phrases.fingerprints(docs([(1, "just one text")])).collect()
    assert (one.n_chars, one.near_next) == (13, 1.0)


def test_texts_together_and_alone_are_cut_alike():
    texts = [text(i, 1 + 3 * i) for i in range(50)] + ["", "x", "xx", "xyx"]
    together = phrases.sketches(texts)
    assert [phrases.shown(x) for x in together] == [phrases.shown(phrases.sketches([t])[0]) for t in texts]


def test_equal_stretches_have_equal_phrases_inside():
    """At any offset, all phrases but those near the ends come again, on each of the first levels."""
    shared = " ".join(words(5, 400))
    for before in ("", "x", "some other words ", "y" * 97):
        levels = []
        for whole in (shared, before + shared + " and an end"):
            names = np.array([ord(c) for c in whole], np.uint64)
            starts, found = np.array([0]), []
            for _ in range(4):
                names, starts = phrases.next_level(names, starts)
                found.append(names)
            levels.append(found)
        for level, (a, b) in enumerate(zip(*levels, strict=True)):
            inside = a[8:-8]
            assert len(inside) > 2 or level == 3
            assert np.isin(inside, b).all()


def test_phrases_are_short():
    names = np.array([ord(c) for c in text(3, 2000)], np.uint64)
    cut, _ = phrases.next_level(names, np.array([0]))
    assert len(names) / 8 < len(cut) < len(names) / 2
