import random

import numpy as np
import pytest
from conftest import words

from msgstream.llm import neardup, registry
from msgstream.llm.common import table

SF = "/root/testdata/sf0.001"


def sets(text, size):
    own = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for mark in "\t\n\x0b\x0c\r":
        own = own.replace(mark, " ")
    own = [w for w in own.split(" ") if w]
    return {tuple(own[i : i + size]) for i in range(max(1, len(own) - size + 1))} if own else set()


def brute(rows, size, percent=80):
    """Every pair of rows compared; component by smallest id."""
    shingles = [sets(t, size) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = shingles[i], shingles[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                group[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted((d, len(s), least[root(i)], least[root(i)] == d) for i, ((d, _), s) in enumerate(zip(rows, shingles, strict=True)))


def found(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


def variants(base, n, most, seed):
    rng = random.Random(seed)
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, most)):
            own[rng.randrange(len(own))] = f"edit{rng.randrange(10**6)}"
        yield " ".join(own)


def test_query(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert found(registry.op3_b_bit_minhash(spark, SF)) == brute(rows, 2)


def test_pairs_at_the_threshold(docs):
    """Of 2-word sets 8 in 10, 79 in 100 and 80 in 100 common."""
    a = [f"w{i}" for i in range(91)]
    b, c = a[:81] + [f"x{i}" for i in range(10)], a[:82] + [f"y{i}" for i in range(9)]
    short, other = [f"s{i}" for i in range(10)], [f"s{i}" for i in range(9)] + ["t"]
    rows = list(enumerate(" ".join(x) for x in (a, b, c, short, other)))
    assert found(neardup.near_duplicates(docs(rows), size=2)) == brute(rows, 2)


@pytest.mark.parametrize("block", [1024, 24])
def test_large_group_with_a_fringe(docs, block):
    """Near copies of one text, many below the threshold of each other; small blocks take the way of large groups."""
    base = words(1, 120)
    rows = list(enumerate([*variants(base, 150, 14, 2), *variants(base, 30, 40, 3), *variants(words(4, 60), 30, 6, 5)]))
    rows += [(1000 + i, " ".join(words(100 + i, 50))) for i in range(20)]
    random.Random(6).shuffle(rows)
    assert found(neardup.near_duplicates(docs(rows), size=2, block=block)) == brute(rows, 2)


def test_edges_grow_with_the_group_not_its_square(docs, monkeypatch):
    """Groups of near copies of 10 and 40 blocks: the edges that the rounds of components join with labels, summed over all rounds."""
    stored, met, edges = neardup.stored, [0], [0]

    def counted(df, purpose):
        out = stored(df, purpose)
        if purpose.endswith("-edges"):
            edges[0] = out.count()
        met[0] += edges[0] * purpose.endswith("-labels")
        return out

    monkeypatch.setattr(neardup, "stored", counted)
    total = []
    for n in (120, 480):
        rows = list(enumerate(variants(words(11, 60), n, 5, n)))
        met[0] = 0
        assert found(neardup.near_duplicates(docs(rows), size=2, block=12)) == brute(rows, 2)
        total.append(met[0])
    assert total[1] < 8 * total[0] and total[1] < 20 * 480, total


@pytest.mark.parametrize("vocabulary", [8, 10**6])
def test_links_of_a_group_are_exact(vocabulary):
    """Sets of one-word edits, of few words that come again and of words that are in one set only; some rows are joined before."""
    rng, base, texts = random.Random(vocabulary), words(12, 60), []
    for _ in range(150):
        own = list(base)
        for _ in range(rng.randint(0, 12)):
            own[rng.randrange(60)] = f"edit{rng.randrange(vocabulary)}"
        texts.append(" ".join(own))
    values = [neardup.shingles(neardup.words(t), 2) for t in texts]
    bits = np.array([neardup.packed_bits(neardup.minima(v)) for v in values])
    left = np.array([rng.random() < 0.5 for _ in texts])
    roots = np.where(left, np.arange(150), np.flatnonzero(~left)[0])
    forest = neardup._Forest(roots)
    for i in range(150):
        for j in range(i):
            common = len(np.intersect1d(values[i], values[j]))
            if (left[i] or left[j]) and 100 * common >= 80 * (len(values[i]) + len(values[j]) - common):
                forest.join(i, j)
    assert neardup._links(texts, bits, roots, left, 2, 80) == [forest.root(i) for i in range(150)]


def test_chains_join(docs):
    """Each text is linked with the next only."""
    chain = [words(7, 80)]
    for step in range(1, 12):
        chain.append([f"n{step}-{i}" if step * 6 <= i < step * 6 + 6 else w for i, w in enumerate(chain[-1])])
    rows = list(enumerate(" ".join(x) for x in chain))
    expected = brute(rows, 2)
    assert len({c for _, _, c, _ in expected}) == 1
    assert found(neardup.near_duplicates(docs(rows), size=2)) == expected


def test_odd_rows(docs):
    long = "word " * 5 + " ".join(words(8, 40_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE "), (6, "É x"), (7, "é x"), (8, long), (9, long + " more"), (4, "one")]
    assert found(neardup.near_duplicates(docs(rows), size=2)) == brute(rows, 2)
    assert neardup.near_duplicates(docs([])).collect() == []
    nameless = neardup.near_duplicates(docs([(None, "a b c d e f"), (3, "A b c d e f"), (None, "other")])).collect()
    assert sorted(map(str, [(r.doc_id, r.component_id, r.kept) for r in nameless])) == sorted(
        map(str, [(None, 3, False), (3, 3, True), (None, None, True)])
    )


def test_one_of_each_keeps_columns(docs):
    text = " ".join(words(9, 50))
    given = docs([(3, text), (2, text), (5, text + " end"), (1, "alone"), (6, None), (7, None)])
    kept = neardup.one_of_each(given)
    assert kept.columns == given.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 6, 7]


def test_one_of_each_drops_rows_not_ids(docs):
    a, b, c, d = (" ".join(words(seed, 50)) for seed in (20, 21, 22, 23))
    rows = [(1, a), (4, a + " end"), (4, b), (4, None), (None, a), (None, a.upper()), (None, c), (None, ""), (None, None), (5, d), (5, d)]
    left = [(1, a), (4, b), (4, None), (None, c), (None, ""), (None, None), (5, d), (5, d)]
    kept = neardup.one_of_each(docs(rows)).select("doc_id", "text").collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, left))


def test_estimates_follow_likeness():
    rng = np.random.default_rng(1)
    for likeness in (0.3, 0.8, 0.95):
        common = rng.integers(0, 2**63, int(2000 * likeness)).astype(np.uint64)
        rest = [rng.integers(0, 2**63, int(1000 * (1 - likeness))).astype(np.uint64) for _ in "ab"]
        a, b = (neardup.packed_bits(neardup.minima(np.concatenate([common, r]))) for r in rest)
        truth = len(common) / (len(common) + 2 * len(rest[0]))
        planes = (a ^ b).view(np.uint64).reshape(neardup.BITS, -1)
        equal = neardup.MINIMA - int(np.bitwise_count(np.bitwise_or.reduce(planes, axis=0)).sum())
        assert abs(neardup._estimate(equal) - truth) < 0.15
