"""Resampling against a plain version, and the sort against Python's."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from msgstream.llm import importance, registry
from msgstream.llm.common import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, longest=1):
    lowered = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")
    words = WORD.findall(lowered)
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain(rows, target, percent=10, buckets=10_000, longest=1, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    raw = Counter(bucket(f) for _, text in rows for f in runs(text, longest)[1])
    aim = Counter(bucket(f) for text in target for f in runs(text, longest)[1])
    all_raw, all_aim = sum(raw.values()), sum(aim.values())
    found = []
    for i, text in rows:
        words, feats = runs(text, longest)
        gain = [
            math.floor(1000 * math.log((aim[b] + 1) * (all_raw + buckets) / ((raw[b] + 1) * (all_aim + buckets))))
            for b in map(bucket, feats)
        ]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([i, len(feats), weight, score, None, len(words) >= least])
    able = sorted((r for r in found if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: len(able) * percent // 100], 1):
        row[4] = rank
    return sorted(tuple(r[:5]) for r in found if r[0] is not None) + [tuple(r[:5]) for r in found if r[0] is None]


def got(df):
    rows = [tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()]
    return sorted(r for r in rows if r[0] is not None) + [r for r in rows if r[0] is None]


def test_query_equals_plain_version(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    target = [r.text for r in table(spark, SF, "benchmark").collect()]
    found = registry.op13_importance_resampling(spark, SF)
    assert {f.name: f.dataType.typeName() for f in found.schema} == dict.fromkeys(
        ["doc_id", "n_features", "weight", "score", "rank"], "long"
    )
    assert got(found) == plain(docs, target)


def test_odd_rows(docs, spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choices(["The", "ünder", "x9", "a-b", "the", "Σ", "日本"], k=rng.randint(0, 60))) for _ in range(80)]
    rows = [*enumerate(texts), (200, None), (201, ""), (202, "-- "), (7, texts[7]), (None, "w " * 30)]
    given = docs(rows).withColumns({name: F.lit("clash") for name in ("score", "rank", "_at", "weight", "eligible", "body")})
    aim = spark.createDataFrame([("the Σ x9",), (None,), ("ünder",)], "text string")
    found = got(importance.resampled(given, aim, percent=50))
    assert found == plain(rows, ["the Σ x9", None, "ünder"], percent=50)
    found = got(importance.resampled(given, aim, percent=100, buckets=97, longest=3, least_words=5))
    assert found == plain(rows, ["the Σ x9", None, "ünder"], percent=100, buckets=97, longest=3, least=5)
    assert importance.resampled(docs([]), aim).collect() == []
    assert len(importance.resampled(given, aim.limit(0)).collect()) == len(rows)


@pytest.mark.parametrize("digit_bits, block_bits", [(11, 16), (3, 4)])
def test_radix_sort(spark, monkeypatch, digit_bits, block_bits):
    """Blocks of 16 rows and digits of 3 bits take the same rows through many passes and blocks."""
    monkeypatch.setattr(importance, "DIGIT_BITS", digit_bits)
    monkeypatch.setattr(importance, "BLOCK_BITS", block_bits)
    rng = random.Random(6)
    hot = [5] * 100
    keys = [(rng.choice([*range(-40, 40), *hot]), rng.choice([0, 1, 7, 500, None])) for _ in range(300)]
    rows = spark.createDataFrame(keys, "a long, b long").repartition(5)
    placed = importance.radix_sorted(rows, ["a", "b"], descending=["a"]).collect()
    assert sorted(r["_at"] for r in placed) == list(range(300))
    found = [(r.a, r.b) for r in sorted(placed, key=lambda r: r["_at"])]
    assert found == sorted(keys, key=lambda k: (-k[0], k[1] is None, k[1] or 0))


def test_radix_sort_over_the_whole_range_of_longs(spark):
    keys = [-(2**63), 2**63 - 1, 0, -1, 1, 2**62, -(2**62), None, 0]
    rows = spark.createDataFrame([(k,) for k in keys], "a long")
    for descending in ([], ["a"]):
        placed = sorted(importance.radix_sorted(rows, ["a"], descending).collect(), key=lambda r: r["_at"])
        expected = sorted([k for k in keys if k is not None], reverse=bool(descending)) + [None]
        assert [r.a for r in placed] == expected
    same = importance.radix_sorted(rows.where("a = 0"), ["a"]).collect()
    assert sorted(r["_at"] for r in same) == [0, 1]
    assert importance.radix_sorted(rows.limit(0), ["a"]).collect() == []


def test_gains_are_floored():
    gain = importance.gains(np.array([0, 10, 3]), np.array([5, 0, 3]))
    assert gain.tolist() == [math.floor(1000 * math.log((t + 1) * 16 / ((s + 1) * 11))) for s, t in ((0, 5), (10, 0), (3, 3))]
