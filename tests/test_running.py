"""Running values in blocks, as-of times and selection, against plain versions."""

import random
from collections import defaultdict
from datetime import datetime, timezone

import pytest
from fixtures import at
from pyspark.sql import functions as F

from msgstream.operators import health, running, selection
from msgstream.operators.dedup import comparable_map


@pytest.mark.parametrize("block, levels", [(7, 1), (7, 3), (1000, 2)])
def test_running_against_a_loop(spark, block, levels):
    rng = random.Random(block)
    rows = [(rng.choice(["a", "a", "a", "b", None]), n, rng.choice([None, rng.randint(-9, 9)]), "x") for n in rng.sample(range(-400, 400), 300)]
    df = spark.createDataFrame(rows, "queue string, at long, change long, other string")
    found = running.running(df.withColumn("top", F.col("change")), ["queue"], ["at"], {"change": "sum", "top": "max"}, block, levels)
    so_far, expected = defaultdict(list), []
    for q, n, change, other in sorted(rows, key=lambda r: r[1]):
        so_far[q] += [] if change is None else [change]
        some = so_far[q]
        expected.append((q, n, sum(some) if some else None, other, max(some, default=None)))
    key = lambda r: (r[0] is None, r[0] or "", r[1])
    assert found.columns == ["queue", "at", "change", "other", "top"]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected, key=key)


def test_a_hot_key_is_summed_in_blocks(spark):
    """All rows under one key: no task of the last step gets more than a block."""
    df = spark.range(20_000).select(F.lit("hot").alias("queue"), F.col("id").alias("at"), F.lit(1).cast("long").alias("n"))
    found = running.running(df, ["queue"], ["at"], {"n": "sum"}, block=500)
    assert found.where("n <> at + 1").isEmpty() and found.count() == 20_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and sum("_block" in line for line in windows) >= 2


def test_last_before_against_a_loop(spark):
    rng = random.Random(2)
    moments = [at(rng.randint(-300, 300) / 7) for _ in range(200)]
    rows = [(rng.choice("ab"), i, m) for i, m in enumerate(moments[:150])] + [("a", 999, None), (None, 998, at(1))]
    marks = [(rng.choice("ab"), m) for m in moments[100:]] * 2 + [(None, at(0)), ("a", None), ("c", at(3))]
    df = spark.createDataFrame(rows, "queue string, i long, event_time timestamp")
    df = df.withColumn("map", F.create_map(F.lit("k"), F.lit("v")))
    found = running.last_before(
        df, spark.createDataFrame(marks, "queue string, event_time timestamp"), ["queue"], "event_time", "mark", 5_000_000, 3
    )
    assert found.columns == [*df.columns, "mark"]
    utc = lambda t: t and t.astimezone(timezone.utc)
    got = {r.i: utc(r.mark) for r in found.collect()}
    assert len(got) == len(rows) == found.count()
    for q, i, m in rows:
        before = [t for k, t in marks if k == q and t is not None and m is not None and t <= m]
        assert got[i] == max(before, default=None)


def log(spark, rows):
    return spark.createDataFrame(
        [(q, i, k, at(s), 1) for q, i, k, s in rows],
        "queue string, message_id long, kind string, event_time timestamp, size_bytes long",
    )


def test_commit_prefixes_against_a_loop(spark):
    rng = random.Random(3)
    rows = []
    for i in rng.sample(range(4000), 500):
        rows.append(("hot" if i % 3 else "cold", i, "delivered", i / 10))
        if i < 3000:
            rows += [("hot" if i % 3 else "cold", i, "acked", i / 10 + rng.expovariate(0.1))] * rng.randint(1, 2)
    rows += [("hot", None, "rebind", 1), ("cold", 1, "published", 0), ("idle", 7, "acked", 3)]
    found = health.commit_prefixes(log(spark, rows), "10 seconds", block=64).collect()
    got = {(r.queue, r.window.start.replace(tzinfo=timezone.utc)): (r.through, r.committed) for r in found}
    expected = {}
    for queue in ("hot", "cold"):
        delivered = sorted({i for q, i, k, _ in rows if q == queue and k == "delivered"})
        done = 0.0
        for i in delivered:
            acked = [s for q, j, k, s in rows if (q, j, k) == (queue, i, "acked")]
            if not acked:
                break
            done = max(done, min(acked))
            start = datetime.fromtimestamp((at(0).timestamp() + done) // 10 * 10, timezone.utc)
            expected[queue, start] = (i, expected.get((queue, start), (0, 0))[1] + 1)
    assert got == expected


def test_causes_of_redelivery(spark):
    rows = [("a", 1, "delivered", 0), ("a", 2, "delivered", 1), ("a", None, "rebind", 2), ("a", 1, "delivered", 3)]
    rows += [("a", 2, "delivered", 4), ("a", None, "rebind", 5), ("a", 2, "delivered", 5), ("a", 2, "delivered", 6), ("b", 9, "delivered", 9)]
    found = health.redelivery_causes(log(spark, rows), slice_us=2_000_000, parts=2).collect()
    got = {(r.queue, r.message_id, r.rebind_at and r.rebind_at.replace(tzinfo=timezone.utc)): r.attempts for r in found}
    assert got == {
        ("a", 1, None): 1, ("a", 2, None): 1, ("a", 1, at(2)): 1, ("a", 2, at(2)): 1, ("a", 2, at(5)): 2, ("b", 9, None): 1,
    }


def keys(df):
    return sorted((r.t, r.i, r.text or "") for r in df.collect())


@pytest.mark.parametrize("fits", [10, 100_000])
@pytest.mark.parametrize("n", [0, 1, 2, 57, 300, 599, 600, 601])
def test_selection_against_sorting(spark, monkeypatch, fits, n):
    """Half of the rows at one time, many under one id there; sketches narrow down when few rows fit a task."""
    monkeypatch.setattr(selection, "FITS", fits)
    rng = random.Random(7)
    rows = [(50 if rng.random() < 0.5 else rng.randint(-100, 100), rng.choice([3, 3, 3, 8, -(2**63), 2**63 - 1]), str(k)) for k in range(600)]
    df = spark.createDataFrame(rows, "t long, i long, text string")
    found = keys(selection.first_rows(df, n, [F.col("t"), F.col("i")]))
    assert len(found) == min(n, 600) and len(set(found)) == len(found)
    assert [k[:2] for k in found] == sorted(r[:2] for r in rows)[:n]


@pytest.mark.parametrize("fits", [10, 100_000])
def test_selection_of_rows_all_alike(spark, monkeypatch, fits):
    monkeypatch.setattr(selection, "FITS", fits)
    df = spark.range(200).select(F.lit(5).cast("long").alias("t"), F.lit(1).cast("long").alias("i"), F.lit("x").alias("text"))
    df = df.withColumn("map", F.create_map(F.lit("a"), F.lit("b")))
    for n in (1, 77, 199, 200):
        found = selection.first_rows(df, n, [F.col("t"), F.col("i")])
        assert found.columns == df.columns and found.count() == n
    assert selection.first_rows(df.limit(0), 3, [F.col("t"), F.col("i")]).collect() == []


def test_selection_does_not_depend_on_tasks(spark):
    """The same rows whatever tasks read them, though all are in one second and tie in time and id."""
    df = spark.range(5000).select(F.lit(0).cast("long").alias("t"), (F.col("id") % 2).alias("i"), F.col("id").cast("string").alias("text"))
    order = [F.col("t"), F.col("i")]
    assert keys(selection.first_rows(df.repartition(3), 1234, order)) == keys(selection.first_rows(df.repartition(11, "text"), 1234, order))


def test_comparable_maps_are_what_the_hash_sees(spark):
    df = spark.range(1).select(F.create_map(F.lit("b"), F.lit(1), F.lit("a"), F.lit(2)).alias("m"))
    same = spark.range(1).select(F.create_map(F.lit("a"), F.lit(2), F.lit("b"), F.lit(1)).alias("m"))
    assert df.select(comparable_map("m")).first() == same.select(comparable_map("m")).first()
