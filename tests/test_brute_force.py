"""Random small inputs against plain Python."""

import random
import re
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from fixtures import START, at, messages

from msgstream.operators import dedup, eventtime, health
from msgstream.plans.flows import deduplicated_word_count

SEEDS = [1, 2, 3]


def random_messages(rng, n=200):
    texts = ["a b", "b, c", "", "12", "Éa-b a", "  \t"]
    return [(rng.choice("pq"), rng.randrange(40), rng.randrange(60), rng.choice(texts), rng.random() < 0.3) for _ in range(n)]


@pytest.mark.parametrize("seed", SEEDS)
def test_word_count(spark, seed):
    rows = random_messages(random.Random(seed))
    first = {}
    for q, i, s, t, r in sorted(rows, key=lambda m: (m[2], m[4], m[0])):
        first.setdefault((s // 4, i), set()).add((s, r, q, t))
    # Copies equal in time, flag and queue may differ in text; leave such messages out.
    safe = set()
    for key, copies in first.items():
        low = min(c[:3] for c in copies)
        if len({c[3] for c in copies if c[:3] == low}) == 1:
            safe.add(key)
    kept = [m for m in rows if (m[2] // 4, m[1]) in safe]
    expected = Counter()
    for window, i in safe:
        text = min(first[window, i])[3]
        expected.update((window, w) for w in re.findall(r"[^\W\d_]+", text))
    counted = eventtime.window_bounds(deduplicated_word_count(messages(spark, kept))).collect()
    base = START.replace(tzinfo=None)
    found = {(int((r.window_start - base).total_seconds()) // 4, r.word): r["count"] for r in counted}
    assert found == dict(expected)


@pytest.mark.parametrize("seed", SEEDS)
def test_receipts_and_bags(spark, seed):
    rows = random_messages(random.Random(seed))
    by_message = defaultdict(list)
    for q, i, _, t, r in rows:
        by_message[q, i].append((t, r))
    expected = {
        key: (sum(not r for _, r in copies), sum(r for _, r in copies), len({t for t, _ in copies}) == 1)
        for key, copies in by_message.items()
    }
    df = messages(spark, rows)
    assert {tuple(r)[:2]: tuple(r)[2:] for r in dedup.receipts(df).collect()} == expected

    left, right = (Counter(t for *_, t, r in rows if r == flag) for flag in (False, True))
    expected = {t: (left[t], right[t]) for t in left | right if left[t] != right[t]}
    found = dedup.bag_difference(df.where("not redelivered"), df.where("redelivered")).collect()
    assert {r.text: (r.left_count, r.right_count) for r in found} == expected


@pytest.mark.parametrize("seed", SEEDS)
def test_queue_reports(spark, seed):
    rng = random.Random(seed)
    kinds = ["published", "delivered", "acked", "ready", "removed"]
    rows = [(rng.choice("ab"), rng.randrange(30), rng.choice(kinds), rng.randrange(600)) for _ in range(250)]
    log = spark.createDataFrame(
        [(q, i, k, at(s), i) for q, i, k, s in rows],
        "queue string, message_id long, kind string, event_time timestamp, size_bytes long",
    )
    reached = defaultdict(lambda: defaultdict(list))
    for q, i, k, s in rows:
        reached[q, i][k].append(s)
    for row in health.queue_status(log, ["idle"]).collect():
        mine = [(i, stages) for (q, i), stages in reached.items() if q == row.queue]
        waiting = [i for i, stages in mine if "published" in stages and "acked" not in stages]
        assert row.message_count == len(waiting) and row.backlog_bytes == sum(waiting)
        assert row.unacked_count == sum("delivered" in stages and "acked" not in stages for _, stages in mine)
        assert row.conserved == all("published" in stages for _, stages in mine if "acked" in stages)

    base = START.replace(tzinfo=None)
    reports = {(r.queue, r.window.start): r for r in health.queue_counters(log).collect()}
    for (queue, start), row in reports.items():
        begin = int((start - base).total_seconds())
        here = Counter(k for q, _, k, s in rows if q == queue and begin <= s < begin + 120)
        assert (row.messages_received, row.messages_completed) == (here["delivered"], here["acked"])
        assert (row.messages_ready, row.messages_removed) == (here["ready"], here["removed"])
        level = 0
        for (q, i), stages in reached.items():
            if q == queue and "published" in stages:
                level += i * (min(stages["published"]) < begin + 120)
                level -= i * (min(stages.get("acked", [10**9])) < begin + 120)
        assert row.queue_backlog == level
    assert {q for q, _ in reports} == {q for q, *_ in rows}


def test_watermark_over_queues(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), i, rng.choice(["acked", "delivered"]), rng.randrange(1000)) for i in range(60)]
    log = spark.createDataFrame(
        [(q, i, k, at(s), 1) for q, i, k, s in rows],
        "queue string, message_id long, kind string, event_time timestamp, size_bytes long",
    )
    latest = {q: max([s for p, _, k, s in rows if p == q and k == "acked"], default=None) for q in {r[0] for r in rows}}
    marks = {r.queue: r.watermark for r in eventtime.queue_watermarks(log).collect()}
    assert marks == {q: datetime(2024, 1, 1) + timedelta(seconds=s) for q, s in latest.items()}
