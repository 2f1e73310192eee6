import json

from fixtures import START, at, messages
from pyspark.sql import functions as F

from msgstream.operators import eventtime, health


def log(spark, rows):
    """(queue, message_id, kind, seconds, size)"""
    return spark.createDataFrame(
        [(q, i, k, at(s), z) for q, i, k, s, z in rows],
        "queue string, message_id long, kind string, event_time timestamp, size_bytes long",
    )


def life(queue, i, *kinds, size=10, start=0):
    return [(queue, i, kind, start + n, size) for n, kind in enumerate(kinds)]


def status(spark, rows, queues=()):
    return {r.queue: r for r in health.queue_status(log(spark, rows), list(queues)).collect()}


def test_status_of_each_stage(spark):
    rows = (
        life("a", 1, "published")
        + life("a", 2, "published", "delivered", size=20)
        + life("a", 3, "published", "delivered", "ready", "acked", size=40)
        + life("b", 1, "published", "delivered")
    )
    found = status(spark, rows, ["idle", "a", "a"])
    a = found["a"]
    assert (a.published, a.received, a.message_count, a.unacked_count, a.backlog_bytes) == (3, 1, 2, 1, 30)
    assert not a.is_empty and not a.all_delivered and a.conserved
    assert found["b"].all_delivered
    idle = found["idle"]
    assert (idle.message_count, idle.backlog_bytes, idle.is_empty, idle.all_delivered) == (0, 0, True, True)


def test_repeated_log_rows_count_once(spark):
    rows = life("a", 1, "published", "delivered", size=5) * 50 + life("a", 1, "rebind", size=5)
    a = status(spark, rows)["a"]
    assert (a.message_count, a.unacked_count, a.backlog_bytes) == (1, 1, 5)


def test_unknown_size_gives_unknown_backlog(spark):
    rows = [("a", 1, "published", 0, None), ("a", 2, "published", 0, 5), ("b", 1, "published", 0, None), ("b", 1, "acked", 1, None)]
    found = status(spark, rows)
    assert found["a"].backlog_bytes is None and found["a"].message_count == 2
    assert found["b"].backlog_bytes == 0


def test_counters_follow_a_redelivery(spark):
    """Ten messages are read, forgotten when the queue is re-opened, read again and acknowledged."""
    n, rows = 10, []
    for i in range(n):
        rows += [("a", i, "published", 0, 3), ("a", i, "delivered", 1, 3), ("a", i, "removed", 2, 3)]
        rows += [("a", i, "delivered", 3, 3), ("a", i, "ready", 4, 3), ("a", i, "acked", 5, 3)]
    rows.append(("a", None, "rebind", 2, None))
    row = health.queue_counters(log(spark, rows)).withColumn("report", health.counters_json()).collect()
    assert len(row) == 1
    assert list(json.loads(row[0].report).items()) == [
        ("queueBacklog", 0),
        ("messagesReceived", 2 * n),
        ("messagesCheckpointReady", n),
        ("messagesCheckpointComplete", n),
        ("pollFlowRebind", 1),
        ("messagesRemovedFromCheckpointQueue", n),
    ]


def test_counters_restart_and_backlog_carries_on(spark):
    rows = life("a", 1, "published", "delivered", start=0) + [("a", 1, "acked", 250, 10)] + life("a", 2, "published", start=130)
    found = health.queue_counters(log(spark, rows)).orderBy("window").collect()
    assert [(r.queue_backlog, r.messages_received, r.messages_completed) for r in found] == [(10, 1, 0), (20, 0, 0), (10, 0, 1)]


def test_watermark_is_the_latest_acknowledged(spark):
    rows = life("a", 1, "published", "delivered", "acked") + life("a", 2, "published", "delivered", start=50) + life("b", 1, "delivered")
    marks = {r.queue: r.watermark for r in eventtime.queue_watermarks(log(spark, rows)).collect()}
    assert marks == {"a": at(2).replace(tzinfo=None), "b": None}
    start = F.lit(at(1))
    marks = {r.queue: r.watermark for r in eventtime.queue_watermarks(log(spark, rows), start).collect()}
    assert marks == {"a": at(2).replace(tzinfo=None), "b": at(1).replace(tzinfo=None)}
    assert eventtime.overall_watermark(log(spark, rows), start).first().watermark == at(1).replace(tzinfo=None)


def test_commits_never_move_the_watermark_back(spark):
    rows = [("a", 1, "acked", 5, 1), ("a", 2, "acked", 25, 1), ("a", 3, "delivered", 45, 1)]
    found = eventtime.commit_progress(log(spark, rows), "10 seconds", F.lit(at(20))).orderBy("window").collect()
    assert [(r.acked, r.watermark) for r in found] == [(1, at(20).replace(tzinfo=None)), (1, at(25).replace(tzinfo=None))]


def test_conservation(spark):
    def ids(queue, numbers):
        return messages(spark, [(queue, i, 0, "x") for i in numbers])

    published, received, left = ids("a", range(10)), ids("a", [*range(6), *range(3)]), ids("a", range(6, 10))
    row = health.delivery_conservation(published, received, left).first()
    assert (row.published, row.received, row.left, row.conserved) == (10, 6, 4, True)
    assert not health.delivery_conservation(published, received, ids("a", range(7, 10))).first().conserved
    assert sorted(r.message_id for r in health.not_received(published, received).collect()) == [6, 7, 8, 9]


def test_drain(spark):
    df = messages(spark, [("a", 1, 0, "x"), ("b", 1, 0, "x"), ("c", 1, 0, "x")])
    assert sorted(r.queue for r in health.drain_queues(df, ["a", "c", "a"]).collect()) == ["b"]


def test_event_time_and_freshness(spark):
    df = spark.createDataFrame(
        [("q", at(5), at(2)), ("q", at(9), None), ("q", at(8.5), at(8))], "queue string, receive_ts timestamp, sender_ts timestamp"
    )
    by_sender = [r.event_time for r in eventtime.with_event_time(df, use_sender_timestamp=True).collect()]
    assert [t.second for t in by_sender] == [2, 9, 8]
    assert [r.event_time for r in eventtime.with_event_time(df).collect()] == [r.receive_ts for r in df.collect()]
    row = eventtime.freshness(df).first()
    assert (row.timed_messages, row.untimed_messages, row.min_latency_ms, row.max_latency_ms) == (2, 1, 500, 3000)


def test_windows_align_to_the_epoch(spark):
    df = eventtime.fixed_window(eventtime.with_event_time(messages(spark, [("q", 1, 3.999, "x"), ("q", 2, 4, "x")])), "4 seconds")
    starts = [r.window_start for r in eventtime.window_bounds(df).orderBy("message_id").collect()]
    assert starts == [START.replace(tzinfo=None), at(4).replace(tzinfo=None)]
