"""Streams against batch, over files that arrive one per micro-batch."""

from collections import Counter
from datetime import timedelta

import pytest
from fixtures import at, envelope_rows, messages

from msgstream.config import ReadConfig
from msgstream.operators import dedup, eventtime, words
from msgstream.operators.mappers import text_record
from msgstream.plans.flows import deduplicated_word_count, windowed, word_count_lines
from msgstream.sinks import log_lines
from msgstream.sources.landing import close_queues, publish
from msgstream.sources.queues import read_queues, stream_each_queue
from msgstream.streaming import jobs

MESSAGE = (
    "queue string, message_id long, receive_ts timestamp, text string, redelivered boolean, sender_ts timestamp, "
    "sequence_number long"
)
ONE_FILE = {"maxFilesPerTrigger": 1}


class Landing:
    """A folder that grows by whole files, read in the order they came."""

    def __init__(self, spark, path):
        self.spark, self.path, self.files = spark, path, 0

    def add(self, *rows):
        import os
        import time

        self.files += 1
        target = f"{self.path}/{self.files:03d}"
        messages(self.spark, rows).coalesce(1).write.parquet(target)
        stamp = time.time() - 1000 + self.files
        for name in os.listdir(target):
            os.utime(f"{target}/{name}", (stamp, stamp))
        return self

    def stream(self):
        return self.spark.readStream.schema(MESSAGE).options(**ONE_FILE, recursiveFileLookup="true").parquet(self.path)

    def batch(self):
        return self.spark.read.schema(MESSAGE).option("recursiveFileLookup", "true").parquet(self.path)


@pytest.fixture
def landing(spark, folder):
    return Landing(spark, folder("landing"))


@pytest.fixture
def drain(spark, folder):
    """Runs a stream over what there is; its output, and the query."""
    checkpoint, path = folder("checkpoint"), folder("out")

    def run(df):
        query = jobs.drain_job(lambda trigger: jobs.start_job(df, path, checkpoint, trigger))
        return spark.read.schema(df.schema).parquet(path), query

    return run


def in_order(landing):
    landing.add(("q", 1, 0, "a b"), ("q", 1, 1, "a b", True), ("q", 2, 2, "b"))
    landing.add(("q", 3, 5, "c"), ("q", 4, 9, "a"))
    return landing.add(("q", 5, 20, "z"))


def closed(df, until):
    return df.where(f"window_end <= timestamp_ntz'{until}'")


def test_stream_equals_batch_but_for_the_open_window(landing, drain):
    in_order(landing)
    streamed, _ = drain(eventtime.window_bounds(deduplicated_word_count(landing.stream())))
    batch = eventtime.window_bounds(deduplicated_word_count(landing.batch()))
    expected = sorted(closed(batch, "2024-01-01 00:00:20").collect())
    assert sorted(streamed.collect()) == expected
    assert len(expected) == 4 and batch.count() == 5


def test_restart_emits_nothing_twice(landing, drain):
    in_order(landing)
    plan = eventtime.window_bounds(deduplicated_word_count(landing.stream()))
    first = sorted(drain(plan)[0].collect())
    again, query = drain(eventtime.window_bounds(deduplicated_word_count(landing.stream())))
    assert sorted(again.collect()) == first
    landing.add(("q", 6, 40, "y"))
    more, _ = drain(eventtime.window_bounds(deduplicated_word_count(landing.stream())))
    assert len(more.collect()) == len(first) + 1


@pytest.fixture
def totals(spark):
    listener = jobs.watch(spark)
    yield listener
    spark.streams.removeListener(listener)


def closing(spark, landing):
    """A last file that says nothing follows, in this folder of whole files."""
    from msgstream.sources.landing import END_OF_TIME

    def close():
        from pyspark.sql import functions as F

        end = F.lit(END_OF_TIME).cast("timestamp")
        row = messages(spark, [("q", -1, 0, None)]).withColumn("receive_ts", end).withColumn("sender_ts", end)
        landing.files += 1
        row.coalesce(1).write.parquet(f"{landing.path}/{landing.files:03d}")

    return close


@pytest.mark.parametrize("lateness", ["0 seconds", "1 hour"])
def test_a_closed_drain_writes_every_window_once(spark, landing, folder, lateness):
    in_order(landing)
    checkpoint, path = folder("checkpoint"), folder("out")

    def start(trigger):
        counted = eventtime.window_bounds(deduplicated_word_count(landing.stream(), lateness=lateness))
        return jobs.start_job(counted, path, checkpoint, trigger)

    expected = sorted(eventtime.window_bounds(deduplicated_word_count(landing.batch())).collect())
    for _ in range(2):  # drained again it writes nothing
        jobs.drain_job(start, closing(spark, landing))
        found = spark.read.schema("window_start timestamp_ntz, window_end timestamp_ntz, word string, count long").parquet(path)
        assert sorted(found.collect()) == expected


def test_a_published_close_is_seen_by_all_readers(spark, folder):
    source, path, checkpoint = folder("landing"), folder("out"), folder("checkpoint")
    rows = [{"queue": "a", "message_id": i, "receive_ts": at(i), "sender_ts": at(i), "content": b"to be"} for i in range(30)]
    publish(envelope_rows(spark, rows), source)

    def start(trigger):
        read = read_queues(spark, source, ReadConfig(["a", "b"]), mapper=text_record)
        counted = eventtime.window_bounds(words.count_words(windowed(read, "10 seconds", lateness="1 hour")))
        return jobs.start_job(counted, path, checkpoint, trigger)

    jobs.drain_job(start, lambda: close_queues(spark, source, ["b"]))
    found = spark.read.schema("window_start timestamp_ntz, window_end timestamp_ntz, word string, count long").parquet(path)
    assert Counter(r.word for r in found.collect()) == {"to": 3, "be": 3}


def test_totals_go_beyond_the_reports_kept(spark, landing, folder, totals):
    """More batches than the query remembers, each but the first with a late row."""
    landing.add(("q", 0, 10_000, "a"))
    for i in range(1, 8):
        landing.add(("q", i, i, "late"), ("q", 100 + i, 10_000 + i * 100, "b"))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        rows = dedup.distinct_in_window(windowed(landing.stream(), "10 seconds")).select("message_id")
        query = jobs.drain_job(lambda trigger: jobs.start_job(rows, folder("out"), folder("checkpoint"), trigger))
        assert len(query.recentProgress) <= 2
        assert totals.input_rows(query) == 15 and totals.dropped_as_late(query) == 6
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def late(landing):
    landing.add(("q", 1, 100, "a")).add(("q", 2, 200, "b")).add(("q", 3, 50, "late"))
    return landing.add(("q", 4, 300, "c"))


def test_late_rows_are_dropped_and_counted(landing, drain, totals):
    late(landing)
    counted = words.count_words(windowed(landing.stream(), "10 seconds"))
    result, query = drain(eventtime.window_bounds(counted))
    assert sorted(r.word for r in result.collect()) == ["a", "b"]
    assert totals.dropped_as_late(query) == 1


def test_allowed_lateness_keeps_them(landing, drain, totals):
    late(landing)
    counted = words.count_words(windowed(landing.stream(), "10 seconds", lateness="200 seconds"))
    result, query = drain(eventtime.window_bounds(counted))
    assert totals.dropped_as_late(query) == 0
    landing.add(("q", 5, 1000, "d"))
    result, query = drain(eventtime.window_bounds(words.count_words(windowed(landing.stream(), "10 seconds", lateness="200 seconds"))))
    assert sorted(r.word for r in result.collect()) == ["a", "b", "c", "late"]


def test_backlog_older_than_the_start_is_not_late(landing, drain, totals):
    """Event times years before the job starts: the watermark comes from the data."""
    in_order(landing)
    _, query = drain(eventtime.window_bounds(deduplicated_word_count(landing.stream())))
    assert totals.dropped_as_late(query) == 0


def test_missing_sequence_numbers_in_a_stream(landing, drain, spark):
    landing.add(("q", 1, 0, "a"), ("q", 1, 1, "a", True)).add(("q", 9, 100, "z"))
    unnumbered = landing.stream().selectExpr("* except (sequence_number)", "nullif(sequence_number, 1) AS sequence_number")
    result, _ = drain(dedup.distinct_by_sequence(windowed(unnumbered, "4 seconds")).select("message_id"))
    assert sorted(r.message_id for r in result.collect()) == [1, 1, 9]


def test_salted_dedup_gives_the_same(landing, folder, spark):
    landing.add(*[("q", 1, 0, "a b", i > 0) for i in range(200)], ("q", 2, 1, "b"))
    in_order(landing)
    counts = []
    for salts in (0, 4):
        rows = landing.stream().repartition(8)
        counted = eventtime.window_bounds(deduplicated_word_count(rows, salts=salts))
        path, checkpoint = folder("out"), folder("checkpoint")
        jobs.drain_job(lambda trigger: jobs.start_job(counted, path, checkpoint, trigger))
        counts.append(sorted(spark.read.schema(counted.schema).parquet(path).collect()))
    assert counts[0] == counts[1] and [r["count"] for r in counts[0] if r.word == "a"][0] == 1


@pytest.mark.parametrize("salts", [0, 3])
def test_dedup_across_files(landing, drain, salts):
    landing.add(("q", 1, 0, "a")).add(("q", 1, 60, "a", True), ("q", 2, 61, "b")).add(("q", 2, 62, "b", True))
    timed = eventtime.with_event_time(landing.stream(), lateness="1 hour")
    result, _ = drain(dedup.distinct_across_windows(timed, salts=salts).select("message_id"))
    assert sorted(r.message_id for r in result.collect()) == [1, 2]


def test_window_files_from_a_stream(landing, folder, spark):
    in_order(landing)
    path, checkpoint = folder("files"), folder("checkpoint")
    lines = word_count_lines(landing.stream(), "4 seconds")
    jobs.drain_job(lambda trigger: jobs.start_window_files(lines, path, checkpoint, trigger, shards=1))
    found = spark.read.schema("value string, window_key string").text(path)
    assert sorted(r.value for r in found.collect()) == ["a: 1", "a: 2", "b: 3", "c: 1"]


def test_unaggregated_window_files_keep_all_batches(landing, folder, spark):
    landing.add(("q", 1, 0, "a")).add(("q", 2, 1, "b"))
    path, checkpoint = folder("files"), folder("checkpoint")
    rows = windowed(landing.stream(), "10 seconds").withColumnRenamed("text", "line")
    jobs.drain_job(lambda trigger: jobs.start_window_files(rows, path, checkpoint, trigger, aggregated=False))
    assert sorted(r.value for r in spark.read.option("recursiveFileLookup", "true").text(path).collect()) == ["a", "b"]


def test_each_row_is_in_one_pane(landing, folder, spark):
    late(landing)
    path, checkpoint = folder("panes"), folder("checkpoint")
    jobs.drain_job(lambda trigger: jobs.start_panes(landing.stream(), path, checkpoint, trigger))
    found = spark.read.parquet(path)
    assert sorted(r.text for r in found.collect()) == ["a", "b", "c", "late"]
    assert found.select("pane").distinct().count() == 4


def test_observed_metrics_in_progress(landing, drain):
    landing.add(("q", 1, 0, "ab"), ("q", 2, 0, " "))
    _, query = drain(words.observe_lines(landing.stream()).select("text"))
    seen = [p["observedMetrics"]["lines"] for p in query.recentProgress if p["numInputRows"]]
    assert seen[0]["empty_lines"] == 1 and seen[0]["length_sum"] == 3


# --- queues and jobs --------------------------------------------------------------------------------


@pytest.fixture
def two_queues(spark, folder):
    """Queue ``a`` has messages a minute apart, ``b`` few; one file each."""
    path = folder("queues")
    rows = [("a", i, i * 60, "x") for i in range(20)] + [("b", 1, 0, "y")]
    messages(spark, rows).repartition("queue").write.partitionBy("queue").parquet(path)
    return path


def read(spark, path, names, **settings):
    return read_queues(spark, path, ReadConfig(names, **settings), schema=MESSAGE)


def test_unlimited_read_is_a_stream(spark, two_queues):
    assert read(spark, two_queues, ["a"]).isStreaming
    assert not read(spark, two_queues, ["a"], max_records=3).isStreaming


def test_idle_queue_does_not_stall_one_stream(spark, two_queues, drain):
    counted = words.count_words(windowed(read(spark, two_queues, ["a", "b"]), "10 seconds"))
    assert drain(eventtime.window_bounds(counted))[0].count() >= 19


@pytest.mark.parametrize("policy, expected", [("min", 0), ("max", 20)])
def test_watermark_policy_over_queues(spark, two_queues, drain, policy, expected):
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)
    try:
        rows = stream_each_queue(spark, two_queues, ReadConfig(["a", "b", "a"]), "0 seconds", schema=MESSAGE)
        counted = words.count_words(eventtime.fixed_window(rows, "10 seconds"))
        assert drain(eventtime.window_bounds(counted))[0].count() == expected
    finally:
        spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")


def start(landing, folder):
    path, checkpoint = folder("job"), folder("checkpoint")
    rows = landing.stream().select("queue", "message_id", "text")
    return path, lambda trigger: jobs.start_job(rows, path, checkpoint, trigger)


def received(spark, path):
    return sorted(r.message_id for r in spark.read.schema("queue string, message_id long, text string").parquet(path).collect())


def test_update_loses_and_repeats_nothing(spark, landing, folder):
    path, job = start(landing.add(("q", 1, 0, "a")).add(("q", 2, 0, "b")), folder)
    slow = job({"processingTime": "10 minutes"})
    while not slow.lastProgress:
        slow.awaitTermination(0.2)
    fast = jobs.update_job(slow, job, {"processingTime": "100 milliseconds"})
    landing.add(("q", 3, 0, "c"))
    fast.processAllAvailable()
    jobs.cancel_job(fast)
    assert not slow.isActive and not fast.isActive
    assert received(spark, path) == [1, 2, 3]


def test_cancel_leaves_the_rest_unread(spark, landing, folder):
    for i in range(3):
        landing.add(("q", i, 0, "a"))
    path, job = start(landing, folder)
    query = job({"processingTime": "10 minutes"})
    while not query.lastProgress:
        query.awaitTermination(0.2)
    jobs.cancel_job(query)
    left = {0, 1, 2} - set(received(spark, path))
    assert 0 < len(left) < 3
    jobs.drain_job(job)
    assert received(spark, path) == [0, 1, 2]


def test_run_for_a_while(landing, folder, spark):
    path, job = start(landing.add(("q", 1, 0, "a")), folder)
    query = job({"processingTime": "100 milliseconds"})
    while not query.lastProgress:
        query.awaitTermination(0.2)
    jobs.run_for(query, timedelta(seconds=1))
    assert not query.isActive and received(spark, path) == [1]


def test_table_job(landing, folder, spark):
    landing.add(("q", 1, 0, "a"))
    checkpoint = folder("checkpoint")
    rows = landing.stream().select("message_id", "text")
    for _ in range(2):
        jobs.drain_job(lambda trigger: jobs.start_table_job(rows, "streamed_messages", checkpoint, trigger))
    assert [tuple(r) for r in spark.table("streamed_messages").collect()] == [(1, "a")]


def test_empty_polls(landing, folder, totals):
    path, job = start(landing.add(("q", 1, 0, "a")), folder)
    query = jobs.drain_job(job)
    assert totals.empty_polls(query) == sum(p["numInputRows"] == 0 for p in query.recentProgress)


def test_log_job(landing, folder):
    landing.add(("q", 1, 0, "hello"))
    lines = log_lines(landing.stream(), "text")
    query = jobs.drain_job(lambda trigger: jobs.start_log(lines, folder("checkpoint"), trigger))
    progress = query.recentProgress[0]
    assert "ConsoleTable" in progress["sink"]["description"] and progress["sink"]["numOutputRows"] == 1


def test_from_landing_folder_to_counts(spark, folder):
    """The whole way as a user would go it: publish, read, map, count, write."""
    source, path, checkpoint = folder("landing"), folder("out"), folder("checkpoint")
    rows = [
        {"queue": q, "message_id": i, "receive_ts": at(i), "sender_ts": at(i), "content": b"to be", "attachment": b" or not"}
        for q in ("orders", "returns", "other")
        for i in range(0, 21, 5)
    ]
    publish(envelope_rows(spark, rows), source)
    config = ReadConfig(["orders", "returns", "orders"], use_sender_timestamp=True, poll_ms=100)
    read_messages = read_queues(spark, source, config, mapper=text_record)
    counts = deduplicated_word_count(read_messages, "10 seconds", use_sender_timestamp=config.use_sender_timestamp)
    query = jobs.start_job(counts.selectExpr("window.start", "word", "count"), path, checkpoint, config.trigger)
    query.processAllAvailable()
    jobs.cancel_job(query)
    found = spark.read.schema("start timestamp, word string, count long").parquet(path).collect()
    assert Counter(r.word for r in found) == {"to": 2, "be": 2, "or": 2, "not": 2}
    assert {r["count"] for r in found} == {2}


def test_other_source_formats(spark, folder):
    source = folder("json")
    envelope_rows(spark, [{"queue": "a", "message_id": i, "content": b"x"} for i in range(3)]).write.json(source)
    batch = read_queues(spark, source, ReadConfig(["a"], max_records=2), mapper=text_record, fmt="json")
    assert [r.text for r in batch.collect()] == ["x", "x"]
