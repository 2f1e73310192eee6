from datetime import timedelta

import pytest
from fixtures import at, envelope_rows
from pyspark.sql import functions as F

from msgstream.config import ReadConfig
from msgstream.functions.proto import decode_test, encode_test
from msgstream.operators import mappers, words
from msgstream.operators.dedup import bag_difference
from msgstream.sources import landing, queues


def receipts(spark, rows):
    df = spark.createDataFrame(rows, "queue string, message_id long, receive_us long")
    return df.select("queue", "message_id", F.timestamp_micros("receive_us").alias("receive_ts"))


def ordered(df):
    return sorted((r.receive_ts, r.message_id, r.queue) for r in df.collect())


@pytest.mark.parametrize("n", [1, 2, 50, 137, 299, 300, 5000])
def test_first_records_against_sorting(spark, n):
    """Many ties in time, some in time and id, over hours and seconds."""
    df = receipts(spark, [(f"q{i % 3}", i % 40 if i % 5 else 7, (i * i) % 11 * 1_000_003_000 // (1 + i % 2 * 999)) for i in range(300)])
    found, expected = ordered(queues.first_records(df, n)), ordered(df)[:n]
    assert [r[:2] for r in found] == [r[:2] for r in expected]
    assert not set(found) - set(ordered(df))


def test_first_records_over_all_ids(spark):
    ids = [-(2**63), -5, 0, 7, 2**40, 2**62, 2**63 - 2, 2**63 - 1]
    df = receipts(spark, [("q", i, 5) for i in ids])
    for n in range(1, len(ids)):
        assert sorted(r.message_id for r in queues.first_records(df, n).collect()) == ids[:n]


def test_first_records_of_equal_rows(spark):
    df = receipts(spark, [("q", 0, 1)] + [("q", 1, 5)] * 20 + [("q", 2, 9)])
    df = df.withColumn("properties", F.create_map(F.lit("a"), F.lit("b")))
    for n in (1, 2, 4, 8, 9, 20, 21, 22):
        found = queues.first_records(df, n)
        assert found.columns == df.columns
        assert sorted(r.message_id for r in found.collect()) == ([0] + [1] * 20 + [2])[:n]


def test_first_records_needs_times(spark):
    for rows in ([("q", 1, None), ("q", 2, 3)], [("q", None, 1), ("q", 2, 3)]):
        with pytest.raises(Exception, match="no receive time"):
            queues.first_records(receipts(spark, rows), 1).collect()


def test_first_records_runs_nothing_before_it_is_asked(spark):
    """The cut is part of the plan: building it starts no job."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    try:
        queues.first_records(receipts(spark, [("q", i, i) for i in range(9)]), 3)
        assert len(tracker.getJobIdsForGroup("building")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_read_time_and_both_limits(spark):
    df = receipts(spark, [("q", i, i * 1_000_000) for i in range(10)])
    assert queues.within_read_time(df, timedelta(seconds=3)).count() == 3
    assert queues.within_read_time(df, timedelta(milliseconds=3001)).count() == 4
    both = ReadConfig(["q"], max_records=2, max_read_time=timedelta(seconds=3))
    assert queues.limited(df, both).count() == 2
    assert queues.limited(df, both.with_(max_records=8)).count() == 3


@pytest.fixture(scope="module")
def landed(spark):
    from msgstream.scratch import shared_folder

    path = shared_folder(spark, "landed")
    landing.publish(landing.numbered_messages(spark, ["a/1", "b", "c"], 10), path)
    return path


def bounded(names, **limits):
    return ReadConfig(names, max_records=limits.pop("n", 1000), **limits)


@pytest.mark.parametrize("names, expected", [(["b"], 10), (["a/1", "b"], 20), (["b", "b"], 10), (["none"], 0)])
def test_queue_lists(spark, landed, names, expected):
    read = queues.read_queues(spark, landed, bounded(names), mappers.text_record)
    wanted = spark.createDataFrame([(f"{q} - {i}",) for q in {*names} - {"none"} for i in range(10)] or [(None,)], "text string")
    assert [r["count"] for r in words.global_count(read).collect()] == ([expected] if expected else [])
    if expected:
        assert bag_difference(read, wanted).isEmpty()


def test_batch_without_a_limit(spark, landed):
    read = queues.read_queues(spark, landed, ReadConfig(["a/1", "c"], batch=True), mappers.text_record)
    assert not read.isStreaming and read.count() == 20


def test_limit_counts_over_all_queues(spark, landed):
    assert queues.read_queues(spark, landed, bounded(["a/1", "b"], n=15)).count() == 15


def test_queue_list_prunes_folders(spark, landed):
    plan = queues.read_queues(spark, landed, ReadConfig(["a/1", "b"], max_read_time=timedelta(days=1)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [queue" in text.replace("isnotnull(queue), ", "")


def test_duplicate_payloads_are_kept(spark, folder):
    path = folder()
    landing.publish(envelope_rows(spark, [{"message_id": i, "attachment": b"q - test"} for i in range(10)]), path)
    read = queues.read_queues(spark, path, bounded(["q"]), mappers.text_record)
    assert [r.text for r in read.collect()] == ["q - test"] * 10


def test_missing_folder_fails(spark, folder):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        queues.read_queues(spark, f"{folder()}/none", bounded(["q"])).count()


def test_copies_of_one_encoded_message(spark):
    sent = landing.copies_per_queue(spark, ["a", "b"], 999, encode_test(F.lit("Test Message")))
    assert {(r.queue, r["count"]) for r in sent.groupBy("queue").count().collect()} == {("a", 999), ("b", 999)}
    bodies = {bytes(r.content) for r in sent.select("content").distinct().collect()}
    assert bodies == {bytes.fromhex("0A0C54657374204D657373616765")}
    decoded = sent.select(decode_test("content").test.alias("test")).distinct().collect()
    assert [r.test for r in decoded] == ["Test Message"]


def test_fields_that_are_not_the_string_are_passed_over(spark):
    other = b"\x10\xff\x01" + b"\x19" + b"8 bytes!" + b"\x25" + b"4444" + b"\x2a\x03abc" + b"\x08\x05"
    bodies = [other + b"\x0a\x02hi" + other, b"\x0a\x01x\x0a\x01y", b"\x0a\x00", b"\x82\x7d\x03abc\x0a\x03\xc3\xa9!"]
    df = spark.createDataFrame([(bytearray(b),) for b in bodies], "content binary")
    assert [r.t for r in df.select(decode_test("content").test.alias("t")).collect()] == ["hi", "y", "", "é!"]
    broken = [other, b"\x0a", b"\x0a\x80", b"\x0a\x02a", b"\x00\x01", b"\x0b", b"\x0a\x01a\x19short", b"\xff" * 11]
    df = spark.createDataFrame([(bytearray(b),) for b in broken], "content binary")
    assert {r.m for r in df.select(decode_test("content", on_bad="null").alias("m")).collect()} == {None}


def test_bodies_that_do_not_parse(spark):
    df = spark.createDataFrame([(bytearray(b"\x0a\x05ab"),), (bytearray(b""),), (bytearray(b"\x0a\x01a"),), (None,)], "content binary")
    found = [r.m and r.m.test for r in df.select(decode_test("content", on_bad="null").alias("m")).collect()]
    assert found == [None, None, "a", None]
    for bad in (bytearray(b"\x0a\x05ab"), bytearray(b"")):
        with pytest.raises(Exception, match="(?i)parsing|missing|protobuf"):
            spark.createDataFrame([(bad,)], "content binary").select(decode_test("content")).collect()


def test_protobuf_text_of_many_lengths(spark):
    texts = ["", "é", "x" * 127, "x" * 128, "y" * 20_000, "z" * 3_000_000, None]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", encode_test("text").alias("b"))
    found = df.select("text", decode_test("b").test.alias("back")).collect()
    assert all(r.text == r.back for r in found)


def test_receive_times_survive(spark, folder):
    path = folder()
    landing.publish(envelope_rows(spark, [{"receive_ts": at(1.000001)}]), path)
    assert queues.read_queues(spark, path, bounded(["q"])).first().receive_ts.microsecond == 1
