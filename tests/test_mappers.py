import json

import pytest
from fixtures import at, envelope_rows, messages
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from msgstream.functions import text as tx
from msgstream.operators import mappers, words


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


TEXT = "test Me123 !@"


@pytest.mark.parametrize(
    "row, expected",
    [
        ({"message_type": "text", "content": TEXT.encode()}, TEXT),
        ({"message_type": "bytes", "content": TEXT.encode()}, TEXT),
        ({"message_type": "stream", "stream_items": [TEXT]}, json.dumps([TEXT], separators=(",", ":"))),
        ({"message_type": "map", "map_items": {"test": TEXT, "a": "b"}}, '{"a":"b","test":"%s"}' % TEXT),
        ({"message_type": "xml", "content": TEXT.encode()}, TEXT),
        ({"message_type": "xml", "content": b"left", "attachment": TEXT.encode()}, TEXT),
        ({"message_type": "xml", "content": TEXT.encode(), "attachment": b""}, TEXT),
        ({"message_type": "xml"}, ""),
    ],
)
def test_string_by_message_type(spark, row, expected):
    assert one(mappers.string_record(envelope_rows(spark, [row]))).text == expected


@pytest.mark.parametrize(
    "content, attachment, expected",
    [
        (b"a", b"b", "ab"),
        (b"a", None, "a"),
        (None, b"b", "b"),
        (b"", b"", ""),
        (None, None, ""),
        (b"\xff\xfe", "é".encode(), "��é"),
    ],
)
def test_text_is_content_then_attachment(spark, content, attachment, expected):
    row = {"content": content, "attachment": attachment}
    assert one(mappers.text_record(envelope_rows(spark, [row]))).text == expected


def test_text_record_fields(spark):
    epoch = at(0).replace(year=1970)
    row = {
        "destination": None, "message_id": 7, "sender_ts": epoch, "properties": {"k": "1"}, "sender_id": "s",
        "sequence_number": None,
    }
    df = envelope_rows(spark, [row])
    record = one(mappers.text_record(df))
    assert tuple(record.asDict()) == mappers.TEXT_RECORD
    assert record.sender_ts is None and record.destination is None and record.sequence_number is None
    assert one(mappers.text_record(df, include_sender_id=True)).sender_id == "s"
    found = one(df.select(mappers.property_value("k").alias("k"), mappers.property_value("none").alias("none")))
    assert found.k == "1" and found.none is None
    without = envelope_rows(spark, [{}])
    assert one(without.select(mappers.property_value("k").alias("k"))).k is None


def test_bytes_record_and_filters(spark):
    df = envelope_rows(spark, [{"message_id": 1, "content": b"\x00\x01"}, {"message_id": 2, "redelivered": True}])
    assert sorted(mappers.bytes_record(df.where("message_id = 1")).collect()) == [(1, bytearray(b"\x00\x01"))]
    assert [r.message_id for r in mappers.redelivered_only(df).collect()] == [2]


def test_words_are_runs_of_letters(spark):
    df = messages(spark, [("q", 1, 0, "Élan, don't 4x4 élan!"), ("q", 2, 0, ""), ("q", 3, 0, "12 34")])
    counted = {r.word: r["count"] for r in words.count_words(df, keep=()).collect()}
    assert counted == {"Élan": 1, "don": 1, "t": 1, "x": 1, "élan": 1}
    lines = words.format_counts(words.count_words(df, keep=()), keep=())
    assert "don: 1" in [r.line for r in lines.collect()]


def test_line_stats_count_as_java_does(spark):
    df = messages(spark, [("q", 1, 0, " \t\n"), ("q", 2, 0, ""), ("q", 3, 0, "a\U0001F600"), ("q", 4, 0, " ")])
    row = one(words.line_stats(df))
    assert row.empty_lines == 2
    assert (row.line_count, row.length_sum, row.length_min, row.length_max) == (4, 7, 0, 3)
    assert row.length_mean == 7 / 4


def test_observed_lines(spark):
    from pyspark.sql import Observation

    seen = Observation("lines")
    df = words.observe_lines(messages(spark, [("q", 1, 0, "ab"), ("q", 2, 0, " ")]), seen)
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["empty_lines"] == 1 and seen.get["length_sum"] == 3


def test_global_count_has_no_default(spark):
    df = messages(spark, [("q", 1, 0, "a"), ("q", 2, 0, "b")])
    assert [r["count"] for r in words.global_count(df).collect()] == [2]
    assert words.global_count(df.where("false")).collect() == []


def test_distinct_and_repeated_lines(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "value string")
    assert tuple(one(words.distinct_lines(df))) == (3, 2, 1)
    assert [tuple(r) for r in words.repeated_lines(df).collect()] == [("a", 2)]
    assert tuple(one(words.distinct_lines(df.where("false")))) == (0, 0, 0)


def test_object_paths(spark):
    df = spark.createDataFrame([("gs://bucket/dir/file",), ("gs:///file",), ("gs://bucket/",), ("x",), (None,)], "url string")
    found = df.select(tx.object_path("url", on_bad="null").alias("p")).collect()
    assert [r.p and tuple(r.p) for r in found] == [("bucket", "dir/file"), None, None, None, None]
    with pytest.raises(PySparkException, match="not a bucket and object path"):
        df.select(tx.object_path("url")).collect()


def test_window_label_repeats_where_key_does_not(spark):
    rows = [("q", i, s, "x") for i, s in enumerate((0, 10, 86400))]
    from msgstream.plans.flows import windowed

    df = windowed(messages(spark, rows), "10 seconds").select(
        tx.window_label("window.start", "window.end").alias("label"), tx.window_key("window.start", "window.end").alias("key")
    )
    found = df.collect()
    assert {r.label for r in found} == {"00.00-00.00"}
    assert sorted(r.key for r in found) == [
        "20240101T000000-20240101T000010", "20240101T000010-20240101T000020", "20240102T000000-20240102T000010",
    ]


def test_window_key_of_short_windows(spark):
    from msgstream.plans.flows import windowed

    df = windowed(messages(spark, [("q", 1, 0.3, "x"), ("q", 2, 0.8, "x")]), "500 milliseconds")
    keys = {r.key for r in df.select(tx.window_key("window.start", "window.end").alias("key")).collect()}
    assert keys == {"20240101T000000-20240101T000000.500", "20240101T000000.500-20240101T000001"}


def test_log_prefix_and_payload(spark):
    df = spark.createDataFrame([("q", 3)], "queue string, n int")
    row = one(df.select(tx.log_line(F.lit("a: 1")).alias("log"), tx.numbered_payload("queue", "n").alias("p")))
    assert tuple(row) == ("***a: 1", "q - 3")


def test_malformed_text_is_replaced_as_usual(spark):
    """Against Python's decoder, which replaces each maximal malformed part by one U+FFFD."""
    import random

    rng = random.Random(7)
    parts = ["é".encode(), "𝄞".encode(), b"a", b"\xff", b"\xe2\x82", b"\xf0\x9d", b"\x80", b"\xc0\xaf", b"\xed\xa0\x80", b"\xf4\x90"]
    bodies = [b"".join(rng.choices(parts, k=rng.randint(1, 8))) for _ in range(500)]
    df = spark.createDataFrame([(bytearray(b),) for b in bodies], "content binary").select("content", tx.utf8("content").alias("text"))
    for row in df.collect():
        assert row.text == bytes(row.content).decode("utf-8", "replace"), bytes(row.content)


def test_line_separators_are_not_blank(spark):
    df = spark.createDataFrame([("\u2028",), ("\u00a0",), ("\x00\r\n",)], "text string")
    assert [r.b for r in df.select(tx.is_blank("text").alias("b")).collect()] == [False, False, True]


def test_typed_properties(spark):
    df = envelope_rows(spark, [{"properties": {"n": "12", "b": "true", "f": "1.5", "t": "plain words"}}])
    row = one(
        df.select(
            mappers.typed_property("n", "int").alias("n"),
            mappers.typed_property("b", "boolean").alias("b"),
            mappers.typed_property("f", "double").alias("f"),
            mappers.typed_property("t", "int").alias("t"),
            mappers.typed_property("none", "int").alias("none"),
        )
    )
    assert tuple(row) == (12, True, 1.5, None, None)
