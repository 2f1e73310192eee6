import pytest
from fixtures import at, messages
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from msgstream.operators import dedup
from msgstream.plans.flows import deduplicated_word_count, windowed


def ids(df):
    return sorted(r.message_id for r in df.collect())


def test_same_id_once_per_window(spark):
    df = windowed(messages(spark, [("q", 1, 0, "a"), ("q", 1, 3, "b", True), ("q", 1, 5, "c", True)]), "4 seconds")
    kept = dedup.distinct_in_window(df).orderBy("receive_ts").collect()
    assert [r.text for r in kept] == ["a", "c"]


def test_ids_of_two_queues(spark):
    df = windowed(messages(spark, [("p", 1, 0, "a"), ("q", 1, 1, "b"), ("q", 1, 2, "b", True)]), "4 seconds")
    assert ids(dedup.distinct_in_window(df)) == [1]
    assert ids(dedup.distinct_in_window(df, ("queue", "message_id"))) == [1, 1]


def with_sequences(spark, numbers):
    df = messages(spark, [("q", i, 0, "x") for i in range(len(numbers))])
    lookup = F.create_map(*[F.lit(v) for i, n in enumerate(numbers) if n is not None for v in (i, n)])
    return windowed(df.withColumn("sequence_number", F.try_element_at(lookup, F.col("message_id").cast("int")).cast("long")), "4 seconds")


def test_missing_sequence_numbers(spark):
    df = with_sequences(spark, [5, 5, None, None, 6])
    assert ids(dedup.distinct_by_sequence(df)) == [0, 2, 3, 4]
    assert ids(dedup.distinct_by_sequence(df, on_null="equal")) == [0, 2, 4]
    with pytest.raises(PySparkException, match="sequence_number is null"):
        dedup.distinct_by_sequence(df, on_null="error").collect()
    with pytest.raises(ValueError, match="on_null"):
        dedup.distinct_by_sequence(df, on_null="drop")


def test_content_equality(spark):
    rows = [
        (1, {"a": "1", "b": "2"}, "d", False, 0, 0, "t", at(0)),
        (2, {"b": "2", "a": "1"}, "d", False, 0, 0, "t", at(1)),
        (3, None, "d", False, 0, 0, "t", at(2)),
        (4, None, "d", True, 0, 0, "t", at(3)),
        (5, None, "d", False, 0, 1, "t", at(4)),
        (6, None, "d", False, 0, 0, "t", at(5)),
        (7, {}, "d", False, 0, 0, "t", at(6)),
    ]
    df = spark.createDataFrame(
        rows,
        "message_id long, properties map<string,string>, destination string, redelivered boolean, expiration long, "
        "priority int, text string, receive_ts timestamp",
    )
    assert ids(dedup.distinct_content(df)) == [1, 3, 4, 5, 7]


def test_across_windows(spark):
    df = messages(spark, [("q", 1, 0, "a"), ("q", 1, 900, "a", True), ("q", 2, 1, "b")])
    assert ids(dedup.distinct_across_windows(df)) == [1, 2]


def test_without_order_any_copy_survives(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "key int, v string")
    assert sorted(r.key for r in dedup.first_by(df, ["key"]).collect()) == [1, 2]


def test_redelivery(spark):
    rows = [("q", 1, 0, "a"), ("q", 1, 1, "a", True), ("q", 1, 2, "a", True), ("q", 2, 0, "b"), ("q", 3, 0, "c"), ("q", 3, 1, "x", True)]
    df = messages(spark, rows)
    pairs = {r.message_id: tuple(r)[2:] for r in dedup.redelivery_pairs(df).collect()}
    assert pairs == {1: (1, 2, True), 3: (1, 1, False)}
    assert [tuple(r) for r in dedup.duplicate_totals(df).collect()] == [("q", 3, 6, 3)]


def test_reconnect_gives_two_n_minus_one(spark):
    """One message was consumed before the reconnect; the others come twice."""
    n = 10
    first = messages(spark, [(q, i, i, f"{q} - {i}") for q in "ab" for i in range(n)])
    again = messages(spark, [(q, i, 60 + i, f"{q} - {i}", True) for q in "ab" for i in range(1, n)])
    totals = {r.queue: r.receipts for r in dedup.duplicate_totals(first.union(again)).collect()}
    assert totals == {"a": 2 * n - 1, "b": 2 * n - 1}


def test_bag_difference(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "text string")
    right = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "text string")
    assert sorted(tuple(r) for r in dedup.bag_difference(left, right).collect()) == [("a", 2, 1), ("c", 0, 1)]
    assert dedup.bag_difference(left, left).isEmpty()


def test_hot_message(spark):
    """Half of all rows are copies of one message; word counts are as if it came once."""
    copies = spark.range(20_000).select(
        F.lit("q").alias("queue"),
        F.when(F.col("id") < 10_000, F.lit(1)).otherwise(F.col("id")).alias("message_id"),
        F.lit(at(0)).alias("receive_ts"),
        (F.col("id") != 0).alias("redelivered"),
        F.lit("one two").alias("text"),
    )
    counted = {r.word: r["count"] for r in deduplicated_word_count(copies).collect()}
    assert counted == {"one": 10_001, "two": 10_001}
