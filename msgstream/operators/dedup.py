"""Removing repeated messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The record fields that make two messages equal, whatever their ids.
CONTENT_FIELDS = ("properties", "destination", "redelivered", "expiration", "priority", "text")

# Of several copies the first by these survives, as far as the rows have them.
SURVIVOR_ORDER = ("receive_ts", "redelivered", "message_id", "queue")


def first_by(df: DataFrame, keys, order=SURVIVOR_ORDER, salts: int = 0) -> DataFrame:
    """One whole row per key. NULL keys count as equal here.

    In batch the first in ``order`` survives; each task drops its own repeats before the shuffle, so
    a key that holds a large share of the rows sends one row per task. In a stream, or where no
    order is known, any one survives. A stream shuffles all copies of a message to one task; if some
    messages come very often, ``salts`` makes that many tasks drop most copies first, at the price
    of a second set of keys to remember.
    """
    order = [c for c in order if c in df.columns and c not in keys]
    if df.isStreaming:
        return _drop_repeats(df, keys, salts, DataFrame.dropDuplicates)
    if not order:
        return df.dropDuplicates(list(keys))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def _drop_repeats(df: DataFrame, keys, salts: int, drop) -> DataFrame:
    if salts:
        # A row that gets another salt when a task is run again only passes on to the second step.
        salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        df = drop(salted, [*keys, "_salt"]).drop("_salt")
    return drop(df, list(keys))


def distinct_in_window(df: DataFrame, key="message_id", on_null: str = "equal", order=SURVIVOR_ORDER, salts: int = 0) -> DataFrame:
    """One row per ``key`` within each ``window``; the same key in two windows stays twice.

    ``key`` is a column or several: ids alone do not tell queues apart, ``("queue", "message_id")`` does.
    ``on_null`` says what a row without a key is: "equal" to other such rows, to be kept as it is
    ("keep", never shuffled), or an "error".

    "keep" reads its input twice, once for rows with a key and once for those without: the second reading
    spares rows without a key the shuffle and, in a stream, the state. Give it rows that are cheap to read.
    """
    keys = [key] if isinstance(key, str) else list(key)
    missing = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    if on_null == "equal":
        return first_by(df, ["window", *keys], order, salts)
    if on_null == "error":
        complaint = F.raise_error(F.lit(f"{', '.join(keys)} is null"))
        checked = df.withColumn(keys[0], F.when(~missing, F.col(keys[0])).otherwise(complaint))
        return first_by(checked, ["window", *keys], order, salts)
    if on_null != "keep":
        raise ValueError(f"on_null must be 'equal', 'keep' or 'error', not {on_null!r}")
    return first_by(df.where(~missing), ["window", *keys], order, salts).unionByName(df.where(missing))


def distinct_by_sequence(df: DataFrame, on_null: str = "keep", salts: int = 0) -> DataFrame:
    return distinct_in_window(df, "sequence_number", on_null, salts=salts)


def comparable_map(column) -> Column:
    """A map as text that is equal for equal maps, whatever the order of their keys."""
    return F.to_json(F.array_sort(F.map_entries(column)))


def distinct_content(df: DataFrame, within=(), order=SURVIVOR_ORDER) -> DataFrame:
    """One row per distinct content: two messages are equal when all of ``CONTENT_FIELDS`` are.

    In a stream name the ``window`` in ``within``, or all contents ever seen are remembered.
    """
    keyed = df.withColumn("_properties", comparable_map("properties"))
    keys = [*within, "_properties", *(c for c in CONTENT_FIELDS if c != "properties")]
    return first_by(keyed, keys, order).drop("_properties")


def distinct_across_windows(df: DataFrame, key=("message_id",), salts: int = 0) -> DataFrame:
    """One row per key for as long as the watermark remembers it; over a whole table, one row per key."""
    if df.isStreaming:
        return _drop_repeats(df, key, salts, DataFrame.dropDuplicatesWithinWatermark)
    return first_by(df, key)


def receipts(df: DataFrame, keys=("queue", "message_id")) -> DataFrame:
    """Per message: how often it came, first sent or sent again, and whether its text was always the same.

    One aggregate, combined before the shuffle, so a message repeated very often stays cheap and no pairs of
    copies are built. Texts are compared by their SHA-256 and never move; a missing text differs from others.
    """
    digest = F.coalesce(F.sha2("text", 256), F.lit(""))
    return df.groupBy(*keys).agg(
        F.count_if(~F.col("redelivered")).alias("first_copies"),
        F.count_if(F.col("redelivered")).alias("redelivered_copies"),
        (F.min(digest) == F.max(digest)).alias("same_text"),
    )


def redelivery_pairs(df: DataFrame) -> DataFrame:
    """Messages that came both as first copy and sent again."""
    return receipts(df).where("first_copies > 0 and redelivered_copies > 0")


def duplicate_totals(df: DataFrame) -> DataFrame:
    """Per queue: messages, receipts and surplus receipts. A reconnect that re-sends all but one of
    n messages shows 2n - 1 receipts."""
    per_message = df.groupBy("queue", "message_id").agg(F.count("*").alias("copies"))
    return per_message.groupBy("queue").agg(
        F.count("*").alias("messages"), F.sum("copies").alias("receipts"), F.sum(F.col("copies") - 1).alias("surplus")
    )


def bag_difference(left: DataFrame, right: DataFrame, columns=("text",)) -> DataFrame:
    """Values that do not occur equally often on both sides, with both counts; empty when the bags are equal.

    Both sides are counted before they meet, so a very frequent value costs one row per task and
    surplus copies are reported as a number, not emitted one by one.
    """
    columns = list(columns)
    sides = [
        df.select(*columns, F.lit(a).alias("left_count"), F.lit(b).alias("right_count"))
        for df, a, b in ((left, 1, 0), (right, 0, 1))
    ]
    counted = reduce(DataFrame.unionByName, sides).groupBy(*columns).agg(
        F.sum("left_count").alias("left_count"), F.sum("right_count").alias("right_count")
    )
    return counted.where("left_count <> right_count")
