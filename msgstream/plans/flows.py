"""The end-to-end flows, each for batch and stream alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgstream.functions.proto import decode_test
from msgstream.operators.dedup import SURVIVOR_ORDER, distinct_by_sequence, distinct_in_window
from msgstream.operators.eventtime import fixed_window, with_event_time
from msgstream.operators.words import count_words, format_counts


def windowed(df: DataFrame, width: str, use_sender_timestamp: bool = False, lateness: str = "0 seconds") -> DataFrame:
    """Rows with their ``window``; a stream drops what comes later than ``lateness`` after it."""
    return fixed_window(with_event_time(df, use_sender_timestamp, lateness if df.isStreaming else None), width)


def deduplicated_word_count(
    df: DataFrame,
    width: str = "4 seconds",
    by_sequence: bool = False,
    use_sender_timestamp: bool = False,
    lateness: str = "0 seconds",
    salts: int = 0,
) -> DataFrame:
    """Words per window, each message counted once in its window; ``salts`` as in :func:`first_by`."""
    needed = ["message_id", "sequence_number", "sender_ts", "receive_ts", "redelivered", "queue", "text"]
    rows = windowed(df.select(*[c for c in needed if c in df.columns]), width, use_sender_timestamp, lateness)
    return count_words(distinct_by_sequence(rows, salts=salts) if by_sequence else distinct_in_window(rows, salts=salts))


def first_messages(
    df: DataFrame, width: str = "4 seconds", use_sender_timestamp: bool = False, lateness: str = "0 seconds"
) -> DataFrame:
    """``window, message_id, text`` of the first copy of each message in its window.

    A stream remembers one row per message of an open window, however many words its text has, and gives all
    messages of a window in the one micro-batch that closes it. So what is counted by window in each micro-batch
    (:func:`msgstream.streaming.jobs.start_panes`) is final and needs no state of its own.
    """
    rows = windowed(df, width, use_sender_timestamp, lateness)
    order = F.struct(*[c for c in SURVIVOR_ORDER if c in rows.columns and c != "message_id"])
    return rows.groupBy("window", "message_id").agg(F.min_by("text", order).alias("text"))


def word_count_lines(
    df: DataFrame, width: str = "10 seconds", use_sender_timestamp: bool = False, lateness: str = "0 seconds"
) -> DataFrame:
    """``word: count`` lines per window, repeats included; to be written as window files."""
    return format_counts(count_words(windowed(df, width, use_sender_timestamp, lateness)))


def decoded_messages(
    df: DataFrame, width: str = "4 seconds", use_sender_timestamp: bool = False, lateness: str = "0 seconds"
) -> DataFrame:
    """Encoded bodies, once per message id and window, decoded."""
    rows = distinct_in_window(windowed(df, width, use_sender_timestamp, lateness))
    decoded = decode_test("content")
    return rows.select("window", "message_id", decoded.alias("message")).select(
        "window", "message_id", F.col("message.test").alias("test")
    )
