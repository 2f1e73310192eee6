"""Small message tables."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from msgstream.schemas import ENVELOPE

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def envelope_rows(spark, rows):
    """Envelope rows from dicts; what a dict leaves out is NULL, but for the queue, type and receive time."""
    defaults = {"queue": "q", "message_type": "text", "message_id": 0, "receive_ts": at(0), "redelivered": False}
    full = [tuple({**defaults, **row}.get(name) for name in ENVELOPE.fieldNames()) for row in rows]
    return spark.createDataFrame(full, ENVELOPE)


def messages(spark, rows):
    """(queue, message_id, seconds, text[, redelivered]) as mapped messages."""
    full = [(q, i, at(s), t, *(rest or [False])) for q, i, s, t, *rest in rows]
    df = spark.createDataFrame(full, "queue string, message_id long, receive_ts timestamp, text string, redelivered boolean")
    return df.select(
        "*", F.col("receive_ts").alias("sender_ts"), F.col("message_id").alias("sequence_number")
    )

