"""Event time, fixed windows and how far each queue has got."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgstream.functions.text import utc_time


def event_time(use_sender_timestamp: bool = False) -> Column:
    """When the message counts as having happened: as sent, else (or where unknown) as received."""
    return F.coalesce("sender_ts", "receive_ts") if use_sender_timestamp else F.col("receive_ts")


def with_event_time(df: DataFrame, use_sender_timestamp: bool = False, lateness: str | None = None) -> DataFrame:
    """Adds ``event_time``; ``lateness`` also sets how late a streamed row may come ("0 seconds": not at all)."""
    timed = df.withColumn("event_time", event_time(use_sender_timestamp))
    return timed if lateness is None else timed.withWatermark("event_time", lateness)


def fixed_window(df: DataFrame, width: str) -> DataFrame:
    """Replaces ``event_time`` by its epoch-aligned ``window``.

    Only one event-time column may follow a streaming dedup, hence the replacement.
    """
    return df.withColumn("window", F.window("event_time", width)).drop("event_time")


def window_bounds(df: DataFrame) -> DataFrame:
    """``window`` as two zone-free columns in UTC, ``window_start`` and ``window_end``."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        utc_time("window.start").alias("window_start"),
        utc_time("window.end").alias("window_end"),
        *rest,
    )


def latency_ms() -> Column:
    return F.unix_millis("receive_ts") - F.unix_millis("sender_ts")


def freshness(df: DataFrame, by=("queue",)) -> DataFrame:
    """Time from sending to receipt, per queue. Messages without a sender time are counted apart.

    Percentiles are exact; what they gather is one count per distinct number of milliseconds.
    """
    wait = latency_ms()
    return df.groupBy(*by).agg(
        F.count("sender_ts").alias("timed_messages"),
        F.count_if(F.col("sender_ts").isNull()).alias("untimed_messages"),
        F.min(wait).alias("min_latency_ms"),
        F.max(wait).alias("max_latency_ms"),
        F.sum(wait).alias("total_latency_ms"),
        F.avg(wait).alias("avg_latency_ms"),
        F.percentile(wait, 0.5).alias("median_latency_ms"),
        F.percentile(wait, 0.95).alias("p95_latency_ms"),
    )


def _acked_time() -> Column:
    return F.when(F.col("kind") == "acked", F.col("event_time"))


def queue_watermarks(log: DataFrame, start: Column | None = None) -> DataFrame:
    """Per queue, the latest event time acknowledged. It never falls behind ``start``, the time the
    reader opened; without one, a queue with nothing acknowledged has none (NULL)."""
    mark = F.max(_acked_time())
    if start is not None:
        mark = F.greatest(start, mark)
    return log.groupBy("queue").agg(F.count(_acked_time()).alias("acked"), mark.alias("watermark"))


def overall_watermark(log: DataFrame, start: Column) -> DataFrame:
    """How far all queues have got: the least of their watermarks, so an idle queue holds it at ``start``."""
    return queue_watermarks(log, start).agg(F.min("watermark").alias("watermark"))


def commit_progress(log: DataFrame, every: str, start: Column | None = None) -> DataFrame:
    """Per queue and commit interval: messages acknowledged, and the watermark once committed.

    An interval without acknowledgements moves nothing and has no row. The running maximum is taken
    over one row per interval, so its cost depends on the time span and not on the message count.
    """
    commits = (
        log.where("kind = 'acked'")
        .groupBy("queue", F.window("event_time", every).alias("window"))
        .agg(F.count("*").alias("acked"), F.max("event_time").alias("latest"))
    )
    so_far = Window.partitionBy("queue").orderBy("window").rowsBetween(Window.unboundedPreceding, 0)
    mark = F.max("latest").over(so_far)
    if start is not None:
        mark = F.greatest(start, mark)
    return commits.select("queue", "window", "acked", mark.alias("watermark"))
