"""Queue health from a delivery log: one row per thing that happened to a message.

Kinds are ``published``, ``delivered``, ``ready`` (part of a commit about to be acknowledged), ``acked``,
``removed`` (forgotten by its reader before being ready, to be delivered again) and ``rebind`` (a reader
re-opened its queue; no message).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from msgstream.operators.running import last_before, running


def _is(kind: str) -> Column:
    return F.col("kind") == kind


def message_status(log: DataFrame) -> DataFrame:
    """One row per message: which stages it reached, and its size.

    One grouped pass in place of joining the log to itself per question. Flags are combined before
    the shuffle, so a message logged very often costs one row per task.
    """
    return (
        log.where(F.col("message_id").isNotNull())
        .groupBy("queue", "message_id")
        .agg(
            F.max(_is("published").cast("int")).alias("published"),
            F.max(_is("delivered").cast("int")).alias("delivered"),
            F.max(_is("acked").cast("int")).alias("acked"),
            F.max("size_bytes").alias("size_bytes"),
        )
    )


def queue_status(log: DataFrame, queues: list[str]) -> DataFrame:
    """Per queue: messages and bytes waiting, unacknowledged deliveries, and what follows from them.

    ``queues`` adds queues with an empty log, shown as zeros. A backlog is NULL where the size of a
    waiting message is unknown.
    """
    status = message_status(log)
    waiting = (F.col("published") == 1) & (F.col("acked") == 0)
    unacked = (F.col("delivered") == 1) & (F.col("acked") == 0)
    per_message = status.select(
        "queue",
        F.col("published").cast("long").alias("published"),
        (F.col("acked") == 1).cast("long").alias("received"),
        waiting.cast("long").alias("message_count"),
        unacked.cast("long").alias("unacked_count"),
        F.when(waiting, F.col("size_bytes")).otherwise(0).alias("backlog_bytes"),
        (waiting & F.col("size_bytes").isNull()).cast("long").alias("unsized"),
    )
    counted = ("published", "received", "message_count", "unacked_count", "backlog_bytes", "unsized")
    empty = _queue_rows(log.sparkSession, queues).select("queue", *[F.lit(0).cast("long").alias(c) for c in counted])
    totals = per_message.unionByName(empty).groupBy("queue").agg(*[F.sum(c).alias(c) for c in counted])
    return totals.select(
        "queue",
        "published",
        "received",
        "message_count",
        "unacked_count",
        F.when(F.col("unsized") == 0, F.col("backlog_bytes")).alias("backlog_bytes"),
        (F.col("message_count") == 0).alias("is_empty"),
        (F.col("unacked_count") >= F.col("message_count")).alias("all_delivered"),
        (F.col("published") == F.col("message_count") + F.col("received")).alias("conserved"),
    )


def _queue_rows(spark: SparkSession, queues: list[str]) -> DataFrame:
    names = F.array(*[F.lit(q) for q in dict.fromkeys(queues)]).cast("array<string>")
    return spark.range(1).select(F.explode(names).alias("queue"))


def queue_backlog(log: DataFrame, queues: list[str]) -> DataFrame:
    return queue_status(log, queues).select("queue", "message_count", "backlog_bytes", "is_empty")


def queue_unacked(log: DataFrame, queues: list[str]) -> DataFrame:
    return queue_status(log, queues).select("queue", "unacked_count")


def queue_caught_up(log: DataFrame, queues: list[str]) -> DataFrame:
    return queue_status(log, queues).select("queue", "message_count", "unacked_count", "all_delivered")


def delivery_conservation(published: DataFrame, received: DataFrame, left: DataFrame) -> DataFrame:
    """Per queue, distinct messages published, received and still waiting, and whether they add up.

    The inputs need ``queue`` and ``message_id``. Repeats of a message collapse before the shuffle.
    """
    per_message = _seen_on(published=published, received=received, left=left)
    both = F.col("received") * F.col("left")
    totals = per_message.groupBy("queue").agg(
        F.sum("published").alias("published"),
        F.sum("received").alias("received"),
        F.sum("left").alias("left"),
        F.sum(both).alias("in_both"),
    )
    return totals.withColumn("conserved", F.col("published") == F.col("left") + F.col("received") - F.col("in_both"))


def not_received(published: DataFrame, received: DataFrame) -> DataFrame:
    """Messages published but not among those received, once each."""
    return _seen_on(published=published, received=received).where("published = 1 and received = 0").select("queue", "message_id")


def _seen_on(**sides: DataFrame) -> DataFrame:
    """One row per message with a 0/1 column per side. Takes the place of full and anti joins: copies
    collapse before the shuffle, so no key is hot on either side."""
    marked = [
        df.select("queue", "message_id", *[F.lit(int(name == side)).alias(name) for name in sides])
        for side, df in sides.items()
    ]
    merged = reduce(DataFrame.unionByName, marked)
    return merged.groupBy("queue", "message_id").agg(*[F.max(name).alias(name) for name in sides])


def drain_queues(df: DataFrame, queues: list[str]) -> DataFrame:
    """The messages that stay when the listed queues are emptied."""
    return df.where(~F.col("queue").isin(*dict.fromkeys(queues)))


def queue_counters(log: DataFrame, period: str = "120 seconds", block: int | None = None) -> DataFrame:
    """Reader counters per queue and period, starting from zero in each; the backlog is the level at its end.

    The backlog counts a message from its first publication to its first acknowledgement, however
    often either was logged. The running sum is over one row per queue and period. Where a queue has more periods
    than one task should hold, as with periods of a second over years, give ``block``: the sum is then taken in
    blocks of that many seconds (:func:`msgstream.operators.running.running`).
    """
    window = F.window("event_time", period).alias("window")
    counted = {
        "messages_received": _is("delivered"),
        "messages_ready": _is("ready"),
        "messages_completed": _is("acked"),
        "rebinds": _is("rebind"),
        "messages_removed": _is("removed"),
    }
    zero = F.lit(0).cast("long")
    activity = log.groupBy("queue", window).agg(
        *[F.count_if(condition).alias(name) for name, condition in counted.items()]
    )

    first = (
        log.where(F.col("kind").isin("published", "acked"))
        .groupBy("queue", "message_id")
        .agg(
            F.min(F.when(_is("published"), F.col("event_time"))).alias("published_at"),
            F.min(F.when(_is("acked"), F.col("event_time"))).alias("acked_at"),
            F.max("size_bytes").alias("size_bytes"),
        )
        .where("published_at is not null")
    )
    step = F.explode(
        F.array(
            F.struct(F.col("published_at").alias("event_time"), F.col("size_bytes").alias("change")),
            F.struct(F.col("acked_at").alias("event_time"), (-F.col("size_bytes")).alias("change")),
        )
    ).alias("step")
    changes = (
        first.select("queue", step)
        .select("queue", "step.*")
        .where("event_time is not null")
        .groupBy("queue", window)
        .agg(F.sum("change").alias("change"))
    )
    merged = activity.withColumn("change", zero).unionByName(
        changes.select("queue", "window", *[zero.alias(c) for c in counted], "change")
    )
    per_period = merged.groupBy("queue", "window").agg(*[F.sum(c).alias(c) for c in (*counted, "change")])
    if block is not None:
        timed = per_period.withColumns({"_second": F.unix_seconds("window.start"), "queue_backlog": F.col("change")})
        levels = running(timed, ["queue"], ["_second"], {"queue_backlog": "sum"}, block)
        return levels.select("queue", "window", "queue_backlog", *counted)
    so_far = Window.partitionBy("queue").orderBy("window").rowsBetween(Window.unboundedPreceding, 0)
    return per_period.select(
        "queue",
        "window",
        F.sum("change").over(so_far).alias("queue_backlog"),
        *counted,
    )


def commit_prefixes(log: DataFrame, every: str, block: int = 65_536) -> DataFrame:
    """Per queue and commit interval, the highest message up to which all delivered ones are acknowledged.

    A reader may only commit what lies before the first message still unacknowledged, so a message counts from
    the time at which it and all delivered ones of smaller ids were acknowledged: a running maximum over the ids of a
    queue, taken in blocks of ids and over many tasks. ``committed`` counts the messages that an interval moved the
    mark past. An interval in which the mark did not move has no row. Ids are taken as sequence numbers.
    """
    stages = log.where(F.col("message_id").isNotNull() & F.col("kind").isin("delivered", "acked"))
    per_message = stages.groupBy("queue", "message_id").agg(
        F.max(_is("delivered")).alias("delivered"),
        F.min(F.when(_is("acked"), F.col("event_time"))).alias("acked_at"),
    )
    # A message that was never acknowledged holds its queue for good.
    never = F.lit(2**63 - 1)
    held = per_message.where("delivered").select(
        "queue", "message_id", F.coalesce(F.unix_micros("acked_at"), never).alias("done")
    )
    marks = running(held, ["queue"], ["message_id"], {"done": "max"}, block).where(F.col("done") < never)
    window = F.window(F.timestamp_micros("done"), every).alias("window")
    return marks.groupBy("queue", window).agg(F.max("message_id").alias("through"), F.count("*").alias("committed"))


def redelivery_causes(log: DataFrame, slice_us: int = 3_600_000_000, parts: int = 4) -> DataFrame:
    """Per message and rebind, how often the message was delivered after that rebind of its queue and before the
    next one; ``rebind_at`` is NULL for deliveries before any.

    Each delivery is joined as of its time to the last rebind at or before it, which needs no pairs: see
    :func:`msgstream.operators.running.last_before`.
    """
    known = F.col("message_id").isNotNull()
    deliveries = log.where(_is("delivered") & known).select("queue", "message_id", "event_time")
    caused = last_before(deliveries, log.where(_is("rebind")), ["queue"], "event_time", "rebind_at", slice_us, parts)
    return caused.groupBy("queue", "message_id", "rebind_at").agg(F.count("*").alias("attempts"))


def counters_json() -> Column:
    """The counters as one line of JSON, keys in a fixed order."""
    # The key of each counter.
    keys = {
        "queueBacklog": "queue_backlog",
        "messagesReceived": "messages_received",
        "messagesCheckpointReady": "messages_ready",
        "messagesCheckpointComplete": "messages_completed",
        "pollFlowRebind": "rebinds",
        "messagesRemovedFromCheckpointQueue": "messages_removed",
    }
    return F.to_json(F.struct(*[F.col(column).alias(key) for key, column in keys.items()]))
