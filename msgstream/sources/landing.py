"""Putting messages where :mod:`msgstream.sources.queues` reads them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgstream.functions.text import numbered_payload
from msgstream.schemas import ENVELOPE

# Later than any message, and early enough for all that adds to it.
END_OF_TIME = "9000-01-01 00:00:00Z"

# Bytes of a row group, the least that a task reads, of published files.
ROW_GROUP = 16 << 20

# Micro-batches into which a landing folder is cut, if it holds files enough.
BATCHES = 4


def envelope(df: DataFrame, **columns: Column) -> DataFrame:
    """Rows completed to the envelope: columns not given and not in ``df`` are NULL."""
    given = {name: F.col(name) for name in df.columns} | columns
    return df.select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ENVELOPE.fields]
    )


def publish(messages: DataFrame, path: str) -> None:
    """Appends messages to a landing folder, one directory per queue.

    Rows are gathered by queue so that each gets few files, while a queue too large for one task is
    split over several. Files are made of small row groups, so that a few of them still keep many tasks busy.
    """
    writer = messages.hint("rebalance", "queue").write.mode("append").option("parquet.block.size", ROW_GROUP)
    writer.partitionBy("queue").parquet(path)


def publish_in_order(messages: DataFrame, path: str, time: Column, slices: int = 4) -> str:
    """:func:`publish` in slices of event time of about equal size, the earliest first, as messages would arrive.

    A stream that reads the oldest files first then meets rows out of order only within a slice. Returns the
    lateness that allows for it: the span of the longest slice. Messages without a time come first.
    """
    us = F.unix_micros(time)
    shares = F.array(*[F.lit(k / slices) for k in range(slices + 1)])
    quantiles = F.kll_sketch_get_quantile_bigint(F.kll_sketch_agg_bigint(us), shares)
    bounds = messages.agg(F.when(F.count(us) > 0, quantiles), F.min(us), F.max(us)).first()
    cuts = sorted({*(bounds[0] or [])[1:-1]})
    edges = [None, *cuts, None]
    for low, high in zip(edges, edges[1:], strict=False):
        inside = F.lit(True) if low is None else us >= low
        inside = inside if high is None else inside & (us < high)
        publish(messages.where(inside | us.isNull() if low is None else inside), path)
    ends = [bounds[1] or 0, *cuts, bounds[2] or 0]
    longest = max(b - a for a, b in zip(ends, ends[1:], strict=False))
    return f"{longest // 1_000_000 + 1} seconds"


def files_per_batch(spark: SparkSession, least: int, path: str | None = None, schema=ENVELOPE) -> int:
    """How many files of a landing folder a micro-batch should take.

    Two for every task that runs at once, so that the time of a drain follows the rows and not the number of files.
    With the ``path`` of the folder no more than gives :data:`BATCHES` micro-batches, for streams that release state
    as they go. Never under ``least``.
    """
    most = 2 * spark.sparkContext.defaultParallelism
    if path is not None:
        most = min(most, len(spark.read.schema(schema).parquet(path).inputFiles()) // BATCHES)
    return max(least, most)


def closing() -> Column:
    """Whether a row is the message that :func:`close_queues` leaves."""
    return F.coalesce(F.col("receive_ts") == F.lit(END_OF_TIME).cast("timestamp"), F.lit(False))


def close_queues(spark: SparkSession, path: str, queues: list[str], schema=ENVELOPE) -> None:
    """Tells readers of a landing folder that nothing follows: one message without a body per queue, from so
    far ahead that it moves the watermark past every window. Its own window never closes, so it is not seen
    in windowed results."""
    names = F.explode(F.array(*[F.lit(q) for q in dict.fromkeys(queues)])).alias("queue")
    known = {"message_id": F.lit(-1), "message_type": F.lit("text"), "redelivered": F.lit(False)}
    known |= {name: F.lit(END_OF_TIME).cast("timestamp") for name in ("receive_ts", "sender_ts")}
    row = spark.range(1).select(names)
    columns = [known.get(f.name, F.col("queue") if f.name == "queue" else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    publish(row.select(*columns), path)


def _ids(spark: SparkSession, queues: list[str], per_queue: int) -> DataFrame:
    """``queue, number`` from 0 for each queue, made by as many tasks as Spark splits the range into."""
    names = F.array(*[F.lit(q) for q in queues])
    return spark.range(per_queue * len(queues)).select(
        F.element_at(names, (F.col("id") % len(queues) + 1).cast("int")).alias("queue"),
        F.call_function("div", "id", F.lit(len(queues))).alias("number"),
    )


def copies_per_queue(spark: SparkSession, queues: list[str], copies: int, body: Column) -> DataFrame:
    """``copies`` persistent messages with the same encoded body for each queue."""
    return envelope(
        _ids(spark, queues, copies),
        message_id=F.col("number") + 1,
        message_type=F.lit("bytes"),
        content=body,
        redelivered=F.lit(False),
        receive_ts=F.current_timestamp(),
    )


def numbered_messages(spark: SparkSession, queues: list[str], per_queue: int) -> DataFrame:
    """``"<queue> - <i>"`` for i from 0, for each queue, in the attachment."""
    return envelope(
        _ids(spark, queues, per_queue),
        message_id=F.col("number"),
        message_type=F.lit("xml"),
        attachment=numbered_payload("queue", "number").cast("binary"),
        redelivered=F.lit(False),
        receive_ts=F.current_timestamp(),
    )
