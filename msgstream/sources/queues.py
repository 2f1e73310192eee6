"""Reading messages of named queues from any Spark source that yields the envelope."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from msgstream.config import ReadConfig
from msgstream.operators.dedup import comparable_map
from msgstream.operators.eventtime import with_event_time
from msgstream.operators.selection import first_rows
from msgstream.schemas import ENVELOPE
from msgstream.sources.landing import closing

def read_queues(
    spark: SparkSession,
    path: str,
    config: ReadConfig,
    mapper: Callable[[DataFrame], DataFrame] = lambda df: df,
    fmt: str = "parquet",
    schema=ENVELOPE,
) -> DataFrame:
    """Messages of the listed queues, mapped: a batch if the config says so or sets a limit, else a stream.

    Each message comes once, however often its queue is listed. Tasks follow the files and their
    splits, so one long queue is read by many of them. ``mapper`` turns envelope rows into records. A batch
    does not see what closed the queues for streams (:func:`msgstream.sources.landing.close_queues`).
    """
    if config.bounded:
        rows = select_queues(_reader(spark.read, config, fmt, schema).load(path), config.queues)
        rows = limited(rows.where(~closing()), config)
    else:
        rows = stream_queues(spark, path, config, fmt, schema)
    return rows.transform(mapper)


def stream_queues(
    spark: SparkSession, path: str, config: ReadConfig, fmt: str = "parquet", schema=ENVELOPE, file_column: str | None = None
) -> DataFrame:
    """``file_column`` adds the path of the file that each message was read from."""
    rows = _reader(spark.readStream, config, fmt, schema).options(**config.rate_options).load(path)
    if file_column is not None:
        rows = rows.select("*", F.col("_metadata.file_path").alias(file_column))
    return select_queues(rows, config.queues)


def stream_each_queue(
    spark: SparkSession, path: str, config: ReadConfig, lateness: str, fmt: str = "parquet", schema=ENVELOPE
) -> DataFrame:
    """One stream and one watermark per queue, in one DataFrame with an ``event_time``.

    Under ``spark.sql.streaming.multipleWatermarkPolicy`` = ``min`` (Spark's default) the slowest
    queue holds back all windows, and an idle one stops them; :func:`stream_queues` has no such stall.
    """
    streams = [
        with_event_time(
            stream_queues(spark, path, config.with_(queues=[queue]), fmt, schema), config.use_sender_timestamp, lateness
        )
        for queue in config.unique_queues
    ]
    return reduce(DataFrame.unionByName, streams)


def _reader(reader, config: ReadConfig, fmt: str, schema):
    return reader.format(fmt).schema(schema).options(**(config.options or {}))


def select_queues(df: DataFrame, queues: list[str]) -> DataFrame:
    """Prunes directories when the source is partitioned by queue."""
    return df.where(F.col("queue").isin(*dict.fromkeys(queues)))


def limited(df: DataFrame, config: ReadConfig) -> DataFrame:
    """Applies the read limits; with both, whichever is reached first ends the read.

    A record limit is found by :func:`msgstream.operators.selection.first_rows`, so jobs run when this is called.
    """
    if config.max_read_time is not None:
        df = within_read_time(df, config.max_read_time)
    if config.max_records is not None:
        df = first_rows(df, config.max_records, [*_receipt_order()])
    return df


def _receipt_order() -> tuple[Column, Column]:
    """Receive time in microseconds and id; a message without either is an error."""
    none = F.raise_error(F.lit("a message has no receive time or no id")).cast("long")
    return F.coalesce(F.unix_micros("receive_ts"), none), F.coalesce("message_id", none)


def within_read_time(df: DataFrame, duration: timedelta) -> DataFrame:
    """Messages received less than ``duration`` after the first one."""
    length = F.make_dt_interval(secs=F.lit(duration / timedelta(seconds=1)))
    end = df.agg((F.min("receive_ts") + length).alias("end")).scalar()
    return df.where(F.col("receive_ts") < end)


def _cut(rows: DataFrame, key: Column, wanted: Column) -> Column:
    """STRUCT<key, before>: the first key at which, in order, ``wanted`` rows are reached, and the rows before it.

    NULL if there are fewer rows. Rows are counted by key first; only the counts are put in order.
    """
    so_far = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    counts = rows.groupBy(key.alias("key")).agg(F.count("*").alias("n"))
    reached = counts.withColumn("before", F.sum("n").over(so_far) - F.col("n"))
    crossing = reached.where(F.col("before") + F.col("n") >= wanted)
    return crossing.agg(F.min(F.struct("key", "before"))).scalar()


def first_records(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` first messages over all queues, by receive time, then id.

    For plans that must not run anything before their result is asked for; else the selection that
    :func:`limited` uses bounds what a task reads.

    A sort with a limit would draw up to ``n`` rows of every task into one. Instead the place of the last row
    is found by counting, by hour, then by second within that hour, then by time and id within that second,
    and rows are kept by a filter. That takes three more passes over the two order columns, as subqueries of
    the one plan: nothing runs before the result is asked for, and nothing depends on the number of rows.
    Messages that agree in time and id, of which only some are kept, are numbered in each task, and tasks keep
    as many as the limit leaves them. Rows must come from the same tasks each time they are read, as those of
    files do. A message without a receive time or id is an error.
    """
    time = F.unix_micros("receive_ts")
    none = F.raise_error(F.lit("a message has no receive time or no id")).cast("long")
    known = F.when(F.col("message_id").isNull(), none).otherwise(F.coalesce(time, none))
    hour, second = F.call_function("div", known, F.lit(3_600_000_000)), F.call_function("div", time, F.lit(1_000_000))
    place = F.struct(time.alias("us"), F.col("message_id").alias("id"))

    order = df.select("receive_ts", "message_id")
    by_hour = _cut(order, hour, F.lit(n))
    within = order.where(F.call_function("div", time, F.lit(3_600_000_000)) == by_hour["key"])
    by_second = _cut(within, second, n - by_hour["before"])
    within = order.where(second == by_second["key"])
    before = by_hour["before"] + by_second["before"]
    last = _cut(within, place, n - before)
    wanted = n - before - last["before"]

    earlier = last.isNull() | (place < last["key"])
    tied = df.where(place == last["key"])
    numbered = tied.withColumn("_task", F.spark_partition_id())
    of_task = Window.partitionBy("_task").orderBy(F.xxhash64(*_comparable(df)))
    numbered = numbered.withColumn("_nr", F.row_number().over(of_task))
    counts = order.where(place == last["key"]).groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"))
    sums = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("before", F.sum("n").over(sums) - F.col("n"))
    starts = counts.agg(F.map_from_entries(F.collect_list(F.struct("task", "before")))).scalar()
    chosen = numbered.where(F.element_at(starts, F.col("_task")) + F.col("_nr") <= wanted)
    return df.where(earlier).unionByName(chosen.drop("_task", "_nr"))


def _comparable(df: DataFrame) -> list[Column]:
    """All columns in a form that can be compared and hashed."""
    return [
        comparable_map(f.name).alias(f.name) if f.dataType.typeName() == "map" else F.col(f.name) for f in df.schema.fields
    ]
