"""Changing the width of the windows of a running job without losing what its open windows hold.

A job that sums values by window keeps the sums of open windows in its state, and Spark ties that state to the
width. So the job is stopped, the sums are read from its checkpoint, and a new job starts from them: they are
the first rows it gets, next to the messages that the old job has not taken.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from msgstream.config import ReadConfig
from msgstream.schemas import ENVELOPE
from msgstream.sources.queues import stream_queues


def window_totals(rows: DataFrame, width: str, keys=("queue",)) -> DataFrame:
    """Sums of ``n`` per window and key, of rows with a watermarked ``event_time``.

    A job made of this alone, before or after others that keep no state, can be given another width.
    """
    return rows.groupBy(F.window("event_time", width).alias("window"), *keys).agg(F.sum("n").alias("count"))


def _batches(spark: SparkSession, folder: str) -> int:
    """The highest batch number that a folder of a checkpoint has a file for; -1 without any."""
    try:
        names = spark.read.text(folder).select(F.col("_metadata.file_name").alias("name"))
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return -1
    highest = names.agg(F.max(F.regexp_extract("name", r"^(\d+)", 1).try_cast("long"))).scalar()
    return spark.range(1).select(F.coalesce(highest, F.lit(-1))).first()[0]


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last batch of a stopped job. One that was begun and not committed is an error: let the job finish it first."""
    begun, committed = (_batches(spark, f"{checkpoint}/{log}") for log in ("offsets", "commits"))
    if begun != committed:
        raise RuntimeError(f"batch {begun} of {checkpoint} was begun and not committed; start the job once more to finish it")
    if committed < 0:
        raise RuntimeError(f"{checkpoint} has no committed batch")
    return committed


def open_windows(spark: SparkSession, checkpoint: str, batch: int, keys=("queue",)) -> DataFrame:
    """What the windows of a job hold that it has not written: ``event_time`` (their start), keys, ``n``."""
    state = spark.read.format("statestore").option("batchId", batch).load(checkpoint)
    total = state.schema["value"].dataType.fieldNames()[0]
    return state.select(
        F.col("key.window.start").alias("event_time"), *[F.col(f"key.{k}").alias(k) for k in keys], F.col(f"value.{total}").alias("n")
    )


def _same_form(path: str):
    """Local paths are written with one slash or three."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def taken_files(spark: SparkSession, checkpoint: str, batch: int, source: int = 0) -> DataFrame:
    """``path`` of the files of one source that a job has read up to a batch, from the source's log."""
    lines = [r.value for r in spark.read.text(f"{checkpoint}/offsets/{batch}", wholetext=True).collect()][0].splitlines()
    entries = spark.read.text(f"{checkpoint}/sources/{source}").where("value LIKE '{%'")
    entry = F.from_json("value", "path string, batchId long").alias("entry")
    upto = F.get_json_object(F.lit(lines[2 + source]), "$.logOffset").cast("long")
    return entries.select(entry).where(F.col("entry.batchId") <= upto).select(_same_form("entry.path").alias("path")).distinct()


def hand_over(spark: SparkSession, checkpoint: str, folder: str, keys=("queue",), sources: int = 1) -> None:
    """Writes what a stopped job leaves to its successor: the sums of its open windows, and which files it has taken.

    Both are written by Spark from its checkpoint, which stays as it is. ``folder`` may already hold a hand-over
    that was interrupted; it is replaced. ``sources`` is the number of sources of the job: 1, or 2 for a job that
    was handed windows itself.
    """
    batch = last_batch(spark, checkpoint)
    open_windows(spark, checkpoint, batch, keys).write.mode("overwrite").parquet(f"{folder}/open")
    taken = taken_files(spark, checkpoint, batch, sources - 1)
    taken.write.mode("overwrite").parquet(f"{folder}/taken")


def handed_over(
    spark: SparkSession, path: str, config: ReadConfig, folder: str, lateness: str,
    prepare: Callable[[DataFrame], DataFrame], keys=("queue",), fmt: str = "parquet", schema=ENVELOPE,
) -> DataFrame:
    """The stream that the successor sums up: the open windows, each as a row at its start, and the messages of
    the files that were not taken, as ``prepare`` makes them rows of ``event_time``, keys and ``n``.

    An open window goes into the new window that holds its start, so none is split if the new width is a multiple
    of the old. The watermark starts anew: no window that was handed over is late.
    """
    open_rows = spark.read.parquet(f"{folder}/open")
    carried = spark.readStream.schema(open_rows.schema).parquet(f"{folder}/open")
    taken = spark.read.parquet(f"{folder}/taken").select(F.col("path").alias("_file"))
    messages = stream_queues(spark, path, config, fmt, schema, file_column="_file").withColumn("_file", _same_form("_file"))
    rest = prepare(messages.join(taken, "_file", "left_anti").drop("_file"))
    columns = ["event_time", *keys, "n"]
    return carried.select(*columns).unionByName(rest.select(*columns)).withWatermark("event_time", lateness)


def rewindow_job(
    spark: SparkSession, query: StreamingQuery, finish: Callable[[dict], StreamingQuery], checkpoint: str, folder: str,
    start: Callable[[], StreamingQuery], keys=("queue",), sources: int = 1,
) -> StreamingQuery:
    """Stops a job and starts its successor under another window width.

    ``finish`` starts the old job again under a trigger; that is done only where it was stopped within a batch,
    so that the batch ends once, as the old job began it. ``start`` starts the successor on a checkpoint of its own,
    reading :func:`handed_over`. Every message counts once: in a window that the old job wrote, or in one
    of the successor's.
    """
    query.stop()
    try:
        last_batch(spark, checkpoint)
    except RuntimeError:
        finish({"once": True}).awaitTermination()
    hand_over(spark, checkpoint, folder, keys, sources)
    return start()
