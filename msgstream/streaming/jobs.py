"""Running streams: start, change, cancel, drain.

Progress lives in the checkpoint folder. A job started again on it goes on where the last commit
ended: what was read but not committed is read again, what was committed is not.
"""

from __future__ import annotations

import threading
from collections import Counter, defaultdict
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from msgstream.sinks import write_window_files

DRAIN = {"availableNow": True}


def start_job(df: DataFrame, path: str, checkpoint: str, trigger: dict, fmt: str = "parquet") -> StreamingQuery:
    """Appends the stream to files; each row is written once, also over restarts."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    return writer.option("path", path).trigger(**trigger).start()


def start_table_job(df: DataFrame, table: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Appends the stream to a table, made if needed."""
    return df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(**trigger).toTable(table)


def start_log(df: DataFrame, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Prints the rows of each micro-batch; see :func:`msgstream.sinks.log_lines`."""
    return df.writeStream.format("console").option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_batches(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict
) -> StreamingQuery:
    """Hands every micro-batch to ``write``, which must give the same result when a batch comes again."""
    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_window_files(
    df: DataFrame, path: str, checkpoint: str, trigger: dict, shards: int | None = None, aggregated: bool = True,
    folders: str | None = None,
) -> StreamingQuery:
    """One set of text files per window, from rows with a ``window`` and a ``line``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_window_files(batch, path, shards=shards, batch_id=None if aggregated else batch_id, folders=folders)

    return start_batches(df, write, checkpoint, trigger)


def start_panes(
    df: DataFrame, path: str, checkpoint: str, every: dict, of: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """The stream cut by processing time: each micro-batch is a pane, each row is in exactly one.

    Nothing is kept between panes, and no row is too late. A pane written again replaces itself. ``of`` makes a
    pane's rows from those of its micro-batch; there it may aggregate.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        pane = (batch if of is None else of(batch)).withColumn("pane", F.lit(batch_id))
        pane.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("pane").parquet(path)

    return start_batches(df, write, checkpoint, every)


def cancel_job(query: StreamingQuery) -> None:
    """Stops at once. Messages not yet read stay where they are."""
    query.stop()


def drain_job(start: Callable[[dict], StreamingQuery], close: Callable[[], None] | None = None) -> StreamingQuery:
    """Reads what there is now, finishes it, and ends.

    ``start`` takes the trigger and starts the job. Windows that reach past the last watermark are only
    finished if ``close`` tells the source that nothing follows, as
    :func:`msgstream.sources.landing.close_queues` does for a landing folder; the job then runs once more and
    writes them. A job that was closed takes in nothing after it, and drained again it writes nothing.
    """
    query = start(DRAIN)
    query.awaitTermination()
    if close is None:
        return query
    close()
    query = start(DRAIN)
    query.awaitTermination()
    return query


def update_job(query: StreamingQuery, start: Callable[[dict], StreamingQuery], trigger: dict) -> StreamingQuery:
    """Stops a job and starts it again on the same checkpoint under another trigger.

    Keys and windows of stateful steps must stay as they were; changing those needs a new checkpoint.
    """
    query.stop()
    return start(trigger)


def run_for(query: StreamingQuery, duration: timedelta) -> None:
    """Lets a job run for that long, then stops it."""
    query.awaitTermination(duration / timedelta(seconds=1))
    query.stop()


class ProgressTotals(StreamingQueryListener):
    """Sums over all progress reports of the streams of a session, from :func:`watch` on.

    A query itself keeps its last reports only. Sums are kept by query id, so they go on over restarts on the
    same checkpoint.
    """

    def __init__(self):
        self._rows, self._late, self._polls = Counter(), Counter(), Counter()
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress, query = event.progress, str(event.progress.id)
        self._rows[query] += progress.numInputRows
        self._late[query] += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        self._polls[query] += progress.numInputRows == 0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def _total(self, totals: Counter, query: StreamingQuery) -> int:
        """So far for a running query; for one that ended, once its last report is in."""
        if not query.isActive:
            self._ended[str(query.runId)].wait(30)
        return totals[str(query.id)]

    def input_rows(self, query: StreamingQuery) -> int:
        return self._total(self._rows, query)

    def dropped_as_late(self, query: StreamingQuery) -> int:
        """Rows dropped behind the watermark; after an aggregation, groups instead of rows."""
        return self._total(self._late, query)

    def empty_polls(self, query: StreamingQuery) -> int:
        """Reported triggers without new messages. Of idle triggers in a row Spark reports but some."""
        return self._total(self._polls, query)


def watch(spark: SparkSession) -> ProgressTotals:
    """Starts to sum up the progress of the session's streams; ``spark.streams.removeListener`` ends it."""
    totals = ProgressTotals()
    spark.streams.addListener(totals)
    return totals
