"""Streams with state of their own shape: a watermark per queue, and seen numbers kept as ranges.

Both keep their state through Spark's ``transformWithState``, which needs the RocksDB provider: start such jobs within
:func:`rocksdb`.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# Spark asks such a processor for its state from a process on the driver that does not get added Python files.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession):
    """Queries started within keep their state in RocksDB; others of the session are left as they are."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


# --- a watermark per queue ----------------------------------------------------------------------------

# Groups of queue and window that a task holds before it passes them on.
HELD_GROUPS = 100_000


def _counted_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per queue and window of what a task reads: how many rows, and the latest time."""
    held, names = None, ["queue", "start", "n", "latest"]
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows.select(held.column_names).cast(held.schema)])
        sums = rows.group_by(["queue", "start"]).aggregate([("n", "sum"), ("latest", "max")])
        held = sums.rename_columns([c.removesuffix("_sum").removesuffix("_max") for c in sums.column_names]).select(names)
        if held.num_rows > HELD_GROUPS:
            yield from held.to_batches(8192)
            held = None
    if held is not None:
        yield from held.to_batches(8192)


class _QueueWindows(StatefulProcessor):
    """Counts per open window of one queue, and the queue's mark."""

    def __init__(self, width: int, lateness: int):
        self.width, self.lateness = width, lateness

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.mark = handle.getValueState("mark", "us long")
        self.open = handle.getMapState("open", "start long", "n long")

    def _closed(self, key, windows: dict[int, int], kept: set[int], upto: int) -> pd.DataFrame:
        done = sorted(start for start in windows if start + self.width <= upto)
        for start in kept.intersection(done):
            self.open.removeKey((start,))
        counts = [windows[start] for start in done]
        columns = {"queue": ([key[0]] * len(done), object), "start": (done, "int64"), "n": (counts, "int64")}
        return pd.DataFrame({name: pd.Series(values, dtype=kind) for name, (values, kind) in columns.items()})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = self.mark.get()[0] if self.mark.exists() else None
        windows = {start: n for (start,), (n,) in self.open.iterator()}
        known, latest = set(windows), mark if mark is None else mark + self.lateness
        changed = set()
        for part in rows:
            for start, n in part.groupby("start")["n"].sum().items():
                if mark is None or start + self.width > mark:
                    windows[int(start)] = windows.get(int(start), 0) + int(n)
                    changed.add(int(start))
            latest = max(int(part["latest"].max()), int(part["latest"].max()) if latest is None else latest)
        mark = latest - self.lateness
        self.mark.update((mark,))
        for start in changed:
            if start + self.width > mark:
                self.open.updateValue((start,), (windows[start],))
                if start not in known:
                    self.handle.registerTimer(-(-(start + self.width) // 1000))
        yield self._closed(key, windows, known, mark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The other queues have left this one behind: its windows up to here close without it."""
        windows = {start: n for (start,), (n,) in self.open.iterator()}
        upto = expiredTimerInfo.getExpiryTimeInMs() * 1000
        if self.mark.exists():
            self.mark.update((max(self.mark.get()[0], upto),))
        yield self._closed(key, windows, set(windows), upto)

    def close(self) -> None:
        pass


def counts_by_queue_mark(messages: DataFrame, width: timedelta, lateness: timedelta, idle: timedelta) -> DataFrame:
    """``queue, window, count``, each queue under a watermark of its own; one scan for all queues.

    A queue's mark is its latest event time less ``lateness``. A message is late if its window ended at or before
    the mark that its queue had before the micro-batch, so a queue that runs behind the others loses nothing. A
    window is written once its queue's mark has passed it. A queue that lies more than ``idle`` behind the
    latest window of all counts as idle: windows that ended before that are written without it, and what comes for
    them from the micro-batch after that on is late.

    Tasks count what they read by queue and window before anything moves, so a queue that holds most of the messages
    sends one row per task and open window. The state of a queue is one count per open window. Messages without an
    event time are left out; a NULL queue is a queue.
    """
    microseconds = timedelta(microseconds=1)
    size = F.lit(width // microseconds)
    us = F.unix_micros("event_time")
    rows = messages.where(F.col("event_time").isNotNull()).select(
        "queue", (us - F.pmod(us, size)).alias("start"), F.lit(1).cast("long").alias("n"), us.alias("latest")
    )
    counted = rows.mapInArrow(_counted_in_task, "queue string, start long, n long, latest long")
    ended = counted.withColumn("ends", F.timestamp_micros(F.col("start") + size))
    timed = ended.withWatermark("ends", f"{idle // microseconds} microseconds")
    processor = _QueueWindows(width // microseconds, lateness // microseconds)
    closed = timed.groupBy("queue").transformWithStateInPandas(
        processor, "queue string, start long, n long", outputMode="Append", timeMode="EventTime"
    )
    start = F.timestamp_micros("start")
    end = F.timestamp_micros(F.col("start") + size)
    return closed.select("queue", F.struct(start.alias("start"), end.alias("end")).alias("window"), F.col("n").alias("count"))


# --- numbers seen, as ranges --------------------------------------------------------------------------


def added(starts: np.ndarray, ends: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of some distinct numbers, in order, lie in none of the ranges, and the ranges with them.

    Ranges are closed, in order, and neither touch nor overlap; nor do those returned.
    """
    at = np.searchsorted(starts, numbers, side="right") - 1
    new = (at < 0) | (numbers > ends[np.maximum(at, 0)]) if len(starts) else np.ones(len(numbers), bool)
    starts, ends = np.concatenate([starts, numbers[new]]), np.concatenate([ends, numbers[new]])
    order = np.argsort(starts)
    starts, ends = starts[order], ends[order]
    gap = np.flatnonzero(starts[1:] > ends[:-1] + 1)
    return new, starts[np.append(0, gap + 1)] if len(starts) else starts, ends[np.append(gap, len(ends) - 1)] if len(ends) else ends


class _SeenRanges(StatefulProcessor):
    """The numbers of one block that have come, as ranges."""

    def __init__(self, sequence: str, columns: list[str]):
        self.sequence, self.columns = sequence, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "starts array<long>, ends array<long>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kept = self.seen.get() if self.seen.exists() else ([], [])
        starts, ends = (np.array(side, np.int64) for side in kept)
        for part in rows:
            first = part.drop_duplicates(self.sequence).sort_values(self.sequence)
            new, starts, ends = added(starts, ends, first[self.sequence].to_numpy(np.int64))
            yield first.loc[new, self.columns]
        self.seen.update((starts.tolist(), ends.tolist()))

    def close(self) -> None:
        pass


def _distinct_in_batch(columns: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.table({str(i): batch.column(i) for i in columns}).append_column("row", pa.array(np.arange(batch.num_rows)))
            first = keys.group_by([str(i) for i in columns]).aggregate([("row", "min")]).column("row_min")
            yield batch.take(first.combine_chunks())

    return run


def distinct_by_ranges(messages: DataFrame, by: Sequence[str] = ("queue",), sequence: str = "sequence_number", block: int = 65_536) -> DataFrame:
    """One message per number of a queue, over the whole stream, in state that grows with gaps and not with messages.

    Numbers that have come are kept as ranges, joined as soon as they touch: a queue without gaps holds one range
    per ``block`` of numbers, whatever its length. Blocks spread a queue over many tasks. Nothing is forgotten, so
    there is no watermark and no message is late. Ids that jump about make as many ranges as there are ids;
    :func:`msgstream.operators.dedup.distinct_across_windows` is for those.

    Copies within an Arrow batch of a task go before anything moves, so a message that comes very often does not make its
    block's task read all of them. Messages without a number are kept as they are. NULL in ``by`` is a value.
    """
    by = list(by)
    missing = F.col(sequence).isNull()
    numbered = messages.where(~missing)
    early = numbered.mapInArrow(_distinct_in_batch([messages.columns.index(c) for c in [*by, sequence]]), messages.schema)
    number = F.col(sequence).cast("long")
    blocked = early.withColumn("_block", F.call_function("div", number - F.pmod(number, F.lit(block)), F.lit(block)))
    # Spark does not hand on the columns it groups by.
    keys = {f"_by{i}": F.col(c) for i, c in enumerate(by)}
    once = blocked.withColumns(keys).groupBy(*keys, "_block").transformWithStateInPandas(
        _SeenRanges(sequence, messages.columns), messages.schema, outputMode="Append", timeMode="None"
    )
    return once.unionByName(messages.where(missing))
