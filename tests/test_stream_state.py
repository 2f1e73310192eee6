"""What streamed queries remember, and how much a micro-batch takes."""

import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql.streaming import StreamingQueryListener

from msgstream.plans import registry
from msgstream.sources import landing


class Seen(StreamingQueryListener):
    def __init__(self, runs):
        self.state_rows, self.batches, self._left, self.ended = 0, 0, runs, threading.Event()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.batches += event.progress.numInputRows > 0
        self.state_rows = max([self.state_rows, *[op.numRowsTotal for op in event.progress.stateOperators]])

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._left -= 1
        if not self._left:
            self.ended.set()


@pytest.fixture
def seen(spark):
    listener = Seen(runs=2)
    spark.streams.addListener(listener)
    yield listener
    spark.streams.removeListener(listener)


def test_word_counts_remember_messages_not_words(spark, folder, seen):
    """200 words a document: the state holds a row per message, whatever its words."""
    path = folder("tables")
    docs = spark.range(60).selectExpr(
        "id AS doc_id", "if(id % 2 = 0, 'en', 'de') AS lang", "concat('s', id % 3) AS source",
        "array_join(transform(sequence(1, 200), k -> concat('w', translate(cast(k AS string), '0123456789', 'abcdefghij'), char(97 + id % 26))), ' ') AS text",
    )
    docs.write.parquet(f"{path}/documents.parquet")
    found = registry.QUERIES["stream_word_count"](spark, path)
    batch = registry.QUERIES["word_count_4s_dedup"](spark, path)
    assert found.columns == batch.columns and sorted(found.collect()) == sorted(batch.collect())
    assert seen.ended.wait(30) and 0 < seen.state_rows <= 60 + 1


@pytest.fixture
def seen_once(spark):
    listener = Seen(runs=1)
    spark.streams.addListener(listener)
    yield listener
    spark.streams.removeListener(listener)


def test_trade_batches_keep_all_tasks_busy(spark, folder, seen_once):
    """Forty files take the eight tasks of this session three micro-batches, two files a task."""
    path = folder("landing")
    rows = spark.range(40).selectExpr("id AS message_id", "CAST(1 AS INT) AS priority", "'[]' AS text", "'Q/A' AS queue")
    rows.repartition(40, "message_id").write.option("maxRecordsPerFile", 1).partitionBy("queue").parquet(path)
    registry._drained(registry._trade_stream(spark, path, rows.schema), "out")
    assert seen_once.ended.wait(30) and seen_once.batches == 3


def test_published_files_can_be_split(spark, folder):
    path = folder("landing")
    text = "array_join(transform(sequence(1, 16), k -> sha2(concat(id, ' ', k), 256)), '') AS text"
    texts = spark.range(60_000).selectExpr("id AS message_id", text, "'Q' AS queue")
    landing.publish(texts.coalesce(1), path)
    files = spark.read.parquet(path).inputFiles()
    groups = [pq.ParquetFile(f.removeprefix("file:").replace("%3D", "=")).num_row_groups for f in files]
    assert sum(groups) >= 3


def test_a_batch_that_comes_again_is_a_part_of_the_job(spark, folder, seen_once):
    path = folder("landing")
    rows = spark.range(40).selectExpr("id AS message_id", "CAST(1 AS INT) AS priority", "'[]' AS text", "'Q/A' AS queue")
    rows.repartition(40, "message_id").write.option("maxRecordsPerFile", 1).partitionBy("queue").parquet(path)
    registry._drained(registry._trade_stream(spark, path, rows.schema, in_parts=True), "out")
    assert seen_once.ended.wait(30) and seen_once.batches == 4
