"""Batches that come again show once."""

import os
from datetime import timedelta

import pytest
from pyspark.errors import StreamingQueryException

from msgstream.config import ReadConfig
from msgstream.streaming import jobs, ledger

SCHEMA = "id long, text string"


def rows(spark, first, n):
    return spark.range(first, first + n).selectExpr("id", "cast(id % 7 AS string) AS text")


def ids(spark, path):
    return sorted(r.id for r in ledger.read_table(spark, path, SCHEMA).collect())


def test_a_table_nobody_wrote_to_is_empty(spark, folder):
    assert ids(spark, folder()) == []


def test_a_batch_is_entered_once(spark, folder):
    path = folder()
    ledger.append_once(rows(spark, 0, 5), path, "a", 0)
    ledger.append_once(rows(spark, 0, 5), path, "a", 0)
    ledger.append_once(rows(spark, 5, 5), path, "a", 1)
    ledger.append_once(rows(spark, 10, 5), path, "b", 0)
    ledger.append_once(rows(spark, 0, 0), path, "a", 2)
    assert ids(spark, path) == list(range(15))
    assert ledger.committed(spark, path).count() == 4


def test_what_was_written_and_not_entered_is_not_read(spark, folder):
    path = folder()
    rows(spark, 0, 5).write.parquet(f"{path}/data/job=a/batch=0/attempt=lost")
    assert ids(spark, path) == []
    ledger.append_once(rows(spark, 0, 5), path, "a", 0)
    assert ids(spark, path) == [0, 1, 2, 3, 4]


def test_clashing_columns_are_refused(spark, folder):
    with pytest.raises(ValueError, match="batch"):
        ledger.append_once(rows(spark, 0, 1).withColumnRenamed("text", "batch"), folder(), "a", 0)


@pytest.mark.parametrize("lost", ["before the entry", "after the entry"])
def test_a_job_that_is_lost_within_a_batch(spark, tmp_path, lost):
    source, path, checkpoint = f"{tmp_path}/in", f"{tmp_path}/table", f"{tmp_path}/ck"
    rows(spark, 0, 50).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)

    def fails(batch, batch_id):
        if lost == "before the entry":
            batch.write.parquet(f"{path}/data/job=a/batch={batch_id}/attempt=lost")
        else:
            ledger.append_once(batch, path, "a", batch_id)
        raise RuntimeError("lost")

    with pytest.raises(StreamingQueryException):
        jobs.start_batches(stream, fails, checkpoint, jobs.DRAIN).awaitTermination()
    start = lambda trigger: ledger.start_ledger_job(stream, path, checkpoint, trigger, "a")
    jobs.drain_job(start)
    assert ids(spark, path) == list(range(50))
    last = max(int(name) for name in os.listdir(f"{checkpoint}/commits") if name.isdigit())
    for name in os.listdir(f"{checkpoint}/commits"):
        if name.lstrip(".").split(".")[0] == str(last):
            os.remove(f"{checkpoint}/commits/{name}")  # as if Spark had not got to commit the batch
    rows(spark, 50, 10).coalesce(1).write.mode("append").parquet(source)
    jobs.drain_job(start)
    assert ids(spark, path) == list(range(60))


def test_the_poll_interval_is_in_force(spark, tmp_path):
    """Two batches start no sooner after each other than the settings say."""
    source, config = f"{tmp_path}/in", ReadConfig(["q"], poll_ms=1500)
    rows(spark, 0, 5).write.parquet(source)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    query = jobs.start_job(stream, f"{tmp_path}/out", f"{tmp_path}/ck", config.trigger)
    query.processAllAvailable()
    jobs.run_for(query, timedelta(milliseconds=10))
    starts = [p["timestamp"] for p in query.recentProgress if p["numInputRows"]]
    seconds = [float(s[17:].rstrip("Z")) + 60 * int(s[14:16]) for s in starts]
    assert len(starts) > 1 and all(b - a >= 1.4 for a, b in zip(seconds, seconds[1:], strict=False))
