"""Tables to which a stream appends each micro-batch exactly once."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from msgstream.streaming.jobs import start_batches

# How rows are laid out below the table's folder, and what an entry of the ledger says.
PLACE = ("job", "batch", "attempt")
ENTRY = "job string, batch long, attempt string"


def _files(spark: SparkSession, path: str):
    """Spark's own handle on the file system of a path, wherever that is."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def committed(spark: SparkSession, path: str) -> DataFrame:
    """``job, batch, attempt``: the ledger."""
    files, ledger = _files(spark, f"{path}/ledger")
    files.mkdirs(ledger)
    return spark.read.schema(ENTRY).json(f"{path}/ledger")


def append_once(batch: DataFrame, path: str, job: str, batch_id: int) -> None:
    """Writes a micro-batch to a folder of its own, and then the entry that makes it part of the table.

    A batch that has an entry is not written again. One that was written and has none, as its job was lost in
    between, is written anew; readers never see the first folder. The entry appears whole, by a rename, and
    of two that are written at once the second fails.
    """
    if clash := set(PLACE) & set(batch.columns):
        raise ValueError(f"columns {sorted(clash)} are taken by the table's layout")
    spark = batch.sparkSession
    files, entry = _files(spark, f"{path}/ledger/{job}-{batch_id}.json")
    if files.exists(entry):
        return
    attempt = uuid.uuid4().hex
    batch.write.parquet(f"{path}/data/job={job}/batch={batch_id}/attempt={attempt}")
    # Names that begin with a dot are not read.
    _, draft = _files(spark, f"{path}/ledger/.{job}-{batch_id}-{attempt}")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps({"job": job, "batch": batch_id, "attempt": attempt}).encode()))
    out.close()
    if not files.rename(draft, entry) and not files.exists(entry):
        raise OSError(f"the entry of batch {batch_id} could not be made in {path}/ledger")


def start_ledger_job(df: DataFrame, path: str, checkpoint: str, trigger: dict, job: str = "stream") -> StreamingQuery:
    """Appends a stream to a table of :func:`read_table`. ``job`` is the same each time the job is started on its
    checkpoint, and another for every other job that writes to the table."""
    return start_batches(df, lambda batch, batch_id: append_once(batch, path, job, batch_id), checkpoint, trigger)


def read_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of all batches that the ledger lists, each once."""
    layout = spark.createDataFrame([], schema).schema
    for column, kind in (("job", "string"), ("batch", "long"), ("attempt", "string")):
        layout = layout.add(column, kind)
    files, data = _files(spark, f"{path}/data")
    files.mkdirs(data)
    rows = spark.read.schema(layout).parquet(f"{path}/data")
    return rows.join(committed(spark, path), list(PLACE), "left_semi").drop(*PLACE)
