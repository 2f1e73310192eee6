"""Writing results: log lines, one set of files per window, tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from msgstream.functions.text import log_line, utc_time, window_key


def log_lines(df: DataFrame, text: str = "line") -> DataFrame:
    """What the log shows: one prefixed line per row. Stream it to the console sink to print it."""
    return df.select(log_line(text).alias("line"))


def write_window_files(
    df: DataFrame, path: str, line: str = "line", shards: int | None = None, batch_id: int | None = None,
    folders: str | None = None,
) -> None:
    """Text files in one directory per window, named by its bounds.

    With ``shards`` a window has at most that many files, one directory each; without, Spark sizes
    the files and splits a window too large for one task. Writing a window again replaces it, so a
    retry is safe. That holds for a stream once its windows are aggregated, as each then comes in one
    batch; for rows not aggregated pass the ``batch_id``, which keeps batches apart.

    ``folders`` ("hour", "day") is for windows so short that each holds few rows: one directory takes all
    windows that begin in that unit of time, and each line begins with its window's name and a tab, so
    directories follow the time span and not the number of windows. It is for batches that hold whole units,
    as writing a unit again replaces it; in a stream pass the ``batch_id`` too.
    """
    if "window" not in df.columns:
        raise ValueError("only windowed rows can be written to window files")
    keys = ["window_key"]
    keyed = df.withColumn("window_key", window_key("window.start", "window.end"))
    if folders is not None:
        unit = F.date_trunc(folders, utc_time("window.start"))
        keyed = keyed.withColumn(line, F.concat_ws("\t", "window_key", line))
        keyed = keyed.withColumn("window_key", F.date_format(unit, "yyyyMMdd'T'HHmmss"))
    if batch_id is not None:
        keyed, keys = keyed.withColumn("batch_id", F.lit(batch_id)), [*keys, "batch_id"]
    if shards is None:
        keyed = keyed.hint("rebalance", *keys)
    else:
        spread = [f.name for f in df.schema.fields if f.dataType.typeName() != "map"]
        number = F.pmod(F.xxhash64(*spread), F.lit(shards))
        keyed, keys = keyed.withColumn("shard", F.concat(number.cast("string"), F.lit(f"-of-{shards}"))), [*keys, "shard"]
        keyed = keyed.repartition(*keys)
    rows = keyed.select(*keys, F.col(line).alias("value"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).text(path)


def ensure_table(spark: SparkSession, name: str, schema: StructType, path: str | None = None) -> None:
    """Creates the table if it is missing; one that exists must have this schema (NULLs aside)."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
        return
    actual = spark.table(name).schema
    if [(f.name, f.dataType) for f in actual] != [(f.name, f.dataType) for f in schema]:
        raise ValueError(
            f"table {name} exists and schemas do not match, "
            f"expecting: {schema.simpleString()}, actual: {actual.simpleString()}"
        )


def append_rows(df: DataFrame, name: str, schema: StructType | None = None, path: str | None = None) -> None:
    """Appends to a table, made if needed. Repeated messages give repeated rows."""
    schema = schema or df.schema
    ensure_table(df.sparkSession, name, schema, path)
    df.select(*schema.fieldNames()).write.insertInto(name)
