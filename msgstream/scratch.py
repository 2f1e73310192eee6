"""Where written intermediate tables and stream checkpoints go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_base(spark: SparkSession) -> str:
    """The folder that all machines share: the one named in ``spark.checkpoint.dir``.

    A session that names none uses a folder below its warehouse, which is shared as well.
    """
    base = spark.conf.get(SETTING, None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared"
    return base.rstrip("/")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """The name of a new folder below the shared one. All of a session's go when its JVM ends."""
    root = f"{shared_base(spark)}/msgstream-{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{root}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to a shared folder and read from it: a cut in the lineage that outlives executors."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
