"""Gathering the small files of window folders into files of a given size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Below a window folder's root; Spark's readers pass over names that begin with an underscore.
WORK = "_compaction"


def _files(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def rewrite_plan(spark: SparkSession, path: str, target: int) -> DataFrame:
    """``window, pack, file``: which files are to be put together, two or more a pack.

    Files of less than half the target are laid end to end, by window and in the order of their names, and cut
    where a multiple of the target is passed. A pack so holds at most one and a half targets, and all packs of a
    window but the last hold at least half of one: they are not taken up again. Only names and sizes are read; empty files are passed
    over.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    window = F.regexp_extract("path", "/(window_key=[^/]*)/", 1)
    small = files.where(F.col("length") < target / 2).select(window.alias("window"), F.col("path").alias("file"), "length")
    laid = Window.partitionBy("window").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("length").over(laid), F.lit(0))
    packed = small.where("window <> ''").withColumn("number", F.call_function("div", before, F.lit(target)))
    several = F.count("*").over(Window.partitionBy("window", "number")) > 1
    pack = F.concat(F.md5("window"), F.lit("-"), F.col("number"))
    return packed.withColumn("several", several).where("several").select("window", pack.alias("pack"), "file")


def compact_window_files(spark: SparkSession, path: str, target: int = 128 << 20) -> int:
    """Puts the small files of each window together; how many files went. The lines of every window stay the same.

    The packs of :func:`rewrite_plan` are written to a folder aside, each by one task; once all of them and the plan
    are there, a mark says so, and then each pack takes the place of its files. A run that is lost before the
    mark has changed nothing; one that is lost after it is finished by the next run. So nothing is lost or doubled
    for good, but a reader at work during the exchange may miss lines, and no job may write to the folder then. Folders
    written in shards are not for this: their number of files was asked for. A folder already compact is left alone.
    """
    finish_compaction(spark, path)
    work = f"{path}/{WORK}"
    rewrite_plan(spark, path, target).write.parquet(f"{work}/plan")
    plan = spark.read.parquet(f"{work}/plan")
    old = [row.file for row in plan.select("file").toLocalIterator()]
    if old:
        lines = spark.read.text(old).select("value", F.col("_metadata.file_path").alias("file"))
        same = F.regexp_replace("file", "^file:/+", "file:/")
        chosen = plan.select("pack", same.alias("file"))
        packs = lines.withColumn("file", same).join(chosen, "file").select("pack", "value").repartition("pack")
        packs.write.partitionBy("pack").text(f"{work}/packs")
    files, ready = _files(spark, f"{work}/ready")
    files.create(ready, True).close()
    finish_compaction(spark, path)
    return len(old)


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Completes a run that was lost while packs took the place of files, and clears away one lost before."""
    files, work = _files(spark, f"{path}/{WORK}")
    if not files.exists(work):
        return
    if files.exists(_files(spark, f"{path}/{WORK}/ready")[1]):
        plan = spark.read.parquet(f"{path}/{WORK}/plan")
        packs = plan.groupBy("pack").agg(F.sort_array(F.collect_list("file")).alias("files"))
        for row in packs.toLocalIterator():
            for file in row.files:
                files.delete(_files(spark, file)[1], False)
            _, staged = _files(spark, f"{path}/{WORK}/packs/pack={row.pack}")
            # A pack that was moved already is gone.
            for status in files.listStatus(staged) if files.exists(staged) else []:
                name = status.getPath().getName()
                if not name.startswith((".", "_")):
                    _, place = _files(spark, row.files[0].rsplit("/", 1)[0])
                    files.mkdirs(place)
                    _, to = _files(spark, f"{row.files[0].rsplit('/', 1)[0]}/pack-{row.pack}-{name}")
                    if not files.rename(status.getPath(), to):
                        raise OSError(f"{status.getPath()} could not be moved to {to}")
    files.delete(work, True)
