"""Session settings and the shared storage that multi-step jobs write to."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

# Folder on the session's default filesystem where no checkpoint folder is set.
DEFAULT_FOLDER = "/tmp/checkpoints"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on: every calendar day is a UTC day."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _filesystem(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Where it is unset, a folder on the session's default filesystem; on a cluster whose default is
    the machines' own disks, that is refused.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        path, filesystem = _filesystem(spark, DEFAULT_FOLDER)
        if filesystem.getScheme() == "file" and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to storage shared by all executors")
        folder = filesystem.makeQualified(path).toString()
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; no two runs ever share one."""
    return f"{shared_dir(spark)}/faqspark/{name}-{uuid.uuid4().hex}"


def spread(table: DataFrame) -> DataFrame:
    """A stored table that Spark would read in fewer tasks than it has cores, dealt evenly to all of them.

    One small file is one task, and so is all that follows it up to the first exchange. A table of more files or splits than
    cores is left alone, so nothing large is ever moved.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to shared storage and read it back.

    Cuts the lineage of plans that are read more than once or grow in a loop. Unlike a
    checkpoint the copy is columnar: readers load only the columns they use, and the optimizer
    knows its size. Losing executors never costs more than the step in progress.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(copy: DataFrame) -> None:
    """Delete the files of a stored copy that nothing reads any more."""
    spark = copy.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in copy.inputFiles()}:
        path, filesystem = _filesystem(spark, folder)
        filesystem.delete(path, True)


def released(spark: SparkSession) -> None:
    """Let executors delete the shuffle files of finished jobs now, ahead of a step that writes much.

    Spark deletes them once the driver's garbage collector finds that nothing refers to them, which may be much later.
    """
    gc.collect()
    spark._jvm.System.gc()
