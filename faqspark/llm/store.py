"""Session settings and written intermediate tables of the operators."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from faqspark.runtime import prepare, scratch_path

#: Bounds of what one Arrow batch hands to Python, whatever the length of the texts in it.
BATCH_ROWS, BATCH_BYTES = 2048, 16 << 20


def session(spark: SparkSession) -> SparkSession:
    """UTC days, and Arrow batches that are bounded in bytes as well as in rows."""
    spark = prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    return next(f"{base}{k}" for k in range(len(taken) + 1) if f"{base}{k}".lower() not in taken)


class Saved:
    """A table written below the shared folder; ``df`` reads it, ``drop`` removes it."""

    def __init__(self, df: DataFrame, name: str, *partition_by: str):
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, name)
        df.write.partitionBy(*partition_by).parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let executors delete the shuffle files of finished jobs now, ahead of a step that writes much.

    Spark deletes them once the driver's garbage collector finds that nothing refers to them, which may be much later.
    """
    gc.collect()
    spark._jvm.System.gc()
