"""Stored messages: course and day partitions of JSON lines, or raw files with JSON arrays."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from faqspark.functions.times import event_time
from faqspark.operators.ingest import DAY, dedupe_messages, in_window
from faqspark.runtime import stored
from faqspark.schemas import RAW_MESSAGE, STORED_MESSAGE
from faqspark.sources.json_records import record_texts


def write_messages(messages: DataFrame, root: str, max_records_per_file: int = 1_000_000) -> None:
    """Write by course and UTC day; only the days present in ``messages`` are replaced.

    The rebalance hint lets adaptive execution cut a very large course-day into several
    files and merge small ones, so no day is written by a single task.
    """
    (
        messages.select(*[f.name for f in STORED_MESSAGE.fields])
        .hint("rebalance", *DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*DAY)
        .json(root)
    )


def merge_days(messages: DataFrame, root: str) -> None:
    """Add fetched messages to their days, the latest fetch of a message winning.

    A fetch may bring only part of a day, so what is stored of that day is read back, merged
    and written as a whole. Only those days are read. The merged rows are written apart first:
    should the replacement of the days be cut short, writing them once more completes it.
    """
    spark = messages.sparkSession
    columns = STORED_MESSAGE.names
    new = stored(messages.select(*columns), "fetched")
    try:
        old = read_messages(spark, root).select(*columns)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        write_messages(dedupe_messages(new), root)
        return
    touched = days_of(old, new)
    write_messages(stored(dedupe_messages(touched.unionByName(new)), "merged-days"), root)


def days_of(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``old`` whose course and day occur in ``new``; other partitions are not read.

    The list of days is written out first, so that its size is known: a short one is broadcast
    and prunes partitions at run time, for which the optimizer asks for a filter on that side.
    """
    days = stored(new.select(*DAY).distinct(), "days").where("year > '0'")
    return old.join(days, DAY, "left_semi")


def read_messages(spark: SparkSession, root: str) -> DataFrame:
    """Read what ``write_messages`` wrote; partition values stay zero-padded text."""
    return spark.read.schema(STORED_MESSAGE).json(root)


def read_window(
    spark: SparkSession, root: str, as_of: str, days: int = 1, hours: int | None = None
) -> DataFrame:
    """Stored days from ``days`` before ``as_of`` up to it, or exactly the last ``hours`` hours.

    The day limits use partition columns alone, so other directories are never opened; hours
    add a filter on the message time.
    """
    end = datetime.fromisoformat(as_of)
    first = end - timedelta(hours=hours or 24 * days)
    day = F.concat_ws("-", "year", "month", "day")
    out = read_messages(spark, root).where(day.between(f"{first:%Y-%m-%d}", f"{end:%Y-%m-%d}"))
    return out.where(in_window(event_time(F.col("ts")), as_of, hours)) if hours else out


def _raw_exports(spark: SparkSession, root: str) -> DataFrame:
    """(path, text, records) of raw files; ``records`` is null where a text is no JSON object."""
    texts = record_texts(spark, root)
    whole = F.concat(F.lit("["), "text", F.lit("]"))
    return texts.select("path", "text", F.from_json(whole, T.ArrayType(RAW_MESSAGE)).alias("records"))


def read_raw_exports(spark: SparkSession, root: str) -> DataFrame:
    """Raw files ``<course>/year=/month=/day=/<date>.json``, each a JSON array or JSON lines.

    Arrays may run over any number of lines, in files of any size. A broken record costs itself only;
    ``rejected_raw_exports`` has it. The course directory may lack ``course_id=``, so the course comes from the decoded
    file path.
    """
    records = _raw_exports(spark, root).select("path", F.explode("records").alias("m")).where("m IS NOT NULL").select("path", "m.*")
    return records.select(*RAW_MESSAGE.names, _course("path").alias("course_id"))


def rejected_raw_exports(spark: SparkSession, root: str) -> DataFrame:
    """(course_id, line, reason) of what ``read_raw_exports`` cannot read, as text."""
    bad = _raw_exports(spark, root).where("records IS NULL OR exists(records, m -> m IS NULL)")
    return bad.select(_course("path").alias("course_id"), F.col("text").alias("line"), F.lit("bad json").alias("reason"))


def _course(path: str) -> Column:
    """Course directory of a file's path, decoded."""
    course = F.regexp_extract(path, r"/(?:course_id=)?([^/]+)/year=[0-9]+/month=[0-9]+/day=[0-9]+/", 1)
    return F.url_decode(F.replace(course, F.lit("+"), F.lit("%2B")))


def read_permissive(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """JSON lines split into well-formed messages and unreadable lines (kept as text)."""
    lines = spark.read.text(root)
    parsed = lines.select(
        "value",
        F.from_json(
            "value", T.StructType([*RAW_MESSAGE.fields, T.StructField("_corrupt_record", T.StringType())]),
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
        ).alias("m"),
    )
    bad = F.col("m").isNull() | F.col("m._corrupt_record").isNotNull()
    good = parsed.where(~bad).select("m.*").drop("_corrupt_record")
    return good, parsed.where(bad).select(F.col("value").alias("line"), F.lit("bad json").alias("reason"))
