"""Continuous ingest, de-duplication, windowed counts and late replies.

All state lives in checkpoints and keyed tables on shared storage. Sinks written through
``foreachBatch`` put each micro-batch into its own directory and replace it on a replay, so a
batch that runs twice after a failure counts once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from faqspark.operators.ingest import DAY, dedupe_messages, enrich_messages
from faqspark.operators.threads import THREAD, compact_threads, with_thread
from faqspark.functions.privacy import scrub_pii
from faqspark.functions.text import thread_id
from faqspark.schemas import RAW_MESSAGE
from faqspark.sources import versions
from faqspark.sources.collections import latest_by_key

# Fixed value: storage buckets of the thread store.
THREAD_BUCKETS = 64


def message_stream(spark: SparkSession, root: str, files_per_trigger: int | None = None) -> DataFrame:
    """Raw messages as JSON lines arriving in a folder."""
    reader = spark.readStream.schema(RAW_MESSAGE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(root)


def start_ingest(
    stream: DataFrame, courses: DataFrame, root: str, checkpoint: str, files_per_day: int | None = None
) -> StreamingQuery:
    """Enriched messages into course and day partitions; the file sink's log makes it exactly once.

    Rows are gathered by day, but salted, so that a busy day is written by ``files_per_day``
    tasks per trigger (by default as many as the session has cores) and the quiet ones leave no
    crowd of small files.
    """
    files_per_day = files_per_day or stream.sparkSession.sparkContext.defaultParallelism
    enriched = enrich_messages(stream, courses).drop("event_ts")
    salt = F.pmod(F.xxhash64("channel_id", "ts"), F.lit(files_per_day))
    return (
        enriched.repartition(*DAY, salt).writeStream.format("json").partitionBy(*DAY)
        .option("path", root).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


KEY = ["channel_id", "ts"]


def keep_first(root: str) -> Callable[[DataFrame, int], None]:
    """The first arrival of each ``(channel_id, ts)`` of a micro-batch of enriched messages, if no earlier batch brought it.

    A message's time is part of its key, so its copies share its day: only the stored days that the batch touches are
    looked at, keys alone, however late a copy comes. No state is held between batches, and a replay replaces its rows.
    """

    def keep(batch: DataFrame, number: int) -> None:
        batch.persist()
        days = [row["day"] for row in batch.select(_day().alias("day")).distinct().collect()]
        if days:
            spark = batch.sparkSession
            new = latest_by_key(batch.withColumn("day_of", _day()), KEY, ["fetched_at", "text"], first=True)
            known = versions.read(spark, root, before=number, text=["day_of"])
            if known is not None:
                seen = known.where(F.col("day_of").isin(days)).select(*[F.col(c).alias(f"_{c}") for c in KEY])
                new = new.join(seen, [F.col(c) == F.col(f"_{c}") for c in KEY], "left_anti")
            versions.add(new, root, number, "day_of")
            versions.fold(spark, root, lambda rows: rows, "day_of", text=["day_of"])
        batch.unpersist()

    return keep


def _day() -> Column:
    """Day of a message, at most a few thousand different ones in any table."""
    return F.date_format("event_ts", "yyyy-MM-dd")


def start_dedupe(stream: DataFrame, courses: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """First arrival of each ``(channel_id, ts)``, by ``keep_first``: no watermark, so no copy comes too late."""
    return (
        enrich_messages(stream, courses).writeStream.foreachBatch(keep_first(root))
        .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    )


def read_first(spark: SparkSession, root: str) -> DataFrame:
    """What ``start_dedupe`` kept."""
    return versions.read(spark, root, text=["day_of"]).drop("batch", "day_of")


def _store_batches(root: str):
    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch={number:012d}")

    return store


def start_window_counts(
    stream: DataFrame, ts: str, keys: list[str], value: str, length: str, root: str, checkpoint: str,
    delay: str = "1 hour",
) -> StreamingQuery:
    """Count and sum per tumbling window and key, in update mode into a keyed store, so open
    windows are visible and nothing is held back until the watermark has passed."""
    counts = stream.withWatermark(ts, delay).groupBy(F.window(ts, length), *keys).agg(
        F.count("*").alias("n"), F.sum(F.col(value).cast("decimal(18,2)")).alias("total")
    )
    flat = counts.select(F.col("window.start").alias("start"), *keys, "n", "total")
    return (
        flat.writeStream.foreachBatch(_store_batches(root)).option("checkpointLocation", checkpoint)
        .outputMode("update").trigger(availableNow=True).start()
    )


def read_window_counts(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """Latest state of each window."""
    stored = spark.read.option("basePath", root).parquet(root)
    return latest_by_key(stored, ["start", *keys], ["batch"]).drop("batch")


def rolling_from_panes(panes: DataFrame, keys: list[str], hours: int = 24) -> DataFrame:
    """Windows of ``hours`` hours moving by one hour, from one-hour counts.

    Events are counted once per hour and key; only those few rows are repeated for the windows
    they belong to, instead of every event ``hours`` times.
    """
    starts = F.sequence(
        F.col("start") - F.expr(f"INTERVAL {hours - 1} HOURS"), F.col("start"), F.expr("INTERVAL 1 HOUR")
    )
    return (
        panes.withColumn("start", F.explode(starts)).groupBy("start", *keys)
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )


def merge_threads(root: str) -> Callable[[DataFrame, int], None]:
    """The merge of enriched messages into stored threads.

    A micro-batch adds its messages to the message store and writes the rows of the threads it touched anew, from
    all messages of those threads; other threads are neither rebuilt nor rewritten. Only the buckets of touched threads
    are read. Both stores are folded as they grow, so that a batch reads a fold and the few batches after it, of a message
    its first and last fetch, and of a thread its current rows.
    """

    def merge(batch: DataFrame, number: int) -> None:
        batch.persist()
        threaded = with_thread(batch).withColumn("bucket", _thread_bucket())
        touched_buckets = [row["bucket"] for row in threaded.select("bucket").distinct().collect()]
        if touched_buckets:
            spark = batch.sparkSession
            versions.add(threaded, f"{root}/messages", number, "bucket")
            messages = versions.read(spark, f"{root}/messages", before=number + 1).where(F.col("bucket").isin(touched_buckets))
            touched = threaded.select("bucket", *THREAD).distinct()
            theirs = messages.join(touched, ["bucket", *THREAD], "left_semi")
            seen = theirs.groupBy(*THREAD).agg(F.min("fetched_at").alias("created_at"), F.max("fetched_at").alias("updated_at"))
            kept = dedupe_messages(theirs).withColumn("text", scrub_pii(F.col("text")))
            packed = compact_threads(kept, same_day=False)
            versions.add(packed.join(seen, THREAD), f"{root}/threads", number)
            versions.fold(spark, f"{root}/messages", _first_and_last, "bucket")
            versions.fold(spark, f"{root}/threads", _current_threads)
        batch.unpersist()

    return merge


def _first_and_last(messages: DataFrame) -> DataFrame:
    """Of the fetches of a message the first and the last, which is all that later merges look at."""
    order = Window.partitionBy(*KEY)
    ranked = messages.withColumns({
        "_first": F.row_number().over(order.orderBy("fetched_at", "text")),
        "_last": F.row_number().over(order.orderBy(F.desc_nulls_last("fetched_at"), F.desc_nulls_last("text"))),
    })
    return ranked.where("_first = 1 OR _last = 1").drop("_first", "_last")


def _current_threads(kept: DataFrame) -> DataFrame:
    """Of each thread the rows of the last batch that touched it."""
    last = kept.groupBy(*[F.col(c).alias(f"_{c}") for c in THREAD]).agg(F.max("batch").alias("_batch"))
    return kept.join(last, [F.col(c) == F.col(f"_{c}") for c in [*THREAD, "batch"]], "left_semi")


def start_thread_updates(stream: DataFrame, courses: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Late replies into the threads they belong to, by ``merge_threads``."""
    return (
        enrich_messages(stream, courses).writeStream.foreachBatch(merge_threads(root))
        .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    )


def _thread_bucket() -> Column:
    """Storage bucket of a thread."""
    return F.pmod(F.xxhash64(*THREAD), F.lit(THREAD_BUCKETS)).cast("int")


def read_threads(spark: SparkSession, root: str) -> DataFrame:
    """Current thread rows: of each thread those of the last micro-batch that touched it.

    A message seen twice counts once. ``created_at`` is the first fetch that brought anything
    of the thread and ``updated_at`` the last, so replaying a batch changes nothing.
    """
    kept = versions.read(spark, f"{root}/threads")
    several = kept if versions.state(spark, f"{root}/threads")[1] == [] else _current_threads(kept)
    return several.drop("batch").withColumn("id", thread_id(F.col("course_id"), F.col("thread_key")))
