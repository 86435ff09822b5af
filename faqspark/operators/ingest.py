"""Message ingest: enrich, select, de-duplicate, bucket by course and UTC day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from faqspark.functions.times import calendar_parts, event_time, minute_of
from faqspark.operators.order import PAGE, page_number, with_position
from faqspark.schemas import RAW_MESSAGE

DAY = ["course_id", "year", "month", "day"]
TIE_BREAK = ["fetched_at", "text", "user_id", "thread_ts"]


def with_course(messages: DataFrame, courses: DataFrame) -> DataFrame:
    """Give each message the course of its channel.

    The configuration is a small relation whose size the optimizer knows, so it is broadcast
    as long as it stays below the session's threshold.
    """
    channels = courses.select("course_id", F.explode("channels").alias("channel_id"))
    return messages.join(channels, "channel_id")


def parse_messages(messages: DataFrame) -> DataFrame:
    """Add the event time and its calendar parts; bad times give nulls."""
    timed = messages.withColumn("event_ts", event_time(F.col("ts")))
    return timed.withColumns(calendar_parts(F.col("event_ts")))


def enrich_messages(messages: DataFrame, courses: DataFrame, fetched_at: str | None = None) -> DataFrame:
    """Course, run constant and calendar date; rows without a date are dropped."""
    out = with_course(messages, courses)
    if fetched_at is not None:
        out = out.withColumn("fetched_at", F.lit(fetched_at))
    return parse_messages(out).where(F.col("event_ts").isNotNull())


def quarantine(messages: DataFrame, courses: DataFrame) -> DataFrame:
    """The rows ``enrich_messages`` drops, with the reason; ``course_id`` is null for an unknown channel."""
    channels = courses.select("course_id", F.explode("channels").alias("channel_id"))
    placed = parse_messages(messages.join(channels, "channel_id", "left"))
    return placed.where(F.col("course_id").isNull() | F.col("event_ts").isNull()).withColumn(
        "reason",
        F.when(F.col("course_id").isNull(), "unknown channel")
        .when(F.coalesce(F.col("ts"), F.lit("")) == "", "missing ts").otherwise("bad ts"),
    )


def in_window(event_ts: Column, as_of: str, hours: int = 24) -> Column:
    """``as_of - hours <= event_ts < as_of``; zero hours means the default."""
    latest = F.lit(as_of).cast("timestamp")
    return (event_ts >= latest - F.expr(f"INTERVAL {int(hours or 24)} HOURS")) & (event_ts < latest)


def dedupe_messages(messages: DataFrame) -> DataFrame:
    """Latest fetch of each ``(channel_id, ts)``.

    The rank limit is applied in every map task before the exchange, so a message fetched a
    billion times reaches the reducer once per map task.
    """
    latest = Window.partitionBy("channel_id", "ts").orderBy(
        *[F.desc_nulls_last(c) for c in TIE_BREAK]
    )
    return messages.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n")


def course_day_pages(messages: DataFrame, page: int = PAGE) -> DataFrame:
    """Messages of each course and day as ordered lists of at most ``page`` messages."""
    placed = with_position(messages, DAY, minute_of(F.col("event_ts")), ["event_ts", "channel_id", "ts"])
    item = F.struct("position", *RAW_MESSAGE.names)
    return (
        placed.withColumn("page", page_number(page))
        .groupBy(*DAY, "page")
        .agg(F.count("*").alias("n"), F.sort_array(F.collect_list(item)).alias("messages"))
    )


def ingest_counters(messages: DataFrame, courses: DataFrame) -> DataFrame:
    """Per course: configured channels (also silent ones), messages seen, dropped, stored days."""
    channels = courses.select("course_id", F.explode("channels").alias("channel_id"))
    configured = channels.groupBy("course_id").agg(F.count("*").alias("channels"))
    per_day = (
        parse_messages(with_course(messages, courses))
        .groupBy(*DAY).agg(F.count("*").alias("n"))
    )
    seen = per_day.groupBy("course_id").agg(
        F.sum("n").alias("messages"),
        F.sum(F.when(F.col("year").isNull(), F.col("n")).otherwise(0)).alias("dropped"),
        F.count("year").alias("files"),
    )
    return configured.join(seen, "course_id", "left").select(
        "course_id", "channels",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("messages", "dropped", "files")],
    )


def partition_manifest(messages: DataFrame) -> DataFrame:
    """Message count and SHA-256 digest of each course and day.

    Each line, all stored fields with null told from empty text, is hashed; the eight 32-bit words
    of the hashes are summed as decimals, which hold any number of rows, and the sums are
    hashed. The result depends on every line but not on their order, so it is combined
    map-side and no partition is ever gathered or sorted. Call it with what was read back.
    """
    line = F.concat_ws("\t", *[F.coalesce(F.concat(F.lit("="), c), F.lit("~")) for c in RAW_MESSAGE.names])
    words = [
        F.conv(F.substring("_h", 8 * i + 1, 8), 16, 10).cast("decimal(28,0)").alias(f"_w{i}") for i in range(8)
    ]
    sums = (
        messages.select(*DAY, F.sha2(line, 256).alias("_h"))
        .select(*DAY, *words)
        .groupBy(*DAY)
        .agg(F.count("*").alias("n"), *[F.sum(f"_w{i}").alias(f"_w{i}") for i in range(8)])
    )
    total = F.concat_ws(":", F.col("n").cast("string"), *[F.col(f"_w{i}").cast("string") for i in range(8)])
    return sums.select(*DAY, "n", F.sha2(total, 256).alias("digest"))


def infer_batches(messages: DataFrame, size: int = 16) -> DataFrame:
    """Order-preserving batches of ``size`` messages, numbered per course."""
    placed = with_position(
        messages, ["course_id"], minute_of(F.col("event_ts")), ["event_ts", "channel_id", "ts"]
    )
    return placed.withColumn("batch", page_number(size)).withColumn(
        "place", ((F.col("position") - 1) % size).cast("int")
    )
