"""Threads: heads, replies, compaction."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from faqspark.functions.times import minute_of
from faqspark.operators.order import PAGE, page_number, with_position

THREAD = ["course_id", "channel_id", "thread_key"]


def with_thread(messages: DataFrame) -> DataFrame:
    """Add the thread key and the head flag; an unthreaded message heads its own thread."""
    key = F.coalesce("thread_ts", "ts")
    return messages.withColumn("thread_key", key).withColumn("is_head", key == F.col("ts"))


def thread_messages(messages: DataFrame) -> DataFrame:
    """Each head followed by its replies, the head once: sort by ``thread_key``, ``place``, time."""
    threaded = with_thread(messages)
    heads = threaded.where("is_head").withColumn("place", F.lit(0))
    replies = threaded.where("NOT is_head")
    attached = replies.join(heads.select(*THREAD), THREAD, "left_semi").withColumn("place", F.lit(1))
    return heads.unionByName(attached)


def attach_replies(
    heads: DataFrame, replies: DataFrame, same_day: bool = True, keep_unanswered: bool = False
) -> DataFrame:
    """Heads (unique per thread) with their replies, one row per reply.

    An inner join, because adaptive execution can split a thread with very many replies only
    when it may split the replies' side, which a left join forbids. Heads without a reply are
    added from an anti join with the distinct threads that have one.
    """
    right = replies.select(
        *[F.col(c).alias(f"reply_{c}") for c in THREAD],
        F.col("ts").alias("reply_ts"),
        F.col("event_ts").alias("reply_event_ts"),
        F.col("role").alias("reply_role"),
        F.col("text").alias("reply_text"),
        F.to_date("event_ts").alias("reply_day"),
    )
    left = heads.withColumn("head_day", F.to_date("event_ts"))
    pairs = [(c, f"reply_{c}") for c in THREAD] + ([("head_day", "reply_day")] if same_day else [])
    on = reduce(and_, [F.col(h) == F.col(r) for h, r in pairs])
    keys = [f"reply_{c}" for c in THREAD]
    out = left.join(right, on).drop(*keys)
    if keep_unanswered:
        answered = right.select(*[r for _, r in pairs]).distinct()
        out = out.unionByName(left.join(answered, on, "left_anti"), allowMissingColumns=True)
    return out


def question_threads(heads: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Heads whose verdict says question."""
    return heads.join(verdicts.where("is_question").select(*THREAD), THREAD, "left_semi")


def compact_replies(
    replies: DataFrame, key: list[str], text: str, event_ts: str, tie: str, page: int = PAGE
) -> DataFrame:
    """Reply texts of each thread in time order, ``page`` replies per row.

    Almost every thread is one row with ``part`` 0. A longer one continues in further parts,
    so no list grows without bound and no reply is left out.
    """
    placed = with_position(replies, key, minute_of(F.col(event_ts)), [event_ts, tie])
    ordered = F.sort_array(F.collect_list(F.struct("position", F.col(text).alias("text"))))
    return (
        placed.withColumn("part", page_number(page))
        .groupBy(*key, "part")
        .agg(F.max("group_size").alias("reply_count"), ordered.alias("_answers"))
        .withColumn("answers", F.transform("_answers", lambda a: a["text"]))
        .drop("_answers")
    )


def compact_threads(messages: DataFrame, same_day: bool = True, page: int = PAGE) -> DataFrame:
    """Reply count and ordered answers per thread: replies of the head's day only, or all of
    them to reconcile threads that run over several days."""
    threaded = with_thread(messages)
    replies = threaded.where("NOT is_head")
    if same_day:
        attached = attach_replies(threaded.where("is_head").select(*THREAD, "event_ts"), replies)
        replies = attached.select(
            *THREAD, F.col("reply_ts").alias("ts"), F.col("reply_event_ts").alias("event_ts"),
            F.col("reply_text").alias("text"),
        )
    packed = compact_replies(replies, THREAD, "text", "event_ts", "ts", page)
    return packed.withColumn("answer_compact", F.array_join("answers", "\n"))


def rebuilt_items(items: DataFrame, replies: DataFrame, touched: DataFrame, page: int = PAGE) -> DataFrame:
    """Items (thread, part, ...) after a batch: the parts of touched threads anew, all others as they were.

    ``replies`` are the merged ones of all threads. Parts that a thread no longer has go with its old rows.
    """
    theirs = replies.join(touched, THREAD, "left_semi")
    packed = compact_replies(theirs, THREAD, "text", "event_ts", "ts", page)
    times = theirs.groupBy(*THREAD).agg(F.min("first_seen").alias("created_at"), F.max("fetched_at").alias("updated_at"))
    fresh = packed.withColumn("answer_compact", F.array_join("answers", "\n")).join(times, THREAD)
    return items.join(touched, THREAD, "left_anti").unionByName(fresh.select(*items.columns))


def preferred_answers(messages: DataFrame, page: int = PAGE) -> DataFrame:
    """First instructor reply of a thread if there is one, else all replies joined."""
    threaded = with_thread(messages).where("NOT is_head")
    first = threaded.where("role = 'assistant'").groupBy(*THREAD).agg(
        F.min_by("text", F.struct("event_ts", "ts")).alias("first_answer")
    )
    rest = threaded.join(first, THREAD, "left_anti")
    joined = compact_replies(rest, THREAD, "text", "event_ts", "ts", page)
    return first.select(*THREAD, F.lit(0).alias("part"), F.col("first_answer").alias("answer")).unionByName(
        joined.select(*THREAD, "part", F.array_join("answers", "\n").alias("answer"))
    )
