"""From raw messages to FAQ items: one keyed row per question thread (and answer part)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from faqspark.functions.privacy import scrub_pii, user_hash
from faqspark.functions.text import thread_id, token_codes
from faqspark.functions.times import stamp
from faqspark.functions.verdicts import verdict_columns
from faqspark.functions.vectors import DENSE_DIM, dense_vector
from faqspark.operators.classify import classify
from faqspark.operators.embedding import EMBED_VERSION, HASH_MODEL
from faqspark.operators.ingest import dedupe_messages, enrich_messages
from faqspark.operators.order import PAGE
from faqspark.operators.threads import THREAD, attach_replies, compact_replies, with_thread
from faqspark.runtime import stored


def question_heads(messages: DataFrame, text: str = "text", all_messages: bool = False) -> DataFrame:
    """Thread heads that ask something. Texts are masked before the model sees them.

    With ``all_messages`` replies are judged too; one that asks heads a thread of its own.
    """
    threaded = with_thread(messages)
    asking = threaded.withColumn("thread_key", F.col("ts")) if all_messages else threaded.where("is_head")
    heads = asking.withColumn("question_text_redacted", scrub_pii(F.col(text)))
    return classify(heads, "question_text_redacted", "role").where("verdict.is_question")


def build_faq_items(
    messages: DataFrame, courses: DataFrame, salt: str, run_at: str, same_day: bool = True, page: int = PAGE,
    all_messages: bool = False,
) -> DataFrame:
    """FAQ items keyed by ``id`` and ``answer_part``.

    The de-duplicated messages, the question heads and their replies are each written once to shared storage:
    a model behind ``classify`` is then never called twice for a row, and the count and the
    rank of replies read the same stored rows. Replies are masked only after the join has left
    those of question threads.
    """
    kept = stored(enrich_messages(dedupe_messages(messages), courses), "messages")
    asked = question_heads(kept, all_messages=all_messages).select(
        *THREAD, "event_ts", "user_id", F.sha2("text", 256).alias("original_question_sha256"),
        "question_text_redacted", "verdict",
    )
    heads = stored(asked, "question-heads")
    replies = with_thread(kept).where("NOT is_head")
    attached = attach_replies(heads.select(*THREAD, "event_ts"), replies, same_day)
    answers = stored(
        attached.select(
            *THREAD, "reply_ts", "reply_event_ts", scrub_pii(F.col("reply_text")).alias("answer")
        ),
        "answers",
    )
    packed = compact_replies(answers, THREAD, "answer", "reply_event_ts", "reply_ts", page)
    no_answers = F.array().cast("array<string>")

    def constant(value: object, name: str) -> Column:
        return F.lit(value).alias(name)

    vector = dense_vector(token_codes(F.col("question_text_redacted")))
    return heads.withColumn("dense", vector).join(packed, THREAD, "left").select(
        thread_id(F.col("course_id"), F.col("thread_key")).alias("id"),
        F.coalesce("part", F.lit(0)).alias("answer_part"),
        "course_id",
        F.col("thread_key").alias("thread_ts"),
        stamp(F.col("event_ts")).alias("ts"),
        "question_text_redacted",
        "original_question_sha256",
        *verdict_columns(F.col("verdict")),
        F.coalesce("reply_count", F.lit(0)).alias("reply_count"),
        F.coalesce("answers", no_answers).alias("answers_redacted"),
        F.coalesce(F.array_join("answers", "\n"), F.lit("")).alias("answer_compact_redacted"),
        user_hash(F.col("user_id"), salt).alias("user_hash"),
        constant(run_at, "created_at"), constant(run_at, "updated_at"),
        constant(HASH_MODEL, "embed_model"), constant(DENSE_DIM, "embed_dim"),
        constant(EMBED_VERSION, "embed_version"), "dense",
    )
