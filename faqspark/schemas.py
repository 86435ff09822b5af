"""Declared schemas. Nothing is inferred, so an empty day still has its columns."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_MESSAGE = T.StructType([
    T.StructField("channel_id", T.StringType()),
    T.StructField("ts", T.StringType()),
    T.StructField("thread_ts", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("fetched_at", T.StringType()),
])

STORED_MESSAGE = T.StructType(
    RAW_MESSAGE.fields
    + [T.StructField(name, T.StringType()) for name in ("course_id", "year", "month", "day")]
)

DOCUMENT = T.StructType([
    T.StructField("body", T.StructType([
        T.StructField("content", T.ArrayType(T.StructType([
            T.StructField("paragraph", T.StructType([
                T.StructField("paragraphStyle", T.StructType([
                    T.StructField("namedStyleType", T.StringType()),
                ])),
                T.StructField("elements", T.ArrayType(T.StructType([
                    T.StructField("textRun", T.StructType([
                        T.StructField("content", T.StringType()),
                    ])),
                ]))),
            ])),
        ]))),
    ])),
])

VERDICT = T.StructType([
    T.StructField("is_question", T.BooleanType()),
    T.StructField("question_type", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("title", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("llm_model", T.StringType()),
    T.StructField("latency_ms", T.IntegerType()),
    T.StructField("request_id", T.StringType()),
])

FAQ_CHUNK = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("section", "question", "answer", "course_id", "course_name", "doc_id", "collection")
])
