"""From styled documents to a searchable collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from faqspark.functions.text import embed_text
from faqspark.functions.vectors import DENSE_DIM
from faqspark.operators.embedding import term_stats, with_vectors
from faqspark.operators.faq_documents import attach_course, faq_chunks, last_per_id, with_point_id
from faqspark.runtime import scratch_path
from faqspark.sources.collections import read_points, write_batch


def build_points(documents: DataFrame, courses: DataFrame) -> DataFrame:
    """Index points. Documents of unknown courses are dropped before they are cut, and the only
    exchange is the one by id that drops repeated chunks. It moves question and answer once:
    the text to embed is put together again after it, and vectors are computed for the chunks
    that stay."""
    chunks = with_point_id(faq_chunks(attach_course(documents, courses))).drop("text")
    kept = last_per_id(chunks).withColumn("text", embed_text(F.col("question"), F.col("answer")))
    payload = F.struct(
        "section", "question", "answer", "text", F.col("doc_id").cast("string").alias("doc_id"),
        F.col("course_name").alias("course"), "course_id",
    )
    return with_vectors(kept).select(
        "id", "collection", "course_id", F.col("course_name").alias("course"), "dense", "sparse", payload.alias("payload")
    )


def index_documents(
    spark: SparkSession, documents: DataFrame, courses: DataFrame, root: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Write the points as the first batch of a collection table, and their term statistics.

    Searches scan the stored columns they need instead of embedding the corpus again.
    """
    root = root or scratch_path(spark, "index")
    write_batch(build_points(documents, courses), f"{root}/points", 0, DENSE_DIM)
    points = read_points(spark, f"{root}/points", single_batch=True)
    term_stats(points).write.mode("overwrite").parquet(f"{root}/terms")
    return points, spark.read.parquet(f"{root}/terms")
