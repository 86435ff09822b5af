"""Cut styled documents into question/answer chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from faqspark.functions.arrays import let
from faqspark.functions.text import embed_text, point_id
from faqspark.sources.collections import collection_name, latest_by_key
from faqspark.sources.documents import paragraph_blocks

SECTION, QUESTION = "HEADING_1", "HEADING_2"


def chunk_blocks(blocks: Column) -> Column:
    """``array<struct<chunk_no, section, question, answer>>`` of one document's blocks.

    A question heading opens a chunk that runs to the next question heading; its section is
    the last section heading above it, and a section heading inside it does not end it.
    Everything happens inside the document's row, in time linear in its blocks: no exchange,
    no window, and a document of any length cannot skew a shuffle.

    Among the headings, the question heading at place ``p`` that is the ``k``-th question has
    ``p - k`` section headings above it, which gives its section without searching.
    """
    def heading(block: Column) -> Column:
        return block["style"].isin(SECTION, QUESTION)

    def chunks(full: Column, heads: Column) -> Column:
        sections = F.transform(
            F.filter(heads, lambda h: h["style"] == SECTION), lambda h: h["text"]
        )
        questions = F.filter(
            F.transform(heads, lambda h, p: h.withField("place", p)),
            lambda h: h["style"] == QUESTION,
        )
        return let(sections, lambda above: let(questions, lambda asked: F.transform(
            asked,
            lambda q, k: F.struct(
                (k + 1).alias("chunk_no"),
                F.coalesce(F.get(above, q["place"] - k - 1), F.lit("")).alias("section"),
                q["text"].alias("question"),
                F.array_join(
                    F.transform(
                        F.filter(
                            F.slice(
                                full, q["at"] + 2,
                                F.coalesce(F.get(asked, k + 1)["at"], F.size(full)) - q["at"] - 1,
                            ),
                            lambda b: ~heading(b),
                        ),
                        lambda b: b["text"],
                    ),
                    "\n",
                ).alias("answer"),
            ),
        )))

    def headings(full: Column) -> Column:
        numbered = F.transform(full, lambda b, i: b.withField("at", i))
        return F.filter(numbered, heading)

    nonempty = F.filter(blocks, lambda b: b["text"] != "")
    return let(nonempty, lambda full: let(headings(full), lambda heads: chunks(full, heads)))


def faq_chunks(documents: DataFrame) -> DataFrame:
    """Chunks of styled documents (``body`` plus key columns); blank answers are dropped, and
    with them the one empty row of a document without chunks."""
    keys = [c for c in documents.columns if c != "body"]
    return (
        documents.select(*keys, F.inline_outer(chunk_blocks(paragraph_blocks(F.col("body.content")))))
        .where("answer != ''")
    )


def selected_courses(courses: DataFrame, only: str | None = None) -> DataFrame:
    """Courses with a usable document id, optionally a single one."""
    usable = courses.where(
        (F.coalesce("google_doc_id", F.lit("")) != "") & ~F.col("google_doc_id").startswith("${")
    )
    return usable.where(F.col("course_id") == only) if only else usable


def attach_course(chunks: DataFrame, courses: DataFrame, base: str = "faq") -> DataFrame:
    """Course id, name and collection of each chunk's document."""
    dim = selected_courses(courses).select(
        "google_doc_id", "course_id", "course_name",
        collection_name(F.lit(base), F.col("collection_suffix")).alias("collection"),
    )
    return chunks.join(dim, "google_doc_id")


def with_point_id(chunks: DataFrame, id_hex: int = 8) -> DataFrame:
    """Text to embed and the content-hash id."""
    texts = chunks.withColumn("text", embed_text(F.col("question"), F.col("answer")))
    return texts.withColumn("id", point_id(F.col("course_id"), F.col("text"), id_hex))


def last_per_id(chunks: DataFrame) -> DataFrame:
    """Equal chunks of a course share an id; the last one in document order stays."""
    return latest_by_key(chunks, ["id"], ["doc_id", "chunk_no"])


def chunk_counts(chunks: DataFrame) -> DataFrame:
    """Chunks per course and, under a null course, in total."""
    return chunks.rollup("course_id").agg(F.count("*").alias("n"))
