"""Message and document tables in the shape of the live sources, built from the test tables.

Every row of the underlying tables is used; see FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from faqspark.runtime import prepare, spread

SALT = "fixture-salt"
FIRST_FETCH = "2024-08-14T06:00:00Z"
SECOND_FETCH = "2024-08-15T06:00:00Z"
EPOCH = 1723420800


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages: threads, late replies, bad times, re-fetched copies, personal data."""
    conv, turn = F.col("conv_id"), F.col("turn")
    base = EPOCH + conv * 900
    mixed = (conv * 8 + turn) % 6
    extra = (
        F.when(mixed == 0, " <@U0001>").when(mixed == 1, " <#C42|general>")
        .when(mixed == 2, " https://x.example.com/a?b=1")
        .when(mixed == 3, " me.7@mail.example.com")
        .when(mixed == 4, " +1 (555) 555-0100").otherwise(" ```a@b.co```")
    )
    fetches = F.when(conv % 10 == 0, F.array(F.lit(FIRST_FETCH), F.lit(SECOND_FETCH))).otherwise(
        F.array(F.lit(FIRST_FETCH))
    )
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("C"), (100 + conv % 5).cast("string")).alias("channel_id"),
        F.when((conv % 50 == 49) & (turn == 1), "bad").otherwise(
            F.concat((base + turn * 4000).cast("string"), F.lit("."),
                     F.lpad(turn.cast("string"), 6, "0"))
        ).alias("ts"),
        F.when((conv % 7 == 6) & (turn == 0), F.lit(None)).otherwise(
            F.concat(base.cast("string"), F.lit(".000000"))
        ).alias("thread_ts"),
        F.concat(F.lit("U"), F.lpad(((conv * 7 + turn) % 50).cast("string"), 4, "0")).alias("user_id"),
        "role",
        F.concat("text", extra, F.when((conv + turn) % 3 == 0, " How do I fix it?").otherwise("")).alias("text"),
        F.explode(fetches).alias("fetched_at"),
    )


def courses(spark: SparkSession) -> DataFrame:
    """Course configuration: five courses with one channel each, one still without messages."""
    return prepare(spark).sql("""
        SELECT id AS course_id, channels FROM VALUES
          ('course-0', array('C100')), ('course-1', array('C101')), ('course-2', array('C102')),
          ('course-3', array('C103')), ('course-4', array('C104', 'C199')) AS t(id, channels)""")


def faq_courses(spark: SparkSession) -> DataFrame:
    """FAQ course configuration; two entries have no usable document id."""
    return prepare(spark).sql("""
        SELECT * FROM VALUES
          ('course-0', 'Course 0', 'faq-0', 'c0'), ('course-1', 'Course 1', 'faq-1', 'c1'),
          ('course-2', 'Course 2', 'faq-2', 'c2'), ('course-3', 'Course 3', 'faq-3', 'c3'),
          ('course-4', 'Course 4', NULL, 'c4'), ('course-5', 'Course 5', '${FAQ_DOC_5}', 'c5')
          AS t(course_id, course_name, google_doc_id, collection_suffix)""")


def _style(pos: Column) -> Column:
    return (
        F.when((pos % 12).isin(4, 10), "HEADING_1").when(pos % 4 == 1, "HEADING_2")
        .when(pos % 4 == 3, "HEADING_3").otherwise("NORMAL_TEXT")
    )


def _run(content: Column) -> Column:
    return F.struct(F.struct(content.alias("content")).alias("textRun"))


def styled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One styled document per row: each line a paragraph of two text runs, and a table between."""

    def paragraph(line: Column, pos: Column) -> Column:
        half = F.floor(F.length(line) / 2).cast("int")
        return F.struct(F.struct(
            F.struct(_style(pos).alias("namedStyleType")).alias("paragraphStyle"),
            F.array(
                _run(F.substring(line, F.lit(1), half)),
                _run(F.lit(None).cast("string")),
                _run(F.concat(F.substring(line, half + 1, F.length(line)), F.lit("\n"))),
            ).alias("elements"),
        ).alias("paragraph"))

    content = F.transform(F.split("text", "\n"), paragraph)
    return documents(spark, sf_dir).select(
        "doc_id",
        F.concat(F.lit("faq-"), (F.col("doc_id") % 4).cast("string")).alias("google_doc_id"),
        F.struct(content.alias("content")).alias("body"),
    )


def document_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents as exported JSON text."""
    return styled_documents(spark, sf_dir).select(
        "doc_id", "google_doc_id", F.to_json(F.struct("body")).alias("json")
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given vectors in four collections."""
    number = (F.col("vec_id") % 4).cast("string")
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"),
        F.concat(F.lit("faq_c"), number).alias("collection"),
        F.col("label").alias("label"),
        F.col("embedding").alias("dense"),
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts in four collections, as points to embed."""
    return documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.lit("faq_c"), (F.col("doc_id") % 4).cast("string")).alias("collection"),
        "text",
    )
