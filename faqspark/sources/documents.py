"""Styled documents and the chunk files made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from faqspark.functions.text import flatten_paragraph
from faqspark.schemas import DOCUMENT, FAQ_CHUNK


def parse_documents(exported: DataFrame, json: str = "json") -> DataFrame:
    """Exported documents as nested columns; elements that are no paragraph stay null."""
    return exported.withColumn("body", F.from_json(json, DOCUMENT)["body"]).drop(json)


def paragraph_blocks(content: Column) -> Column:
    """Paragraphs in order as ``array<struct<style, text>>``; tables and the like are skipped."""
    paragraphs = F.filter(content, lambda el: el["paragraph"].isNotNull())
    return F.transform(
        paragraphs,
        lambda el: F.struct(
            F.coalesce(el["paragraph"]["paragraphStyle"]["namedStyleType"], F.lit("")).alias("style"),
            flatten_paragraph(el["paragraph"]["elements"]).alias("text"),
        ),
    )


def document_blocks(documents: DataFrame) -> DataFrame:
    """One row per paragraph with its position in the document.

    The outer form is on purpose, here and wherever a computed array is exploded: for the plain
    form the optimizer adds a filter on the array's size below, which computes it again.
    """
    keys = [c for c in documents.columns if c != "body"]
    return documents.select(
        *keys, F.posexplode_outer(paragraph_blocks(F.col("body.content"))).alias("pos", "block")
    ).where("pos IS NOT NULL").select(*keys, "pos", "block.style", "block.text")


def write_chunks(chunks: DataFrame, root: str) -> None:
    """JSON lines per collection; non-ASCII text is written as it is."""
    (
        chunks.select(*FAQ_CHUNK.names)
        .hint("rebalance", "collection")
        .write.mode("overwrite").partitionBy("collection").json(root)
    )


def read_chunks(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(FAQ_CHUNK).json(root)
