"""Which rows a model may learn from, and bounded samples of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def remainder(doc_id: Column, modulus: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))


def held_out(doc_id: Column, modulus: int = 5, rest: int = 0) -> Column:
    """Rows kept out of learning; a row without id always is."""
    return F.coalesce(remainder(doc_id, modulus) == rest, F.lit(True))


def label_table(labels: DataFrame, column: str) -> DataFrame:
    """(id, label) of the rows a model may learn from: known id and label, one row per id, the larger label if they differ."""
    known = labels.where(F.col(column).isin(0, 1) & ~held_out(F.col("doc_id")))
    return known.groupBy(F.col("doc_id").alias("id")).agg(F.max(column).alias("label"))


def first_by_hash(rows: DataFrame, most: int, *ties: str) -> DataFrame:
    """At most ``most`` of ``rows`` (id, ...): those with the smallest hashes of the id.

    A bound on the hash, from the row count, leaves little more than ``most`` rows to be ordered, however
    many partitions there are.
    """
    share = 1.2 * most / max(rows.count(), 1)
    code = F.pmod(F.xxhash64("id"), F.lit(1 << 40))
    near = rows.where(code < int(share * (1 << 40))) if share < 1 else rows
    return near.orderBy(code, "id", *ties).limit(most)
