"""Embedding of whole tables, with a seam for trained models."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from faqspark.functions.text import token_codes
from faqspark.functions.vectors import DENSE_DIM, dense_vector, sparse_vector

HASH_MODEL = "token-hash"
EMBED_VERSION = "v1"


def with_vectors(df: DataFrame, text: str = "text", dim: int = DENSE_DIM) -> DataFrame:
    """Add ``dense`` and ``sparse``; both read the tokens of the whole text once."""
    coded = df.withColumn("_codes", token_codes(F.col(text)))
    return coded.withColumns(
        {"dense": dense_vector(F.col("_codes"), dim), "sparse": sparse_vector(F.col("_codes"))}
    ).drop("_codes")


def model_udf(load: Callable[[], Callable[[list[str]], list[list[float]]]]) -> Callable[[Column], Column]:
    """Wrap a trained encoder. ``load`` runs once per Python worker, then batches stream through."""

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            yield pd.Series([[float(x) for x in v] for v in model(batch.tolist())])

    return encode


def term_stats(points: DataFrame) -> DataFrame:
    """``idx, df, n_docs``: document frequency per term index, and the corpus size in each row.

    At most 2^20 rows by construction of the index. Stored beside a collection, it saves every
    search a pass over the corpus.
    """
    n_docs = points.agg(F.count("*").alias("n_docs")).scalar()
    terms = points.select(F.explode_outer("sparse.indices").alias("idx")).where("idx IS NOT NULL")
    return terms.groupBy("idx").agg(F.count("*").alias("df")).withColumn("n_docs", n_docs)


def idf() -> Column:
    """Inverse document frequency from the columns of ``term_stats``."""
    n_docs, df = F.col("n_docs"), F.col("df")
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def term_rows(df: DataFrame, key: str) -> DataFrame:
    """Long form ``(key, idx, tf_weight)`` of the sparse vectors."""
    pairs = F.arrays_zip("sparse.indices", "sparse.values")
    return df.select(key, F.explode_outer(pairs).alias("t")).where("t IS NOT NULL").select(
        key, F.col("t.indices").alias("idx"), F.col("t.values").alias("tf_weight")
    )


def weighted_terms(points: DataFrame, key: str) -> DataFrame:
    """Long form ``(key, idx, weight)`` with idf applied.

    The broadcast table has at most 2^20 rows of two numbers (about 16 MB), whatever the corpus.
    """
    weights = term_stats(points).select("idx", idf().alias("idf"))
    return term_rows(points, key).join(F.broadcast(weights), "idx").select(
        key, "idx", (F.col("tf_weight") * F.col("idf")).alias("weight")
    )


def stale_points(points: DataFrame, current: DataFrame) -> DataFrame:
    """Points whose vectors are absent from ``current`` (``id``, ``embed_version``)."""
    return points.join(current, ["id", "embed_version"], "left_anti")
