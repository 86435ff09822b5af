"""Groups of vectors that mean the same: mutual neighbours, and what they connect."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from faqspark.operators.cells import cell_top_k, write_cells
from faqspark.operators.similar_sets import connected_components
from faqspark.runtime import scratch_path, stored


def mutual_neighbours(points: DataFrame, near: int, threshold: float) -> DataFrame:
    """``id, leader, score``: pairs of points (id bigint, dense) that are among each other's ``near`` best, the higher id first.

    Their cosine, rounded to six digits, is at least ``threshold``. Unlike all pairs over a threshold, mutual neighbours do not
    chain a crowd together by its hubs, and there are at most ``near`` of them for a point. Ids are
    unique; ties go to the smaller id as text. The search is exact, by cells.
    """
    root = scratch_path(points.sparkSession, "neighbours")
    named = points.select(F.col("id").cast("string").alias("id"), "dense")
    write_cells(named, root)
    # One more than asked for, as a point finds itself.
    hits = cell_top_k(points.sparkSession, root, named.withColumnRenamed("id", "query_id"), near + 1, threshold)[0]
    order = Window.partitionBy("query_id").orderBy("rank")
    kept = hits.where("id != query_id").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= near)
    a, b = F.col("query_id").cast("long"), F.col("id").cast("long")
    ends = kept.select(F.greatest(a, b).alias("id"), F.least(a, b).alias("leader"), "score")
    return ends.groupBy("id", "leader").agg(F.count("*").alias("n"), F.min("score").alias("score")).where("n = 2").drop("n")


def semantic_groups(vectors: DataFrame, near: int = 10, threshold: float = 0.9) -> DataFrame:
    """``id, canonical, group_size`` of vectors (id bigint, dense): equal vectors and mutual neighbours are grouped together.

    Equal vectors are folded first, map-side, so copies take no place among a vector's neighbours, however many there are.
    Null vectors and those of length zero mean nothing and stay alone. ``canonical`` is the smallest id.
    """
    means = F.exists("dense", lambda x: x != 0)
    own = F.when(means, F.xxhash64("dense"))
    tagged = stored(vectors.select("id", "dense", own.alias("code")), "vectors")
    heads = stored(tagged.where("code IS NOT NULL").groupBy("code", "dense").agg(F.min("id").alias("head")), "distinct-vectors")
    links = mutual_neighbours(heads.select(F.col("head").alias("id"), "dense"), near, threshold)
    labels = connected_components(links).withColumnRenamed("id", "head")
    named = heads.join(labels, "head", "left").select("code", "dense", F.coalesce("label", "head").alias("canonical"))
    alone = tagged.where("code IS NULL").select("id", F.col("id").alias("canonical"))
    grouped = tagged.join(named, ["code", "dense"]).select("id", "canonical").unionByName(alone)
    sizes = grouped.groupBy("canonical").agg(F.count("*").alias("group_size"))
    return grouped.join(sizes, "canonical").select("id", "canonical", "group_size")
