"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from faqspark.llm.store import Saved


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable id of every id that occurs in ``links`` (a, b), numbers or strings: (id, component_id).

    Each round takes the smallest label next to an id and then that label's own label, so the
    number of rounds grows with the logarithm of the longest chain. Labels are combined before
    every exchange and joined by inner joins, whose hot keys adaptive execution splits. Every
    round is written to shared storage; the copy before it is removed.
    """
    both = links.select("a", "b").where("a != b")
    kind = both.schema["a"].dataType
    edges = Saved(both.union(both.select("b", "a")).distinct(), "edges")
    first = edges.df.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("c"))
    labels = Saved(first.select("id", F.least("c", "id").alias("c"), F.lit(True).alias("moved")), "labels")
    while labels.df.where("moved").limit(1).count():
        own = labels.df.select("id", "c")
        near = edges.df.join(own, F.col("b") == F.col("id")).select(F.col("a").alias("id"), "c", F.lit(None).cast(kind).alias("old"))
        low = near.union(own.select("id", "c", F.col("c").alias("old"))).groupBy("id").agg(F.min("c").alias("c"), F.max("old").alias("old"))
        up = own.select(F.col("id").alias("o"), F.col("c").alias("up"))
        hop = low.join(up, F.col("c") == F.col("o")).select("id", F.least("c", "up").alias("c"), (F.least("c", "up") != F.col("old")).alias("moved"))
        new = Saved(hop, "labels")
        labels.drop()
        labels = new
    edges.drop()
    return labels.df.select("id", F.col("c").alias("component_id"))
