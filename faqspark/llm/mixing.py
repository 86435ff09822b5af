"""Temperature mixing of sources, realised as budgeted block permutations.

Weights are token shares raised to one exponent and normalised. Exponent 1 keeps the shares,
exponent 0 makes all sources equal; between them entropy and repetition move monotonically, which
is what the bisection uses. Everything is DataFrame code; the driver sees two numbers per step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from faqspark.llm.rule_cascade import words_of
from faqspark.llm.store import Saved, free_name

#: Exponents tried per pass over the source table; five halvings at once.
_GRID = 32


def _number(*parts) -> Column:
    """60 pseudo-random bits of the given values, the same on every engine that has md5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def source_shares(docs: DataFrame) -> DataFrame:
    """(source, n_docs, tokens, share) of rows (source, n_tokens); null is a source of its own."""
    stats = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("tokens"))
    total = stats.agg(F.sum("tokens")).scalar()
    return stats.withColumn("share", F.col("tokens") / F.greatest(total, F.lit(1)))


def exponent(shares: DataFrame, budget: int, *, max_repeats: float | None = 4.0, target_entropy: float | None = None,
             high: float = 8.0, passes: int = 8) -> float:
    """Smallest exponent in [0, ``high``] that keeps both limits, to ``high / 32 ** passes``.

    ``max_repeats`` bounds how often a source's tokens are used; ``target_entropy`` (nats) bounds the
    entropy of the weights from above. If no exponent does, ``high``.
    """
    low, top = 0.0, high
    used = shares.where("tokens > 0").select("tokens", "share")
    for _ in range(passes):
        steps = [low + (top - low) * k / _GRID for k in range(_GRID + 1)]
        tried = used.withColumn("k", F.explode(F.array(*[F.lit(k) for k in range(_GRID + 1)]))).withColumn(
            "p", F.pow("share", F.lit(low) + F.col("k") * F.lit((top - low) / _GRID)))
        sums = tried.groupBy("k").agg(
            F.sum("p").alias("z"), F.sum(F.col("p") * F.log("share")).alias("s"), F.max(F.col("p") / F.col("tokens")).alias("m"))
        a = F.lit(low) + F.col("k") * F.lit((top - low) / _GRID)
        fine = F.lit(True)
        if max_repeats is not None:
            fine &= F.col("m") / F.col("z") * F.lit(float(budget)) <= F.lit(float(max_repeats)) * (1 + 1e-12)
        if target_entropy is not None:
            fine &= F.log("z") - a * F.col("s") / F.col("z") <= F.lit(target_entropy) + 1e-12
        first = sums.where(fine).agg(F.min("k")).first()[0]
        if first is None:
            return high if top == high else top
        if first == 0:
            return low
        low, top = steps[first - 1], steps[first]
    return top


def quotas(shares: DataFrame, alpha: float, budget: int) -> DataFrame:
    """(source, n_docs, tokens, weight, full, rest): whole passes and tokens of the last, partial pass.

    A source without tokens costs nothing; its rows get one pass.
    """
    p = F.when(F.col("tokens") > 0, F.pow("share", F.lit(alpha))).otherwise(0.0)
    total = shares.agg(F.sum(p)).scalar()
    weighted = shares.withColumn("p", p).withColumn("weight", F.col("p") / F.greatest(total, F.lit(1e-300)))
    quota = F.floor(F.col("weight") * F.lit(float(budget))).cast("long")
    return weighted.withColumn("quota", quota).select(
        "source", "n_docs", "tokens", "weight",
        F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.greatest("tokens", F.lit(1)))).otherwise(1).cast("long").alias("full"),
        F.when(F.col("tokens") > 0, F.col("quota") % F.greatest("tokens", F.lit(1))).otherwise(0).cast("long").alias("rest"))


def plan_mix(docs: DataFrame, *, budget: int | None = None, max_repeats: float | None = 4.0, target_entropy: float | None = None,
             seed: int = 17) -> DataFrame:
    """How often, and where, each row of ``docs`` (doc_id, source, n_tokens) is used.

    Returns (doc_id, source, n_tokens, full, extra, block_rank, place): ``full`` whole passes, and one
    more if ``extra`` is 1. A source is cut by hash into about sqrt(rows) blocks; the order of the blocks
    and the order inside them are its permutation. The partial pass takes rows in this order while
    those before them leave some of the source's budget: no long row keeps others out, a source's budget is used
    up, and is exceeded by less than one row.
    No task sorts more than the blocks of a source or the rows of a block. ``budget`` defaults to
    the tokens of all rows. Rows with equal doc_id are ordered by their tokens; null sources form
    a source; rows without doc_id are ordered by tokens too.
    """
    rows = Saved(docs.select("doc_id", "source", "n_tokens"), "mix-rows").df
    shares = Saved(source_shares(rows), "mix-shares").df
    budget = shares.agg(F.sum("tokens")).first()[0] or 0 if budget is None else budget
    alpha = exponent(shares, budget, max_repeats=max_repeats, target_entropy=target_entropy)
    use = quotas(shares, alpha, budget).withColumnRenamed("source", "s").withColumn("n_blocks", F.ceil(F.sqrt("n_docs")).cast("long"))
    code = _number(F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.col("n_tokens").cast("string"))))
    placed = rows.join(use, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "n_tokens", "full", "rest", code.alias("code"), F.pmod(code, F.col("n_blocks")).alias("block"))
    blocks = placed.groupBy("source", "block").agg(F.sum("n_tokens").alias("size"))
    order = Window.partitionBy("source").orderBy(_number(F.lit(f"{seed}b"), F.col("block").cast("string")), "block")
    blocks = blocks.select(
        F.col("source").alias("s"), F.col("block").alias("b"), F.row_number().over(order).cast("long").alias("block_rank"),
        (F.sum("size").over(order) - F.col("size")).alias("before"))
    inside = Window.partitionBy("source", "block").orderBy("code", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    joined = placed.join(blocks, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    end = F.col("before") + F.sum("n_tokens").over(inside)
    return joined.select(
        "doc_id", "source", "n_tokens", "full",
        F.when(end - F.col("n_tokens") < F.col("rest"), 1).otherwise(0).cast("long").alias("extra"),
        "block_rank", F.row_number().over(inside).cast("long").alias("place"))


def with_tokens(docs: DataFrame) -> DataFrame:
    """doc_id, source and the number of words of the text (0 for null)."""
    return docs.select("doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("n_tokens"))


def mixture(docs: DataFrame, **limits) -> DataFrame:
    """The realised mixture: one row (doc_id, source, n_tokens, pass, block_rank, place) per use of a document.

    ``pass``, ``block_rank`` and ``place`` give a source's order of use. Empty texts cost no tokens and
    come along in whole passes, and in a partial pass while it lasts. An empty table gives no rows.
    """
    plan = plan_mix(with_tokens(docs), **limits)
    uses = F.col("full") + F.col("extra")
    return plan.where(uses > 0).select(
        "doc_id", "source", "n_tokens", F.explode(F.sequence(F.lit(0).cast("long"), uses - 1)).alias("pass"), "block_rank", "place")


def mix(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` with every row as often as the mixture uses it, all columns kept, whatever their names.

    Rows that share a doc_id are one document whose uses all its rows get. Rows without doc_id cannot
    be told apart: they stay once each and count for no budget. A source has less than one document above its
    budget, and one long document keeps no others out. Null texts cost nothing; an empty table stays empty.
    """
    known = docs.where("doc_id IS NOT NULL")
    one = with_tokens(known).groupBy("doc_id").agg(F.min("source").alias("source"), F.sum("n_tokens").alias("n_tokens"))
    of, times, use = (free_name(docs, base) for base in ("mixed", "times", "use"))
    uses = plan_mix(one, **limits).select(F.col("doc_id").alias(of), (F.col("full") + F.col("extra")).alias(times))
    named = known.join(uses.where(F.col(times) > 0), F.col("doc_id") == F.col(of)).drop(of)
    many = named.withColumn(use, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).drop(times, use)
    return many.unionByName(docs.where("doc_id IS NULL"))
