"""Dense and sparse top-k retrieval for many queries at once, and their fusion.

Points have ``id`` (string), ``dense``, ``sparse`` and, when searches are confined to parts of
the corpus, a ``scope`` column; queries have ``query_id`` (string), the same vectors and scope.

One job scores all queries, however many there are. Queries are dealt into groups that a task can hold. A single
group is broadcast, and the scan of the points is the only pass over them. Several groups meet shards of the
points in a cogroup by (shard, group): a query travels once per shard, a point once per group, and neither passes
the driver. A task keeps its best ``depth`` points per query and emits only those, never a row per (query, point); they
are merged in two steps. Queries of a scope are scored on the points of that scope alone.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import ceil
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from faqspark.operators.embedding import idf, term_rows, term_stats
from faqspark.runtime import stored

# Tasks get this module's functions by value, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Queries and query terms of a group, about; points of a shard, about.
GROUP_QUERIES, GROUP_TERMS, SHARD_POINTS = 4096, 1 << 20, 1 << 15
# Points that share entries with queries, and cells of a score matrix, computed at a time.
PAIRS, CELLS = 1 << 21, 1 << 21
# Shards whose candidates meet before all candidates of a query do.
TIER_SHARDS = 64
RRF_K = 60
DIGITS = 6
CANDIDATE = "kind string, query_id string, id string, score double"


@dataclass
class QueryBlock:
    """Queries of one scope as arrays; sparse queries as (sorted term, query, weight)."""

    scope: str | None
    ids: list[str]
    dense: np.ndarray | None = None
    terms: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    term_query: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    term_weight: np.ndarray = field(default_factory=lambda: np.empty(0))


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def _dense_scores(block: QueryBlock, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    rows = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = _unit(rows.reshape(len(vectors), -1))
    scores = np.round(rows @ block.dense.T, DIGITS)
    return scores, np.ones(scores.shape, bool)


def _sparse_scores(block: QueryBlock, vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
    indices, values = vectors.field("indices"), vectors.field("values")
    offsets = indices.offsets.to_numpy()
    offsets = offsets - offsets[0]
    term = indices.flatten().to_numpy(zero_copy_only=False)
    weight = values.flatten().to_numpy(zero_copy_only=False)
    first = np.searchsorted(block.terms, term, "left")
    hits = np.searchsorted(block.terms, term, "right") - first
    shape = (len(vectors), len(block.ids))
    scores, found = np.zeros(shape), np.zeros(shape, bool)
    before = np.concatenate(([0], np.cumsum(hits)))[offsets]
    start = 0
    while start < len(vectors):
        # As many points as have about PAIRS shared (term, query) entries, at least one.
        end = max(start + 1, int(np.searchsorted(before, before[start] + PAIRS, "right")) - 1)
        part = slice(offsets[start], offsets[end])
        n = hits[part]
        skipped = np.concatenate(([0], np.cumsum(n)))[:-1]
        entry = np.repeat(first[part] - skipped, n) + np.arange(n.sum())
        point = np.repeat(np.arange(end - start), np.diff(offsets[start:end + 1]))
        cell = np.repeat(point, n) * shape[1] + block.term_query[entry]
        product = np.repeat(weight[part], n) * block.term_weight[entry]
        size = (end - start) * shape[1]
        scores[start:end] = np.bincount(cell, weights=product, minlength=size).reshape(-1, shape[1])
        found[start:end] = np.bincount(cell, minlength=size).reshape(-1, shape[1]) > 0
        start = end
    return np.round(scores, DIGITS), found


@dataclass
class Best:
    """Running best points of each query, by falling score and rising id.

    ``floors`` are the scores a further point must reach; once they are high, a slab costs a
    comparison and hardly any query needs work.
    """

    floors: np.ndarray
    kept: list[list[tuple[float, str]]]

    def add(self, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, depth: int) -> None:
        good = allowed & (scores >= self.floors)
        for q in np.flatnonzero(good.any(axis=0)):
            rows = np.flatnonzero(good[:, q])
            if len(rows) > depth:
                column = scores[rows, q]
                rows = rows[column >= np.partition(column, len(rows) - depth)[len(rows) - depth]]
            found = [(-scores[r, q], ids[r]) for r in rows]
            self.kept[q] = heapq.nsmallest(depth, self.kept[q] + found)
            if len(self.kept[q]) == depth:
                self.floors[q] = -self.kept[q][-1][0]


def _blocks(queries: pa.Table, kinds: list[str]) -> list[QueryBlock]:
    """The queries (query_id, scope?, dense?, terms?) of each scope as one block."""
    scopes = queries.column("scope").unique().to_pylist() if "scope" in queries.column_names else [None]
    blocks = []
    for scope in scopes:
        own = queries if "scope" not in queries.column_names else queries.filter(pc.equal(queries.column("scope"), scope))
        if not own.num_rows:
            continue
        block = QueryBlock(scope, own.column("query_id").to_pylist())
        if "dense" in kinds:
            rows = own.column("dense").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            block.dense = _unit(rows.reshape(own.num_rows, -1))
        if "sparse" in kinds:
            lists = own.column("terms").combine_chunks()
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            flat = lists.flatten()
            term, weight = (flat.field(name).to_numpy(zero_copy_only=False) for name in ("idx", "weight"))
            query = np.repeat(np.arange(own.num_rows), sizes)
            by_term = np.lexsort((query, term))
            block.terms, block.term_query, block.term_weight = term[by_term].astype(np.int64), query[by_term], weight[by_term]
        blocks.append(block)
    return blocks


def _search(points: Iterable[pa.RecordBatch], blocks: list[QueryBlock], kinds: list[str], depth: int, more: list[str]) -> pa.Table:
    """Best ``depth`` of the points for every query and kind, with the points' columns ``more``."""
    score = {"dense": _dense_scores, "sparse": _sparse_scores}
    best = [{kind: Best(np.full(len(b.ids), -np.inf), [[] for _ in b.ids]) for kind in kinds} for b in blocks]
    step = max(64, CELLS // max([len(b.ids) for b in blocks], default=1))
    for batch in points:
        scopes = batch.column("scope") if "scope" in batch.schema.names else None
        for block, kept in zip(blocks, best):
            own = batch if scopes is None else batch.filter(pc.equal(scopes, block.scope))
            for start in range(0, own.num_rows, step):
                slab = own.slice(start, step)
                ids = np.array(list(zip(*(slab.column(c).to_pylist() for c in ("id", *more)))) + [None], object)[:-1]
                for kind in kinds:
                    kept[kind].add(*score[kind](block, slab.column(kind)), ids, depth)
    rows = [(kind, block.ids[q], *point, -loss)
            for block, kept in zip(blocks, best) for kind in kinds for q, some in enumerate(kept[kind].kept) for loss, point in some]
    columns = list(zip(*rows)) if rows else [[] for _ in range(4 + len(more))]
    names = ["kind", "query_id", "id", *more, "score"]
    kind_of = {"score": pa.float64()} | {c: pa.int32() for c in more}
    return pa.table({name: pa.array(list(column), kind_of.get(name, pa.string())) for name, column in zip(names, columns)})


def _by_broadcast(points: DataFrame, queries: DataFrame, kinds: list[str], depth: int, more: list[str], schema: str) -> DataFrame:
    """Candidates for a group of queries that every task holds; its size is checked by the caller."""
    blocks = [vars(block) for block in _blocks(queries.toArrow(), kinds)]
    sent = points.sparkSession.sparkContext.broadcast(blocks)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _search(batches, [SimpleNamespace(**b) for b in sent.value], kinds, depth, more).to_batches()

    return points.mapInArrow(search, schema)


def _by_shard(points: DataFrame, queries: DataFrame, groups: int, kinds: list[str], depth: int, more: list[str], schema: str) -> DataFrame:
    """Candidates of every shard of the points for every group of queries, in one cogroup."""
    shards = max(1, ceil(points.count() / SHARD_POINTS))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = points.select("*", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("_shard"), numbers(groups).alias("_group"))
    asked = queries.select("*", numbers(shards).alias("_shard"), F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int").alias("_group"))

    def search(some: pa.Table, group: pa.Table) -> pa.Table:
        return _search(some.combine_chunks().to_batches(), _blocks(group, kinds), kinds, depth, more)

    sides = [side.groupBy("_shard", "_group") for side in (own, asked)]
    return sides[0].cogroup(sides[1]).applyInArrow(search, schema)


def _candidates(points: DataFrame, queries: DataFrame, kinds: list[str], depth: int, stats: DataFrame | None, more: list[str]) -> DataFrame:
    """(kind, query_id, id, *more, score): at least the best ``depth`` points per query and kind."""
    scope = ["scope"] if "scope" in queries.columns else []
    packed = queries.select("query_id", *scope, *(["dense"] if "dense" in kinds else []))
    if "sparse" in kinds:
        packed = packed.join(_weighted_queries(queries, stats), "query_id", "left")
    packed = stored(packed, "queries")
    terms = F.sum(F.size("terms")) if "sparse" in kinds else F.lit(0)
    total = packed.agg(F.count("*").alias("n"), terms.alias("terms")).first()
    groups = max(1, ceil(total["n"] / GROUP_QUERIES), ceil((total["terms"] or 0) / GROUP_TERMS))
    if scope:
        # An inner join side: only scopes that are asked for are scored.
        points = points.join(packed.select("scope").distinct(), "scope", "left_semi")
    own = points.select("id", *kinds, *scope, *more)
    schema = CANDIDATE.replace("score", "".join(f"{c} int, " for c in more) + "score")
    if groups == 1:
        return _by_broadcast(own, packed, kinds, depth, more, schema)
    return _by_shard(own, packed, groups, kinds, depth, more, schema)


def _ranked(candidates: DataFrame, depth: int) -> DataFrame:
    """The best ``depth`` per kind and query; points are limited by parts of the corpus before all of a query's meet."""
    best = [F.desc("score"), "id"]
    part = Window.partitionBy("kind", "query_id", F.pmod(F.xxhash64("id"), F.lit(TIER_SHARDS))).orderBy(*best)
    some = candidates.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= depth)
    order = Window.partitionBy("kind", "query_id").orderBy(*best)
    return some.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= depth)


def _weighted_queries(queries: DataFrame, stats: DataFrame) -> DataFrame:
    """Query terms with the squared idf of the corpus (one factor per side of the product)."""
    weight = (F.col("tf_weight") * F.pow(idf(), 2)).alias("weight")
    return term_rows(queries, "query_id").join(stats, "idx").groupBy("query_id").agg(
        F.collect_list(F.struct("idx", weight)).alias("terms")
    )


def top_k(
    points: DataFrame, queries: DataFrame, kind: str, depth: int, stats: DataFrame | None = None
) -> DataFrame:
    """Exact best ``depth`` points per query: ``query_id, rank, id, score``.

    ``dense`` is cosine similarity. ``sparse`` is the dot product of idf-weighted term
    vectors; points that share no term with the query are no candidates.
    """
    if kind == "sparse" and stats is None:
        stats = term_stats(points)
    return _ranked(_candidates(points, queries, [kind], depth, stats, []), depth).select("query_id", "rank", "id", "score")


def _fused(candidates: DataFrame, limit: int, depth: int, k: int, more: list[str]) -> DataFrame:
    """Reciprocal Rank Fusion of the two candidate lists, cut to ``limit``."""
    fused = _ranked(candidates, depth).groupBy("query_id", "id", *more).agg(
        F.round(F.sum(1.0 / (k + F.col("rank"))), DIGITS).alias("score")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return fused.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def hybrid_search(
    points: DataFrame, queries: DataFrame, limit: int = 10, multiplier: int = 2, k: int = RRF_K,
    stats: DataFrame | None = None,
) -> DataFrame:
    """``query_id, rank, id, score, payload``: dense and sparse lists of ``limit * multiplier``
    points each, fused by Reciprocal Rank Fusion.

    Filter ``points`` beforehand (or give both sides a ``scope``): conditions apply before the
    candidate lists are cut. ``stats`` are the ``term_stats`` of the whole collection. Vectors
    never reach the result.

    The hits are written out, so that the corpus is scored once; the payload is then fetched by a join that the optimizer
    broadcasts if the hits are small. Where points are stored by ``bucket``, hits carry theirs, whatever their
    number is, and prune the partitions that are read.
    """
    stats = term_stats(points) if stats is None else stats
    depth = limit * multiplier
    where = [c for c in ("bucket",) if c in points.columns]
    hits = _fused(_candidates(points, queries, ["dense", "sparse"], depth, stats, where), limit, depth, k, where)
    # The filter is always true; partition pruning at run time asks for one on this side.
    hits = stored(hits, "hits").where(F.col("rank") <= limit)
    shown = points.select("id", "payload", *where).join(hits, ["id", *where])
    return shown.select("query_id", "rank", "id", "score", "payload")


def of_course(points: DataFrame, course: str) -> DataFrame:
    """Points of a course, given by name or by id; where they are stored by course, only its files are opened."""
    at = (lambda name: F.col(name)) if {"course", "course_id"} <= set(points.columns) else (lambda name: F.col(f"payload.{name}"))
    return points.where((at("course") == course) | (at("course_id") == course))


def search_by_course(points: DataFrame, queries: DataFrame, course: str, **options) -> DataFrame:
    """Search within one course, given by name or by id."""
    return hybrid_search(of_course(points, course), queries, **options)


def search_by_section(points: DataFrame, queries: DataFrame, section: str, **options) -> DataFrame:
    return hybrid_search(points.where(F.col("payload.section") == section), queries, **options)


def search(
    points: DataFrame, queries: DataFrame, course: str | None = None, section: str | None = None, **options
) -> DataFrame:
    """Search with an optional filter; a course takes precedence over a section."""
    if course:
        return search_by_course(points, queries, course, **options)
    if section:
        return search_by_section(points, queries, section, **options)
    return hybrid_search(points, queries, **options)


def format_hits(
    hits: DataFrame, digits: int = 4, answer_chars: int = 200, question_chars: int | None = None
) -> DataFrame:
    """Display form: rounded scores, ``N/A`` for missing fields, shortened texts."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(f"payload.{name}"), F.lit("N/A"))

    def cut(text: Column, chars: int) -> Column:
        return F.concat(F.substring(text, 1, chars), F.lit("..."))

    question = shown("question")
    return hits.select(
        "query_id", "rank", F.round("score", digits).alias("score"),
        shown("course").alias("course"), shown("section").alias("section"),
        (cut(question, question_chars) if question_chars else question).alias("question"),
        cut(shown("answer"), answer_chars).alias("answer"),
    )


def rag_context(hits: DataFrame, queries: DataFrame, top: int = 3) -> DataFrame:
    """Best ``top`` answers of each query joined in rank order, and the prompt around them."""
    best = hits.where(F.col("rank") <= top).groupBy("query_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", F.col("payload.answer").alias("answer")))).alias("a")
    )
    context = F.array_join(F.transform("a", lambda x: x["answer"]), "\n")
    return best.join(queries.select("query_id", "text"), "query_id").select(
        "query_id",
        context.alias("context"),
        F.concat(F.lit("Context:\n"), context, F.lit("\n\nQuestion: "), "text", F.lit("\nAnswer:")).alias("prompt"),
    )
