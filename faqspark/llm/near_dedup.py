"""Near-duplicate documents by banded minimum hashes, in place of an LSH forest.

A level has a number of bands, each one hash of exactly ``depth`` minimum hashes; nothing is sorted and no
prefix is compared, so that documents are exchanged by equal keys only. Documents that agree on a band
form a region, and the members of a region are candidates. Depth and number of bands go together,
so that two documents of similarity 0.75 miss each other in all orders with a chance below 1e-5.

Where a region stays crowded with texts that are not linked, its documents go on to a deeper and wider
level (``LEVELS``) of fresh bands, which tells unrelated texts apart and keeps that chance; in the last one nothing is
handed on. Inside a region every member is compared with the smallest one first. Members that are in
the region's largest component need no further comparison with each other; each of the others is
compared with every member of another component. So a region costs about its size, however many
copies it holds, and no link that joins two components is left out.

All links are confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from faqspark.llm.components import components
from faqspark.llm.store import Saved, free_name, release
from faqspark.llm.words import Words, mix, shingles, slices

WIDTH, PERCENT = 5, 75
#: (depth, orders) of the forests; a pair of similarity s shares a region with chance 1 - (1 - s ** depth) ** orders.
LEVELS = ((4, 32), (8, 128), (12, 448))
#: Members outside a region's largest component up to which it is compared here and not deeper.
CROWD = 2048
#: Rows and shingles of one side that a task compares at a time, about.
PART_ROWS, PART_ITEMS = 2048, 1 << 20

SKETCH = "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, regions array<bigint>"
_BLOCK = 4096


def _factors(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minimum_hashes(items: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Smallest value of each hash function over ``items``."""
    lowest = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), _BLOCK):
        np.minimum(lowest, (factors[:, None] * items[None, at : at + _BLOCK]).min(axis=1), out=lowest)
    return lowest


def _sketcher(depth: int, orders: int):
    """Set digest and region codes of texts, on Arrow batches (doc_id, text)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _factors(depth * orders, depth)
        place = _factors(depth, 1)
        order = np.arange(1, orders + 1, dtype=np.uint64) + np.uint64(depth << 32)
        for batch in slices(batches):
            n, d1, d2, regions, offsets = [], [], [], [], [0]
            for items in shingles(Words(batch.column("text")), WIDTH):
                n.append(len(items))
                d1.append(items.sum(dtype=np.uint64) if len(items) else 0)
                d2.append(mix(items ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64) if len(items) else 0)
                if len(items):
                    lowest = mix(minimum_hashes(items, factors).reshape(orders, depth) >> np.uint64(8))
                    regions.append(mix(mix(order) + (lowest * place).sum(axis=1, dtype=np.uint64)))
                offsets.append(offsets[-1] + (orders if len(items) else 0))
            flat = np.concatenate(regions) if regions else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(np.array(d1, np.uint64).view(np.int64)),
                 pa.array(np.array(d2, np.uint64).view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view(np.int64)))],
                names=["doc_id", "n_shingles", "d1", "d2", "regions"])

    return sketch


def sketches(docs: DataFrame, depth: int, orders: int) -> DataFrame:
    """Per document its set's size and digest, and one region code for each order; none for an empty set."""
    return docs.select("doc_id", "text").mapInArrow(_sketcher(depth, orders), SKETCH)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sets = [items.tobytes() for items in shingles(Words(batch.column("text")), WIDTH)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], names=["id", "items"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, left, right = (batch.column(c) for c in ("a", "b", "items_a", "items_b"))
        keep = []
        for x, y in zip(left, right):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
            if len(x) > len(y):
                x, y = y, x
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            common = int((y[at] == x).sum())
            keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], names=["a", "b"])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("items_b"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "items_a", "items_b").mapInArrow(_confirm, "a bigint, b bigint")


def _plausible(a: str, b: str):
    """Set sizes that allow the similarity."""
    return (F.col(a) * 100 >= F.col(b) * PERCENT) & (F.col(b) * 100 >= F.col(a) * PERCENT)


def _entries(sketched: DataFrame) -> DataFrame:
    return sketched.select(F.explode("regions").alias("region"), F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"))


def _members(entries: DataFrame) -> DataFrame:
    """Rows (region, id, n, leader) of the regions with at least two documents; the leader is the smallest."""
    shared = entries.groupBy("region").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("leader"))
    return entries.join(shared.where("size > 1").select("region", "leader"), "region")


def _stars(members: DataFrame) -> DataFrame:
    """Pairs of every member with its region's leader."""
    first = members.where("id = leader").select("region", F.col("n").alias("leader_n"))
    rest = members.where("id != leader").join(first, "region").where(_plausible("n", "leader_n"))
    return rest.select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()


def _labelled(members: DataFrame, known: DataFrame) -> DataFrame:
    """Members with the component ``c`` that the links so far give them."""
    found = known.select(F.col("id").alias("k"), F.col("component_id").alias("c"))
    return members.join(found, F.col("id") == F.col("k"), "left").select("region", "id", "n", F.coalesce("c", "id").alias("c"))


def _parted(members: DataFrame) -> DataFrame:
    """(region, main, others, m_parts, x_parts) of regions that hold several components and more than two members.

    Of two members, one is the leader, which the other has been compared with. ``main`` is the component with most
    members there, ``others`` counts the members outside of it. So many parts keep what a task loads of the
    members, and of the others, within bounds.
    """
    sizes = members.groupBy("region", "c").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("items"))
    best = sizes.groupBy("region").agg(
        F.max(F.struct("size", "c", "items")).alias("best"), F.sum("size").alias("total"), F.sum("items").alias("items"), F.count(F.lit(1)).alias("parts"))
    others, other_items = F.col("total") - F.col("best.size"), F.col("items") - F.col("best.items")

    def parts(rows, items):
        return F.greatest(F.ceil(rows / PART_ROWS), F.ceil(items / PART_ITEMS)).cast("int")

    return best.where("parts > 1 AND total > 2").select(
        "region", F.col("best.c").alias("main"), others.alias("others"), parts(F.col("total"), F.col("items")).alias("m_parts"), parts(others, other_items).alias("x_parts"))


def _joined_components(c_x: np.ndarray, c_m: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest of components that are linked pairwise."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    forest = []
    for x, m in set(zip(c_x.tolist(), c_m.tolist())):
        a, b = find(x), find(m)
        if a != b:
            root[max(a, b)] = min(a, b)
            forest.append((x, m))
    return forest


def _cross(others: pa.Table, members: pa.Table) -> pa.Table:
    """Components (a, b) joined by a similar pair of one of ``others`` and one of ``members``; full sets are compared."""
    found: list[tuple[int, int]] = []
    if others.num_rows and members.num_rows:
        x_sets, m_sets = ([np.frombuffer(v.as_buffer(), np.uint64) for v in t.column("items")] for t in (others, members))
        x_c, m_c = (t.column("c").to_numpy() for t in (others, members))
        x_n, m_n = (np.array([len(v) for v in sets]) for sets in (x_sets, m_sets))
        values, owner = np.concatenate(x_sets), np.repeat(np.arange(len(x_sets)), x_n)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        at = 0
        while at < len(m_sets):
            last, pending = at, []
            while last < len(m_sets) and (last == at or sum(len(p) for p, _ in pending) < (1 << 21)):
                low = np.searchsorted(values, m_sets[last], "left")
                run = np.searchsorted(values, m_sets[last], "right") - low
                hits = owner[np.repeat(low - (np.cumsum(run) - run), run) + np.arange(run.sum())]
                pending.append((hits, last))
                last += 1
            common = np.stack([np.bincount(hits, minlength=len(x_sets)) for hits, _ in pending])
            union = x_n[None, :] + m_n[at:last, None] - common
            m, x = np.nonzero((100 * common >= PERCENT * union) & (m_c[at:last, None] != x_c[None, :]))
            found += _joined_components(x_c[x], m_c[at + m])
            at = last
        found = _joined_components(*np.array(found, np.int64).reshape(-1, 2).T)
    a, b = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _rest(members: DataFrame, parted: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components, from every member outside its region's main component and the members of other components."""
    inside = members.join(parted, "region").join(sets.withColumnRenamed("id", "k"), F.col("id") == F.col("k"))
    zero, m_at, x_at = F.lit(0), F.pmod(F.hash("id"), "m_parts"), F.pmod(F.hash("id"), "x_parts")
    outer = inside.where("c != main").select("region", "c", "items", x_at.alias("x_part"), F.explode(F.sequence(zero, F.col("m_parts") - 1)).alias("m_part"))
    every = inside.select("region", "c", "items", m_at.alias("m_part"), F.explode(F.sequence(zero, F.col("x_parts") - 1)).alias("x_part"))
    sides = [side.toDF(*(f"{c}_" for c in side.columns)).toDF(*side.columns).groupBy("region", "m_part", "x_part") for side in (outer, every)]
    return sides[0].cogroup(sides[1]).applyInArrow(_cross, "a bigint, b bigint")


def _compared(texts: DataFrame, entries: DataFrame, known: DataFrame | None, last: bool) -> tuple[DataFrame, DataFrame | None]:
    """Components (id, component_id) after one forest, and the ids of crowded regions, which the next one takes."""
    members = Saved(_members(entries), "forest-members")
    ids = members.df.select("id").distinct()
    sets = Saved(texts.join(ids, F.col("doc_id") == F.col("id"), "left_semi").mapInArrow(_sets, "id bigint, items binary"), "forest-sets")
    links = confirmed(_stars(members.df), sets.df)
    if known is not None:
        links = links.union(known.select("component_id", "id"))
    first = components(links)
    labelled = Saved(_labelled(members.df, first), "forest-labels").df
    members.drop()
    parted = Saved(_parted(labelled), "forest-parted").df
    release(texts.sparkSession)
    here, beyond = (parted, parted.where("false")) if last else (parted.where(F.col("others") <= CROWD), parted.where(F.col("others") > CROWD))
    second = components(_rest(labelled, here, sets.df))
    higher = second.select(F.col("id").alias("k"), F.col("component_id").alias("up"))
    both = first.join(higher, F.col("component_id") == F.col("k"), "left").select("id", F.coalesce("up", "component_id").alias("component_id"))
    merged = Saved(both.union(second).groupBy("id").agg(F.min("component_id").alias("component_id")), "forest-components").df
    sets.drop()
    if last or not beyond.limit(1).count():
        return merged, None
    return merged, labelled.join(beyond, "region", "left_semi").select("id").distinct()


def similar_components(texts: DataFrame, heads: DataFrame) -> DataFrame:
    """(id, component_id) of the sets that are similar to another one.

    ``heads``: sketches of the first forest, one per distinct set; ``texts``: (doc_id, text), those and others.
    """
    known, crowded = _compared(texts, _entries(heads), None, len(LEVELS) == 1)
    for depth, orders in LEVELS[1:]:
        if crowded is None:
            break
        wanted = texts.join(crowded, F.col("doc_id") == F.col("id"), "left_semi")
        known, crowded = _compared(texts, _entries(sketches(wanted, depth, orders)), known, (depth, orders) == LEVELS[-1])
    return known


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of ``docs`` (doc_id, text, ...).

    Words are folded A-Z; a set holds the distinct runs of five words, or the whole sequence of a shorter
    text. Null and empty texts have empty sets and are linked with nothing. Equal sets are one class,
    whose smallest id stands for it, so a hot group of copies is compared once. Repeated rows get equal
    results; rows that share a doc_id but not a text each get the component of their own text. Rows without
    doc_id are linked with nothing, have no component and are kept. An empty table gives an empty result.
    """
    rows = Saved(sketches(docs, *LEVELS[0]), "sketches").df
    known = rows.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = Saved(known.groupBy("d1", "d2").agg(F.min("doc_id").alias("first")), "classes").df
    own = classes.select(F.col("first").alias("k"), F.col("d1").alias("k1"), F.col("d2").alias("k2"))
    heads = known.join(own, (F.col("doc_id") == F.col("k")) & (F.col("d1") == F.col("k1")) & (F.col("d2") == F.col("k2")), "left_semi")
    similar = similar_components(docs.where("doc_id IS NOT NULL").select("doc_id", "text"), heads.dropDuplicates(["doc_id", "d1", "d2"]))
    found = similar.select(F.col("id").alias("k"), "component_id")
    named = classes.join(found, F.col("first") == F.col("k"), "left").select(
        F.col("d1").alias("k1"), F.col("d2").alias("k2"), F.coalesce("component_id", "first").alias("component"))
    matched = (F.col("d1") == F.col("k1")) & (F.col("d2") == F.col("k2")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", "d1", "d2").join(named, matched, "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, that of the smallest doc_id; all columns stay, whatever their names.

    Rows with the same doc_id count as one document, of which the row with the smallest text stays (null first); rows
    without doc_id all stay. Texts of other rows are not exchanged.
    """
    gone, many, place = (free_name(docs, base) for base in ("gone", "many", "place"))
    dropped = near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias(gone)).distinct()
    known = docs.where("doc_id IS NOT NULL").join(dropped, F.col("doc_id") == F.col(gone), "left_anti")
    repeated = docs.groupBy(F.col("doc_id").alias(many)).count().where("count > 1").select(many)
    same = F.col("doc_id") == F.col(many)
    order = Window.partitionBy("doc_id").orderBy("text", *(c for c, kind in docs.dtypes if c != "text" and not kind.startswith(("map", "variant"))))
    first = known.join(repeated, same, "left_semi").withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place)
    return known.join(repeated, same, "left_anti").unionByName(first).unionByName(docs.where("doc_id IS NULL"))
