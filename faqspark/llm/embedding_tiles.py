"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

Vectors are compared inside their label, block by block. A block holds its vectors as 8-bit integers with, for each
vector, the scale and the exact norm of what the rounding lost. The integer product of two blocks, exact in 32-bit
floats, then bounds every cosine from above; only pairs whose bound reaches the threshold are computed in double
precision. Large labels are cut into cells around pivots first, and pairs of blocks that the triangle inequality
of angles keeps apart are not multiplied at all.

A tile returns link counts per vector and a spanning forest of its links, never the links themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T, Window
from pyspark.sql.functions import arrow_udf

from faqspark.llm.components import components
from faqspark.llm.store import Saved

THRESHOLD = 0.93
#: Numbers in a block's matrix, and vectors in a sub-tile's side.
BLOCK_NUMBERS, SIDE = 1 << 17, 512
#: Pivots of a label with more than ``LARGE`` blocks, and labels that get pivots at most; their product bounds the broadcast.
PIVOTS, PIVOT_LABELS, LARGE = 16, 256, 4
#: Slack for the rounding of double-precision sums.
SLACK = 1e-9


def _usable(vector: Column, label: Column) -> Column:
    """Whether a vector may be linked: label known, no null or non-finite component, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(label.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as int8 with a scale each, and the norms of the rounding errors."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None])
    return q.astype(np.int8), scale, np.linalg.norm(x - q * scale[:, None], axis=1)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows in doubles, very large and very small ones by a power of two, so that their squares stay finite and above 0."""
    x = x.astype(np.float64)
    power = np.frexp(np.abs(x).max(axis=1))[1]
    return np.ldexp(x, np.where(np.abs(power) > 400, -power, 0)[:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _placed(pivots: dict[tuple[int, int], np.ndarray]):
    """Nearest pivot and angle to it for every vector; cell 0 and angle 0 without pivots."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, dim = (batch.column(c).to_numpy() for c in ("label", "dim"))
            cell, angle = np.zeros(len(label), np.int32), np.zeros(len(label))
            for key in {k for k in zip(label.tolist(), dim.tolist()) if k in pivots}:
                at = np.flatnonzero((label == key[0]) & (dim == key[1]))
                cosine = np.clip(_unit(_matrix(batch.column("embedding").take(pa.array(at)), key[1])) @ pivots[key].T, -1, 1)
                cell[at] = cosine.argmax(axis=1)
                angle[at] = np.arccos(cosine.max(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(angle)], names=[*batch.schema.names, "cell", "angle"])

    return place


def _block(table: pa.Table) -> pa.Table:
    """One row for a group of vectors: ids, weights, the vectors, their int8 form, scales and errors."""
    table = table.sort_by("id")
    dim = table.column("dim")[0].as_py()
    x = _scaled(_matrix(table.column("embedding"), dim))
    q, scale, error = quantised(_unit(x))
    angle = table.column("angle").to_numpy()
    data = {k: [v] for k, v in {
        "label": table.column("label")[0].as_py(), "dim": dim, "cell": table.column("cell")[0].as_py(), "block": table.column("block")[0].as_py(),
        "low": float(angle.min()), "high": float(angle.max()), "ids": table.column("id").to_numpy().tobytes(),
        "weights": table.column("copies").to_numpy().tobytes(), "exact": x.tobytes(), "q": q.tobytes(), "scale": scale.tobytes(), "error": error.tobytes()}.items()}
    return pa.table(data, schema=_BLOCK_ARROW)


_BLOCK_ARROW = pa.schema([("label", pa.int32()), ("dim", pa.int32()), ("cell", pa.int32()), ("block", pa.int64()), ("low", pa.float64()), ("high", pa.float64()),
                          *((c, pa.binary()) for c in ("ids", "weights", "exact", "q", "scale", "error"))])
_BLOCK = "label int, dim int, cell int, block bigint, low double, high double, ids binary, weights binary, exact binary, q binary, scale binary, error binary"
_DATA = ("ids", "weights", "exact", "q", "scale", "error")


class _Side:
    def __init__(self, row: dict, suffix: str):
        def get(name, kind):
            return np.frombuffer(row[name + suffix], kind)

        self.ids, self.weights = get("ids", np.int64), get("weights", np.int64)
        self.exact = get("exact", np.float64).reshape(len(self.ids), -1)
        self.q = get("q", np.int8).reshape(len(self.ids), -1).astype(np.float32)
        self.scale, self.error = get("scale", np.float64), get("error", np.float64)
        self.size = self.scale * np.sqrt((self.q.astype(np.float64) ** 2).sum(axis=1))
        self.norm = np.linalg.norm(self.exact, axis=1)


def _merge(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of ``i`` and ``j`` in ``root``, where every entry points to its set's smallest member."""
    while True:
        a, b = root[i], root[j]
        if (a == b).all():
            return
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root[:] = root[root]


def linked(a: _Side, b: _Side, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Weighted link counts of both sides, and the links of a spanning forest as two id arrays."""
    counts = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
    root = np.arange(len(a.ids) + len(b.ids))
    if same:
        root[len(a.ids) :] = root[: len(a.ids)]
    for r in range(0, len(a.ids), SIDE):
        for c in range(0, len(b.ids), SIDE):
            if same and c + SIDE <= r:
                continue
            rows, cols = slice(r, r + SIDE), slice(c, c + SIDE)
            near = (a.q[rows] @ b.q[cols].T).astype(np.float64) * a.scale[rows, None] * b.scale[None, cols]
            near += a.size[rows, None] * b.error[None, cols] + a.error[rows, None] * (b.size + b.error)[None, cols]
            i, j = np.nonzero(near >= threshold - SLACK)
            i, j = i + r, j + c
            if same:
                i, j = i[i < j], j[i < j]
            cosine = np.empty(len(i))
            for k in range(0, len(i), 1 << 14):
                part = slice(k, k + (1 << 14))
                cosine[part] = np.einsum("kd,kd->k", a.exact[i[part]], b.exact[j[part]]) / (a.norm[i[part]] * b.norm[j[part]])
            i, j = i[cosine >= threshold], j[cosine >= threshold]
            np.add.at(counts[0], i, b.weights[j])
            np.add.at(counts[1], j, a.weights[i])
            _merge(root, i, j + (0 if same else len(a.ids)))
    ids = np.concatenate([a.ids, b.ids])
    member = np.flatnonzero(root != np.arange(len(root)))
    if same:
        member = member[member < len(a.ids)]
    return *counts, [ids[member], ids[root[member]]]


def _tiles(threshold: float):
    """Rows (id, links, other): link counts of vectors (other null), and links to keep components whole (links 0)."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                a, b = _Side(row, "_a"), _Side(row, "_b")
                for_a, for_b, (left, right) = linked(a, b, row["same"], threshold)
                ids = np.concatenate([a.ids[for_a > 0], b.ids[for_b > 0], left])
                links = np.concatenate([for_a[for_a > 0], for_b[for_b > 0], np.zeros(len(left), np.int64)])
                other = pa.array(np.concatenate([np.zeros(len(ids) - len(left), np.int64), right]), mask=np.arange(len(ids)) < len(ids) - len(left))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), other], names=["id", "links", "other"])

    return multiply


def _apart(pivots: dict[tuple[int, int], np.ndarray], threshold: float):
    """Whether two blocks' cells may hold vectors within the threshold's angle of each other."""
    reach = float(np.arccos(threshold)) + 1e-6

    @arrow_udf("boolean")
    def may_touch(label: pa.Array, dim: pa.Array, ca: pa.Array, cb: pa.Array, la: pa.Array, ha: pa.Array, lb: pa.Array, hb: pa.Array) -> pa.Array:
        out = []
        for l, d, p, q, a0, a1, b0, b1 in zip(*(x.to_pylist() for x in (label, dim, ca, cb, la, ha, lb, hb))):
            if (l, d) not in pivots:
                out.append(True)
                continue
            between = 0.0 if p == q else float(np.arccos(np.clip(pivots[l, d][p] @ pivots[l, d][q], -1, 1)))
            out.append(max(between - a1 - b1, a0 - between - b1, b0 - between - a1) <= reach)
        return pa.array(out, pa.bool_())

    return may_touch


def _pivots(classes: DataFrame, block_numbers: int) -> dict[tuple[int, int], np.ndarray]:
    """Unit pivots, chosen by hash, of the largest labels: at most PIVOTS * PIVOT_LABELS vectors."""
    sizes = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * F.col("dim") > LARGE * block_numbers)
    sizes = sizes.orderBy(F.desc("n"), "label", "dim").limit(PIVOT_LABELS).select("label", "dim")
    first = Window.partitionBy("label", "dim").orderBy(F.xxhash64("id"), "id")
    rows = classes.join(F.broadcast(sizes), ["label", "dim"]).withColumn("k", F.row_number().over(first)).where(F.col("k") <= PIVOTS)
    found: dict[tuple[int, int], list] = {}
    for row in rows.select("label", "dim", "embedding").collect():
        found.setdefault((row["label"], row["dim"]), []).append(row["embedding"])
    return {key: _unit(np.array(x)) for key, x in found.items()}


def near_vectors(vectors: DataFrame, *, threshold: float = THRESHOLD, block_numbers: int = BLOCK_NUMBERS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors`` (vec_id, embedding, label).

    Vectors are linked if their labels are equal and known and their cosine, in double precision, is at least
    ``threshold`` (above 0). Vectors that are null, empty, zero or hold null or non-finite components, vectors of different
    length and rows without vec_id are linked with nothing. Every row counts as a vector: copies link with each other.
    Equal vectors of a label are one class with a weight, so a hot group of copies is compared once. Components keep
    their type, floats or doubles; any other type becomes doubles.
    """
    kind = "float" if isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType) else "double"
    x = F.transform("embedding", lambda v: v.cast(kind))
    d1, d2 = F.xxhash64(F.lit(1), "embedding"), F.xxhash64("embedding", F.lit(2))
    rows = vectors.select("vec_id", F.col("label").cast("int").alias("label"), x.alias("embedding")).select(
        "vec_id", "label", "embedding", d1.alias("d1"), d2.alias("d2"), F.size("embedding").alias("dim"),
        (_usable(F.col("embedding"), F.col("label")) & F.col("vec_id").isNotNull()).alias("usable"))
    usable = rows.where("usable")
    groups = Saved(usable.groupBy("label", "dim", "d1", "d2").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")), "vector-classes").df
    named = groups.select(F.col("label").alias("l"), F.col("d1").alias("k1"), F.col("d2").alias("k2"), "id", "copies")
    match = (F.col("label") == F.col("l")) & (F.col("d1") == F.col("k1")) & (F.col("d2") == F.col("k2"))
    heads = usable.join(named, match & (F.col("vec_id") == F.col("id"))).select("id", "copies", "label", "dim", "embedding", "d1", "d2")
    classes = Saved(heads.dropDuplicates(["id", "label", "d1", "d2"]).drop("d1", "d2"), "vectors").df
    pivots = _pivots(classes, block_numbers)
    placed = Saved(classes.mapInArrow(_placed(pivots), f"id bigint, copies bigint, label int, dim int, embedding array<{kind}>, cell int, angle double"), "placed").df
    cells = placed.groupBy("label", "dim", "cell").agg(F.ceil(F.count(F.lit(1)) * F.col("dim") / block_numbers).cast("long").alias("n_blocks"))
    keyed = placed.join(cells, ["label", "dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("n_blocks")))
    blocks = Saved(keyed.select("id", "copies", "label", "dim", "embedding", "cell", "angle", "block").groupBy(
        "label", "dim", "cell", "block").applyInArrow(_block, _BLOCK), "blocks").df
    a = blocks.select("label", "dim", *(F.col(c).alias(f"{c}_a") for c in ("cell", "block", "low", "high")))
    b = blocks.select("label", "dim", *(F.col(c).alias(f"{c}_b") for c in ("cell", "block", "low", "high")))
    touch = _apart(pivots, threshold)("label", "dim", "cell_a", "cell_b", "low_a", "high_a", "low_b", "high_b")
    pairs = a.join(b, ["label", "dim"]).where("cell_a < cell_b OR cell_a = cell_b AND block_a <= block_b").where(touch).select(
        "label", "dim", "cell_a", "block_a", "cell_b", "block_b", F.expr("cell_a = cell_b AND block_a = block_b").alias("same"))
    for side in "ab":
        data = blocks.select("label", "dim", F.col("cell").alias(f"cell_{side}"), F.col("block").alias(f"block_{side}"), *(F.col(c).alias(f"{c}_{side}") for c in _DATA))
        pairs = pairs.join(data, ["label", "dim", f"cell_{side}", f"block_{side}"])
    tiles = pairs.select("same", *(f"{c}_{side}" for side in "ab" for c in _DATA))
    found = Saved(tiles.mapInArrow(_tiles(threshold), "id bigint, links bigint, other bigint"), "tile-links").df
    totals = found.where("other IS NULL").groupBy(F.col("id").alias("t")).agg(F.sum("links").alias("links"))
    reach = components(found.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b"))).withColumnRenamed("id", "c")
    known = groups.join(totals, F.col("id") == F.col("t"), "left").join(reach, F.col("id") == F.col("c"), "left").select(
        F.col("label").alias("l"), F.col("d1").alias("k1"), F.col("d2").alias("k2"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("component_id", "id").alias("component"))
    return rows.join(known, match & F.col("usable"), "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(True)).alias("kept"))
