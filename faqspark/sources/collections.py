"""Collections of index points, kept as batches of keyed rows where the latest row wins."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from faqspark.sources import versions

# Storage buckets of a batch by default; points of a bucket of a compacted store, about.
BUCKETS, BUCKET_POINTS = 16, 200_000
# Columns that partition a store, so far as the points have them; always text.
PARTITIONS = ("collection", "course_id", "course")


def collection_name(base: Column, suffix: Column) -> Column:
    return F.concat_ws("_", base, suffix)


def latest_by_key(rows: DataFrame, key: list[str], order: list[str], first: bool = False) -> DataFrame:
    """The row with the highest ``order`` per key, or the lowest; limited per map task before the exchange."""
    newest = Window.partitionBy(*key).orderBy(*[F.asc_nulls_first(c) if first else F.desc_nulls_last(c) for c in order])
    return rows.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def upsert(current: DataFrame, batch: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Insert new keys and replace whole rows of known ones."""
    both = current.withColumn("_batch", F.lit(0)).unionByName(batch.withColumn("_batch", F.lit(1)))
    return latest_by_key(both, key or ["collection", "id"], ["_batch"]).drop("_batch")


def bucket_of(point: Column, buckets: int) -> Column:
    """Storage bucket of a point id."""
    return F.pmod(F.xxhash64(point), F.lit(buckets)).cast("int")


def _laid_out(points: DataFrame, buckets: int) -> tuple[DataFrame, list[str]]:
    """``points`` by collection, course and id bucket, ordered by section inside; and the columns to partition by."""
    by = [*(c for c in PARTITIONS if c in points.columns), "bucket"]
    section = ["payload.section"] if "payload" in points.columns else []
    dealt = points.withColumn("bucket", bucket_of(F.col("id"), buckets)).hint("rebalance", *by)
    return dealt.sortWithinPartitions(*by, *section), by


def write_batch(points: DataFrame, root: str, batch: int, dim: int, buckets: int = BUCKETS) -> None:
    """Store one upsert batch, by collection, course and id bucket; the place is created if missing.

    Writing the same batch again replaces it, so a retry is harmless. Nothing already stored is
    rewritten; ``read_points`` merges batches and ``fold_points`` and ``compact`` fold them. A vector of another
    length than the collection's fails the write. Points with a payload lie ordered by section, so that row groups of other
    sections are skipped. Batches may differ in their number of buckets. A point whose ``deleted`` is true ends
    with this batch.
    """
    fits = F.when(F.size("dense") == dim, F.col("dense")).otherwise(
        F.raise_error(F.concat(F.lit("wrong vector length: "), F.size("dense").cast("string")))
    )
    if "deleted" in points.columns:
        fits = F.when(~F.col("deleted"), fits)
    rows, by = _laid_out(points.withColumn("dense", fits), buckets)
    versions.add(rows, root, batch, *by)


def delete_points(keys: DataFrame, root: str, batch: int) -> None:
    """Store a batch that ends points (collection, id); keys that are not stored do no harm."""
    known = read_points(keys.sparkSession, root, before=batch)
    asked = keys.select(F.col("collection").alias("_collection"), F.col("id").alias("_id")).distinct()
    found = known.join(asked, (F.col("collection") == F.col("_collection")) & (F.col("id") == F.col("_id")), "left_semi")
    write_batch(found.withColumn("deleted", F.lit(True)), root, batch, 0)


def replace_stored_documents(points: DataFrame, root: str, batch: int, dim: int, doc: Column | None = None) -> None:
    """Store an upsert batch that also ends the stored points of its documents which it does not bring again."""
    doc = F.col("payload.doc_id") if doc is None else doc
    known = read_points(points.sparkSession, root, before=batch)
    mine = points.select(doc.alias("_doc")).distinct()
    key = points.select(F.col("collection").alias("_collection"), F.col("id").alias("_id"))
    gone = known.withColumn("_own", doc).join(mine, F.col("_own") == F.col("_doc"), "left_semi").drop("_own").join(
        key, (F.col("collection") == F.col("_collection")) & (F.col("id") == F.col("_id")), "left_anti")
    ended = gone.select(*points.columns).withColumn("deleted", F.lit(True))
    write_batch(points.withColumn("deleted", F.lit(False)).unionByName(ended), root, batch, dim)


def _current(kept: DataFrame) -> DataFrame:
    """Rows (collection, id, batch, ...) that no later batch replaces or ends.

    Keys and batch numbers alone tell which rows are gone; leaving them out by an anti join moves no vector as long as the
    replaced keys can be broadcast.
    """
    last = kept.groupBy(F.col("collection").alias("_collection"), F.col("id").alias("_id")).agg(
        F.max("batch").alias("_last"), F.count("*").alias("_n")
    ).where("_n > 1")
    replaced = (F.col("collection") == F.col("_collection")) & (F.col("id") == F.col("_id")) & (F.col("batch") < F.col("_last"))
    current = kept.join(last, replaced, "left_anti")
    return current.where("NOT coalesce(deleted, false)").drop("deleted") if "deleted" in current.columns else current


def read_points(spark: SparkSession, root: str, single_batch: bool = False, before: int | None = None) -> DataFrame:
    """Current points, of the batches numbered under ``before`` if it is given. After a fold, or with a single batch, keys are
    unique already and nothing is grouped."""
    kept = versions.read(spark, root, before, text=PARTITIONS)
    if kept is None:
        raise FileNotFoundError(f"no points at {root}")
    folded = versions.state(spark, root, before)[1] == []
    return (kept if single_batch or folded else _current(kept)).drop("batch")


def fold_points(spark: SparkSession, root: str, grown: float = versions.GROWN) -> bool:
    """Fold the batches into the store once they have grown to a share of it, in as many buckets as its points need."""
    def merged(rows: DataFrame) -> DataFrame:
        current = _current(rows)
        return _laid_out(current, max(1, ceil(current.count() / BUCKET_POINTS)))[0]

    by = [c for c in PARTITIONS if c in versions.read(spark, root, text=PARTITIONS).columns]
    return versions.fold(spark, root, merged, *by, "bucket", grown=grown, text=PARTITIONS)


def compact(spark: SparkSession, root: str, target: str, dim: int) -> None:
    """Fold all batches into one at a new place, in as many buckets as its points need."""
    points = read_points(spark, root)
    write_batch(points, target, 0, dim, max(1, ceil(points.count() / BUCKET_POINTS)))


def replace_documents(current: DataFrame, batch: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Variant of upsert that also drops points of re-indexed documents that no longer exist."""
    return current.join(batch.select(doc).distinct(), doc, "left_anti").unionByName(batch)


def collection_info(points: DataFrame, requested: DataFrame, dim: int) -> DataFrame:
    """Status, size and vector shape per requested collection; unknown ones are ``missing``."""
    stats = points.groupBy("collection").agg(
        F.count("*").alias("points_count"),
        F.min(F.size("dense")).alias("min_dim"),
        F.max(F.size("dense")).alias("max_dim"),
        F.avg(F.size("sparse.indices")).alias("avg_terms"),
    )
    status = (
        F.when(F.col("points_count").isNull(), "missing")
        .when((F.col("min_dim") == dim) & (F.col("max_dim") == dim), "green")
        .otherwise("dimension mismatch")
    )
    return requested.join(stats, "collection", "left").select(
        "collection",
        status.alias("status"),
        F.coalesce("points_count", F.lit(0)).alias("points_count"),
        F.coalesce("max_dim", F.lit(0)).alias("dense_dim"),
        F.coalesce("avg_terms", F.lit(0.0)).alias("avg_terms"),
    )


def merge_replies(old: DataFrame, new: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """Replies (key, ts, text, event_ts, fetched_at, first_seen) after a batch, and the keys it touched.

    A reply is kept once per ``key`` and ``ts``: its latest fetch, and when it was first seen. A batch may hold only
    part of a conversation, or rows that are known already; replaying one changes nothing.
    """
    both = old.unionByName(new.withColumn("first_seen", F.col("fetched_at")))
    seen = both.groupBy(*key, "ts").agg(F.min("first_seen").alias("first_seen"))
    latest = latest_by_key(both.drop("first_seen"), [*key, "ts"], ["fetched_at", "text"])
    return latest.join(seen, [*key, "ts"]).select(*old.columns), new.select(*key).distinct()
