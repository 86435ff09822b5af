"""One query per operator, over the whole test tables.

Timestamps leave as text and lists as joined text, so that both engines print them alike.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from faqspark import fixtures as fx
from faqspark.functions import verdicts as V
from faqspark.functions.privacy import scrub_pii, strip_file_urls, user_hash
from faqspark.functions.text import embed_text, flatten_paragraph, token_codes
from faqspark.functions.times import event_time, stamp
from faqspark.functions.vectors import dense_vector
from faqspark.operators import calibration, canonical, cells, classify, embedding, faq_documents, ingest, languages, retrieval, threads
from faqspark.operators.semantic import semantic_groups
from faqspark.plans.faq_index import index_documents
from faqspark.plans.faq_items import build_faq_items, question_heads
from faqspark.runtime import prepare, scratch_path, stored
from faqspark.schemas import RAW_MESSAGE
from faqspark.sources import collections as store
from faqspark.sources import documents as docs
from faqspark.sources import messages as msgs
from faqspark.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
RUN_AT = "2024-08-16T02:00:00Z"
AS_OF = "2024-08-13T06:00:00Z"


def query(fn: Query, name: str | None = None) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[name or fn.__name__] = run
    return run


def query_named(name: str) -> Callable[[Query], Query]:
    """For queries named like a function they use."""
    return lambda fn: query(fn, name)


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.enrich_messages(fx.messages(spark, sf), fx.courses(spark))


def _stored(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.enrich_messages(ingest.dedupe_messages(fx.messages(spark, sf)), fx.courses(spark))


def _masked(spark: SparkSession, sf: str) -> DataFrame:
    return _stored(spark, sf).withColumn("text", scrub_pii(F.col("text")))


def _heads(spark: SparkSession, sf: str) -> DataFrame:
    return threads.with_thread(_stored(spark, sf)).where("is_head")


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    known = faq_documents.attach_course(fx.styled_documents(spark, sf), fx.faq_courses(spark))
    return faq_documents.faq_chunks(known)


def _index(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return index_documents(spark, fx.styled_documents(spark, sf), fx.faq_courses(spark))


def _corpus(spark: SparkSession, sf: str) -> DataFrame:
    """All texts with both vectors, embedded once and stored."""
    return stored(embedding.with_vectors(fx.corpus(spark, sf)).drop("text"), "corpus")


def _questions(spark: SparkSession, sf: str) -> DataFrame:
    """Every benchmark passage as a search query."""
    asked = fx.table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), "text")
    return embedding.with_vectors(asked)


def _hits(hits: DataFrame) -> DataFrame:
    return hits.select("query_id", "rank", "id", "score", "payload.course", "payload.section", "payload.question")


# --- sources and sinks ---------------------------------------------------------------------


def _write_raw(kept: DataFrame, root: str, record: Callable[[Column], Column] = lambda line: line) -> None:
    """Course 0 as an array on one line, course 1 as arrays over many lines, the others as JSON lines below a plain course directory."""
    line, lines = (F.to_json(F.struct(*RAW_MESSAGE.names), options) for options in ({}, {"pretty": "true"}))
    for course, text, glue in (("course-0", line, ","), ("course-1", lines, ",\n")):
        page = F.substring("ts", 1, 6)
        pages = kept.where(F.col("course_id") == course).groupBy(*ingest.DAY, page.alias("page")).agg(
            F.concat(F.lit("["), F.array_join(F.collect_list(record(text)), glue), F.lit("]")).alias("value"))
        pages.drop("page").write.option("maxRecordsPerFile", 1).mode("append").partitionBy(*ingest.DAY).text(root)
    for course in ("course-2", "course-3", "course-4"):
        kept.where(F.col("course_id") == course).select(*ingest.DAY[1:], record(line).alias("value")).write.partitionBy(
            *ingest.DAY[1:]).text(f"{root}/{course}")


@query
def scan_messages(spark, sf):
    root = scratch_path(spark, "raw")
    _write_raw(stored(_stored(spark, sf), "messages"), root)
    return msgs.read_raw_exports(spark, root).select(
        "course_id", "channel_id", "ts", "thread_ts", "user_id", "role", "text", "fetched_at"
    )


@query
def broken_exports(spark, sf):
    """One user's records are cut short, in arrays as in lines: each costs itself only."""
    root = scratch_path(spark, "raw")
    _write_raw(stored(_stored(spark, sf), "messages"), root, lambda line: F.when(
        F.col("user_id") == "U0007", F.concat(F.lit('{"ts": "'), "ts", F.lit('"'))).otherwise(line))
    good = msgs.read_raw_exports(spark, root).select("course_id", "channel_id", "ts", F.lit(None).cast("string").alias("line"), F.lit("read").alias("reason"))
    return good.unionByName(msgs.rejected_raw_exports(spark, root), allowMissingColumns=True)


@query
def scan_window(spark, sf):
    root = scratch_path(spark, "messages")
    msgs.write_messages(_stored(spark, sf), root)
    days = msgs.read_window(spark, root, AS_OF, days=1).withColumn("span", F.lit("day"))
    hours = msgs.read_window(spark, root, AS_OF, hours=6).withColumn("span", F.lit("hours"))
    return days.unionByName(hours).select("span", "course_id", "year", "month", "day", "channel_id", "ts")


@query
def roundtrip_partitions(spark, sf):
    root = scratch_path(spark, "messages")
    msgs.write_messages(_stored(spark, sf), root)
    return msgs.read_messages(spark, root).select(
        "course_id", "year", "month", "day", "channel_id", "ts", "thread_ts", "user_id", "text"
    )


@query
def merge_days(spark, sf):
    """The second fetch brings part of each day again; the rest of the day must survive."""
    root = scratch_path(spark, "messages")
    enriched = _enriched(spark, sf)
    for fetched_at in (fx.FIRST_FETCH, fx.SECOND_FETCH):
        msgs.merge_days(enriched.where(F.col("fetched_at") == fetched_at), root)
    return msgs.read_messages(spark, root).select(*ingest.DAY, "channel_id", "ts", "fetched_at", "text")


@query
def partition_manifest(spark, sf):
    """Digests of what was stored, not of what was about to be."""
    root = scratch_path(spark, "messages")
    msgs.write_messages(_stored(spark, sf), root)
    return ingest.partition_manifest(msgs.read_messages(spark, root))


@query
def faq_jsonl_roundtrip(spark, sf):
    root = scratch_path(spark, "chunks")
    chunks = _chunks(spark, sf).withColumn("doc_id", F.col("doc_id").cast("string"))
    docs.write_chunks(chunks, root)
    return docs.read_chunks(spark, root)


@query
def doc_blocks(spark, sf):
    return docs.document_blocks(docs.parse_documents(fx.document_json(spark, sf))).select(
        "doc_id", "pos", "style", "text"
    )


@query
def upsert_points(spark, sf):
    """Two stored batches: all chunks, then new versions of two courses and one new point per chunk."""
    root = scratch_path(spark, "points")
    vector = F.array(F.length("question").cast("float"), F.lit(1.0).cast("float"))
    first = stored(faq_documents.last_per_id(faq_documents.with_point_id(_chunks(spark, sf))).select(
        "collection", "id", "question", F.lit(1).alias("version"), vector.alias("dense")
    ), "first-points")
    again = first.where("collection IN ('faq_c1', 'faq_c3')").withColumn("version", F.lit(2))
    added = first.withColumns({"id": F.concat(F.lit("new_"), "id"), "version": F.lit(2)})
    store.write_batch(first, root, 0, 2)
    store.write_batch(again.unionByName(added), root, 1, 2)
    return store.read_points(spark, root).select("collection", "id", "question", "version")


@query
def collection_info(spark, sf):
    requested = spark.sql(
        "SELECT * FROM VALUES ('faq_c0'), ('faq_c1'), ('faq_c2'), ('faq_c3'), ('faq_c9') AS t(collection)"
    )
    root, folded = scratch_path(spark, "points"), scratch_path(spark, "points")
    points = _corpus(spark, sf)
    store.write_batch(points, root, 0, 64)
    store.write_batch(points.where("collection = 'faq_c2'"), root, 1, 64)
    store.compact(spark, root, folded, 64)
    info = store.collection_info(store.read_points(spark, folded, single_batch=True), requested, 64)
    return info.withColumn("avg_terms", F.round("avg_terms", 6))


@query
def quarantine(spark, sf):
    """One course is not configured, so its messages are set aside too."""
    configured = fx.courses(spark).where("course_id != 'course-4'")
    return ingest.quarantine(fx.messages(spark, sf), configured).select(
        "course_id", "channel_id", "ts", "thread_ts", "user_id", "reason"
    )


@query
def unreadable_lines(spark, sf):
    """JSON lines of which one user's are cut short: they are kept apart as text, all others go on."""
    root = scratch_path(spark, "lines")
    source = fx.messages(spark, sf)
    line = F.to_json(F.struct(*RAW_MESSAGE.names))
    source.select(F.when(F.col("user_id") == "U0007", F.substring(line, 1, 12)).otherwise(line).alias("value")).write.text(root)
    good, bad = msgs.read_permissive(spark, root)
    return good.select("channel_id", "ts", "fetched_at", F.lit(None).cast("string").alias("line"), F.lit("read").alias("reason")).unionByName(
        bad, allowMissingColumns=True
    )


@query
def replace_documents(spark, sf):
    """A quarter of the stored documents is cut anew and keeps its first chunk only; the others stay."""
    root = scratch_path(spark, "points")
    points = stored(_chunks(spark, sf).select(
        F.lit("faq").alias("collection"), F.concat_ws(":", "doc_id", "chunk_no").alias("id"), "doc_id", "chunk_no", "question",
        F.array(F.lit(1.0).cast("float")).alias("dense")), "chunks")
    store.write_batch(points, root, 0, 1)
    first = points.groupBy("doc_id").agg(F.min("chunk_no").alias("chunk_no"))
    batch = points.where("doc_id % 4 = 1").join(first, ["doc_id", "chunk_no"], "left_semi").select(*points.columns)
    store.replace_stored_documents(batch, root, 1, 1, F.col("doc_id"))
    store.fold_points(spark, root, grown=0.0)
    return store.read_points(spark, root).select("doc_id", "chunk_no", "question")


# --- projections and filters ---------------------------------------------------------------


@query
def parse_event_time(spark, sf):
    return fx.messages(spark, sf).select(
        "channel_id", "ts", "fetched_at", "user_id",
        stamp(event_time(F.col("ts"))).alias("event_time"),
        stamp(event_time(F.col("fetched_at"))).alias("fetch_time"),
    )


@query
def ymd_parts(spark, sf):
    return ingest.parse_messages(fx.messages(spark, sf)).select(
        "channel_id", "ts", "fetched_at", "user_id", "year", "month", "day"
    )


@query
def enrich_messages(spark, sf):
    run = ingest.enrich_messages(fx.messages(spark, sf), fx.courses(spark), RUN_AT)
    return run.select(
        "course_id", "channel_id", "fetched_at", "ts", "thread_ts", "user_id", "role", "text",
        "year", "month", "day",
    )


@query
def window_filter(spark, sf):
    return _stored(spark, sf).where(ingest.in_window(F.col("event_ts"), AS_OF, 24)).select(
        "course_id", "channel_id", "ts"
    )


@query
def select_courses(spark, sf):
    """Documents of the usable courses, and of one selected course."""
    tagged = fx.styled_documents(spark, sf).select("doc_id", "google_doc_id")
    usable = faq_documents.selected_courses(fx.faq_courses(spark)).select("google_doc_id", "course_id")
    one = faq_documents.selected_courses(fx.faq_courses(spark), "course-2").select(
        "google_doc_id", F.lit(1).alias("selected")
    )
    return tagged.join(usable, "google_doc_id").join(one, "google_doc_id", "left").select(
        "doc_id", "course_id", F.coalesce("selected", F.lit(0)).alias("selected")
    )


@query
def hybrid_by_course(spark, sf):
    points, stats = _index(spark, sf)
    return _hits(retrieval.search(points, _questions(spark, sf), course="Course 1", stats=stats))


@query
def hybrid_by_section(spark, sf):
    """Search inside the section with most chunks; without any section there are no hits."""
    points, stats = _index(spark, sf)
    biggest = (
        points.where("payload.section != ''").groupBy(F.col("payload.section").alias("section"))
        .count().orderBy(F.desc("count"), "section").limit(1).select("section")
    )
    inside = points.join(biggest, F.col("payload.section") == F.col("section"), "left_semi")
    return _hits(retrieval.search(inside, _questions(spark, sf), stats=stats))


@query
def format_hits(spark, sf):
    points, stats = _index(spark, sf)
    return retrieval.format_hits(retrieval.search(points, _questions(spark, sf), limit=5, stats=stats))


# --- joins ---------------------------------------------------------------------------------


@query
def course_channel_join(spark, sf):
    return ingest.with_course(fx.messages(spark, sf), fx.courses(spark)).select(
        "course_id", "channel_id", "ts", "user_id", "fetched_at"
    )


@query
def chunk_metadata_join(spark, sf):
    return _chunks(spark, sf).select("doc_id", "chunk_no", "course_id", "course_name", "collection")


@query
def thread_messages(spark, sf):
    return threads.thread_messages(_stored(spark, sf)).select(
        "course_id", "channel_id", "thread_key", "place", "ts", "user_id", "text"
    )


@query
def same_day_replies(spark, sf):
    threaded = threads.with_thread(stored(_stored(spark, sf), "messages"))
    heads = threaded.where("is_head").select(*threads.THREAD, "event_ts")
    replies = threaded.where("NOT is_head")
    return threads.attach_replies(heads, replies, keep_unanswered=True).select(
        *threads.THREAD, "reply_ts", "reply_role"
    )


@query
def question_threads(spark, sf):
    kept = stored(_stored(spark, sf), "messages")
    heads = threads.with_thread(kept).where("is_head")
    asked = question_heads(kept).select(*threads.THREAD, "verdict.is_question")
    return threads.question_threads(heads, asked).select(*threads.THREAD, "ts", "user_id")


@query
def memoized_verdicts(spark, sf):
    documents = fx.documents(spark, sf).select("doc_id", scrub_pii(F.col("text")).alias("text"))
    scored = classify.memoized(documents, "text", classify.classify)
    return scored.select(
        "doc_id", "text_key", "verdict.is_question", "verdict.question_type", "verdict.confidence", "verdict.title"
    )


@query
def stale_embeddings(spark, sf):
    """Vectors of a third of the labels are current, another third old, the rest unversioned."""
    vectors = fx.vectors(spark, sf).select("id", "label")
    points = vectors.select(
        "id",
        F.when(F.col("label") % 3 == 0, "v1").when(F.col("label") % 3 == 1, "v0").alias("embed_version"),
    )
    current = vectors.select("id", F.lit("v1").alias("embed_version"))
    return embedding.stale_points(points, current)


def _golden(spark: SparkSession, sf: str) -> DataFrame:
    labels = fx.table(spark, sf, "labels").select("doc_id", (F.col("quality") == 1).alias("labelled"))
    golden = fx.documents(spark, sf).join(labels, "doc_id").select("labelled", scrub_pii(F.col("text")).alias("text"))
    return classify.classify(golden).select(
        F.col("verdict.is_question").alias("predicted"), F.col("verdict.confidence").alias("confidence"), "labelled")


@query
def golden_eval(spark, sf):
    scored = _golden(spark, sf)
    out = classify.golden_eval(scored)
    return out.select(
        "n", "tp", "fp", "fn", "tn", *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall")]
    )


@query
def confidence_map(spark, sf):
    """How often verdicts of each confidence are right, as a rising function."""
    table = calibration.calibration(_golden(spark, sf))
    return table.select("confidence", "n", *[F.round(c, 6).alias(c) for c in ("rate", "calibrated")])


# --- aggregations --------------------------------------------------------------------------


@query
def course_day_groups(spark, sf):
    return ingest.course_day_pages(_stored(spark, sf), page=20).select(
        *ingest.DAY, "page", "n",
        F.array_join(F.transform("messages", lambda m: F.concat_ws("|", m["channel_id"], m["ts"], m["user_id"])), ",")
        .alias("messages"),
    )


@query
def ingest_counters(spark, sf):
    return ingest.ingest_counters(fx.messages(spark, sf), fx.courses(spark))


@query
def faq_counts(spark, sf):
    return faq_documents.chunk_counts(_chunks(spark, sf))


def _compacted(packed: DataFrame) -> DataFrame:
    return packed.select(*threads.THREAD, "part", "reply_count", "answer_compact")


@query
def compact_threads(spark, sf):
    return _compacted(threads.compact_threads(stored(_masked(spark, sf), "messages"), page=2))


@query
def preferred_answer(spark, sf):
    return threads.preferred_answers(stored(_masked(spark, sf), "messages")).select(*threads.THREAD, "part", "answer")


@query
def verdict_metrics(spark, sf):
    """All messages; the calls for one user's messages failed, another's succeeded at the second try."""
    scored = classify.classify(_masked(spark, sf), "text", "role")
    answered = scored.withColumn("verdict", F.when(F.col("user_id") != "U0007", F.col("verdict")))
    tries = F.when(F.col("user_id") == "U0007", 4).when(F.col("user_id") == "U0008", 2).otherwise(1)
    metrics = classify.verdict_metrics(classify.normalize(answered.withColumn("tries", tries)), attempts="tries")
    return metrics.withColumn("avg_confidence", F.round("avg_confidence", 6))


# --- windows -------------------------------------------------------------------------------


@query
def faq_chunks(spark, sf):
    return faq_documents.faq_chunks(fx.styled_documents(spark, sf)).select(
        "doc_id", "chunk_no", "section", "question", "answer"
    )


@query
def dedupe_messages(spark, sf):
    return ingest.dedupe_messages(fx.messages(spark, sf)).select("channel_id", "ts", "fetched_at", "text")


@query
def dedupe_by_digest(spark, sf):
    return canonical.exact_text_copies(fx.table(spark, sf, "documents"), "doc_id", "text")


@query
def thread_heads(spark, sf):
    return threads.with_thread(_stored(spark, sf)).select("course_id", "channel_id", "ts", "thread_key", "is_head")


@query
def infer_batches(spark, sf):
    return ingest.infer_batches(_stored(spark, sf)).select("course_id", "channel_id", "ts", "batch", "place")


# --- retrieval -----------------------------------------------------------------------------


def _vectors(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """All vectors, and the mean vector of each label as a query."""
    vectors = fx.table(spark, sf, "embeddings")
    means = (
        vectors.select("label", F.posexplode("embedding").alias("pos", "x"))
        .groupBy("label", "pos").agg(F.avg("x").alias("x"))
    )
    queries = means.groupBy(F.col("label").cast("string").alias("query_id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"]).alias("dense")
    )
    return vectors.select(F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("dense")), queries


@query
def dense_topk(spark, sf):
    """Vectors nearest to the mean vector of each label."""
    points, queries = _vectors(spark, sf)
    return retrieval.top_k(points, queries, "dense", 20)


@query
def dense_topk_cells(spark, sf):
    """The same hits from a store of cells, of which only those are opened that bounds cannot rule out."""
    points, queries = _vectors(spark, sf)
    root = scratch_path(spark, "cells")
    cells.write_cells(points, root)
    return cells.cell_top_k(spark, root, queries, 20)[0]


@query
def sparse_topk(spark, sf):
    return retrieval.top_k(_corpus(spark, sf), _questions(spark, sf), "sparse", 20)


@query
def hybrid_search(spark, sf):
    points, stats = _index(spark, sf)
    return _hits(retrieval.hybrid_search(points, _questions(spark, sf), stats=stats))


@query
def preview_hits(spark, sf):
    """Short form of the two best hits."""
    points, stats = _index(spark, sf)
    hits = retrieval.search(points, _questions(spark, sf), limit=2, stats=stats)
    return retrieval.format_hits(hits, digits=3, question_chars=60).drop("answer")


@query
def batch_hybrid(spark, sf):
    """Every query in every collection, two hits each; an unknown collection gives none."""
    points, stats = _index(spark, sf)
    points = points.withColumnRenamed("collection", "scope")
    names = F.array(*[F.lit(f"faq_c{i}") for i in (0, 1, 2, 3, 9)])
    queries = _questions(spark, sf).withColumn("scope", F.explode(names))
    queries = queries.withColumn("query_id", F.concat_ws("|", "scope", "query_id"))
    return _hits(retrieval.hybrid_search(points, queries, limit=2, stats=stats))


@query
def top_titles(spark, sf):
    return classify.top_titles(classify.classify(_masked(spark, sf), "text", "role"), 10)


@query
def rag_context(spark, sf):
    queries = _questions(spark, sf)
    points, stats = _index(spark, sf)
    return retrieval.rag_context(retrieval.hybrid_search(points, queries, limit=3, stats=stats), queries)


# --- scalar functions ----------------------------------------------------------------------


@query
def flatten_paragraphs(spark, sf):
    content = F.posexplode("body.content").alias("pos", "el")
    return fx.styled_documents(spark, sf).select("doc_id", content).select(
        "doc_id", "pos", flatten_paragraph(F.col("el.paragraph.elements")).alias("text")
    )


@query_named("embed_text")
def embed_texts(spark, sf):
    return _chunks(spark, sf).select(
        "doc_id", "chunk_no", embed_text(F.col("question"), F.col("answer")).alias("text")
    )


@query
def point_ids(spark, sf):
    return faq_documents.with_point_id(_chunks(spark, sf)).select("doc_id", "chunk_no", "id")


@query_named("scrub_pii")
def scrub_messages(spark, sf):
    return fx.messages(spark, sf).select(
        "channel_id", "ts", "user_id", "fetched_at", scrub_pii(F.col("text")).alias("text")
    )


@query
def scrub_documents(spark, sf):
    return fx.documents(spark, sf).select("doc_id", scrub_pii(F.col("text")).alias("text"))


@query_named("strip_file_urls")
def strip_file_links(spark, sf):
    """Messages with a file link added to every one."""
    link = F.concat(F.lit(" <https://files.example.com/"), "user_id", F.lit("/x.png> "))
    text = F.concat("text", link, "text")
    return fx.messages(spark, sf).select(
        "channel_id", "ts", "user_id", "fetched_at", strip_file_urls(text).alias("text")
    )


@query
def hash_users(spark, sf):
    return fx.messages(spark, sf).select(
        "channel_id", "ts", "fetched_at", "user_id",
        user_hash(F.when(F.col("role") != "system", F.col("user_id")), fx.SALT).alias("user_hash"),
    )


@query
def question_prefilter(spark, sf):
    return _masked(spark, sf).where(V.looks_like_question(F.col("text"))).select("channel_id", "ts", "user_id")


@query
def normalize_verdicts(spark, sf):
    """Raw model answers derived from the documents, every tenth one missing."""
    number = F.col("doc_id")
    kinds = F.array(*[F.lit(k) for k in [*V.QUESTION_TYPES, "chat", ""]])
    raw = F.struct(
        (number % 2 == 0).alias("is_question"),
        F.get(kinds, (number % 8).cast("int")).alias("question_type"),
        (F.col("n_chars") / 2000).alias("confidence"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.lit("model answer").alias("reason"), F.lit("m1").alias("llm_model"),
        F.lit(5).alias("latency_ms"), F.lit(None).cast("string").alias("request_id"),
    )
    answered = fx.documents(spark, sf).select(
        "doc_id", F.when(number % 10 != 9, raw).alias("verdict")
    )
    return classify.normalize(answered, "verdict", "m1").select(
        "doc_id", *[F.col(f"verdict.{c}").alias(c) for c in V.VERDICT_FIELDS if c != "request_id"]
    )


# --- models --------------------------------------------------------------------------------


@query
def dense_embed(spark, sf):
    coded = fx.documents(spark, sf).select("doc_id", token_codes(F.col("text")).alias("codes"))
    vectors = coded.select("doc_id", F.posexplode_outer(dense_vector(F.col("codes"))).alias("bucket", "value"))
    return vectors.where("value != 0").select(
        "doc_id", "bucket", F.round(F.col("value").cast("double"), 6).alias("value")
    )


@query
def sparse_embed(spark, sf):
    documents = embedding.with_vectors(fx.documents(spark, sf).select("doc_id", "text"))
    vectors = stored(documents.select("doc_id", "sparse"), "sparse-vectors")
    return embedding.weighted_terms(vectors, "doc_id").select(
        "doc_id", "idx", F.round("weight", 6).alias("weight")
    )


def counting_model():
    """An encoder that counts: characters, question marks."""
    return lambda texts: [[float(len(t)), float(t.count("?"))] for t in texts]


@query
def model_embed(spark, sf):
    """Vectors of a plugged-in encoder."""
    encode = embedding.model_udf(counting_model)
    vectors = fx.documents(spark, sf).select("doc_id", encode(F.col("text")).alias("v"))
    return vectors.select("doc_id", F.col("v")[0].cast("double").alias("x"), F.col("v")[1].cast("double").alias("y"))


def _verdicts(df: DataFrame) -> DataFrame:
    return df.select(
        "channel_id", "ts", *[F.col(f"verdict.{c}").alias(c) for c in V.VERDICT_FIELDS if c != "request_id"]
    )


@query
def classify_questions(spark, sf):
    return _verdicts(classify.classify(_masked(spark, sf), "text", "role"))


def flaky_model():
    """A model that fails at once for some texts, always for others, and gives too few answers to others still."""
    tried: dict[str, int] = {}

    def predict(texts: list[str]) -> list[dict]:
        (text,) = texts
        tried[text] = tried.get(text, 0) + 1
        if len(text) % 7 == 0 or len(text) % 5 == 0 and tried[text] % 3 == 1:
            raise TimeoutError
        if len(text) % 3 == 0 and tried[text] % 3 != 0:
            return []
        return [{"is_question": "?" in text, "question_type": "other", "confidence": 0.9, "reason": "stub"}]

    return predict


@query
def model_verdicts(spark, sf):
    """Counters of a run through the model seam: attempts and failures come from the calls themselves."""
    distinct = _masked(spark, sf).groupBy("text").agg(F.min("course_id").alias("course_id"))
    score = classify.model_classifier(flaky_model, "stub", batch=1, waits=(0.0, 0.0))
    metrics = classify.verdict_metrics(score(distinct, "text"), attempts="attempts")
    return metrics.select("course_id", "llm_model", "total", "success", "retried", "failed", "questions")


@query
def two_stage_verdicts(spark, sf):
    return _verdicts(classify.two_stage(_masked(spark, sf), "text", "role"))


@query
def calibrated_verdicts(spark, sf):
    """A second opinion on messages whose confidence is right in less than half of the golden set."""
    table = calibration.calibration(_golden(spark, sf))
    return _verdicts(calibration.calibrated_two_stage(_masked(spark, sf), table, "text", "role", wanted=0.5))


@query
def faq_items(spark, sf):
    items = build_faq_items(fx.messages(spark, sf), fx.courses(spark), fx.SALT, RUN_AT)
    shown = F.array_join(F.transform("dense", lambda x: F.round(x * 1000).cast("int").cast("string")), " ")
    return items.withColumns({
        "answers_redacted": F.array_join("answers_redacted", "␞"), "dense": shown
    })


@query
def canonical_groups(spark, sf):
    return canonical.canonical_groups(fx.documents(spark, sf), "doc_id", "text", 0.6)


@query_named("semantic_groups")
def semantic(spark, sf):
    """Vectors that are among each other's ten nearest; the smallest id stands for the group."""
    vectors = fx.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("dense"))
    return semantic_groups(vectors, 10, 0.9)


@query
def questions_by_lang(spark, sf):
    return classify.questions_by_language(fx.documents(spark, sf))


@query
def found_languages(spark, sf):
    """Languages read off the texts; those of a quarter of the texts, by a hash of the id, are not learned from."""
    texts = fx.documents(spark, sf)
    held_out = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1) < "4"
    profiles = languages.language_profiles(texts.where(~held_out))
    return languages.with_language(texts, profiles).select("doc_id", "lang", "found_lang", held_out.alias("held_out"))


# --- streaming and incremental -------------------------------------------------------------


def _arrivals(spark: SparkSession, sf: str, parts: list[Column]) -> list[DataFrame]:
    source = fx.messages(spark, sf)
    return [source.where(part) for part in parts]


def _feed(spark: SparkSession, batches: list[DataFrame], name: str, start) -> str:
    """Write each arrival and run the stream over what is new, on one checkpoint."""
    inbox, root, state = (scratch_path(spark, f"{name}-{part}") for part in ("in", "out", "state"))
    for batch in batches:
        batch.write.mode("append").json(inbox)
        start(jobs.message_stream(spark, inbox), root, state).awaitTermination()
    return root


def _by_fetch() -> list[Column]:
    return [F.col("fetched_at") == fx.FIRST_FETCH, F.col("fetched_at") != fx.FIRST_FETCH]


@query
def stream_ingest(spark, sf):
    root = _feed(
        spark, _arrivals(spark, sf, _by_fetch()), "ingest",
        lambda stream, out, state: jobs.start_ingest(stream, fx.courses(spark), out, state),
    )
    return msgs.read_messages(spark, root).select(
        "course_id", "year", "month", "day", "channel_id", "ts", "user_id", "fetched_at", "text"
    )


@query
def stream_dedupe(spark, sf):
    """The second arrival replays copies from the whole history, whose days are looked up."""
    root = _feed(
        spark, _arrivals(spark, sf, _by_fetch()), "dedupe",
        lambda stream, out, state: jobs.start_dedupe(stream, fx.courses(spark), out, state),
    )
    return jobs.read_first(spark, root).select("course_id", "channel_id", "ts", "fetched_at")


def _event_panes(spark: SparkSession, sf: str, length: str) -> DataFrame:
    schema = fx.table(spark, sf, "events").schema
    events = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )
    root, state = scratch_path(spark, "windows"), scratch_path(spark, "windows-state")
    jobs.start_window_counts(events, "ts", ["event_type"], "value", length, root, state).awaitTermination()
    return jobs.read_window_counts(spark, root, ["event_type"])


def _windows(df: DataFrame) -> DataFrame:
    return df.select(
        stamp(F.col("start")).alias("start"), "event_type", "n", F.col("total").cast("double").alias("total")
    )


@query
def tumbling_day(spark, sf):
    return _windows(_event_panes(spark, sf, "1 day"))


@query
def rolling_24h(spark, sf):
    return _windows(jobs.rolling_from_panes(_event_panes(spark, sf, "1 hour"), ["event_type"]))


@query
def stream_thread_upsert(spark, sf):
    """Messages arrive in two parts cut by time of day, so late replies meet stored threads."""
    early = F.pmod(F.unix_seconds(event_time(F.col("ts"))), F.lit(86400)) < 43200
    parts = [F.coalesce(early, F.lit(True)), ~F.coalesce(early, F.lit(True))]
    root = _feed(
        spark, _arrivals(spark, sf, parts), "threads",
        lambda stream, out, state: jobs.start_thread_updates(stream, fx.courses(spark), out, state),
    )
    return jobs.read_threads(spark, root).select(
        "id", "channel_id", "part", "reply_count", "answer_compact", "created_at", "updated_at"
    )


@query
def reconcile_threads(spark, sf):
    return _compacted(threads.compact_threads(_masked(spark, sf), same_day=False))


@query
def upsert_faq_items(spark, sf):
    """Items in three batches: early replies, late replies of the same threads alone, the second fetch."""
    columns = ["ts", "event_ts", "text", "fetched_at"]
    replies = threads.with_thread(_enriched(spark, sf)).where("NOT is_head").select(
        *threads.THREAD, *columns[:2], scrub_pii(F.col("text")).alias("text"), "fetched_at"
    )
    kept = replies.withColumn("first_seen", F.col("fetched_at")).limit(0)
    items = kept.select(
        *threads.THREAD, F.lit(0).alias("part"), F.lit(0).cast("long").alias("reply_count"), F.lit("").alias("answer_compact"),
        F.lit("").alias("created_at"), F.lit("").alias("updated_at"),
    )
    first, late = F.col("fetched_at") == fx.FIRST_FETCH, F.pmod(F.unix_seconds("event_ts"), F.lit(8000)) >= 4000
    for batch in (first & ~late, first & late, ~first):
        merged, touched = store.merge_replies(kept, replies.where(batch), threads.THREAD)
        kept = stored(merged, "replies")
        items = stored(threads.rebuilt_items(items, kept, touched, page=2), "items")
    return items.select(*threads.THREAD, "part", "reply_count", "answer_compact", "created_at", "updated_at")
