"""Documents, collections, retrieval and canonical groups against brute force."""

import hashlib
import random
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from faqspark import fixtures as fx
from faqspark.operators import canonical, embedding, faq_documents, retrieval, similar_sets, threads
from faqspark.plans.faq_index import build_points, index_documents
from faqspark.runtime import scratch_path
from faqspark.schemas import FAQ_CHUNK
from faqspark.sources import collections as store
from faqspark.sources import documents as docs

H1, H2, H3, TEXT = "HEADING_1", "HEADING_2", "HEADING_3", "NORMAL_TEXT"


def document(blocks):
    return {"body": {"content": [
        {"paragraph": {"paragraphStyle": {"namedStyleType": style}, "elements": [{"textRun": {"content": text}}]}}
        if style else {"table": {}}
        for style, text in blocks
    ]}}


def documents(spark, *many):
    import json

    rows = [(i, f"faq-{i % 4}", json.dumps(document(b))) for i, b in enumerate(many)]
    return docs.parse_documents(spark.createDataFrame(rows, "doc_id long, google_doc_id string, json string"))


def plain_chunks(blocks):
    """Chunks found by looking outwards from each question heading."""
    kept = [(style, text.strip()) for style, text in blocks if style and text.strip()]
    asked = [i for i, (style, _) in enumerate(kept) if style == H2]
    out = []
    for start, end in zip(asked, asked[1:] + [len(kept)]):
        above = [text for style, text in kept[:start] if style == H1]
        answer = "\n".join(text for style, text in kept[start:end] if style not in (H1, H2))
        if answer:
            out.append((above[-1] if above else "", kept[start][1], answer))
    return out


CASES = [
    [],
    [(TEXT, "intro"), (H1, "S"), (TEXT, "before any question")],
    [(H2, "Q1"), (TEXT, "a"), (H1, "S"), (TEXT, "still Q1"), (H2, "Q2"), (TEXT, "b")],
    [(H1, "S1"), (H1, "S2"), (H2, "Q"), (H3, "sub"), ("TITLE", "t"), (None, ""), (TEXT, "  x \n")],
    [(H2, "no answer"), (H2, "blank"), (TEXT, "   "), (H2, "Q"), (TEXT, "a")],
    [(H2, "Q"), (TEXT, "a"), (H2, " "), (TEXT, "b")],
]


def test_chunks_follow_the_rules(spark):
    rng = random.Random(5)
    cases = CASES + [
        [(rng.choice([H1, H2, H2, H3, TEXT, TEXT, None]), rng.choice(["", " ", "w", "two words"])) for _ in range(60)]
        for _ in range(30)
    ]
    rows = faq_documents.faq_chunks(documents(spark, *cases)).orderBy("doc_id", "chunk_no").collect()
    for i, case in enumerate(cases):
        got = [(r["section"], r["question"], r["answer"]) for r in rows if r["doc_id"] == i]
        assert got == plain_chunks(case), case


def test_chunking_needs_no_exchange(spark):
    plan = faq_documents.faq_chunks(documents(spark, *CASES))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_point_id(spark):
    rows = spark.createDataFrame([("c", "q", "a"), (None, "q", "a")], "course_id string, question string, answer string")
    digest = hashlib.sha256(b"q\na").hexdigest()
    assert [r["id"] for r in faq_documents.with_point_id(rows).collect()] == [f"c_{digest[:8]}", f"unknown_{digest[:8]}"]
    assert faq_documents.with_point_id(rows, 16).first()["id"] == f"c_{digest[:16]}"


def test_equal_chunks_share_a_point_and_the_last_wins(spark):
    same = [(H1, "one"), (H2, "Q"), (TEXT, "a"), (H1, "two"), (H2, "Q"), (TEXT, "a")]
    points = build_points(documents(spark, same), fx.faq_courses(spark)).collect()
    assert [p["payload"]["section"] for p in points] == ["two"]


def test_courses_without_a_document_are_skipped(spark):
    usable = faq_documents.selected_courses(fx.faq_courses(spark))
    assert sorted(r["course_id"] for r in usable.collect()) == [f"course-{i}" for i in range(4)]
    assert [r["course_id"] for r in faq_documents.selected_courses(fx.faq_courses(spark), "course-2").collect()] == ["course-2"]


def test_chunk_files_keep_non_ascii(spark, tmp_path):
    rows = [("", "Qué?", "ä ☃", "c", "C", "d", "faq_c0")]
    docs.write_chunks(spark.createDataFrame(rows, FAQ_CHUNK), str(tmp_path / "out"))
    raw = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out").rglob("*.json"))
    assert "ä ☃" in raw
    assert [tuple(r) for r in docs.read_chunks(spark, str(tmp_path / "out")).collect()] == rows


# --- collections ---------------------------------------------------------------------------


def points(spark, rows):
    return spark.createDataFrame(rows, "collection string, id string, dense array<float>, v int")


def test_upsert_twice_is_upsert_once(spark):
    old = points(spark, [("c", "a", [1.0], 1), ("c", "b", [1.0], 1)])
    new = points(spark, [("c", "b", [2.0], 2), ("d", "b", [2.0], 2)])
    once = store.upsert(old, new)
    twice = store.upsert(once, new)
    want = [("c", "a", 1), ("c", "b", 2), ("d", "b", 2)]
    for df in (once, twice):
        assert sorted((r["collection"], r["id"], r["v"]) for r in df.collect()) == want


def test_batches_merge_on_read_and_replay_harmlessly(spark):
    root = scratch_path(spark, "points")
    store.write_batch(points(spark, [("c", "a", [1.0], 1), ("c", "b", [1.0], 1)]), root, 0, 1)
    for _ in range(2):
        store.write_batch(points(spark, [("c", "b", [1.0], 2)]), root, 1, 1)
    want = [("a", 1), ("b", 2)]
    assert sorted((r["id"], r["v"]) for r in store.read_points(spark, root).collect()) == want
    target = scratch_path(spark, "points")
    store.compact(spark, root, target, 1)
    assert sorted((r["id"], r["v"]) for r in store.read_points(spark, target, single_batch=True).collect()) == want


def stored_points(spark, root):
    return sorted((r.id, r.v) for r in store.read_points(spark, root).collect())


def test_deleted_points_stay_gone_until_they_come_again(spark):
    root = scratch_path(spark, "points")
    store.write_batch(points(spark, [("c", "a", [1.0], 1), ("c", "b", [1.0], 1), ("d", "a", [1.0], 1)]), root, 0, 1)
    ended = spark.createDataFrame([("c", "a"), ("c", "never")], "collection string, id string")
    for _ in range(2):
        store.delete_points(ended, root, 1)
        assert stored_points(spark, root) == [("a", 1), ("b", 1)]
    assert store.fold_points(spark, root) and stored_points(spark, root) == [("a", 1), ("b", 1)]
    plan = store.read_points(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan, "a folded store is read as it lies"
    store.delete_points(ended, root, 1)
    assert stored_points(spark, root) == [("a", 1), ("b", 1)], "a replay after the fold"
    store.write_batch(points(spark, [("c", "a", [1.0], 3)]), root, 2, 1)
    assert stored_points(spark, root) == [("a", 1), ("a", 3), ("b", 1)]
    assert not store.fold_points(spark, root, grown=0.9), "one row beside two is not worth a fold"
    assert store.fold_points(spark, root, grown=0.0) and stored_points(spark, root) == [("a", 1), ("a", 3), ("b", 1)]


def test_reindexed_documents_end_points_they_no_longer_have(spark):
    def chunks(rows):
        return spark.createDataFrame(rows, "collection string, id string, dense array<float>, v int, doc string")

    root = scratch_path(spark, "points")
    store.write_batch(chunks([("c", "a", [1.0], 1, "d1"), ("c", "b", [1.0], 1, "d1"), ("c", "z", [1.0], 1, "d2")]), root, 0, 1)
    for _ in range(2):
        store.replace_stored_documents(chunks([("c", "b", [1.0], 2, "d1"), ("c", "n", [1.0], 2, "d1")]), root, 1, 1, F.col("doc"))
        assert stored_points(spark, root) == [("b", 2), ("n", 2), ("z", 1)]
    store.fold_points(spark, root)
    assert stored_points(spark, root) == [("b", 2), ("n", 2), ("z", 1)]


def test_wrong_vector_length_fails(spark):
    with pytest.raises(PySparkException, match="wrong vector length"):
        store.write_batch(points(spark, [("c", "a", [1.0, 2.0], 1)]), scratch_path(spark, "points"), 0, 3)


def test_replacing_a_document_drops_its_old_points(spark):
    old = spark.createDataFrame([("d1", "x"), ("d1", "y"), ("d2", "z")], "doc_id string, id string")
    new = spark.createDataFrame([("d1", "w")], "doc_id string, id string")
    assert sorted(r["id"] for r in store.replace_documents(old, new).collect()) == ["w", "z"]


def test_late_replies_alone_extend_a_stored_thread(spark):
    """A batch with one late reply keeps the replies stored before and moves the parts that follow."""
    key = ["course_id", "channel_id", "thread_key"]
    shape = "course_id string, channel_id string, thread_key string, ts string, event_ts timestamp, text string, fetched_at string"

    def replies(rows):
        return spark.createDataFrame([("c", "C1", t, ts, datetime(2024, 8, 1, 0, 0, int(ts)), f"r{ts}", f) for t, ts, f in rows], shape)

    kept = replies([]).withColumn("first_seen", F.col("fetched_at"))
    items = spark.createDataFrame(
        [], "course_id string, channel_id string, thread_key string, part int, reply_count long, answer_compact string, created_at string, updated_at string")
    for batch in ([("a", "5", "d1"), ("a", "7", "d1"), ("b", "9", "d1")], [("a", "2", "d2")], [("a", "2", "d2")]):
        kept, touched = store.merge_replies(kept, replies(batch), key)
        items = threads.rebuilt_items(items, kept, touched, page=2)
    got = sorted((r["thread_key"], r["part"], r["reply_count"], r["answer_compact"], r["created_at"], r["updated_at"]) for r in items.collect())
    assert got == [("a", 0, 3, "r2\nr5", "d1", "d2"), ("a", 1, 3, "r7", "d1", "d2"), ("b", 0, 1, "r9", "d1", "d1")]


# --- retrieval -----------------------------------------------------------------------------

SPARSE = "struct<indices:array<int>,values:array<double>>"


@pytest.fixture(scope="module")
def corpus(spark):
    """300 points and 30 queries with many ties, few common terms and empty vectors."""
    rng = np.random.default_rng(11)

    def rows(n, prefix):
        out = []
        for i in range(n):
            terms = sorted(set(rng.zipf(1.6, rng.integers(0, 12)) % 50))
            dense = [float(x) for x in rng.integers(-1, 2, 4)]
            out.append((f"{prefix}{i}", f"s{i % 3}", dense, ([int(t) for t in terms], [float(1 + t % 2) for t in terms])))
        return out

    return rows(300, "p"), rows(30, "q")


def frames(spark, corpus):
    p = spark.createDataFrame(corpus[0], f"id string, scope string, dense array<float>, sparse {SPARSE}")
    q = spark.createDataFrame(corpus[1], f"query_id string, scope string, dense array<float>, sparse {SPARSE}")
    return p.repartition(5).withColumn("payload", F.struct(F.col("scope").alias("course"))), q


def brute_force(corpus, kind, depth, scoped):
    points, queries = corpus
    df = {}
    for _, _, _, (terms, _) in points:
        for t in terms:
            df[t] = df.get(t, 0) + 1
    out = {}
    for name, scope, dense, (terms, weights) in queries:
        found = []
        for pid, pscope, pdense, (pterms, pweights) in points:
            if scoped and scope != pscope:
                continue
            if kind == "dense":
                norm = np.linalg.norm(dense) * np.linalg.norm(pdense)
                found.append((-round(float(np.dot(dense, pdense) / norm), 6) if norm else 0.0, pid))
                continue
            shared = set(terms) & set(pterms)
            if shared:
                mine, theirs = dict(zip(terms, weights)), dict(zip(pterms, pweights))
                score = sum(
                    mine[t] * theirs[t] * np.log(1 + (len(points) - df[t] + 0.5) / (df[t] + 0.5)) ** 2 for t in shared
                )
                found.append((-round(float(score), 6), pid))
        out[name] = [(pid, -loss) for loss, pid in sorted(found)[:depth]]
    return {q: hits for q, hits in out.items() if hits}


def lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    return out


@pytest.mark.parametrize("scoped", [False, True])
@pytest.mark.parametrize("kind", ["dense", "sparse"])
def test_top_k_is_exact(spark, corpus, kind, scoped):
    p, q = frames(spark, corpus)
    if not scoped:
        q = q.drop("scope")
    got = lists(retrieval.top_k(p, q, kind, 20))
    want = brute_force(corpus, kind, 20, scoped)
    assert {k: [i for i, _ in v] for k, v in got.items()} == {k: [i for i, _ in v] for k, v in want.items()}
    for name in want:
        assert [s for _, s in got[name]] == pytest.approx([s for _, s in want[name]], abs=2e-6)


@pytest.mark.parametrize("scoped", [False, True])
def test_small_groups_shards_and_slabs_change_nothing(spark, corpus, monkeypatch, scoped):
    """Many groups of queries meet many shards in one cogroup, which no broadcast and no driver takes part in."""
    p, q = frames(spark, corpus)
    if not scoped:
        q = q.drop("scope")
    p = p.withColumn("payload", F.struct("id"))
    whole = lists(retrieval.hybrid_search(p, q))
    few = {"GROUP_QUERIES": max(1, q.count() // 5), "SHARD_POINTS": 40, "CELLS": 100, "PAIRS": 50, "TIER_SHARDS": 3}
    for name, value in few.items():
        monkeypatch.setattr(retrieval, name, value)
    gathered = []
    monkeypatch.setattr(retrieval, "_by_broadcast", lambda *args: gathered.append(args))
    assert lists(retrieval.hybrid_search(p, q)) == whole and not gathered
    plan = retrieval.top_k(p, q, "dense", 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapCoGroupsInArrow") == 1 and "CartesianProduct" not in plan


def test_many_query_terms_make_more_groups(spark, corpus, monkeypatch):
    p, q = frames(spark, corpus)
    whole = lists(retrieval.top_k(p, q.drop("scope"), "sparse", 20))
    monkeypatch.setattr(retrieval, "GROUP_TERMS", 40)
    assert lists(retrieval.top_k(p, q.drop("scope"), "sparse", 20)) == whole


def test_queries_of_no_known_scope_have_no_hits(spark, corpus):
    p, q = frames(spark, corpus)
    lost = q.withColumn("scope", F.when(F.col("query_id") == q.first().query_id, F.lit(None)).otherwise(F.lit("nowhere")))
    assert retrieval.top_k(p, lost, "dense", 5).count() == 0


def test_a_course_filter_opens_its_files_only(spark, sf):
    points, stats = index_documents(spark, fx.styled_documents(spark, sf), fx.faq_courses(spark))
    for name in ("Course 1", "course-1"):
        own = retrieval.of_course(points, name)
        plan = own._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [((" in plan and own.count() == points.where("payload.course = 'Course 1'").count() > 0
        read = {r.file for r in own.select(F.col("_metadata.file_path").alias("file")).distinct().collect()}
        assert read and all("/course_id=course-1/" in file for file in read)


def test_names_that_look_like_numbers_stay_text(spark):
    root = scratch_path(spark, "points")
    rows = [("c", "007", "1e3", "a", [1.0, 2.0]), ("c", None, "", "b", [1.0, 2.0])]
    store.write_batch(spark.createDataFrame(rows, "collection string, course_id string, course string, id string, dense array<float>"), root, 0, 2)
    got = {r.id: (r.course_id, r.course) for r in store.read_points(spark, root).collect()}
    assert got["a"] == ("007", "1e3")


def test_compaction_chooses_buckets_by_size(spark, monkeypatch):
    root, target = scratch_path(spark, "points"), scratch_path(spark, "points")
    points = spark.range(500).select(F.col("id").cast("string"), F.lit("c").alias("collection"), F.array(F.lit(1.0).cast("float")).alias("dense"))
    store.write_batch(points, root, 0, 1)
    monkeypatch.setattr(store, "BUCKET_POINTS", 100)
    store.compact(spark, root, target, 1)
    assert store.read_points(spark, target).select("bucket").distinct().count() == 5


def test_fusion(spark, corpus):
    p, q = frames(spark, corpus)
    q = q.drop("scope")
    got = lists(retrieval.hybrid_search(p, q, limit=5))
    dense, sparse = (brute_force(corpus, kind, 10, False) for kind in ("dense", "sparse"))
    for name, hits in got.items():
        score = {}
        for ranked in (dense.get(name, []), sparse.get(name, [])):
            for rank, (pid, _) in enumerate(ranked, 1):
                score[pid] = score.get(pid, 0) + 1 / (60 + rank)
        want = sorted((-round(s, 6), pid) for pid, s in score.items())[:5]
        assert hits == [(pid, -loss) for loss, pid in want]
        assert {pid for pid, _ in hits} <= set(score)


def test_no_queries_and_no_points(spark, corpus):
    p, q = frames(spark, corpus)
    assert retrieval.hybrid_search(p, q.drop("scope").limit(0)).count() == 0
    assert retrieval.hybrid_search(p.limit(0), q.drop("scope")).count() == 0


def test_vectors_are_not_read_for_payloads(spark, sf):
    points, stats = index_documents(spark, fx.styled_documents(spark, sf), fx.faq_courses(spark))
    asked = embedding.with_vectors(spark.createDataFrame([("q", "the and of")], "query_id string, text string"))
    hits = retrieval.hybrid_search(points, asked, limit=2, stats=stats)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert all("dense" not in line for line in plan.splitlines() if "FileScan" in line)
    assert hits.count() == 2


def test_filters(spark, sf):
    points, stats = index_documents(spark, fx.styled_documents(spark, sf), fx.faq_courses(spark))
    asked = embedding.with_vectors(spark.createDataFrame([("q", "the and of")], "query_id string, text string"))
    for options, field, value in (
        ({"course": "Course 1"}, "course", "Course 1"),
        ({"course": "course-1"}, "course", "Course 1"),
        ({"section": ""}, "section", ""),
        ({"course": "Course 2", "section": "no such"}, "course", "Course 2"),
    ):
        hits = retrieval.search(points, asked, stats=stats, **options).collect()
        if value:
            assert len(hits) == 10
        assert {h["payload"][field] for h in hits} <= ({value} if value else {h["payload"][field] for h in hits})


def test_format_hits_fills_gaps(spark):
    payload = "struct<course:string,section:string,question:string,answer:string>"
    hits = spark.createDataFrame(
        [("q", 1, "p", 0.123456, (None, "s", "x" * 80, "y" * 300))],
        f"query_id string, rank int, id string, score double, payload {payload}",
    )
    row = retrieval.format_hits(hits, question_chars=60).first()
    assert (row["score"], row["course"], row["question"], row["answer"]) == (
        0.1235, "N/A", "x" * 60 + "...", "y" * 200 + "..."
    )


# --- canonical groups ----------------------------------------------------------------------


def plain_components(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_connected_components(spark, shape):
    rng = random.Random(2)
    links = {
        "chain": [(i + 1, i) for i in range(60)],
        "star": [(i, 0) for i in range(1, 200)] + [(900, 901)],
        "random": [(rng.randrange(120), rng.randrange(120)) for _ in range(90)],
    }[shape]
    links = [(a, b) for a, b in links if a != b]
    got = similar_sets.connected_components(spark.createDataFrame(links, "id long, leader long"))
    assert {r["id"]: r["label"] for r in got.collect()} == plain_components(links)


def test_hot_group_gives_one_link_per_member(spark):
    """A third of all texts are copies or near copies of one: links grow with members, not pairs."""
    rng = random.Random(9)
    vocabulary = [f"word{i}" for i in range(3000)]
    base = rng.sample(vocabulary, 40)
    texts = [" ".join(base[:39] + [f"own{i}"]) for i in range(60)] + [" ".join(base)] * 40
    texts += [" ".join(rng.sample(vocabulary, 40)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = canonical.canonical_groups(df, "doc_id", "text").collect()
    assert {r["doc_id"] for r in groups if r["canonical"] == 0} == set(range(100))
    assert all(r["group_size"] == 1 for r in groups if r["doc_id"] >= 100)
    from faqspark.functions.text import token_set

    sets = df.select(F.col("doc_id").alias("id"), token_set(F.col("text")).alias("codes")).dropDuplicates(["codes"])
    prefixes = similar_sets.rare_tokens(sets, 0.6)
    assert prefixes.groupBy("id").count().agg({"count": "max"}).first()[0] <= 40 - 24 + 1
    assert similar_sets._leader_pairs(prefixes, 0.6).count() <= prefixes.count()


@pytest.mark.parametrize("n", [300, 2500])
def test_crowded_short_texts_lose_no_pair(spark, n):
    """Twelve words out of 45: every bucket is crowded with unlike texts."""
    rng = random.Random(n)
    texts = [frozenset(rng.sample(range(45), 12)) for _ in range(n)]
    df = spark.createDataFrame([(k, " ".join(f"w{x}" for x in t)) for k, t in enumerate(texts)], "doc_id long, text string")
    masks = np.array([sum(1 << x for x in t) for t in texts], np.uint64)
    links = [(k, k) for k in range(n)]
    for k in range(n):
        common = np.bitwise_count(masks[:k] & masks[k])
        links += [(k, int(x)) for x in np.flatnonzero(common >= 0.6 * (24 - common.astype(float)) - 1e-9)]
    got = {r["doc_id"]: r["canonical"] for r in canonical.canonical_groups(df, "doc_id", "text").collect()}
    assert got == plain_components(links)


def test_groups_in_other_scripts(spark):
    texts = ["Привет как дела сегодня", "Привет как дела", "如何安装软件包", "如何安装软件", "Größe ändern wie", "…", "—"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["canonical"] for r in canonical.canonical_groups(df, "doc_id", "text").collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 5, 6: 6}


def test_few_pairs_are_confirmed_on_whole_sets(spark, monkeypatch):
    """Texts of unlike lengths that share common words: bit maps as wide as the sets leave hardly more than the similar pairs."""
    rng = random.Random(12)
    common, rare = [f"c{i}" for i in range(60)], [f"r{i}" for i in range(1500)]
    texts = [rng.sample(common, 20) + rng.sample(rare, rng.choice([10, 60, 600])) for _ in range(150)]
    texts += [t[:-4] + [f"own{k}"] for k, t in enumerate(texts[:15])]
    confirmed, seen = similar_sets._confirmed, []

    def counted(pairs, sets, threshold):
        seen.append(pairs.count())
        return confirmed(pairs, sets, threshold)

    monkeypatch.setattr(similar_sets, "_confirmed", counted)
    for name, few in (("CROWD", 8), ("PART_ROWS", 16), ("ROUND_ROWS", 4000)):
        monkeypatch.setattr(similar_sets, name, few)
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["canonical"] for r in canonical.canonical_groups(df, "doc_id", "text").collect()}
    links = [(k, k) for k in range(len(texts))]
    links += [(a, b) for a in range(len(texts)) for b in range(a)
              if len(set(texts[a]) & set(texts[b])) >= 0.6 * len(set(texts[a]) | set(texts[b])) - 1e-9]
    assert got == plain_components(links)
    assert sum(seen) <= 3 * sum(a != b for a, b in links)


def test_keys_may_repeat(spark):
    """Two unlike texts of one key are one entry, whatever their places."""
    rows = [(5, "a b c d"), (5, "p q r s"), (3, "a b c d"), (9, "p q r s t"), (5, "a b c d"), (7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in canonical.canonical_groups(df, "doc_id", "text").collect())
    assert {r[:2] for r in got} == {(5, 3), (5, 5), (3, 3), (9, 5), (7, 7)}
    assert len(got) == len(rows)


def test_pairs_are_looked_at_once_and_at_half_the_width_first(spark, monkeypatch):
    """Unlike sets of one bucket: each pair's maps are compared once, folded to half; those of similar sets at full width too."""
    rng = np.random.default_rng(17)
    sets = [np.unique(rng.integers(-(1 << 62), 1 << 62, 300)) for _ in range(40)] + [np.unique(rng.integers(0, 1 << 62, 500))]
    sets += [np.append(sets[0][:-30], rng.integers(0, 1 << 62, 30)), np.append(sets[40][:-60], rng.integers(0, 1 << 62, 90))]
    codes = pa.RecordBatch.from_pydict({"id": pa.array(range(len(sets)), pa.int64()), "codes": pa.array([s.tolist() for s in sets], pa.list_(pa.int64()))})
    maps = pa.Table.from_batches(similar_sets._folded(iter([codes])))
    maps = maps.append_column("c", maps.column("id"))
    n = len(sets)
    rows = pa.table({"key": pa.array([7] * n + [8], pa.int64()), "id": pa.array([*range(n), 0], pa.int64()),
                     "pos": pa.array([0] * (n + 1), pa.int32()), "role": pa.array([0] * (n + 1), pa.int32())})
    words, real = [], similar_sets._differences

    def counted(x, y):
        words.extend([x.shape[1]] * len(x))
        return real(x, y)

    monkeypatch.setattr(similar_sets, "_differences", counted)
    got = similar_sets.cross(0.6)(rows, maps).to_pylist()
    assert {(r["leader"], r["id"]) for r in got} == {(0, 41), (40, 42)}
    # Of 300 tokens have maps of 32 words, of 500 also: half of that for each pair, all of it for the two similar ones.
    assert words.count(16) <= n * (n - 1) // 2 and sum(words) <= 16 * n * (n - 1) // 2 + 32 * 4


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.9, 1.0])
def test_bit_maps_lose_no_pair_at_any_width(threshold):
    """Sets of one to 3000 tokens, whose maps are folded to the narrower one's half width."""
    rng = np.random.default_rng(18)
    sets = []
    for size in (1, 2, 60, 120, 140, 260, 300, 700, 1500, 3000):
        base = np.unique(rng.integers(-(1 << 62), 1 << 62, size))
        sets += [base] + [np.append(base[:int(len(base) * part)], rng.integers(0, 1 << 62, int(len(base) * more))) for part, more in ((0.9, 0.0), (0.8, 0.1), (0.7, 0.4), (1.0, 0.6))]
    sets = [s for s in map(np.unique, sets) if len(s)]
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(len(sets)), pa.int64()), "codes": pa.array([s.tolist() for s in sets], pa.list_(pa.int64()))})
    table = pa.Table.from_batches(similar_sets._folded(iter([batch])))
    sizes = table.column("n").to_numpy().astype(np.int64)
    a, b = (x.ravel() for x in np.meshgrid(range(len(sets)), range(len(sets))))
    fits = np.minimum(sizes[a], sizes[b]) >= np.maximum(sizes[a], sizes[b]) * threshold - 1e-9
    a, b = a[fits], b[fits]
    close = similar_sets.Maps(table.column("bits"), sizes).near(a, b, threshold)
    for x, y, near in zip(a, b, close):
        shared = len(np.intersect1d(sets[x], sets[y]))
        assert near or shared < threshold * (len(sets[x]) + len(sets[y]) - shared) - 1e-9


def test_scripts_without_blanks_lie_in_the_range_that_is_asked_for_first(spark):
    from faqspark.functions.text import HIGH, SINGLE, tokens

    points = spark.createDataFrame([(chr(k),) for k in range(1, 0x3400) if not 0xD800 <= k < 0xE000] + [("𠀀",), ("ｱ",), ("𛀁",)], "c string")
    assert points.where(F.col("c").rlike(SINGLE) & ~F.col("c").rlike(HIGH)).count() == 0
    df = spark.createDataFrame([("é漢字a𠀀b",), ("déjà vu",), (None,)], "t string")
    assert [r[0] for r in df.select(tokens(F.col("t"))).collect()] == [["é", "漢", "字", "a", "𠀀", "b"], ["déjà", "vu"], None]
