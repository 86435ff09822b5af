"""Streams give what the batch forms give, also when batches are replayed."""

from pyspark.sql import functions as F

from faqspark import fixtures as fx
from faqspark.operators import ingest, threads
from faqspark.runtime import scratch_path
from faqspark.schemas import RAW_MESSAGE
from faqspark.sources import messages as msgs
from faqspark.sources import versions
from faqspark.streaming import jobs

BASE = 1723420800


def message(ts, thread=None, text="x", fetched="2024-08-14T06:00:00Z"):
    return ("C100", ts, thread, "U1", "user", text, fetched)


def arrive(spark, inbox, rows):
    spark.createDataFrame(rows, RAW_MESSAGE).coalesce(1).write.mode("append").json(inbox)


def test_ingest_equals_batch_and_restarts_cleanly(spark, sf):
    inbox, root, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    source = fx.messages(spark, sf)
    source.write.json(inbox)
    for _ in range(2):
        jobs.start_ingest(jobs.message_stream(spark, inbox, 2), fx.courses(spark), root, state).awaitTermination()
    keys = ["course_id", "year", "month", "day", "channel_id", "ts", "fetched_at", "text"]
    batch = ingest.enrich_messages(source, fx.courses(spark)).select(*keys)
    stream = msgs.read_messages(spark, root).select(*keys)
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect()))


def test_dedupe_keeps_the_first_arrival(spark):
    inbox, root, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    for rows in (
        [message(f"{BASE}.1", fetched="a"), message(f"{BASE + 5}.1", fetched="a")],
        [message(f"{BASE}.1", fetched="b"), message(f"{BASE + 9}.1", fetched="b")],
    ):
        arrive(spark, inbox, rows)
        jobs.start_dedupe(jobs.message_stream(spark, inbox), fx.courses(spark), root, state).awaitTermination()
    got = sorted((r["ts"], r["fetched_at"]) for r in jobs.read_first(spark, root).collect())
    assert got == [(f"{BASE}.1", "a"), (f"{BASE + 5}.1", "a"), (f"{BASE + 9}.1", "b")]


def test_late_events_update_open_windows(spark):
    inbox, root, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    schema = "ts timestamp, kind string, value double"
    for hours in ([0, 1, 30], [29, 31]):
        rows = spark.createDataFrame([(h, "k", 1.5) for h in hours], "h int, kind string, value double")
        rows.select(F.timestamp_seconds(F.lit(BASE) + F.col("h") * 3600).alias("ts"), "kind", "value").coalesce(
            1
        ).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(schema).parquet(inbox)
        jobs.start_window_counts(stream, "ts", ["kind"], "value", "1 day", root, state, "6 hours").awaitTermination()
    got = sorted((str(r["start"]), r["n"], float(r["total"])) for r in jobs.read_window_counts(spark, root, ["kind"]).collect())
    assert got == [("2024-08-12 00:00:00", 2, 3.0), ("2024-08-13 00:00:00", 3, 4.5)]


def test_rolling_windows_equal_sliding_windows(spark, sf):
    events = fx.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    amount = F.sum(F.col("value").cast("decimal(18,2)")).alias("total")

    def counts(*window):
        grouped = events.groupBy(F.window("ts", *window).start.alias("start"), "event_type")
        return grouped.agg(F.count("*").alias("n"), amount)

    rolled = jobs.rolling_from_panes(counts("1 hour"), ["event_type"]).select("start", "event_type", "n", "total")
    direct = counts("24 hours", "1 hour")
    assert sorted(map(tuple, rolled.collect())) == sorted(map(tuple, direct.collect()))


def test_late_reply_updates_its_thread(spark):
    inbox, root, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    head = f"{BASE}.0"
    arrivals = [
        [message(head, head, "head", "d1"), message(f"{BASE + 60}.0", head, "first", "d1")],
        [message(f"{BASE + 90000}.0", head, "late", "d2"), message(f"{BASE + 60}.0", head, "first", "d2")],
    ]
    for rows in arrivals:
        arrive(spark, inbox, rows)
        jobs.start_thread_updates(jobs.message_stream(spark, inbox), fx.courses(spark), root, state).awaitTermination()
    row = jobs.read_threads(spark, root).collect()
    assert [(r["id"], r["reply_count"], r["answers"], r["created_at"], r["updated_at"]) for r in row] == [
        (f"course-0:{head}", 2, ["first", "late"], "d1", "d2")
    ]


def test_replayed_batch_changes_nothing(spark, sf):
    root = scratch_path(spark, "out")
    store = jobs.merge_threads(root)
    enriched = ingest.enrich_messages(fx.messages(spark, sf), fx.courses(spark))
    store(enriched, 0)
    once = sorted(map(str, jobs.read_threads(spark, root).collect()))
    store(enriched, 0)
    store(enriched, 1)
    assert sorted(map(str, jobs.read_threads(spark, root).collect())) == once
    batch = threads.compact_threads(ingest.dedupe_messages(enriched), same_day=False)
    assert batch.count() == len(once)


def test_copies_of_any_age_are_recognised_and_replays_change_nothing(spark):
    """Copies years later, a batch that runs twice, and one that runs again after it was folded in."""
    root = scratch_path(spark, "out")
    keep = jobs.keep_first(root)
    year = 365 * 86400
    batches = [[message(f"{BASE + n * year + k}.1", fetched=f"f{n}") for n in range(number + 1) for k in range(5)] for number in range(6)]
    frames = [ingest.enrich_messages(spark.createDataFrame(b, RAW_MESSAGE), fx.courses(spark)) for b in batches]
    want = sorted((f"{BASE + n * year + k}.1", f"f{n}") for n in range(6) for k in range(5))
    for number, frame in enumerate(frames):
        keep(frame, number)
        keep(frame, number)
    assert sorted((r.ts, r.fetched_at) for r in jobs.read_first(spark, root).collect()) == want
    base, after = versions.state(spark, root)
    assert base is not None and len(after) <= 3
    keep(frames[0].limit(0), 6)
    assert jobs.read_first(spark, root).count() == len(want)


def test_dedupe_reads_keys_of_touched_days_only(spark):
    root = scratch_path(spark, "out")
    keep = jobs.keep_first(root)
    days = [ingest.enrich_messages(spark.createDataFrame([message(f"{BASE + n * 86400 + k}.1", text="t" * 50) for k in range(5)], RAW_MESSAGE), fx.courses(spark)) for n in range(4)]
    for number, frame in enumerate(days):
        keep(frame, number)
    known = versions.read(spark, root, text=["day_of"]).where(F.col("day_of").isin(["2024-08-13"])).select("channel_id", "ts")
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "day_of" in plan.split("PartitionFilters: [")[1].split("]")[0] and "text" not in plan.split("ReadSchema: ")[1]
    assert known.count() == 5


def test_ten_batches_leave_a_fold_and_few_batches(spark):
    """Every batch touches the same threads; what a batch reads does not grow with the number of batches."""
    root = scratch_path(spark, "out")
    store, heads, everything = jobs.merge_threads(root), [f"{BASE + 100 * h}.0" for h in range(8)], []
    folders = []
    for number in range(10):
        rows = [message(h, h, "head", f"d{number:02d}") for h in heads]
        rows += [message(f"{float(h) + 1 + number}", h, f"reply {number}", f"d{number:02d}") for h in heads]
        everything += rows
        store(ingest.enrich_messages(spark.createDataFrame(rows, RAW_MESSAGE), fx.courses(spark)), number)
        base, after = versions.state(spark, f"{root}/messages")
        folders.append(len(after) + (base is not None))
    assert max(folders) <= 6
    kept = versions.read(spark, f"{root}/messages")
    assert kept.where("text = 'head'").count() <= 8 * (2 + len(versions.state(spark, f"{root}/messages")[1]))
    whole = ingest.enrich_messages(spark.createDataFrame(everything, RAW_MESSAGE), fx.courses(spark))
    want = threads.compact_threads(ingest.dedupe_messages(whole), same_day=False)
    got = jobs.read_threads(spark, root)
    assert sorted((r.thread_key, r.reply_count, tuple(r.answers)) for r in got.collect()) == sorted(
        (r.thread_key, r.reply_count, tuple(r.answers)) for r in want.collect())
    assert {(r.created_at, r.updated_at) for r in got.collect()} == {("d00", "d09")}
