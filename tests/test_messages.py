"""Ingest, threads and positions, including groups that dwarf all others."""

import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from faqspark import fixtures as fx
from faqspark.functions.times import event_time
from faqspark.operators import ingest, order, threads
from faqspark.plans.faq_items import build_faq_items
from faqspark.runtime import scratch_path, shared_dir, spread, stored
from faqspark.schemas import RAW_MESSAGE
from faqspark.sources import messages as msgs

BASE = 1723420800


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_MESSAGE)


def message(ts, thread=None, text="x", role="user", user="U1", channel="C100", fetched="2024-08-14T06:00:00Z"):
    return (channel, ts, thread, user, role, text, fetched)


@pytest.fixture(scope="module")
def skewed(spark):
    """One thread with a third of all replies, spread over days, plus many small threads."""
    rng = random.Random(3)
    rows = []
    for t in range(40):
        head = f"{BASE + t * 60}.000000"
        rows.append(message(head, head, f"How do I do {t}?"))
        for r in range(500 if t == 0 else 25):
            at = BASE + t * 60 + 1 + rng.randrange(200_000)
            rows.append(message(f"{at}.{t:03d}{r:03d}", head, f"reply {t} {r}"))
    rng.shuffle(rows)
    return rows


def test_positions_equal_a_plain_window(spark, skewed):
    df = raw(spark, skewed).withColumn("event_ts", event_time(F.col("ts")))
    from faqspark.functions.times import minute_of

    got = order.with_position(df, ["thread_ts"], minute_of(F.col("event_ts")), ["event_ts", "ts"])
    groups = defaultdict(list)
    for row in skewed:
        groups[row[2]].append(row[1])
    want = {
        (thread, ts): (i + 1, len(all_ts))
        for thread, all_ts in groups.items() for i, ts in enumerate(sorted(all_ts))
    }
    have = {(r["thread_ts"], r["ts"]): (r["position"], r["group_size"]) for r in got.collect()}
    assert have == want


def test_large_group_is_not_gathered(spark, skewed):
    """Without broadcasts, wide rows are exchanged by slice, never by the bare thread key."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        messages = ingest.parse_messages(raw(spark, skewed)).withColumn("course_id", F.lit("c"))
        plan = threads.compact_threads(messages, page=100)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "_slice" in plan and "REPARTITION_BY_COL" in plan
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "_slice" in line]
    assert len(exchanges) >= 2


def test_long_threads_continue_in_parts(spark, skewed):
    messages = ingest.parse_messages(raw(spark, skewed)).withColumn("course_id", F.lit("c"))
    rows = threads.compact_threads(messages, same_day=False, page=100).collect()
    first = sorted((r for r in rows if r["thread_key"] == f"{BASE}.000000"), key=lambda r: r["part"])
    assert [len(r["answers"]) for r in first] == [100] * 5
    assert {r["reply_count"] for r in first} == {500}
    want = [text for ts, text in sorted((m[1], m[5]) for m in skewed if m[2] == f"{BASE}.000000" and m[1] != m[2])]
    assert [a for r in first for a in r["answers"]] == want


def test_items_keep_every_answer_whatever_the_page(spark, skewed):
    courses = fx.courses(spark)
    whole = build_faq_items(raw(spark, skewed), courses, "s", "now", same_day=False)
    paged = build_faq_items(raw(spark, skewed), courses, "s", "now", same_day=False, page=7)
    joined = defaultdict(list)
    for r in sorted(paged.collect(), key=lambda r: (r["id"], r["answer_part"])):
        joined[r["id"]] += r["answers_redacted"]
    assert {r["id"]: r["answers_redacted"] for r in whole.collect()} == dict(joined)
    assert len(joined) == 40


def test_dedupe_keeps_the_latest_fetch(spark):
    rows = [message("1.0", fetched=f"2024-08-{d:02d}") for d in range(1, 29)] + [message("2.0")]
    got = {r["ts"]: r["fetched_at"] for r in ingest.dedupe_messages(raw(spark, rows)).collect()}
    assert got == {"1.0": "2024-08-28", "2.0": "2024-08-14T06:00:00Z"}


def test_dedupe_limits_before_the_exchange(spark):
    plan = ingest.dedupe_messages(raw(spark, []))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_enrich_and_quarantine_split_the_input(spark):
    rows = [message("1.0"), message("bad"), message(""), message(None)]
    courses = fx.courses(spark)
    good = ingest.enrich_messages(raw(spark, rows), courses, "run")
    bad = ingest.quarantine(raw(spark, rows + [("C999", *message("2.0")[1:])]), courses)
    assert [(r["ts"], r["course_id"], r["fetched_at"]) for r in good.collect()] == [("1.0", "course-0", "run")]
    assert sorted((r["ts"] or "", r["reason"]) for r in bad.collect()) == [
        ("", "missing ts"), ("", "missing ts"), ("2.0", "unknown channel"), ("bad", "bad ts")
    ]


def test_window_is_half_open_and_zero_hours_means_a_day(spark):
    ts = [f"{BASE + s}" for s in (-86401, -86400, -1, 0)]
    df = raw(spark, [message(t) for t in ts]).withColumn("event_ts", event_time(F.col("ts")))
    for hours in (24, 0):
        kept = df.where(ingest.in_window(F.col("event_ts"), "2024-08-12T00:00:00Z", hours)).collect()
        assert sorted(r["ts"] for r in kept) == sorted(ts[1:3])


def test_threads_of_unthreaded_and_orphan_messages(spark):
    rows = [
        message("10.0", None, "single"), message("20.0", "20.0", "head"), message("21.0", "20.0", "reply"),
        message("31.0", "30.0", "orphan"),
    ]
    df = ingest.enrich_messages(raw(spark, rows), fx.courses(spark))
    heads = {r["ts"] for r in threads.with_thread(df).where("is_head").collect()}
    assert heads == {"10.0", "20.0"}
    assert {r["ts"] for r in threads.thread_messages(df).collect()} == {"10.0", "20.0", "21.0"}


def test_head_without_replies_is_kept(spark):
    rows = [message("20.0", "20.0"), message("21.0", "20.0"), message("90000.0", "20.0"), message("40.0", "40.0")]
    df = threads.with_thread(ingest.enrich_messages(raw(spark, rows), fx.courses(spark)))
    heads, replies = df.where("is_head"), df.where("NOT is_head")
    got = threads.attach_replies(heads, replies, keep_unanswered=True).collect()
    assert sorted((r["thread_key"], r["reply_ts"] or "") for r in got) == [("20.0", "21.0"), ("40.0", "")]
    every = threads.attach_replies(heads, replies, same_day=False).collect()
    assert sorted(r["reply_ts"] for r in every) == ["21.0", "90000.0"]


def test_preferred_answer(spark):
    rows = [
        message("1.0", "1.0"), message("2.0", "1.0", "student"), message("4.0", "1.0", "late", "assistant"),
        message("3.0", "1.0", "early", "assistant"),
        message("10.0", "10.0"), message("12.0", "10.0", "b"), message("11.0", "10.0", "a"),
    ]
    df = ingest.enrich_messages(raw(spark, rows), fx.courses(spark))
    got = {r["thread_key"]: r["answer"] for r in threads.preferred_answers(df).collect()}
    assert got == {"1.0": "early", "10.0": "a\nb"}


def test_writing_a_day_again_leaves_other_days(spark):
    root = scratch_path(spark, "days")
    courses = fx.courses(spark)
    days = [message(f"{BASE + d * 86400}", text=f"day {d}") for d in range(3)]
    msgs.write_messages(ingest.enrich_messages(raw(spark, days), courses), root)
    again = ingest.enrich_messages(raw(spark, [message(f"{BASE + 86400}", text="new")]), courses)
    msgs.write_messages(again, root)
    rows = msgs.read_messages(spark, root).collect()
    assert sorted((r["day"], r["text"]) for r in rows) == [("12", "day 0"), ("13", "new"), ("14", "day 2")]
    assert {r["month"] for r in rows} == {"08"}


def test_merging_part_of_a_day_keeps_the_rest(spark):
    root = scratch_path(spark, "days")
    courses = fx.courses(spark)

    def fetch(hours, text, fetched):
        rows = [message(f"{BASE + h * 3600}", text=f"{text}{h}", fetched=fetched) for h in hours]
        msgs.merge_days(ingest.enrich_messages(raw(spark, rows), courses), root)

    fetch([1, 5, 9, 30], "a", "d1")
    fetch([9, 20, 50], "b", "d2")
    fetch([9, 20, 50], "b", "d2")
    rows = sorted((r["day"], r["text"]) for r in msgs.read_messages(spark, root).collect())
    assert rows == [("12", "a1"), ("12", "a5"), ("12", "b20"), ("12", "b9"), ("13", "a30"), ("14", "b50")]
    kept = msgs.read_messages(spark, root)
    plan = msgs.days_of(kept, kept.limit(1))._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_window_scan_prunes_partitions(spark):
    root = scratch_path(spark, "days")
    days = [message(f"{BASE + d * 86400}") for d in range(5)]
    msgs.write_messages(ingest.enrich_messages(raw(spark, days), fx.courses(spark)), root)
    df = msgs.read_window(spark, root, "2024-08-14T06:00:00Z", days=1)
    assert sorted(r["day"] for r in df.collect()) == ["13", "14"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(concat_ws" in plan


def test_raw_exports_read_arrays_and_lines(spark, tmp_path):
    both = [{"ts": "1.0", "text": "é", "extra": 1}, {"ts": "2.0", "text": "b"}, {"ts": "3.0", "text": "[c]"}]
    forms = {
        "course-9": json.dumps(both, ensure_ascii=False), "ml course+1": json.dumps(both, indent=2, ensure_ascii=False),
        "course_id=c 3": "\n".join(json.dumps(r, ensure_ascii=False) for r in both) + "\n\n",
    }
    for course, body in forms.items():
        folder = tmp_path / "raw" / course / "year=2024" / "month=08" / "day=13"
        folder.mkdir(parents=True)
        (folder / "2024-08-13.json").write_text(body, encoding="utf-8")
    rows = msgs.read_raw_exports(spark, str(tmp_path / "raw")).collect()
    assert sorted((r["course_id"], r["ts"], r["text"]) for r in rows) == sorted(
        (course.removeprefix("course_id="), r["ts"], r["text"]) for course in forms for r in both
    )


def export(folder, course, body):
    day = folder / course / "year=2024" / "month=08" / "day=13"
    day.mkdir(parents=True, exist_ok=True)
    (day / "2024-08-13.json").write_text(body, encoding="utf-8")


def reply(n):
    """A record with nested objects, and text that looks like structure."""
    return {"ts": f"{n}.0", "text": 'a "},\n{ [x]\\', "replies": [{"user": "U1", "ts": "9.9"}, {"user": "U2", "ts": "8.8"}], "n": {"a": {"b": 1}}}


FORMS = ("lines", "array", "flat", "pretty", "tight")
BROKEN = {"none": None, "cut": '{"ts": "x", "replies": [{"a": 1', "closed": '{"ts": "x"}}', "word": "oops", "list": '{"ts": [}'}


def body_of(form, wrong):
    """Forty records in one form, a broken one among them or, where all share a line, behind them."""
    records = [json.dumps(reply(n), indent=None if form in ("lines", "array") else 1) for n in range(40)]
    if form == "flat":
        records = ["\n".join(line.strip() for line in r.split("\n")) for r in records]
    joined = form in ("array", "tight")
    if wrong and not joined:
        records.insert(20, wrong)
    text = {"lines": "\n", "array": ", ", "tight": ", "}.get(form, ",\n").join(records)
    text = text if form == "lines" else f"[{text}]" if joined else f"[\n{text}\n]\n"
    return f"{text}\n{wrong}\n" if wrong and joined else text


@pytest.mark.parametrize("split", [1 << 20, 1500])
def test_a_broken_record_costs_itself_only(spark, tmp_path, split):
    for form in FORMS:
        for name, wrong in BROKEN.items():
            export(tmp_path, f"{form}-{name}", body_of(form, wrong))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        good = sorted((r.course_id, r.ts) for r in msgs.read_raw_exports(spark, str(tmp_path)).collect())
        bad = sorted((r.course_id, r.line) for r in msgs.rejected_raw_exports(spark, str(tmp_path)).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert good == sorted((f"{form}-{name}", f"{n}.0") for form in FORMS for name in BROKEN for n in range(40))
    assert bad == sorted((f"{form}-{name}", wrong) for form in FORMS for name, wrong in BROKEN.items() if wrong)


def test_a_cut_array_line_keeps_the_other_lines(spark, tmp_path):
    lines = [json.dumps({"ts": f"{n}.0", "text": "t"}) for n in range(100)]
    export(tmp_path, "c1", "\n".join([*lines[:3], '[{"ts": "x"', *lines[3:]]))
    export(tmp_path, "c2", "[]\n \n[\n]\n")
    export(tmp_path, "c3", '[{"ts": "1.0"}, {"ts": "x", {"ts": "2.0"}, {"ts": "2.0"')
    good = msgs.read_raw_exports(spark, str(tmp_path))
    assert sorted((r.course_id, r.ts) for r in good.collect()) == sorted([("c1", f"{n}.0") for n in range(100)] + [("c3", "1.0"), ("c3", "2.0")])
    bad = msgs.rejected_raw_exports(spark, str(tmp_path)).collect()
    assert sorted((r.course_id, r.line, r.reason) for r in bad) == [("c1", '{"ts": "x"', "bad json"), ("c3", '{"ts": "2.0"', "bad json"), ("c3", '{"ts": "x"', "bad json")]
    assert "CartesianProduct" not in good._jdf.queryExecution().executedPlan().toString()


def test_unreadable_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"ts": "1.0"}\n{"ts": \n{"ts": "2.0"}\n', encoding="utf-8")
    good, bad = msgs.read_permissive(spark, str(tmp_path))
    assert sorted(r["ts"] for r in good.collect()) == ["1.0", "2.0"]
    assert [r["line"] for r in bad.collect()] == ['{"ts": ']


def test_manifest_depends_on_content_not_order(spark):
    rows = [message(f"{BASE + i}", text=f"t{i}") for i in range(50)]
    courses = fx.courses(spark)

    def digest(some):
        return ingest.partition_manifest(ingest.enrich_messages(raw(spark, some), courses)).first()

    one, two = digest(rows), digest(rows[::-1])
    assert one == two and one["n"] == 50
    changed = rows[:-1] + [message(f"{BASE + 49}", text="other")]
    assert digest(changed)["digest"] != one["digest"]
    assert digest(rows + rows[:1])["digest"] != one["digest"]
    for place, value in ((4, "system"), (6, "later"), (2, "")):
        other = (*rows[0][:place], value, *rows[0][place + 1:])
        assert digest([other, *rows[1:]])["digest"] != one["digest"]


def test_manifest_sums_hold_any_number_of_rows(spark):
    """Sums of 32-bit words as decimals stay exact far beyond 64 bits."""
    words = spark.range(4).select(F.lit(2**62).cast("decimal(28,0)").alias("w"))
    assert int(words.agg(F.sum("w")).first()[0]) == 2**64


def test_silent_channels_count(spark):
    rows = ingest.ingest_counters(raw(spark, [message("1.0"), message("bad")]), fx.courses(spark)).collect()
    got = {r["course_id"]: tuple(r)[1:] for r in rows}
    assert got["course-0"] == (1, 2, 1, 1)
    assert got["course-4"] == (2, 0, 0, 0)


def test_shared_folder_is_the_sessions(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    kept = stored(spark.range(3), "x")
    assert kept.count() == 3 and "Range" not in kept._jdf.queryExecution().executedPlan().toString()


def test_only_tables_of_few_files_are_dealt_to_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    one, many = scratch_path(spark, "one"), scratch_path(spark, "many")
    spark.range(100).coalesce(1).write.parquet(one)
    spark.range(100).repartition(2 * cores).write.option("maxRecordsPerFile", 5).parquet(many)
    dealt = spread(spark.read.parquet(one))
    assert dealt.rdd.getNumPartitions() == cores and dealt.count() == 100
    spark.conf.set("spark.sql.files.openCostInBytes", 128 << 20)
    try:
        large = spark.read.parquet(many)
        assert spread(large) is large
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
