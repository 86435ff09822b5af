"""Rule cascade, temperature mixing and chat formatting."""

import hashlib
import math
import re
from collections import Counter

import pytest
from harness import connect, difference, spark_rows, sql_rows
from hypothesis import given, settings, strategies as st
from llm_cases import docs, empty, rows
from pyspark.sql import functions as F

from faqspark.llm import chat_parts, mixing, rule_cascade
from faqspark.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"op1_near_duplicates"}))
def test_matches_sql(spark, sf, name):
    assert difference(spark_rows(QUERIES[name](spark, sf)), sql_rows(connect(sf), ORACLES[name])) == ""


def figures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    covered = {p for i, w in enumerate(windows) if many[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_figures_of_awkward_rows(spark):
    got = rule_cascade.figures_and_verdict(docs(spark)).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == Counter(
        (r[0], *figures(r[1])) for r in rows())
    assert {r.doc_id for r in got if r.kept} >= {1, 2, 3, 11}
    assert not any(r.kept for r in got if r.doc_id in (5, 6, 7, 8, 14, 15, 16) or r.base_failed)
    assert rule_cascade.figures_and_verdict(empty(spark)).count() == 0


def test_cascade_orders_by_rejection_per_cost_and_never_changes_the_verdict(spark):
    cheap = rule_cascade.Rule("cheap", lambda t: F.length(t.text) < 30)
    never = rule_cascade.Rule("never", lambda t: t.n_repeat_words < 0)
    order = [m.rule.name for m in rule_cascade.measure(docs(spark), (never, cheap))]
    assert order == ["cheap", "never"]
    kept = rule_cascade.cascade(docs(spark), out="score")
    assert kept.columns == docs(spark).columns
    one = {r.doc_id for r in kept.where("score IS NULL").collect()}
    back = rule_cascade.cascade(docs(spark), rule_cascade.RULES[::-1], out="why")
    assert one == {r.doc_id for r in back.where("why IS NULL").collect()}


def test_cascade_is_lazy(spark):
    """A rule behind a rejecting one is not evaluated: it would fail."""
    first = rule_cascade.Rule("all", lambda t: F.length(t.text) >= 0)
    broken = rule_cascade.Rule("broken", lambda t: F.raise_error(F.lit("evaluated")).isNull())
    column = rule_cascade.first_rejection(rule_cascade.Facts(F.col("text")), [first, broken])
    assert docs(spark).select(column.alias("r")).distinct().count() == 1


def shares(spark, tokens):
    rows = spark.createDataFrame([(k, f"s{k}", n) for k, n in enumerate(tokens)], "doc_id bigint, source string, n_tokens bigint")
    return mixing.source_shares(rows)


def test_exponent_meets_repetition_limit_and_entropy(spark):
    tokens = [900, 90, 10]
    stats = shares(spark, tokens).cache()
    alpha = mixing.exponent(stats, 1000, max_repeats=4.0)
    weights = [(t / 1000) ** alpha for t in tokens]
    assert max(w / sum(weights) * 1000 / t for w, t in zip(weights, tokens)) == pytest.approx(4, rel=1e-9)
    alpha = mixing.exponent(stats, 1000, max_repeats=None, target_entropy=0.6)
    weights = [(t / 1000) ** alpha for t in tokens]
    entropy = -sum(w / sum(weights) * math.log(w / sum(weights)) for w in weights)
    assert entropy == pytest.approx(0.6, abs=1e-9)
    assert mixing.exponent(stats, 1000, max_repeats=100.0) == 0.0


def test_mixture_stays_within_budgets_and_is_a_permutation(spark):
    table = [(k, "big" if k % 10 else "small", 5 + k % 7) for k in range(2000)]
    plan = mixing.plan_mix(spark.createDataFrame(table, "doc_id bigint, source string, n_tokens bigint"), max_repeats=2.0).collect()
    total = sum(t for _, _, t in table)
    for source in ("big", "small"):
        own = [r for r in plan if r.source == source]
        assert len({r.doc_id for r in own}) == len(own)
        assert len({(r.block_rank, r.place) for r in own}) == len(own)
        size = sum(r.n_tokens for r in own)
        used = sum(r.n_tokens * (r.full + r.extra) for r in own)
        assert used < 2.0 * size + 12
        order = sorted(own, key=lambda r: (r.block_rank, r.place))
        extras = [r.extra for r in order]
        assert extras == sorted(extras, reverse=True), "the partial pass is a prefix of the permutation"
    assert total <= sum(r.n_tokens * (r.full + r.extra) for r in plan) + 2 < total + 2 * 12


def test_one_giant_document_keeps_no_others_out_of_the_mix(spark):
    """A source far above its budget holds one giant document; its budget is used whatever the order is."""
    table = [(k, " ".join(["w"] * (30_000 if k == 7 else 10)), "big") for k in range(3000)] + [(5000, " ".join(["v"] * 40_000), "one")]
    frame = spark.createDataFrame(table, "doc_id bigint, text string, source string").repartition(4)
    for seed in range(4):
        used = Counter()
        for r in mixing.mix(frame, budget=16_000, seed=seed).collect():
            used[r.source] += len(r.text.split())
        assert used["big"] >= 8_000 and used["one"] == 40_000
        assert used["big"] < 8_000 + 30_000


def test_every_source_uses_up_its_budget(spark):
    """The query's rows: a source has its quota, and less than one document above it, in whatever order it comes."""
    table = [(k, 20_000 if k == 7 else 10, "big") for k in range(2001)] + [(5000 + k, 10, "one") for k in range(500)]
    frame = spark.createDataFrame(table, "doc_id bigint, n_tokens bigint, source string")
    for seed in range(5):
        plan = mixing.plan_mix(frame, budget=40_000, max_repeats=None, target_entropy=0.68, seed=seed).collect()
        used = Counter()
        for r in plan:
            used[r.source] += r.n_tokens * (r.full + r.extra)
        assert 15_000 < used["one"] < 25_000 and 15_000 < used["big"] < 25_000 + 20_000


def test_mix_keeps_columns_of_any_name(spark):
    table = docs(spark).withColumns({n: F.lit(1) for n in ("mixed0", "Times0", "use0", "_mix_use", "_mix_id", "_mix_uses")})
    mixed = mixing.mix(table)
    assert mixed.columns == table.columns and mixed.where("use0 != 1 OR _mix_use != 1").count() == 0


def test_repeated_words_of_very_long_texts(spark):
    """Each window once but for the last ones. Texts of millions of words need more memory than a test session has."""
    words = F.transform(F.sequence(F.lit(1), F.lit(300_000)), lambda k: F.when(k > 299_997, k - 200_000).otherwise(k).cast("string"))
    text = spark.range(1).select(F.array_join(words, " ").alias("text"))
    assert text.select(rule_cascade.Facts(F.col("text")).n_repeat_words.alias("n")).first().n == 6


def test_mix_awkward_rows(spark):
    mixed = mixing.mix(docs(spark))
    assert mixed.columns == docs(spark).columns
    counts = Counter(r.doc_id for r in mixed.collect())
    assert counts[None] == 2 and counts[20] % 2 == 0
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mixture(empty(spark)).count() == 0
    mixing.mixture(docs(spark)).count()


PARTS = "conv_id bigint, turn bigint, role string, parts array<struct<kind:string,text:string,ref:string,units:bigint>>"


def test_typed_parts_become_ordered_placeholders(spark):
    parts = [("text", "see <image> [INST]\\", None, None), ("image", None, "a.png", 300), ("text", None, None, None), ("audio", None, "b.wav", 50),
             ("document", None, "c.pdf", 3), ("video", None, "d.mp4", 9), (None, "x", None, None)]
    got = chat_parts.format_turns(spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, None, None)], PARTS)).orderBy("turn").collect()
    assert got[0].segment == "<s>[INST]assistant[/INST]see \\<image> \\[INST]\\\\<image><audio><document></s>"
    assert [(a.kind, a.ref, a.tokens) for a in got[0].attachments] == [
        ("image", "a.png", 300), ("audio", "b.wav", 50), ("document", "c.pdf", 1536), ("video", "d.mp4", 0), (None, None, 0)]
    assert got[0].expanded_tokens == 1886
    assert chat_parts.parse(got[0].segment) == ("assistant", "see <image> [INST]\\<image><audio><document>")
    assert got[1].segment == "<s>[INST][/INST]</s>" and got[1].loss_start == got[1].loss_end


def test_read_back_awkward_conversations(spark):
    turns = [(1, 1, "assistant", "b</s>"), (1, 0, "user", "a"), (1, 1, "assistant", "b</s>"), (None, None, None, None), (None, 0, "assistant", "é\\"), (3, 0, "assistant", "")]
    messages = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("parts", chat_parts.text_part(F.col("text")))
    got = {r.conv_id: r for r in chat_parts.read_back(chat_parts.format_turns(messages)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].n_turns == 3 and got[1].turns_sha256 == sha("user\na\nassistant\nb</s>\nassistant\nb</s>\n")
    assert got[1].loss_sha256 == sha("b</s>b</s>") and got[1].loss_chars == 10
    assert got[None].n_turns == 2 and got[None].loss_sha256 == sha("é\\")
    assert got[3].loss_chars == 0 and len(got) == 3
    assert chat_parts.read_back(chat_parts.format_turns(messages.limit(0))).count() == 0


@given(st.text(), st.text())
@settings(max_examples=200, deadline=None)
def test_escapes_are_reversible(role, text):
    escaped = [re.sub(r"([\\<\[])", r"\\\1", x) for x in (role, text)]
    assert chat_parts.parse(f"<s>[INST]{escaped[0]}[/INST]{escaped[1]}</s>") == (role, text)
