"""Near duplicates against exact sets and components."""

import random

import pytest
from llm_cases import docs, empty, rows
from pyspark.sql import functions as F

from faqspark.llm import near_dedup
from faqspark.llm.components import components

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = (text or "").translate(FOLD).split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(table):
    """doc_id -> (set size, component) by comparing all pairs of distinct sets."""
    sets = {}
    for key, text in table:
        if key is not None and (s := shingle_set(text)):
            sets.setdefault(s, []).append(key)
    heads = {s: min(keys) for s, keys in sets.items()}
    root = {h: h for h in heads.values()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    every = list(heads.items())
    for i, (s, a) in enumerate(every):
        for t, b in every[:i]:
            if 4 * min(len(s), len(t)) >= 3 * max(len(s), len(t)):
                common = len(s & t)
                if 100 * common >= 75 * (len(s) + len(t) - common):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {key: (len(shingle_set(t)), find(heads[shingle_set(t)]) if shingle_set(t) else key) for key, t in table if key is not None}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect() if r.doc_id is not None}


def copies(rng, n_groups, n_members, length, edits):
    table, key = [], 0
    for _ in range(n_groups):
        base = [f"t{rng.randrange(3000)}" for _ in range(length)]
        for _ in range(n_members):
            words = list(base)
            for _ in range(rng.randrange(edits)):
                words[rng.randrange(length)] = f"u{rng.randrange(10**6)}"
            table.append((key, " ".join(words)))
            key += 1
    return table


def test_awkward_rows(spark):
    got = near_dedup.near_duplicates(docs(spark))
    assert got.count() == len(rows())
    assert result(got) == brute([r[:2] for r in rows()])
    lost = got.where("doc_id IS NULL").collect()
    assert len(lost) == 2 and all(r.component_id is None and r.kept for r in lost)


def test_empty_table(spark):
    assert near_dedup.near_duplicates(empty(spark)).count() == 0
    assert near_dedup.without_near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("groups, members, length, edits", [(1, 300, 120, 9), (60, 6, 90, 8)])
def test_near_copies_around_the_threshold(spark, groups, members, length, edits):
    table = copies(random.Random(5), groups, members, length, edits)
    got = near_dedup.near_duplicates(spark.createDataFrame(table, "doc_id bigint, text string").repartition(4))
    assert result(got) == brute(table)


def test_crowded_regions_go_deeper_and_lose_nothing(spark, monkeypatch):
    """Many texts that share half of their words with all others, and a few pairs among them."""
    rng = random.Random(8)
    shared = [f"s{k}" for k in range(60)]
    table = [(k, " ".join(shared + [f"o{rng.randrange(10**6)}" for _ in range(40)])) for k in range(150)]
    for k in range(0, 150, 10):
        words = table[k][1].split()
        words[-1] = "x"
        table.append((1000 + k, " ".join(words)))
    monkeypatch.setattr(near_dedup, "CROWD", 2)
    levels = []
    compared = near_dedup._compared
    monkeypatch.setattr(near_dedup, "_compared", lambda *a: levels.append(a[-1]) or compared(*a))
    got = near_dedup.near_duplicates(spark.createDataFrame(table, "doc_id bigint, text string").repartition(4))
    assert result(got) == brute(table)
    assert len(levels) > 1


def test_one_document_of_each_group_stays_with_all_its_columns(spark):
    kept = near_dedup.without_near_duplicates(docs(spark))
    assert kept.columns == docs(spark).columns
    ids = sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect())
    truth = brute([r[:2] for r in rows()])
    assert ids == sorted(k for k, (_, c) in truth.items() if k == c)
    assert kept.where("doc_id IS NULL").count() == 2


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r.id: r.component_id for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)}


def test_stage_keeps_columns_of_any_name_and_the_smallest_text(spark):
    table = docs(spark).withColumns({n: F.lit(1) for n in ("gone0", "Many0", "place0", "_dropped_id", "k", "count")})
    twice = table.unionByName(table.where("doc_id = 101").withColumn("text", F.lit("a smaller text")))
    kept = near_dedup.without_near_duplicates(twice)
    assert kept.columns == table.columns and kept.where("place0 != 1").count() == 0
    ids = [r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()]
    assert len(ids) == len(set(ids)) and kept.where("doc_id IS NULL").count() == 2
    assert kept.where("doc_id = 101").first().text == "a smaller text"
