"""Calibrated confidences against pool-adjacent-violators by hand, and languages from letters."""

import random

import pytest
from pyspark.sql import functions as F

from faqspark import fixtures as fx
from faqspark.operators import calibration, classify, languages

GOLDEN = "confidence double, predicted boolean, labelled boolean"


def pooled(rows):
    """Blocks of equal value, merged while one falls below the one before."""
    steps = {}
    for confidence, predicted, labelled in rows:
        if None not in (confidence, predicted, labelled):
            steps.setdefault(round(min(1, max(0, confidence)), 3), []).append(predicted == labelled)
    blocks = []
    for confidence, right in sorted(steps.items()):
        blocks.append([sum(right), len(right), [confidence]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] > blocks[-1][0] / blocks[-1][1]:
            top = blocks.pop()
            blocks[-1] = [blocks[-1][0] + top[0], blocks[-1][1] + top[1], blocks[-1][2] + top[2]]
    return {c: right / n for right, n, at in blocks for c in at}


@pytest.mark.parametrize("seed", [1, 2])
def test_calibration_is_the_pooled_fit(spark, seed):
    r = random.Random(seed)
    rows = [(r.choice([0.05, 0.1, 0.2, 0.35, 0.5, 0.6, 0.75, 0.8, 0.95, 1.5]), r.random() < 0.5, r.random() < 0.6) for _ in range(120)]
    rows += [(None, True, True), (0.2, None, True), (0.2, True, None), (-3.0, True, False)]
    table = calibration.calibration(spark.createDataFrame(rows, GOLDEN))
    got = {row["confidence"]: row["calibrated"] for row in table.collect()}
    want = pooled(rows)
    assert got.keys() == want.keys() and all(got[c] == pytest.approx(want[c], abs=1e-12) for c in want)
    values = [got[c] for c in sorted(got)]
    assert values == sorted(values)
    asked = spark.createDataFrame([(c,) for c in (-1.0, 0.0, 0.07, 0.5, 0.7499, 0.99, 2.0, None, float("nan"))], "c double")
    for c, value in asked.select("c", calibration.calibrated(table, F.col("c"))).collect():
        if c is None or c != c:
            assert value is None
        else:
            below = [k for k in want if k <= round(min(1, max(0, c)), 3)]
            assert value == pytest.approx(want[max(below, default=min(want))], abs=1e-12)


def test_band_and_second_opinion(spark):
    rows = [(0.55, False, i < 6) for i in range(10)] + [(0.7, True, i < 7) for i in range(10)] + [(0.9, True, True)] * 5
    table = calibration.calibration(spark.createDataFrame(rows, GOLDEN))
    assert calibration.uncertain_band(table, 0.8) == (0.55, 0.7)
    assert calibration.uncertain_band(table, 0.8, 0.5) == (0.7, 0.7)
    assert calibration.uncertain_band(table, 0.1) is None
    texts = spark.createDataFrame([(1, "how do I do this and why"), (2, "nothing"), (3, "is it open?")], "id int, text string")
    second = {r["id"]: r["verdict"]["llm_model"] for r in calibration.calibrated_two_stage(texts, table, wanted=0.8, hopeless=0.5).collect()}
    first = {r["id"]: r["verdict"] for r in classify.classify(texts).collect()}
    redone = {i for i, v in first.items() if 0.7 <= v["confidence"] < 0.9}
    assert redone and {i for i, model in second.items() if model != first[i]["llm_model"]} == redone


def test_empty_golden_set_changes_nothing(spark):
    table = calibration.calibration(spark.createDataFrame([], GOLDEN))
    assert table.count() == 0 and calibration.uncertain_band(table) is None
    texts = spark.createDataFrame([("nothing",), (None,)], "text string")
    assert calibration.calibrated_two_stage(texts, table).count() == 2


def test_languages_of_texts_not_learned_from(spark, sf):
    texts = fx.documents(spark, "/root/testdata/sf0.01")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    profiles = languages.language_profiles(texts.where(~held_out))
    found = languages.with_language(texts.where(held_out), profiles).where("lang IS NOT NULL")
    total, right, wrong = found.agg(
        F.count("*"), F.count_if(F.col("found_lang") == F.col("lang")), F.count_if(F.col("found_lang") != F.col("lang"))).first()
    assert total > 100 and right >= 0.95 * total and wrong <= 0.02 * total


def test_unknown_stays_unknown(spark):
    known = spark.createDataFrame([
        ("de", "der hund und die katze laufen durch das haus " * 3), ("en", "the dog and the cat run through the house " * 3),
        ("en", None), ("fr", ""), (None, "the dog")], "lang string, text string")
    profiles = languages.language_profiles(known)
    assert {r["lang"] for r in profiles.collect()} <= {"de", "en", "fr"}
    asked = [("The Cat, the DOG!", "en"), ("die Katze und der Hund", "de"), ("", None), (None, None), ("12 + 34", None), ("我们今天去公园散步吧", None),
             ("x", None), ("the house " * 40_000, "en")]
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(asked)], "i int, text string").withColumn("found_lang", F.lit("old"))
    got = {r["i"]: r["found_lang"] for r in languages.with_language(df, profiles).collect()}
    assert got == {i: lang for i, (_, lang) in enumerate(asked)}
    nothing = languages.language_profiles(known.where("lang IS NULL"))
    assert {r["found_lang"] for r in languages.with_language(df, nothing).collect()} == {None}


def test_stretches_do_not_cut_threes(spark, monkeypatch):
    text = " der hund läuft "
    whole = [c for cells in languages._threes(text) for c in cells]
    monkeypatch.setattr(languages, "STRETCH", 3)
    assert [c for cells in languages._threes(text) for c in cells] == whole and len(whole) == len(text) - 2
