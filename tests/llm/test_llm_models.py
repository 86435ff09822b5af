"""The two trained text classifiers: held-out accuracy, method, awkward rows."""

import numpy as np
import pytest
from llm_cases import docs, empty, labels, no_labels, rows
from pyspark.sql import functions as F

from faqspark.llm import pu_quality, toxicity


@pytest.fixture(scope="module")
def tables(spark):
    d = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")


def accuracy(scored, labels, column):
    both = scored.where("held_out").join(labels.select("doc_id", column), "doc_id")
    return both.selectExpr(f"avg(cast(predicted = {column} as int))").first()[0]


def test_toxicity_held_out(tables):
    assert accuracy(toxicity.toxicity_scores(*tables), tables[1], "toxic") > 0.97


def test_quality_held_out(tables):
    assert accuracy(pu_quality.quality_scores(*tables), tables[1], "quality") > 0.97


@pytest.mark.parametrize("score", [toxicity.toxicity_scores, pu_quality.quality_scores])
def test_awkward_rows(spark, score):
    got = score(docs(spark), labels(spark)).collect()
    assert len(got) == len(rows())
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert all(r.held_out for r in got if r.doc_id is None)
    blank = {r.score for r in got if r.doc_id in (5, 6, 7)}
    assert len(blank) == 1


@pytest.mark.parametrize("score", [toxicity.toxicity_scores, pu_quality.quality_scores])
def test_nothing_to_learn_from(spark, score):
    assert score(docs(spark), no_labels(spark)).count() == len(rows())
    assert score(empty(spark), labels(spark)).count() == 0


def test_toxic_rows_go_and_columns_stay(spark):
    kept = toxicity.without_toxic(docs(spark), no_labels(spark))
    assert kept.columns == docs(spark).columns and kept.count() == len(rows())


def test_swaps_change_only_group_terms():
    found = list(toxicity.swaps("Nice day. Those women sing! Men too."))
    assert ("Those women sing!", "Those people sing!") in found and ("Those women sing!", "Those men sing!") in found
    assert all("Nice" not in a for a, _ in found)


def test_one_long_document_cannot_fill_all_swaps(spark, monkeypatch):
    """The first document has more mentions of one group than there are swaps; other documents name another."""
    long = "The women sing. " * 300
    table = [(k, long if k < 4 else f"w{k} the hindus cook." if k % 2 else "such trash") for k in range(200)]
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda label, buckets, changed: seen.append((len(label), changed)))
    frame = spark.createDataFrame(table, "doc_id bigint, text string").coalesce(1)
    marks = spark.createDataFrame([(k, k % 2) for k, _ in table], "doc_id bigint, toxic int")
    toxicity.train(frame, marks, max_swaps=40)
    assert seen[0][0] > 100 and len(seen[0][1]) == 40
    hindu = set(encoded(["hindus"])[0].tolist())
    assert sum(bool(hindu & set(before.tolist())) for before, _ in seen[0][1]) >= 20


def encoded(texts):
    row, bucket = toxicity.present(__import__("pyarrow").array(texts))
    return [bucket[row == k].astype(np.int32) for k in range(len(texts))]


@pytest.mark.parametrize("before, term, after", [
    ("今天天气很好我们一起去公园散步", "垃圾白痴", "然后回家吃饭"), ("a-very-long_joined/run-of-words-without-blanks-", "idiot", "-and-more"),
    ("one\u00a0run\u00a0held\u00a0by\u00a0hard\u00a0blanks\u00a0", "idiot", "\u00a0on"), ("not-an-", "idiot", "-hm"), ("很好的", "垃圾", "东西")])
def test_a_term_late_in_an_unspaced_run_changes_the_score(before, term, after):
    toxic = [f"w{k} {term} w{k + 1}" for k in range(60)]
    clean = [f"w{k} fine w{k + 1}" for k in range(60)]
    model = toxicity.fit(np.array([1.0] * 60 + [0.0] * 60), encoded(toxic + clean), [])
    scores = model.score(__import__("pyarrow").array([before + after, before + term + after, before + "fine" + after]))
    assert scores[1] > 0.5 and scores[1] > scores[0] + 0.1 and scores[1] > scores[2] + 0.1


def test_every_byte_of_a_long_word_counts():
    for n in (40, 5000, 3_000_000):
        one, two, three = encoded(["x" * n + "a" + "x" * 9, "x" * n + "b" + "x" * 9, "x" * n + "xa" + "x" * 9])
        assert set(one.tolist()) != set(two.tolist()) and set(one.tolist()) != set(three.tolist())


def test_features_do_not_depend_on_the_rows_beside():
    texts = ["a-bcde", "fghi-j", "很好的东西" * 9, "x" * 30, "x" * 30 + "-y", "z" * 5000 + "q", "", "--", "今天-天气"]
    for together, alone in zip(encoded(texts), (encoded([t])[0] for t in texts)):
        assert together.tolist() == alone.tolist()


def test_counterfactual_penalty_protects_neutral_mentions():
    """Abuse in the sample names one group; without the penalty a neutral mention looks abusive."""
    toxic = ["those women are scum and trash"] * 30 + ["the women sing badly"] * 10
    clean = ["the weather is fine"] * 30 + ["music and trees are nice"] * 30
    label = np.array([1.0] * len(toxic) + [0.0] * len(clean))
    pairs = [p for t in toxic for p in toxicity.swaps(t)]
    changed = []
    for before, after in pairs:
        x, y = (set(e.tolist()) for e in encoded([before, after]))
        changed.append((np.array(sorted(x - y)), np.array(sorted(y - x))))
    texts = __import__("pyarrow").array(["women like music", "people like music", "scum and trash"])
    plain = toxicity.fit(label, encoded(toxic + clean), changed, fairness=0.0).score(texts)
    fair = toxicity.fit(label, encoded(toxic + clean), changed, fairness=50.0).score(texts)
    assert abs(fair[0] - fair[1]) < 0.3 * abs(plain[0] - plain[1])
    assert fair[2] > 0.5


def test_prior_and_non_negative_risk():
    rng = np.random.default_rng(1)
    positive = rng.normal(1.5, 1, (3000, 2))
    unlabelled = np.concatenate([rng.normal(1.5, 1, (1800, 2)), rng.normal(-1.5, 1, (1200, 2))])
    apart = pu_quality.fit_apart(positive, unlabelled)
    bins = np.linspace(0, 1, 101)
    prior = pu_quality.class_prior(*(np.histogram(apart.score(x), bins)[0] for x in (positive, unlabelled)))
    assert abs(prior - 0.6) < 0.06
    net = pu_quality.fit_non_negative(positive, unlabelled, prior)
    assert (net.score(rng.normal(1.5, 1, (500, 2))) > 0.5).mean() > 0.93
    assert (net.score(rng.normal(-1.5, 1, (500, 2))) < 0.5).mean() > 0.93


@pytest.mark.parametrize("n, every", [(400, 80), (400, 133), (40, 2), (3, 1)])
def test_labels_that_nothing_tells_reject_nothing(spark, n, every):
    """Texts have nothing to do with their labels, of which few, half or all are toxic."""
    frame = spark.createDataFrame([(k, f"own{k} text{k}") for k in range(n)], "doc_id bigint, text string").withColumn("toxicity0", F.lit(1))
    marks = spark.createDataFrame([(k, int(k % every == 0)) for k in range(n)], "doc_id bigint, toxic int")
    kept = toxicity.without_toxic(frame, marks)
    assert kept.columns == frame.columns and kept.count() == n


def test_texts_without_telling_words_score_the_labelled_share():
    toxic, clean = [f"w{k} vile scum" for k in range(20)], [f"w{k} kind bloom" for k in range(60)]
    model = toxicity.fit(np.array([1.0] * 20 + [0.0] * 60), encoded(toxic + clean), [])
    score = model.score(__import__("pyarrow").array(["unknown", "", None, "vile scum", "kind bloom"]))
    assert score[:3] == pytest.approx([0.25] * 3) and score[3] > 0.9 and score[4] < 0.1


@pytest.mark.parametrize("sentence, term", [("Aquellas mujeres cantan.", "hombres"), ("Cette femme chante.", "homme"), ("Die Juden singen.", "jüdinnen")])
def test_swaps_in_other_languages(sentence, term):
    assert any(term in after.lower() for _, after in toxicity.swaps(sentence))


def plain_loss_slope(label, buckets, moves, fairness, ridge, weight, bias):
    """The documented loss, and its slope by differences."""
    share = label.mean()

    def loss(w, b):
        z = np.array([sum(w[k] for k in some) + b for some in buckets])
        p = 1 / (1 + np.exp(-z))
        fit = -np.mean(np.where(label == 1, 0.5 / share * np.log(p), 0.5 / (1 - share) * np.log(1 - p)))
        change = np.mean([(sum(w[k] for k in gained) - sum(w[k] for k in lost)) ** 2 for lost, gained in moves]) if moves else 0.0
        return fit + fairness * change + ridge * (w**2).sum() / len(w) ** 0.5

    h = 1e-5
    own = loss(weight, bias)
    return own, [(loss(weight + h * np.eye(len(weight))[k], bias) - own) / h for k in range(len(weight))] + [(loss(weight, bias + h) - own) / h]


def test_fit_minimises_the_documented_loss():
    """The weights found are a minimum of the loss written out plainly: no direction improves it by much."""
    texts = [f"{a} {b}" for a in ("vile", "scum") for b in ("women", "men")] * 6 + [f"{a} {b}" for a in ("kind", "calm") for b in ("women", "people")] * 9
    label = np.array([1.0] * 24 + [0.0] * 36)
    buckets = encoded(texts)
    pairs = [p for t in texts for p in toxicity.swaps(t)][:40]
    before, after = (encoded([p[k] for p in pairs]) for k in (0, 1))
    changed = [(np.setdiff1d(x, y), np.setdiff1d(y, x)) for x, y in zip(before, after)]
    model = toxicity.fit(label, buckets, changed, steps=3000)
    own = lambda some: [int(k) for k in model.slot[some] if k >= 0]
    value, slope = plain_loss_slope(label, [own(b) for b in buckets], [(own(x), own(y)) for x, y in changed], 4.0, 1e-3, model.weight, model.bias)
    worse, _ = plain_loss_slope(label, [own(b) for b in buckets], [(own(x), own(y)) for x, y in changed], 4.0, 1e-3, model.weight * 0, 0.0)
    assert value < worse and max(abs(g) for g in slope) < 2e-2
