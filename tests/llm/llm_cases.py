"""Small awkward tables that every operator has to stand."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, label int, component_id bigint, id bigint, bucket string"


def sentence(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def rows(seed=3):
    """Nulls in every column, empty and very long texts, ties, repeated rows, near and exact copies."""
    rng = random.Random(seed)
    base = sentence(rng, 120)
    near = base.split()
    near[60] = "changed"
    texts = [
        (1, base), (2, base), (3, " ".join(near)), (4, base.upper()), (5, None), (6, ""), (7, " \t\n "), (8, "one"), (9, "one two"),
        (10, "ONE  two"), (11, sentence(rng, 30000)), (12, "x" * 200_000), (13, "é" * 300 + " " + sentence(rng, 80)), (None, base), (None, None),
        (14, "line a b\n" * 40), (15, "*** ### " * 60), (16, "GREAT NEWS!! " * 40),
    ]
    texts += [(100 + k, sentence(rng, 60 + k)) for k in range(20)]
    texts += [(20, "same words here"), (20, "same words here")]
    out = []
    for k, (doc_id, text) in enumerate(texts):
        out.append((doc_id, text, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"src{k % 3}", None if text is None else len(text), 0.5, k % 2, None, 7, "b"))
    return out


def docs(spark, seed=3):
    return spark.createDataFrame(rows(seed), DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, seed=3):
    pairs = [(r[0], (k % 3 > 0) * 1, (k % 4 == 0) * 1, None) for k, r in enumerate(rows(seed))] + [(101, None, None, 1), (None, 1, 1, 1), (999, 1, 0, 1), (102, 1, 0, 1), (102, 0, 1, 1)]
    return spark.createDataFrame(pairs, "doc_id bigint, quality int, toxic int, id int")


def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int, id int")
