"""Question classification and its bookkeeping."""

from __future__ import annotations

import logging
import sys
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from faqspark.functions import verdicts as V
from faqspark.functions.text import strip
from faqspark.schemas import VERDICT

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Classifier = Callable[[DataFrame, str], DataFrame]
MAX_BATCH = 16
# Waits before the second and the third attempt, in seconds.
WAITS = (1.0, 2.0)
log = logging.getLogger(__name__)


def classify(df: DataFrame, text: str = "text", role: str | None = None) -> DataFrame:
    """Add a ``verdict`` column from the rule model; texts must be masked already."""
    ruled = df.withColumn("_rule", V.rule_number(F.col(text), F.col(role) if role else None))
    return ruled.withColumn("verdict", V.rule_verdict(F.col("_rule"), F.col(text))).drop("_rule")


def model_classifier(
    load: Callable[[], Callable[[list[str]], list[dict]]], model: str, batch: int = MAX_BATCH,
    waits: tuple[float, ...] = WAITS,
) -> Classifier:
    """Wrap a model that maps an ordered list of texts to an ordered list of verdict dicts.

    ``load`` runs once per Python worker and batches stream through. A call that fails, or returns
    another number of answers than it got texts, is logged and tried again after each wait: three
    attempts by default. One that never succeeds leaves no answer, which becomes the failure
    record while all other rows go on. The result has a column ``attempts`` beside ``verdict``.
    """
    names = VERDICT.names
    answer_type = T.StructType([*VERDICT.fields, T.StructField("attempts", T.IntegerType())])

    @F.pandas_udf(answer_type)
    def call(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = load()
        for column in columns:
            texts, rows = column.tolist(), []
            for start in range(0, len(texts), batch):
                part = texts[start:start + batch]
                answers: list[dict] = [{}] * len(part)
                for attempt, wait in enumerate((0.0, *waits), 1):
                    time.sleep(wait)
                    began = time.monotonic()
                    try:
                        got = predict(part)
                        if len(got) != len(part):
                            raise ValueError(f"{len(got)} answers to {len(part)} texts")
                        answers = got
                        break
                    except Exception as failure:
                        log.warning("attempt %d of model %s failed: %r", attempt, model, failure)
                spent = int(1000 * (time.monotonic() - began) / max(1, len(part)))
                rows += [
                    {**dict.fromkeys(names), "attempts": attempt}
                    | ({"llm_model": model, "latency_ms": spent, **a} if a else {})
                    for a in answers
                ]
            yield pd.DataFrame(rows, columns=answer_type.names)

    def score(df: DataFrame, text: str) -> DataFrame:
        answered = df.withColumn("_answer", call(F.col(text)))
        verdict = F.struct(*[F.col(f"_answer.{name}").alias(name) for name in names])
        present = F.when(F.col("_answer.llm_model").isNotNull(), verdict)
        counted = answered.withColumns({"verdict": present, "attempts": F.col("_answer.attempts")}).drop("_answer")
        return normalize(counted, "verdict", model)

    return score


def two_stage(
    df: DataFrame, text: str = "text", role: str | None = None, low: float = 0.5, high: float = 0.75,
    second: Classifier | None = None, unsure: Column | None = None,
) -> DataFrame:
    """First model for all rows, second model only inside the band ``low <= confidence <= high``, or where ``unsure`` holds.

    With the built-in second model the choice is one CASE in the same pass; a plugged-in one
    gets its rows by filter, so it never sees the others.
    """
    first = classify(df, text, role)
    unsure = F.col("verdict.confidence").between(low, high) if unsure is None else unsure
    if second is None:
        return first.withColumn(
            "verdict", F.when(unsure, V.cue_count_verdict(F.col(text))).otherwise(F.col("verdict"))
        )
    redo = second(first.where(unsure).drop("verdict"), text)
    return first.where(~unsure).unionByName(redo)


def memoized(
    df: DataFrame, text: str, score: Classifier, model: str = V.MODEL, known: DataFrame | None = None
) -> DataFrame:
    """Score each distinct text once and hand the verdict to every row with that text.

    Copies collapse map-side before the exchange. ``known`` holds verdicts of earlier runs
    (``text_key``, ``verdict``); those texts are not scored again.
    """
    keyed = df.withColumn("text_key", F.concat_ws(":", F.sha2(F.col(text), 256), F.lit(model)))
    todo = keyed.select("text_key", text).distinct()
    if known is not None:
        todo = todo.join(known.select("text_key"), "text_key", "left_anti")
    scored = score(todo, text).select("text_key", "verdict")
    if known is not None:
        scored = scored.unionByName(known.select("text_key", "verdict"))
    return keyed.join(scored, "text_key", "left")


def normalize(df: DataFrame, verdict: str = "verdict", model: str = V.MODEL) -> DataFrame:
    """Bring a model's verdicts into the contract, failures included."""
    return df.withColumn(verdict, V.normalized_verdict(F.col(verdict), model))


def verdict_metrics(df: DataFrame, group: str = "course_id", attempts: str | None = None) -> DataFrame:
    """Counters per course and model; no message text in the result."""
    v = F.col("verdict")
    tries = F.col(attempts) if attempts else F.lit(1)
    return df.groupBy(group, v["llm_model"].alias("llm_model")).agg(
        F.count("*").alias("total"),
        F.count_if(v["reason"] != "llm_error").alias("success"),
        F.count_if(tries > 1).alias("retried"),
        F.count_if(v["reason"] == "llm_error").alias("failed"),
        F.count_if(v["is_question"]).alias("questions"),
        F.avg(v["latency_ms"]).alias("avg_latency_ms"),
        F.avg(v["confidence"]).alias("avg_confidence"),
    )


def top_titles(df: DataFrame, n: int = 10) -> DataFrame:
    """Most frequent question titles."""
    titles = df.where(F.col("verdict.is_question")).groupBy(F.col("verdict.title").alias("title")).agg(
        F.count("*").alias("n")
    )
    return titles.orderBy(F.desc("n"), "title").limit(n)


def golden_eval(scored: DataFrame) -> DataFrame:
    """Confusion counts and rates of ``predicted`` against ``labelled`` (both boolean).

    Join the labels first and score what is left: the golden set is a small part of the data.
    """
    p, t = F.col("predicted"), F.col("labelled")
    counts = scored.agg(
        F.count("*").alias("n"),
        F.count_if(p & t).alias("tp"), F.count_if(p & ~t).alias("fp"),
        F.count_if(~p & t).alias("fn"), F.count_if(~p & ~t).alias("tn"),
    )

    def rate(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom)

    return counts.select(
        "*",
        rate(F.col("tp") + F.col("tn"), F.col("n")).alias("accuracy"),
        rate(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        rate(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
    )


def questions_by_language(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Questions per language, each language with its own question words."""
    low = F.lower(strip(F.col(text)))
    asks = F.col(text).contains("?")
    for code, cue in V.LANGUAGE_CUES:
        asks = asks | ((F.col(lang) == code) & low.rlike(cue))
    return df.groupBy(F.col(lang).alias("lang")).agg(
        F.count("*").alias("total"), F.count_if(asks).alias("questions")
    )
