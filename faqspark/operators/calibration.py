"""How often verdicts of a given confidence are right, and which of them deserve a second opinion."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from faqspark.operators import classify
from faqspark.runtime import stored

# Digits that confidences are told apart by, so a map has at most 10 ** DIGITS + 1 rows.
DIGITS = 3


def _step(confidence: Column) -> Column:
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), confidence.cast("double"))), DIGITS)


def calibration(golden: DataFrame) -> DataFrame:
    """``confidence, n, rate, calibrated`` from a golden set (``confidence``, ``predicted`` and ``labelled``, both boolean).

    ``rate`` is the share of right verdicts at a confidence, ``calibrated`` the non-decreasing step function nearest to the rates by
    squares weighted with ``n``: isotonic regression. Rows are counted per confidence, map-side, before anything is fitted,
    so the fit sees a bounded table however large the golden set is. Confidences are taken between 0 and 1,
    in steps of a thousandth; rows with a null in any of the three columns tell nothing. An empty golden set gives an empty map.
    """
    told = golden.where("confidence IS NOT NULL AND NOT isnan(confidence) AND predicted IS NOT NULL AND labelled IS NOT NULL")
    steps = told.groupBy(_step(F.col("confidence")).alias("confidence")).agg(
        F.count("*").alias("n"), F.avg((F.col("predicted") == F.col("labelled")).cast("double")).alias("rate"))
    # Bounded by DIGITS; written out, as the fit and the result read it.
    steps = stored(steps.coalesce(1), "confidences")
    if steps.isEmpty():
        return steps.select("*", F.lit(None).cast("double").alias("calibrated"))
    points = VectorAssembler(inputCols=["confidence"], outputCol="at").transform(steps)
    model = IsotonicRegression(featuresCol="at", labelCol="rate", weightCol="n", predictionCol="calibrated").fit(points)
    return model.transform(points).drop("at")


def calibrated(table: DataFrame, confidence: Column | None = None) -> Column:
    """Value of the map at the next confidence at or below ``confidence``, else at the lowest; null for null, or without a map.

    The map is bounded, so a row finds its value in itself, in a literal table of steps, without an exchange.
    """
    confidence = F.col("verdict.confidence") if confidence is None else confidence
    known = sorted((row["confidence"], row["calibrated"]) for row in table.select("confidence", "calibrated").collect())
    if not known:
        return F.lit(None).cast("double")
    # Only where the function rises does a step begin.
    rises = [known[0], *(now for before, now in zip(known, known[1:]) if now[1] != before[1])]
    at, value = (F.array(*map(F.lit, column)) for column in zip(*rises))
    below = F.size(F.filter(at, lambda x: x <= _step(confidence)))
    return F.when(confidence.isNotNull() & ~F.isnan(confidence), F.get(value, F.greatest(below - 1, F.lit(0))))


def uncertain_band(table: DataFrame, wanted: float = 0.9, hopeless: float = 0.0) -> tuple[float, float] | None:
    """Lowest and highest confidence of the map whose verdicts are right less often than ``wanted``, yet not less than ``hopeless``.

    The map rises, so all confidences between them are such. None if there are no such.
    """
    found = table.where((F.col("calibrated") < wanted) & (F.col("calibrated") >= hopeless)).agg(
        F.min("confidence").alias("low"), F.max("confidence").alias("high")).first()
    return None if found["low"] is None else (found["low"], found["high"])


def calibrated_two_stage(
    df: DataFrame, table: DataFrame, text: str = "text", role: str | None = None, wanted: float = 0.9, hopeless: float = 0.0,
    second: classify.Classifier | None = None,
) -> DataFrame:
    """``two_stage`` with the band that a golden set gives, in place of fixed limits; without a map all first verdicts stand."""
    value = calibrated(table)
    unsure = F.coalesce((value < wanted) & (value >= hopeless), F.lit(False))
    return classify.two_stage(df, text, role, second=second, unsure=unsure)
