"""Quality classifier learnt from trusted positives and unlabelled web text.

Only texts labelled good and texts without a label are used. First a logistic model tells the two apart;
the class prior is the smallest ratio of unlabelled to positive mass above one of its thresholds, counted
over all rows. Then a small network minimises the non-negative unbiased risk for that prior: the risk on the
inferred negatives may not fall below zero, where the network would only learn the positives by heart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from faqspark.llm.folds import first_by_hash, held_out, label_table
from faqspark.llm.store import Saved
from faqspark.llm.words import Words, slices

#: Trusted positives and unlabelled texts that the models are fitted on, at most, each.
MAX_TRAIN = 10_000
#: Score bins of the prior's histogram; a threshold counts if this share of the positives lies above it.
BINS, LEAST_SHARE = 200, 0.5

_CLASSES = {
    "capital": range(ord("A"), ord("Z") + 1), "small": range(ord("a"), ord("z") + 1), "digit": range(ord("0"), ord("9") + 1),
    "symbol": b"#*$%&|<>", "loud": b"!?", "stop": b".,;:", "wide": range(128, 256), "line": b"\n", "mark": b"\"'()[]{}/\\_=+-@^~`",
}
_MEMBER = {name: np.isin(np.arange(256), list(codes)) for name, codes in _CLASSES.items()}
N_FEATURES = 2 + len(_CLASSES) + 6


def figures(column: pa.Array) -> np.ndarray:
    """Style figures of whole texts, a row each: size, byte classes per byte, variety and repetition of words and lines."""
    words = Words(column)
    n_bytes = np.diff(words.offsets)
    n = words.count
    found = [np.log1p(n), np.log1p(n_bytes / np.maximum(n, 1))]
    exact = Words(column, lower=False).data
    for member in _MEMBER.values():
        total = np.concatenate([[0], np.cumsum(member[exact])])
        found.append((total[words.offsets[1:]] - total[words.offsets[:-1]]) / np.maximum(n_bytes, 1))
    own, most, pairs, again, short = (np.zeros(len(n)) for _ in range(5))
    size = words.end - words.start
    two = words.hash[:-1] * np.uint64(0x9E3779B97F4A7C15) + words.hash[1:]
    for r in np.flatnonzero(n):
        low, high = words.first[r], words.first[r + 1]
        counts = np.unique(words.hash[low:high], return_counts=True)[1]
        own[r], most[r] = len(counts) / n[r], counts.max() / n[r]
        if n[r] > 1:
            pairs[r] = len(np.unique(two[low : high - 1])) / (n[r] - 1)
            again[r] = (words.hash[low : high - 1] == words.hash[low + 1 : high]).mean()
        short[r] = (size[low:high] <= 2).mean()
    found += [own, own * np.log1p(n), most, pairs, again, short]
    return np.stack(found, axis=1).astype(np.float32)


def _figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = figures(batch.column("text"))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([r.tobytes() for r in rows], pa.binary())], names=["doc_id", "x"])


def figure_table(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text").mapInArrow(_figures, "doc_id bigint, x binary")


def matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, N_FEATURES).astype(float)


@dataclass
class Network:
    """Standardised inputs, one hidden layer of tanh units (none for a linear model), one logit."""

    centre: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -6, 6)

    def forward(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.layers) == 2:
            return z, z @ self.layers[0] + self.layers[1]
        hidden = np.tanh(z @ self.layers[0] + self.layers[1])
        return hidden, hidden @ self.layers[2] + self.layers[3]

    def slopes(self, z: np.ndarray, hidden: np.ndarray, gap: np.ndarray) -> list[np.ndarray]:
        last = [hidden.T @ gap, np.array(gap.sum())]
        if len(self.layers) == 2:
            return last
        back = np.outer(gap, self.layers[2]) * (1 - hidden**2)
        return [z.T @ back, back.sum(axis=0), *last]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(self._inputs(x))[1], -40, 40)))


def _network(x: np.ndarray, hidden: int) -> Network:
    random = np.random.default_rng(7)
    layers = [random.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), random.normal(0, 1 / np.sqrt(hidden), hidden), np.array(0.0)] if hidden else [
        np.zeros(x.shape[1]), np.array(0.0)]
    return Network(x.mean(axis=0), x.std(axis=0) + 1e-6, layers)


def _sigmoid(f: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(f, -40, 40)))


def _descend(net: Network, slopes_at, steps: int, rate: float, ridge: float = 1e-4) -> Network:
    mean, square = ([np.zeros_like(w) for w in net.layers] for _ in range(2))
    for step in range(1, steps + 1):
        for k, slope in enumerate(slopes_at()):
            slope = slope + ridge * net.layers[k]
            mean[k], square[k] = 0.9 * mean[k] + 0.1 * slope, 0.99 * square[k] + 0.01 * slope**2
            net.layers[k] = net.layers[k] - rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-9)
    return net


def fit_apart(positive: np.ndarray, unlabelled: np.ndarray, hidden: int = 4, steps: int = 80) -> Network:
    """A model that tells positive from unlabelled texts, both with weight one half."""
    x = np.concatenate([positive, unlabelled])
    y = np.concatenate([np.ones(len(positive)), np.zeros(len(unlabelled))])
    weight = np.concatenate([np.full(len(positive), 0.5 / len(positive)), np.full(len(unlabelled), 0.5 / len(unlabelled))])
    net = _network(x, hidden)
    z = net._inputs(x)

    def slopes():
        hidden_out, f = net.forward(z)
        return net.slopes(z, hidden_out, weight * (_sigmoid(f) - y))

    return _descend(net, slopes, steps, 0.02)


def fit_non_negative(positive: np.ndarray, unlabelled: np.ndarray, prior: float, *, hidden: int = 16, steps: int = 400) -> Network:
    """Minimise prior * risk of positives as positive + max(0, risk of unlabelled as negative - prior * risk of positives as negative).

    The loss is logistic. In steps where the second part is below zero, its slope is taken the other way.
    """
    x = np.concatenate([positive, unlabelled])
    net = _network(x, hidden)
    z, p = net._inputs(x), len(positive)

    def slopes():
        hidden_out, f = net.forward(z)
        s = _sigmoid(f)
        as_negative = np.logaddexp(0, f)
        inferred = as_negative[p:].mean() - prior * as_negative[:p].mean()
        sign = 1.0 if inferred >= 0 else -1.0
        gap = np.concatenate([
            (prior * (s[:p] - 1) * (sign > 0) - sign * prior * s[:p]) / p, sign * s[p:] / len(unlabelled)])
        return net.slopes(z, hidden_out, gap)

    return _descend(net, slopes, steps, 0.02)


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, least_share: float = LEAST_SHARE) -> float:
    """Share of positives among the unlabelled, from histograms of scores (low to high).

    Above any threshold the unlabelled mass is at least prior times the positive mass; the smallest ratio is the estimate.
    """
    above_p = positive[::-1].cumsum() / max(positive.sum(), 1)
    above_u = unlabelled[::-1].cumsum() / max(unlabelled.sum(), 1)
    trusted = above_p >= least_share
    if not trusted.any() or not unlabelled.sum():
        return 0.5
    return float(np.clip((above_u[trusted] / above_p[trusted]).min(), 0.02, 0.98))


def _score_column(net: Network):
    @arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array(net.score(matrix(part)) if len(part) else np.zeros(0), pa.float64())

    return score


def train(table: DataFrame, labels: DataFrame, *, column: str = "quality", max_train: int = MAX_TRAIN) -> tuple[Network | None, float]:
    """The network and the estimated prior, from a table (doc_id, x).

    The networks are fitted on at most ``max_train`` positives and as many unlabelled rows outside the held-out
    fold, chosen by hash; the prior's histograms count all of them. Without rows of either kind there is no network.
    """
    known = label_table(labels, column)
    given = labels.select(F.col("doc_id").alias("id")).where("id IS NOT NULL").distinct()
    free = table.where(~held_out(F.col("doc_id")))
    positives = free.join(known.where("label = 1").select("id"), F.col("doc_id") == F.col("id"), "left_semi")
    unlabelled = free.join(given, F.col("doc_id") == F.col("id"), "left_anti")
    samples = []
    for rows in (positives, unlabelled):
        chosen = first_by_hash(rows.select(F.col("doc_id").alias("id"), "x"), max_train, "x").toArrow()
        samples.append(matrix(chosen.column("x")) if chosen.num_rows else np.zeros((0, N_FEATURES)))
    if not min(map(len, samples)):
        return None, 0.5
    apart = _score_column(fit_apart(*samples))
    both = positives.select("x", F.lit(1).alias("p")).union(unlabelled.select("x", F.lit(0).alias("p")))
    counts = both.groupBy("p", F.least(F.floor(apart("x") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")).count().collect()
    histograms = np.zeros((2, BINS))
    for row in counts:
        histograms[row["p"], row["bin"]] = row["count"]
    prior = class_prior(histograms[1], histograms[0])
    return fit_non_negative(*samples, prior), prior


def quality_scores(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text, ...).

    The score looks at the text alone. Null and empty texts get the score of a text without words. Rows without
    doc_id count as held out. Without anything to learn from, every score is one half. Repeated rows get equal scores, an
    empty table gives no rows, further columns of either table are left alone.
    """
    table = Saved(figure_table(docs), "figures").df
    net, _ = train(table, labels)
    score = _score_column(net)("x") if net else F.lit(0.5)
    scored = table.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
