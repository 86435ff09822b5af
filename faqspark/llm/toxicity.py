"""Counterfactually regularised toxicity classifier.

A logistic model over the presence of words and word beginnings, hashed into buckets; long or unspaced
runs also have the beginnings at each of their characters, and joined words those of their pieces. For labelled
sentences that name a group, the group is swapped for others and for a neutral word, and the squared
change of the score is part of the loss: the model cannot tell groups apart, nor use their mention.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from faqspark.llm.folds import first_by_hash, held_out, label_table
from faqspark.llm.store import Saved, free_name
from faqspark.llm.words import Words, hash_runs, mix, slices

BUCKET_BITS = 20
#: Bytes of the word beginnings that are features beside the whole word.
BEGINNINGS = (4, 5, 6)
#: Labelled documents that the model is fitted on, at most, and sentences that are swapped.
MAX_TRAIN, MAX_SWAPS = 12_000, 4_000
#: Swaps of one document that replace the same term, at most.
TERM_SWAPS = 4
#: Features kept: the most telling ones of the sample, each in at least this many documents of its class.
MAX_FEATURES, MIN_DOCUMENTS = 8_192, 4
#: Groups whose terms may stand for each other; the first of each set is the neutral word.
IDENTITY_TERMS = (
    ("person", "woman", "man", "immigrant", "refugee", "muslim", "jew", "christian", "hindu", "buddhist", "atheist", "catholic", "lesbian"),
    ("people", "women", "men", "immigrants", "refugees", "muslims", "jews", "christians", "hindus", "buddhists", "atheists", "catholics", "lesbians"),
    ("local", "black", "white", "asian", "african", "european", "american", "mexican", "indian", "chinese", "arab", "jewish", "islamic",
     "gay", "straight", "transgender", "bisexual", "disabled", "blind", "deaf", "old", "young", "female", "male"),
    ("persona", "mujer", "hombre", "inmigrante", "refugiado", "refugiada", "musulmán", "musulmana", "judío", "judía", "cristiano", "cristiana", "gitano", "gitana", "lesbiana"),
    ("personas", "mujeres", "hombres", "inmigrantes", "refugiados", "refugiadas", "musulmanes", "musulmanas", "judíos", "judías", "cristianos", "cristianas", "gitanos", "gitanas", "lesbianas"),
    ("personne", "femme", "homme", "immigré", "immigrée", "réfugié", "réfugiée", "musulman", "musulmane", "juif", "juive", "chrétien", "chrétienne", "lesbienne"),
    ("personnes", "femmes", "hommes", "immigrés", "immigrées", "réfugiés", "réfugiées", "musulmans", "musulmanes", "juifs", "juives", "chrétiens", "chrétiennes", "lesbiennes"),
    ("mensch", "frau", "mann", "einwanderer", "einwanderin", "flüchtling", "muslimin", "jude", "jüdin", "christ", "christin", "lesbe"),
    ("menschen", "frauen", "männer", "einwanderinnen", "flüchtlinge", "muslime", "musliminnen", "juden", "jüdinnen", "christen", "christinnen", "lesben"),
)


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of the features of every word, repeats included. Bytes that are not letters at a word's ends are ignored.

    Every byte of a word counts, however long it is. Runs of letters inside a word are words too. Where blanks do not
    part words (runs over ``_LONGEST`` bytes, other scripts) every character may begin one.
    """
    start, end = words.start.copy(), words.end.copy()
    letter = _LETTER[words.data]
    for _ in range(3):
        start += (start < end) & ~letter[np.minimum(start, len(letter) - 1)]
        end -= (start < end) & ~letter[np.maximum(end - 1, 0)]
    keep = start < end
    start, end, row = start[keep], end[keep], words.row()[keep]
    if not len(start):
        return row, np.zeros(0, np.int64)
    dense = (end - start > _LONGEST) | _holds(_UNSPACED[words.data], start, end)
    joined = _holds(~letter, start, end)
    found = [_beginnings(words.data, start, end, row), _whole(words.data, start, end, row)]
    if joined.any():
        piece = _pieces(letter, start[joined], end[joined], row[joined])
        found += [_beginnings(words.data, *piece), _whole(words.data, *piece)]
    found += _inside(words.data, start[dense], end[dense], row[dense])
    return np.concatenate([r for r, _ in found]), (np.concatenate([c for _, c in found]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _holds(marked: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether each run holds a marked byte."""
    before = np.zeros(len(marked) + 1, np.int64)
    np.cumsum(marked, out=before[1:])
    return before[end] > before[start]


def _beginnings(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and codes of the first bytes of every run."""
    code, found = np.zeros(len(start), np.uint64), []
    for k in range(max(BEGINNINGS)):
        inside = start + k < end
        start, end, row, code = start[inside], end[inside], row[inside], code[inside]
        code = mix(code * np.uint64(257) + data[start + k].astype(np.uint64) + np.uint64(1))
        if k + 1 in BEGINNINGS:
            found.append((row, code ^ np.uint64(k + 1)))
    return np.concatenate([r for r, _ in found]), np.concatenate([c for _, c in found])


def _whole(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and codes of whole runs; those over ``_LONGEST`` bytes go on from there by a sum over the rest."""
    size = end - start
    code = np.zeros(len(start), np.uint64)
    for k in range(int(min(size.max(initial=0), _LONGEST))):
        inside = size > k
        byte = data[np.minimum(start + k, len(data) - 1)].astype(np.uint64)
        code = np.where(inside, mix(code * np.uint64(257) + byte + np.uint64(1)), code)
    long = size > _LONGEST
    code[long] = mix(code[long] ^ hash_runs(data, start[long] + _LONGEST, end[long]))
    return row, code


def _pieces(letter: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the runs of letters inside words."""
    change, edge = np.zeros(len(letter) + 1, np.int8), np.zeros(len(letter) + 1, bool)
    change[start] += 1
    change[end] -= 1
    edge[start] = True
    inner = np.zeros(len(letter) + 2, bool)
    inner[1:-1] = letter & (np.cumsum(change[:-1]) > 0)
    first, last = np.flatnonzero(inner[1:-1] & (~inner[:-2] | edge[:-1])), np.flatnonzero(inner[1:-1] & (~inner[2:] | edge[1:])) + 1
    return first, last, row[np.searchsorted(start, first, "right") - 1]


def _distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values, sorted; several times faster than hashing millions of them."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _inside(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and codes of the beginnings at every character of runs, each once per block of runs or of parts of a long one."""
    size = end - start
    before = np.concatenate([[0], np.cumsum(size)])
    for block in range(0, int(before[-1]), _BLOCK):
        place = np.arange(block, min(block + _BLOCK, int(before[-1])))
        run = np.searchsorted(before, place, "right") - 1
        at = start[run] + place - before[run]
        fresh = (data[at] & 0xC0) != 0x80
        r, code = _beginnings(data, at[fresh], end[run[fresh]], row[run[fresh]])
        both = _distinct((r.astype(np.int64) << BUCKET_BITS) | (code >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
        yield both >> BUCKET_BITS, (both & ((1 << BUCKET_BITS) - 1)).astype(np.uint64) << np.uint64(64 - BUCKET_BITS)


#: Bytes of a word above which every character may begin a word; positions looked at in one step.
_LONGEST, _BLOCK = 24, 1 << 20
#: Bytes of scripts and marks that stand between words or do without blanks: no-break space, and characters of three bytes or more.
_UNSPACED = np.zeros(256, bool)
_UNSPACED[[0xC2, *range(0xE0, 256)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = True


def present(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) of a text column, sorted."""
    row, bucket = features(Words(column))
    both = _distinct((row.astype(np.int64) << BUCKET_BITS) | bucket)
    return both >> BUCKET_BITS, both & ((1 << BUCKET_BITS) - 1)


def swaps(text: str, terms=IDENTITY_TERMS) -> Iterator[tuple[str, str]]:
    """Every sentence of a text that names a group, with the term replaced by the neutral word and by the next term."""
    for _, sentence, swapped in _term_swaps(text, terms):
        yield sentence, swapped


def _term_swaps(text: str, terms=IDENTITY_TERMS) -> Iterator[tuple[str, str, str]]:
    """The term replaced, the sentence and the sentence without it."""
    for sentence in re.split(r"(?<=[.!?])\s+|\n", text):
        for group in terms:
            for at, term in enumerate(group):
                pattern = rf"\b{term}\b"
                if re.search(pattern, sentence, re.IGNORECASE):
                    for other in sorted({group[0], group[(at + 1) % len(group)]} - {term}):
                        yield term, sentence, re.sub(pattern, other, sentence, flags=re.IGNORECASE)


def chosen_swaps(key: int | None, text: str | None) -> list[tuple[int, str, str]]:
    """(hash, before, after) of at most ``TERM_SWAPS`` swaps of each term in a text, by hash of its id and the swap's number."""
    kept: dict[str, list[tuple[int, str, str]]] = {}
    for number, (term, before, after) in enumerate(_term_swaps(text) if text and _MENTION.search(text) else ()):
        code = int.from_bytes(hashlib.blake2b(f"{key}:{number}".encode(), digest_size=7).digest(), "little")
        own = kept.setdefault(term, [])
        (heapq.heappush if len(own) < TERM_SWAPS else heapq.heappushpop)(own, (-code, before, after))
    return sorted((-code, before, after) for own in kept.values() for code, before, after in own)


@dataclass(frozen=True)
class Model:
    """``slot``: place of each bucket's weight, -1 without one."""

    slot: np.ndarray
    weight: np.ndarray
    bias: float
    #: Log odds of the labelled share of class 1: what is known of a text that has no bucket with a weight.
    odds: float
    #: Whether anything telling was found; if not, the score says nothing of a text.
    informed: bool = True

    def score(self, column: pa.Array) -> np.ndarray:
        row, bucket = features(Words(column))
        slot = self.slot[bucket]
        hit = slot >= 0
        pairs = _distinct((row[hit].astype(np.int64) << 16) | slot[hit])
        total = np.bincount(pairs >> 16, weights=self.weight[pairs & 0xFFFF], minlength=len(column))
        some = np.bincount(pairs >> 16, minlength=len(column)) > 0
        return 1 / (1 + np.exp(-np.clip(np.where(some, total + self.bias, self.odds), -40, 40)))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its buckets, and the hash of each chosen swap in it with the buckets lost and gained by it."""
    for batch in slices(batches):
        row, bucket = present(batch.column("text"))
        cut = np.searchsorted(row, np.arange(batch.num_rows + 1))
        buckets = [bucket[a:b].astype(np.int32).tobytes() for a, b in zip(cut, cut[1:])]
        changed = []
        for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            some = chosen_swaps(key, text)
            sides = [[set(b[r == k].tolist()) for k in range(len(some))] for r, b in (present(pa.array([p[s] for p in some], pa.string())) for s in (1, 2))] if some else [[], []]
            changed.append([{"id": p[0], "move": np.array([*sorted(x - y), -1, *sorted(y - x)], np.int32).tobytes()} for p, x, y in zip(some, *sides)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array(buckets, pa.binary()), pa.array(changed, pa.list_(pa.struct([("id", pa.int64()), ("move", pa.binary())])))],
            names=["label", "buckets", "changed"])


_MENTION = re.compile(r"\b(?:" + "|".join(t for g in IDENTITY_TERMS for t in g) + r")\b", re.IGNORECASE)


def _chosen(label: np.ndarray, row: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """The most telling buckets: difference of the smoothed log shares in either class, in standard errors."""
    size = 1 << BUCKET_BITS
    toxic = np.bincount(bucket[label[row] == 1], minlength=size).astype(float)
    clean = np.bincount(bucket[label[row] == 0], minlength=size).astype(float)
    n1, n0 = max(int(label.sum()), 1), max(int((1 - label).sum()), 1)
    z = np.abs(np.log((toxic + 0.5) / n1) - np.log((clean + 0.5) / n0)) / np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    z[np.maximum(toxic, clean) < MIN_DOCUMENTS] = 0
    order = np.argsort(-z, kind="stable")[:MAX_FEATURES]
    return np.sort(order[z[order] > 2.5])


def fit(label: np.ndarray, buckets: list[np.ndarray], changed: list[tuple[np.ndarray, np.ndarray]], *,
        fairness: float = 4.0, ridge: float = 1e-3, steps: int = 300) -> Model:
    """Weights that minimise balanced log loss + ``fairness`` * mean squared score change + ``ridge`` * squared weights.

    Full-batch gradient descent with per-weight step sizes (Adam). Where nothing tells the classes apart, and without rows
    of both, the score of every text is the labelled share of class 1.
    """
    share = float(label.mean()) if len(label) else 0.0
    slot = np.full(1 << BUCKET_BITS, -1, np.int32)
    odds = float(np.log(share / (1 - share))) if 0 < share < 1 else 20.0 if share else -20.0
    if not 0 < share < 1:
        return Model(slot, np.zeros(1), 0.0, odds, informed=False)
    row = np.repeat(np.arange(len(buckets)), [len(b) for b in buckets])
    bucket = np.concatenate(buckets)
    chosen = _chosen(label, row, bucket)
    if not len(chosen):
        return Model(slot, np.zeros(1), 0.0, odds, informed=False)
    slot[chosen] = np.arange(len(chosen))
    place = slot[bucket]
    row, place = row[place >= 0], place[place >= 0]
    moves = [(k, slot[b], sign) for k, sides in enumerate(changed) for b, sign in zip(sides, (-1.0, 1.0))]
    move_row = np.concatenate([np.full(len(s), k) for k, s, _ in moves]) if moves else np.zeros(0, int)
    move_at = np.concatenate([s for _, s, _ in moves]) if moves else np.zeros(0, int)
    move_by = np.concatenate([np.full(len(s), sign) for _, s, sign in moves]) if moves else np.zeros(0)
    move_row, move_at, move_by = move_row[move_at >= 0].astype(int), move_at[move_at >= 0].astype(int), move_by[move_at >= 0]
    n, m = len(label), max(len(changed), 1)
    balance = np.where(label == 1, 0.5 / share, 0.5 / (1 - share))
    weight, bias = np.zeros(len(chosen)), 0.0
    mean, square = np.zeros(len(weight) + 1), np.zeros(len(weight) + 1)
    for step in range(1, steps + 1):
        total = np.bincount(row, weights=weight[place], minlength=n) + bias
        gap = balance * (1 / (1 + np.exp(-np.clip(total, -40, 40))) - label) / n
        slope = np.bincount(place, weights=gap[row], minlength=len(weight)) + 2 * ridge * weight / len(weight) ** 0.5
        if len(move_at):
            shift = np.bincount(move_row, weights=move_by * weight[move_at], minlength=m)
            slope += 2 * fairness / m * np.bincount(move_at, weights=move_by * shift[move_row], minlength=len(weight))
        slope = np.append(slope, gap.sum())
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        move = 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        weight, bias = weight - move[:-1], bias - move[-1]
    return Model(slot, weight, bias, odds)


def train(docs: DataFrame, labels: DataFrame, *, column: str = "toxic", max_train: int = MAX_TRAIN, max_swaps: int = MAX_SWAPS) -> Model:
    """Fit on at most ``max_train`` labelled documents outside the held-out fold and ``max_swaps`` of their swaps, chosen by hash.

    The chosen ids are bounded and broadcast, so the texts stay where they are.
    """
    ids = first_by_hash(label_table(labels, column), max_train)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("id")).select("doc_id", "text", "label")
    examples = Saved(rows.select("doc_id", "text", F.col("label").cast("long").alias("label")).mapInArrow(
        _examples, "label bigint, buckets binary, changed array<struct<id:bigint,move:binary>>"), "toxicity-examples").df
    got = examples.select("label", "buckets").toArrow()
    label = got.column("label").to_numpy().astype(float)
    buckets = [np.frombuffer(b.as_buffer(), np.int32) for b in got.column("buckets")]
    moves = first_by_hash(examples.select(F.explode("changed").alias("c")).select("c.*"), max_swaps, "move").toArrow()
    changed = []
    for packed in moves.column("move").to_pylist():
        both = np.frombuffer(packed, np.int32)
        cut = int(np.flatnonzero(both == -1)[0])
        changed.append((both[:cut], both[cut + 1 :]))
    return fit(label, buckets, changed)


def with_score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``docs`` with the model's score of the whole text; null and empty texts get the score of no words."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            pieces = [sent.value.score(b.column(0)) for b in slices([pa.record_batch([part], names=["text"])])]
            yield pa.array(np.concatenate(pieces) if pieces else np.zeros(0))

    return docs.withColumn(out, score(F.col("text")))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; a row without doc_id counts as held out.

    Null and empty texts get the score of no words. Repeated rows get equal scores, an empty table gives no rows. Further
    columns of either table are left alone. Without labels every score is near 0.
    """
    scored = with_score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns kept, whatever their names.

    A model that found nothing telling in the labels rejects nothing, so null and empty texts stay, and an unlabelled or
    empty table stays as it is. Repeated rows stay or go together; rows without doc_id are judged too.
    """
    model = train(docs, labels)
    if not model.informed:
        return docs
    name = free_name(docs, "toxicity")
    return with_score(docs, model, name).where(F.col(name) < 0.5).drop(name)
