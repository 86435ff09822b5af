"""Katz backoff language model over words, order two.

A seen pair has probability d(c) * c / (c(history) + 1), where d is the Good-Turing discount of counts up to five; an unseen one
the history's backoff weight times the probability of the word alone, which is discounted likewise, and an unknown word
shares what the known ones leave. The one added to every history stands for the event of something new, so that
weights exist for histories without rare pairs too; they are normalised exactly.

Token occurrences are exchanged once, as compressed blocks. The bucket of an occurrence follows from its word, so a bucket
has every pair of its words with all its counts; frequent words are spread over several buckets by their history and
frequent pairs by document. A history's weight needs pairs of all buckets: those sums go to a table, which
only unseen pairs of documents outside the training set are joined with.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faqspark.llm.folds import held_out
from faqspark.llm.store import Saved
from faqspark.llm.words import Words, mix, slices

#: Counts up to this are discounted.
DISCOUNTED = 5
#: Token occurrences that a bucket holds, about; occurrences and documents of a block's batch.
BUCKET_TOKENS, BATCH_TOKENS, BATCH_DOCS = 2_500_000, 1_500_000, 60_000
#: Words and pairs with at least this share of all tokens may be spread; so there are at most as many as its inverse.
WORD_SHARE, PAIR_SHARE = 1 / 50_000, 1 / 1_000
#: Codes that stand for the start and the end of a text.
START, END = np.uint64(0x53544152542D3031), np.uint64(0x454E442D54455854)
_ODD = np.uint64(0xD6E8FEB86659FD93)


class _Sums:
    """Counts per key, merged whenever many are pending."""

    def __init__(self, most: int = 1_500_000):
        self.most, self.keys, self.counts, self.pending = most, [], [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.pending += len(keys)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, which = np.unique(np.concatenate(self.keys or [np.zeros(0, np.uint64)]), return_inverse=True)
        counts = np.bincount(which, np.concatenate(self.counts or [np.zeros(0)]), len(keys)).astype(np.int64)
        self.keys, self.counts, self.pending = [keys], [counts], len(keys)
        return keys, counts

    def flush(self, end: bool) -> Iterator[pa.RecordBatch]:
        if end or self.pending > 2 * self.most:
            keys, counts = self.merged()
            if end or len(keys) > self.most:
                self.keys, self.counts, self.pending = [], [], 0
                for at in range(0, len(keys), 1 << 18):
                    part = slice(at, at + (1 << 18))
                    yield pa.RecordBatch.from_arrays([pa.array(keys[part].view(np.int64)), pa.array(counts[part])], names=["h", "c"])


def _learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        learn = batch.column("learn").to_numpy(zero_copy_only=False)
        if learn.any():
            yield batch.filter(pa.array(learn))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = _Sums()
    for batch in _learnt(batches):
        words, counts = np.unique(Words(batch.column("text")).hash, return_counts=True)
        sums.add(np.append(words, END), np.append(counts, batch.num_rows))
        yield from sums.flush(False)
    yield from sums.flush(True)


def _tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and their rows, the end of each row included."""
    rows = np.arange(len(words.count), dtype=np.int32)
    row = np.repeat(rows, words.count + 1)
    token = np.empty(len(row), np.uint64)
    token[np.arange(len(words.hash)) + np.repeat(rows, words.count)] = words.hash
    token[np.cumsum(words.count + 1) - 1] = END
    return token, row


def _histories(token: np.ndarray, row: np.ndarray) -> np.ndarray:
    """What stands before every token of consecutive rows."""
    history = np.empty_like(token)
    history[1:] = token[:-1]
    history[np.diff(row, prepend=np.int32(-1)) != 0] = START
    return history


def pair_code(history: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(history * _ODD + token)


def _pair_counter(frequent: np.ndarray):
    """Counts of pairs of frequent words, coded as places in ``frequent`` (sorted)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()
        for batch in _learnt(batches):
            token, row = _tokens(Words(batch.column("text")))
            history = _histories(token, row)
            places = [np.searchsorted(frequent, x) for x in (history, token)]
            both = np.logical_and(*(frequent[np.minimum(p, len(frequent) - 1)] == x for p, x in zip(places, (history, token))))
            code = places[0][both].astype(np.uint64) * np.uint64(len(frequent)) + places[1][both].astype(np.uint64)
            sums.add(*np.unique(code, return_counts=True))
            yield from sums.flush(False)
        yield from sums.flush(True)

    return count


@dataclass(frozen=True)
class Spread:
    """Number of buckets, and over how many of them frequent words (sorted hashes) and pairs (sorted codes, full counts) go."""

    buckets: int
    words: np.ndarray
    word_ways: np.ndarray
    pairs: np.ndarray
    pair_ways: np.ndarray
    pair_counts: np.ndarray

    @staticmethod
    def _find(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(x), int), np.zeros(len(x), bool)
        at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
        return at, keys[at] == x

    def _bucket(self, token: np.ndarray, way: np.ndarray) -> np.ndarray:
        return (mix(token + way * _ODD) % np.uint64(self.buckets)).astype(np.int32)

    def bucket(self, history: np.ndarray, token: np.ndarray, document: np.ndarray) -> np.ndarray:
        way = np.zeros(len(token), np.uint64)
        at, there = self._find(self.words, token)
        way[there] = np.uint64(1) + mix(history[there]) % self.word_ways[at[there]]
        at, there = self._find(self.pairs, pair_code(history, token))
        way[there] = np.uint64(1 << 32) + mix(document[there]) % self.pair_ways[at[there]]
        return self._bucket(token, way)

    def buckets_of_words(self, token: np.ndarray, pair_tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``token``, bucket) of all buckets that may hold occurrences of each word."""
        found = [(np.arange(len(token)), self._bucket(token, np.zeros(len(token), np.uint64)))]
        at, there = self._find(self.words, token)
        for k in np.flatnonzero(there):
            ways = np.arange(1, int(self.word_ways[at[k]]) + 1, dtype=np.uint64)
            found.append((np.full(len(ways), k), self._bucket(np.full(len(ways), token[k]), ways)))
        for pair_token, ways in zip(pair_tokens, self.pair_ways):
            for k in np.flatnonzero(token == pair_token):
                way = np.uint64(1 << 32) + np.arange(int(ways), dtype=np.uint64)
                found.append((np.full(len(way), k), self._bucket(np.full(len(way), token[k]), way)))
        place, bucket = (np.concatenate(x) for x in zip(*found))
        both = np.unique(place.astype(np.int64) * self.buckets + bucket)
        return both // self.buckets, (both % self.buckets).astype(np.int32)


def _packed(arrays: list[np.ndarray]) -> bytes:
    return np.array([a.nbytes for a in arrays], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)


def _unpacked(data: bytes, kinds: list) -> list[np.ndarray]:
    bounds = np.cumsum([8 * len(kinds), *np.frombuffer(data, np.int64, len(kinds))])
    return [np.frombuffer(data[a:b], k) for a, b, k in zip(bounds, bounds[1:], kinds)]


#: Words and their numbers of entries; histories; per entry the history's place (two halves), the row's place and the count,
#: larger counts apart; per row the steps of the row numbers and flags; the ids of the rows whose end is in the block.
_KINDS = [np.uint64, np.uint32, np.uint64, np.uint16, np.uint16, np.uint16, np.uint8, np.uint32, np.int64, np.uint32, np.uint8, np.int64]


def _blocks(spread: Spread):
    """Occurrences (history, token, document, count) of a batch of documents, one block per bucket."""

    def emit(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        token, row, uid, doc, known, learn = (np.concatenate(x) for x in zip(*parts))
        parts.clear()
        history = _histories(token, row)
        bucket = spread.bucket(history, token, uid[row].view(np.uint64))
        order = np.lexsort((history, token, bucket)).astype(np.int32)  # stable: rows stay in order
        history, token = history[order], token[order]
        row, bucket = row[order], bucket[order]
        del order
        new = np.ones(len(row), bool)
        new[1:] = False
        for key in (history, token, row, bucket):
            new[1:] |= key[1:] != key[:-1]
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(row)))
        history, token, row, bucket = history[first], token[first], row[first], bucket[first]
        del first, new
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=spread.buckets))
        for a, b in zip(cuts, cuts[1:]):
            tokens, runs = np.unique(token[a:b], return_counts=True)
            histories, which = np.unique(history[a:b], return_inverse=True)
            rows, place = np.unique(row[a:b], return_inverse=True)
            much = np.minimum(count[a:b], 255)
            own = uid[rows]
            data = _packed([
                tokens, runs.astype(np.uint32), histories, (which & 0xFFFF).astype(np.uint16), (which >> 16).astype(np.uint16), place.astype(np.uint16),
                much.astype(np.uint8), count[a:b][much == 255].astype(np.uint32), own[:1], np.diff(own, prepend=own[0]).astype(np.uint32),
                (known[rows] + 2 * learn[rows]).astype(np.uint8), doc[row[a:b][token[a:b] == END]]])
            yield pa.RecordBatch.from_arrays([pa.array([int(bucket[a])], pa.int32()), pa.array([data], pa.binary())], names=["bucket", "data"])

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, tokens, docs = [], 0, 0
        for batch in slices(batches):
            token, row = _tokens(Words(batch.column("text")))
            ids = batch.column("doc_id")
            parts.append((token, row + np.int32(docs), batch.column("uid").to_numpy(), ids.fill_null(0).to_numpy(),
                          ids.is_valid().to_numpy(zero_copy_only=False), batch.column("learn").to_numpy(zero_copy_only=False)))
            tokens, docs = tokens + len(token), docs + batch.num_rows
            if tokens > BATCH_TOKENS or docs > BATCH_DOCS - 2048:
                yield from emit(parts)
                tokens, docs = 0, 0
        if parts:
            yield from emit(parts)

    return block


_FOUND = ("kind int, key bigint, other bigint, tokens bigint, unknown bigint, " + ", ".join(f"n{r} bigint" for r in range(1, DISCOUNTED + 1))
          + ", a double, b double")
_FOUND_NAMES = [c.split()[0] for c in _FOUND.split(", ")]
DOCUMENT, HISTORY, UNSEEN, COUNTS = range(4)


def _rows(kind: int, key, other=None, tokens=None, unknown=None, counts=None, a=None, b=None) -> pa.Table:
    n = len(key)
    zeros, zero = pa.array(np.zeros(n, np.int64)), np.zeros(n)
    counts = counts if counts is not None else np.zeros((DISCOUNTED, n), np.int64)
    columns = [pa.array(np.full(n, kind, np.int32)), pa.array(key), zeros if other is None else other, *(zeros if x is None else pa.array(x.astype(np.int64)) for x in (tokens, unknown)),
               *(pa.array(x.astype(np.int64)) for x in counts), *(pa.array(zero if x is None else x.astype(float)) for x in (a, b))]
    return pa.table(columns, names=_FOUND_NAMES)


def discounts(counts: np.ndarray) -> np.ndarray:
    """Good-Turing factors of the counts 1 to 5 from how many events have counts 1 to 6.

    Where the formula has no value between 0 and 1, absolute discounting takes its place.
    """
    n = np.asarray(counts, float)
    r = np.arange(1, DISCOUNTED + 1)
    flat = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    factors = (r - flat) / r
    if (n > 0).all():
        rest = (DISCOUNTED + 1) * n[DISCOUNTED] / n[0]
        turing = ((r + 1) * n[1:] / (r * n[:-1]) - rest) / (1 - rest) if rest < 1 else np.zeros(DISCOUNTED)
        factors = np.where((turing > 0) & (turing < 1), turing, factors)
    return np.clip(factors, 1e-6, 1)


@dataclass(frozen=True)
class Unigrams:
    """What the words alone say: token and word numbers, training documents and discounts."""

    tokens: int
    words: int
    documents: int
    counts: tuple[int, ...]

    def chance(self, c: np.ndarray) -> np.ndarray:
        """Probability of a word with count ``c``, of unknown words together for 0."""
        d = discounts(np.array(self.counts))
        r = np.arange(1, DISCOUNTED + 1)
        left = 1 + (r * np.array(self.counts)[:DISCOUNTED] * (1 - d)).sum()
        factor = np.concatenate([[0], d])[np.minimum(c, DISCOUNTED)]
        factor = np.where(c > DISCOUNTED, 1, factor)
        return np.where(c > 0, factor * c, left) / (self.tokens + 1)


def _scorer(spread: Spread, unigrams: Unigrams):
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        words = right.column("h").to_numpy().view(np.uint64)
        order = np.argsort(words)
        words, word_counts = words[order], right.column("c").to_numpy()[order]
        parts, docs = [], 0
        uid, doc, flag = [], [], []  # a row's id is known in the bucket of its end only
        for data in left.column("data"):
            tokens, runs, histories, low, high, place, much, much_more, base, steps, f, ids = _unpacked(data.as_py(), _KINDS)
            count = much.astype(np.int32)
            count[much == 255] = much_more
            token, d, there = np.repeat(tokens, runs), np.zeros(len(f), np.int64), np.zeros(len(f), bool)
            d[place[token == END]], there[place[token == END]] = ids, True
            parts.append((histories[low.astype(np.int32) + (high.astype(np.int32) << 16)], token, place.astype(np.int32) + np.int32(docs), count))
            uid.append(base + np.cumsum(steps, dtype=np.int64))
            doc.append(d)
            flag.append(np.where(there, f, f & 2))
            docs += len(f)
        if not parts:
            return _rows(COUNTS, np.zeros(0, np.int64))
        history, token, row, count = (np.concatenate(x) for x in zip(*parts))
        del parts
        uid, doc, flag = (np.concatenate(x) for x in (uid, doc, flag))
        learn = flag >= 2
        codes = pair_code(history, token)
        order = np.argsort(codes, kind="stable")
        codes, history, token, row, count = (x[order] for x in (codes, history, token, row, count))
        del order
        new = np.ones(len(codes), bool)
        new[1:] = codes[1:] != codes[:-1]
        first, which = np.flatnonzero(new), np.cumsum(new, dtype=np.int32) - np.int32(1)
        codes = codes[first]
        seen = np.bincount(which, count * learn[row], len(codes)).astype(np.int64)
        at, common = spread._find(spread.pairs, codes)
        seen[common] = spread.pair_counts[at[common]]
        pair_history, pair_token = history[first], token[first]
        del token
        at, there = Spread._find(words, pair_token)
        alone = np.where(there, word_counts[at] if len(words) else 0, 0)
        chance = unigrams.chance(alone)
        each = np.where(seen > 0, np.log10(np.maximum(seen, 1)), np.log10(chance)) - np.where(pair_token != END, np.log10(alone + 1), 0)
        per_doc = [np.bincount(row, (count * (seen == r)[which]), docs) for r in range(1, DISCOUNTED + 1)]
        out = [_rows(DOCUMENT, uid, pa.array(doc, mask=flag % 2 == 0), np.bincount(row, count, docs), np.bincount(row, count * (alone == 0)[which], docs), per_doc,
                     np.bincount(row, count * each[which], docs), np.bincount(row, count * np.log10(alone + 1)[which], docs))]
        own = (seen > 0) & ~common
        keys, place = np.unique(pair_history[own], return_inverse=True)
        by_count = [np.bincount(place, seen[own] == r, len(keys)) for r in range(1, DISCOUNTED + 1)]
        out.append(_rows(HISTORY, keys.view(np.int64), counts=by_count, a=np.bincount(place, chance[own], len(keys))))
        new = (seen == 0)[which]
        out.append(_rows(UNSEEN, history[new].view(np.int64), pa.array(uid[row[new]]), count[new]))
        numbers = np.bincount(np.minimum(seen[own], DISCOUNTED + 2), minlength=DISCOUNTED + 3)
        out.append(_rows(COUNTS, np.zeros(1, np.int64), tokens=numbers[DISCOUNTED + 1 : DISCOUNTED + 2], counts=numbers[1 : DISCOUNTED + 1].reshape(-1, 1)))
        return pa.concat_tables(out)

    return score


def _unigrams(table: DataFrame) -> Unigrams:
    numbers = [F.count_if(F.col("c") == r) for r in range(1, DISCOUNTED + 2)]
    total, words, documents, *counts = table.agg(
        F.sum("c"), F.count(F.lit(1)), F.sum(F.when(F.col("h") == int(END.view(np.int64)), F.col("c"))), *numbers).first()
    return Unigrams(total or 0, words, documents or 0, tuple(counts))


def _spread(docs: DataFrame, table: DataFrame, unigrams: Unigrams, bucket_tokens: int) -> tuple[Spread, np.ndarray, np.ndarray]:
    """How occurrences are dealt out, and history and token of the frequent pairs."""
    buckets = max(1, -(-unigrams.tokens * 7 // (6 * bucket_tokens)))
    share = max(1 / (4 * buckets), WORD_SHARE)
    pair_share = max(share, PAIR_SHARE)
    frequent = {r["h"]: r["c"] for r in table.where(F.col("c") >= share * max(unigrams.tokens, 1)).collect()}
    frequent[int(START.view(np.int64))] = unigrams.documents
    keys = np.array(sorted(h for h, c in frequent.items() if c >= pair_share * unigrams.tokens), np.int64).view(np.uint64)
    keys = np.sort(keys)
    counted = docs.select("text", "learn").mapInArrow(_pair_counter(keys), "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c")) if len(keys) else table.limit(0)
    pairs = [(r["h"] // len(keys), r["h"] % len(keys), r["c"]) for r in counted.where(F.col("c") >= pair_share * max(unigrams.tokens, 1)).collect()]
    history, token = (np.array([keys[p[k]] for p in pairs], np.uint64) for k in (0, 1))
    counts = np.array([p[2] for p in pairs], np.int64)
    codes = pair_code(history, token)
    order = np.argsort(codes)
    each = max(unigrams.tokens / (4 * buckets), 1)
    ways = lambda c: np.clip(np.ceil(c / each), 1, buckets).astype(np.uint64)
    words = np.array(sorted((np.int64(h).view(np.uint64), c) for h, c in frequent.items()), dtype=[("h", np.uint64), ("c", np.int64)])
    spread = Spread(buckets, words["h"].copy(), ways(words["c"]), codes[order], ways(counts[order]), counts[order])
    return spread, history[order], token[order]


def katz_scores(docs: DataFrame, *, modulus: int = 7, rest: int = 2, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row for each row of ``docs``.

    Tokens are the words, folded A-Z, and one end; null and empty texts have the end alone. Rows whose id has the remainder
    ``rest``, and rows without doc_id, are held out of learning. Repeated rows are documents of their own and get equal
    scores. ``score`` is the log10 probability of the whole text under the model; a seen pair, the word alone, then the class of
    unknown words are tried in turn. An empty table gives an empty result; without training rows every word is unknown.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("uid"), (~held_out(F.col("doc_id"), modulus, rest)).alias("learn"))
    table = Saved(rows.select("text", "learn").mapInArrow(_count_words, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c")), "unigrams").df
    unigrams = _unigrams(table)
    spread, pair_histories, pair_tokens = _spread(rows, table, unigrams, bucket_tokens)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, bucket = spread.buckets_of_words(batch.column("h").to_numpy().view(np.uint64), pair_tokens)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), batch.column("h").take(pa.array(place)), batch.column("c").take(pa.array(place))], names=["bucket", "h", "c"])

    blocks = rows.mapInArrow(_blocks(spread), "bucket int, data binary")
    dealt = table.mapInArrow(deal, "bucket int, h bigint, c bigint")
    found = Saved(blocks.groupBy("bucket").cogroup(dealt.groupBy("bucket")).applyInArrow(_scorer(spread, unigrams), _FOUND), "katz", "kind").df
    sums = found.where(F.col("kind") == COUNTS).agg(*(F.sum(f"n{r}") for r in range(1, DISCOUNTED + 1)), F.sum("tokens")).first()
    numbers = np.array([x or 0 for x in sums]) + np.bincount(np.minimum(spread.pair_counts, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2]
    factors = [float(x) for x in discounts(numbers)]
    weights = Saved(_weights(spark, found, factors, spread, pair_histories, pair_tokens, table, unigrams), "backoff").df
    own = found.where(F.col("kind") == DOCUMENT).select(
        F.col("key").alias("uid"), F.col("other").alias("doc_id"), "tokens", "unknown", "b",
        (F.col("a") + sum(F.col(f"n{r}") * float(np.log10(d)) for r, d in enumerate(factors, 1))).alias("a"))
    none = F.lit(0).cast("long")
    unseen = found.where(F.col("kind") == UNSEEN).select("key", "other", "tokens").join(weights, F.col("key") == F.col("history")).select(
        F.col("other").alias("uid"), F.lit(None).cast("long").alias("doc_id"), none.alias("tokens"), none.alias("unknown"), F.lit(0.0).alias("b"),
        (F.col("tokens") * F.col("weight")).alias("a"))
    total = own.unionByName(unseen).groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"), F.sum("tokens").alias("n_tokens"), F.sum("unknown").alias("unknown"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    return total.select(
        "doc_id", held_out(F.col("doc_id"), modulus, rest).alias("held_out"), "n_tokens", (F.col("n_tokens") - F.col("unknown")).alias("n_known"),
        F.lit(unigrams.tokens).cast("long").alias("train_tokens"),
        (F.col("b") - F.col("n_tokens") * float(np.log10(unigrams.tokens + unigrams.words + 1))).alias("base_score"),
        (F.col("a") - float(np.log10(unigrams.documents + 1))).alias("score"))


def _weights(spark, found: DataFrame, factors: list[float], spread: Spread, histories: np.ndarray, tokens: np.ndarray, table: DataFrame, unigrams: Unigrams) -> DataFrame:
    """(history, weight): log10 of the backoff weight times (count of the history + 1)."""
    sums = found.where(F.col("kind") == HISTORY).select(F.col("key").alias("history"), *(f"n{r}" for r in range(1, DISCOUNTED + 1)), "a")
    if len(histories):
        wanted = [int(x) for x in np.unique(tokens).view(np.int64)]
        alone = {r["h"]: r["c"] for r in table.where(F.col("h").isin(wanted)).collect()}
        common = [(int(h.view(np.int64)), *(int(c == r) for r in range(1, DISCOUNTED + 1)), float(unigrams.chance(np.array([alone[int(t.view(np.int64))]]))[0]))
                  for h, t, c in zip(histories, tokens, spread.pair_counts)]
        sums = sums.union(spark.createDataFrame(common, sums.schema))
    grouped = sums.groupBy("history").agg(*(F.sum(f"n{r}").alias(f"n{r}") for r in range(1, DISCOUNTED + 1)), F.sum("a").alias("a"))
    left = 1 + sum(F.col(f"n{r}") * (r * (1 - d)) for r, d in enumerate(factors, 1))
    return grouped.select("history", (F.log10(left) - F.log10(F.greatest(1 - F.col("a"), F.lit(1e-15)))).alias("weight"))
