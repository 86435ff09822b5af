"""Periodic runs of words, by a suffix automaton whose suffix links form a link-cut tree.

Every state of the automaton stands for substrings that end at the same places. The path from the newest
prefix's state up the suffix links holds all suffixes of the text so far, by length. Each path segment
has a colour: the place where its strings ended last. Appending a word is one *access* of the link-cut tree,
which meets the segments of the path with their old colours and recolours the whole path with the new end.

A segment last seen ``d`` words before, with strings of up to ``h`` words, says that the last ``h + d``
words have period ``d``: for ``h >= d`` a square, for ``h >= (e - 1) * d`` a power of exponent ``e``. ``h`` is
the longest such string, so the stretch's start is that of its run, and ``d`` is its smallest period: a
smaller one would have given a later colour. The run's end follows from the next words, which meet the same segment one
word longer. There are O(n log n) segments in all, whatever the text is.

A text is cut where no run can pass: words of a run lie in windows of ``window(...)`` words that occur twice
in the text. Each remaining stretch has an automaton of its own; a text that repeats nothing has none.
Memory is about 80 bytes a word of the longest stretch of one text in a task.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from faqspark.llm.store import free_name
from faqspark.llm.words import Words, mix, slices

#: A run has at least so many words, and at least so many times its period.
MIN_LENGTH, MIN_EXPONENT = 24, 3

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
Run = tuple[int, int, int]


class SuffixAutomaton:
    """States 1 (empty string) and up, 0 for none. Most states have one arc, kept in arrays; further arcs are in ``more``."""

    def __init__(self, n: int):
        size = 2 * n + 2
        self.length, self.link, self.word, self.to = (array("i", bytes(4 * size)) for _ in range(4))
        self.more: dict[int, dict[int, int]] = {}
        self.last, self.states = 1, 1

    def arc(self, state: int, word: int) -> int:
        if self.to[state] and self.word[state] == word:
            return self.to[state]
        some = self.more.get(state)
        return some.get(word, 0) if some else 0

    def set_arc(self, state: int, word: int, target: int) -> None:
        if not self.to[state] or self.word[state] == word:
            self.word[state], self.to[state] = word, target
        else:
            self.more.setdefault(state, {})[word] = target

    def append(self, word: int) -> tuple[int, int, int]:
        """The new prefix's state, and (clone, original) if a state was split, else zeros."""
        length, link = self.length, self.link
        self.states += 1
        new, state = self.states, self.last
        length[new] = length[state] + 1
        self.last = new
        while state and not self.arc(state, word):
            self.set_arc(state, word, new)
            state = link[state]
        if not state:
            link[new] = 1
            return new, 0, 0
        target = self.arc(state, word)
        if length[target] == length[state] + 1:
            link[new] = target
            return new, 0, 0
        self.states += 1
        clone = self.states
        length[clone], link[clone] = length[state] + 1, link[target]
        self.word[clone], self.to[clone] = self.word[target], self.to[target]
        if target in self.more:
            self.more[clone] = dict(self.more[target])
        link[target] = link[new] = clone
        while state and self.arc(state, word) == target:
            self.set_arc(state, word, clone)
            state = link[state]
        return new, clone, target


class LastEnds:
    """Link-cut tree over suffix links: each preferred path is a splay tree, ordered by depth, of one colour.

    A path's colour is kept at the root of its splay tree; -1 means that the strings did not occur before.
    """

    def __init__(self, n: int):
        size = 2 * n + 2
        self.up, self.left, self.right = (array("i", bytes(4 * size)) for _ in range(3))
        self.end = array("i", b"\xff" * (4 * size))

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        y = up[x]
        z = up[y]
        if left[y] == x:
            inner = right[x]
            left[y], right[x] = inner, y
        else:
            inner = left[x]
            right[y], left[x] = inner, y
        if inner:
            up[inner] = y
        up[y], up[x] = x, z
        if z:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x

    def splay(self, x: int) -> None:
        """Make ``x`` the root of its splay tree; the colour moves along."""
        up, left, right, end = self.up, self.left, self.right, self.end
        while True:
            y = up[x]
            if not y or (left[y] != x and right[y] != x):
                return
            z = up[y]
            if z and (left[z] == y or right[z] == y):
                end[x] = end[z]
                self._rotate(y if (left[y] == x) == (left[z] == y) else x)
            else:
                end[x] = end[y]
            self._rotate(x)

    def split(self, clone: int, state: int) -> None:
        """Put ``clone`` right above ``state``, on the same path: both ended last at the same place."""
        self.splay(state)
        above = self.left[state]
        self.left[clone], self.left[state], self.up[clone] = above, clone, state
        if above:
            self.up[above] = clone

    def access(self, state: int, now: int) -> Iterator[tuple[int, int]]:
        """(lowest state, last end) of every segment from ``state`` to the root, all of which end ``now`` afterwards."""
        up, right, end = self.up, self.right, self.end
        below, x = 0, state
        while x:
            self.splay(x)
            seen = end[x]
            if seen >= 0:
                yield x, seen
            cut = right[x]
            if cut:
                end[cut] = seen
            right[x] = below
            below, x = x, up[x]
        end[below] = now


def runs_of(words: list[int], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[Run]:
    """(start, length, period) of all runs of a sequence of small non-negative numbers, by start, then period."""
    automaton, tree = SuffixAutomaton(len(words)), LastEnds(len(words))
    length, link = automaton.length, automaton.link
    found: dict[tuple[int, int], int] = {}
    for now, word in enumerate(words):
        new, clone, split = automaton.append(word)
        if clone:
            tree.split(clone, split)
        tree.up[new] = link[new]
        for state, seen in tree.access(new, now):
            period, longest = now - seen, length[state]
            if longest >= (min_exponent - 1) * period and longest + period >= min_length:
                found[now + 1 - longest - period, period] = now + 1
    return sorted((start, stop - start, period) for (start, period), stop in found.items())


def window(min_length: int, min_exponent: int) -> int:
    """Most words such that every window of so many words inside any run occurs twice or more.

    A window of k words in a run of length L and period q has an equal one q words to its left or right if
    k <= L - 2q + 1; L is least at max(min_length, min_exponent * q).
    """
    q = min_length // min_exponent
    return max(1, min(min_length - 2 * q + 1, (min_exponent - 2) * (q + 1) + 1))


def stretches(hashes: np.ndarray, row: np.ndarray, width: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of every stretch of at least ``least`` words whose ``width``-word windows all recur in their row."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = row[:n].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for j in range(width):
        code = mix(code + hashes[j : j + n]) if j % 4 == 3 else code * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n]
    _, group, count = np.unique(mix(code), return_inverse=True, return_counts=True)
    again = np.zeros(n + 2, np.int8)
    again[1:-1] = (count[group] > 1) & (row[:n] == row[width - 1 :])
    # A new row starts a new stretch.
    change = np.diff(again)
    start, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1) + width - 1
    long = end - start >= least
    return start[long], end[long]


def dropped(n: int, runs: list[Run]) -> np.ndarray:
    """Which of ``n`` words lie in a run after its first period."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:-1]) > 0


def scan(column: pa.Array, min_length: int, min_exponent: int) -> tuple[list[list[Run]], Words]:
    """Runs of every text of a column."""
    words = Words(column, lower=False)
    row = words.row()
    found: list[list[Run]] = [[] for _ in words.count]
    for a, b in zip(*stretches(words.hash, row, window(min_length, min_exponent), min_length)):
        numbers = np.unique(words.hash[a:b], return_inverse=True)[1].tolist()
        first = int(a - words.first[row[a]])
        found[row[a]] += [(first + start, length, period) for start, length, period in runs_of(numbers, min_length, min_exponent)]
    return found, words


def collapse(text: str | None, runs: list[Run]) -> str:
    """The text's words joined by single spaces, without those that continue a run after its first period."""
    words = (text or "").encode().split()
    if runs:
        words = compress(words, ~dropped(len(words), runs))
    return b" ".join(words).decode()


def run_columns(text: Column, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> Column:
    """Struct of n_words, runs (by start, then period) and the collapsed text; a null or empty text has none of either."""
    if min_exponent < 2 or min_length < min_exponent:
        raise ValueError("a run has at least two periods, and at least one word in each")

    @arrow_udf(f"struct<n_words:bigint,runs:{RUNS},collapsed:string>")
    def find(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
        for part in parts:
            out = []
            for batch in slices([pa.record_batch([part], names=["text"])]):
                runs, words = scan(batch.column(0), min_length, min_exponent)
                listed = [[dict(zip(("start", "length", "period"), r)) for r in some] for some in runs]
                texts = [collapse(text, some) for text, some in zip(batch.column(0).to_pylist(), runs)]
                out.append(pa.StructArray.from_arrays(
                    [pa.array(words.count, pa.int64()), pa.array(listed, kind), pa.array(texts, pa.string())],
                    names=["n_words", "runs", "collapsed"]))
            yield pa.concat_arrays(out) if out else pa.array([], pa.struct([("n_words", pa.int64()), ("runs", kind), ("collapsed", pa.string())]))

    return find(text)


def without_repeats(docs: DataFrame, *, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``docs`` with the words that continue a run removed from ``text``; texts without runs stay as they are.

    All other columns pass through, whatever their names; ``n_chars`` is counted anew where a text changed. Nulls and empty
    texts stay, repeated rows change alike, an empty table stays empty.
    """
    found = run_columns(F.col("text"), min_length, min_exponent)
    name = free_name(docs, "found")
    many = docs.withColumn(name, found)
    changed = F.size(F.col(name)["runs"]) > 0
    out = {"text": F.when(changed, F.col(name)["collapsed"]).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(changed, F.length(F.col(name)["collapsed"])).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return many.select(*[out[c].alias(c) if c in out else F.col(c) for c in docs.columns])


def strongest(runs: Column) -> Column:
    """The run of greatest length / period, compared exactly; of equal ones the first, null if there is none."""
    better = lambda best, run: run["length"] * best["period"] > best["length"] * run["period"]
    return F.when(F.size(runs) > 0, F.aggregate(runs, runs[0], lambda best, run: F.when(better(best, run), run).otherwise(best)))


def run_report(docs: DataFrame) -> DataFrame:
    """Runs of every row's text: doc_id, n_runs, the strongest run and digests of all runs and of the collapsed text.

    One row per row of ``docs``; null and empty texts have no runs and an empty collapsed text. Repeated rows get equal
    reports, rows without doc_id are reported too.
    """
    found = docs.select("doc_id", run_columns(F.col("text")).alias("f"))
    best = found.select("doc_id", "f", strongest(F.col("f.runs")).alias("best"))
    lines = F.transform("f.runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return best.select(
        "doc_id", F.size("f.runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(F.col("f.collapsed"), 256).alias("collapsed_sha256"))
