"""Quality rules as a short-circuit cascade, ordered by measured rejection per cost.

Every figure is a column expression over one row, so nothing is exchanged. A rule further down the
cascade is evaluated only for rows that all rules above it let pass.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from faqspark.llm.store import Saved

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Runs of characters other than space and ``\\x09`` to ``\\x0d``; none for null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))


def count_chars(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in the text, each counted once.

    Window hashes carry their position in the low bits, as many as the text needs. Sorted, equal
    windows are neighbours; the positions of those that have one go through a second, different hash, as the positions
    have taken bits from the first. No equal windows are parted by either. Positions, sorted again, give the cover.
    """

    def cover(places: Column) -> Column:
        steps = F.transform(places, lambda x, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get(places, i + 1) - x, F.lit(3).cast("long"))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    def placed(code: Column, place: Column, bits: Column) -> Column:
        return F.call_function("shiftleft", code, bits).bitwiseOR(place.cast("long"))

    def first(codes: Column, bits: Column) -> Column:
        return F.transform(
            F.slice(codes, 1, F.greatest(F.size(codes) - 2, F.lit(0))),
            lambda x, i: placed(F.xxhash64(x, F.get(codes, i + 1), F.get(codes, i + 2)), i, bits))

    def second(codes: Column, places: Column, bits: Column) -> Column:
        at = lambda i: F.get(codes, i.cast("int"))
        return F.transform(places, lambda i: placed(F.xxhash64(at(i + 2), at(i), F.lit(2), at(i + 1)), i, bits))

    def repeated(keys: Column, bits: Column) -> Column:
        top = lambda x: F.call_function("shiftright", x, bits)
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
        return F.array_compact(F.transform(keys, lambda x, i: F.when(
            (top(x) == top(F.get(keys, i + 1))) | (top(x) == top(F.get(keys, i - 1))), x.bitwiseAND(mask))))

    def both(codes: Column, bits: Column) -> Column:
        near = let(F.sort_array(first(codes, bits)), lambda k: repeated(k, bits))
        sure = lambda places: let(F.sort_array(second(codes, places, bits)), lambda k: F.sort_array(repeated(k, bits)))
        return let(let(near, sure), cover)

    codes = F.transform(words, lambda w: F.xxhash64(w))
    return let(codes, lambda c: let(F.length(F.bin(F.size(c))).cast("int"), lambda b: both(c, b)))


def base_figures(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, all long. Null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        count_chars(text, SYMBOLS).alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words")))


class Facts:
    """Figures of a text column that rules look at, each an expression of its own."""

    def __init__(self, text: Column):
        self.text = F.coalesce(text, F.lit(""))

    @property
    def n_words(self) -> Column:
        return F.size(words_of(self.text)).cast("long")

    @property
    def word_chars(self) -> Column:
        return F.length(F.translate(self.text, BLANKS, "")).cast("long")

    @property
    def n_symbols(self) -> Column:
        return self.count(SYMBOLS)

    @property
    def n_repeat_words(self) -> Column:
        return let(words_of(self.text), repeated_words)

    def count(self, chars: str) -> Column:
        return count_chars(self.text, chars)

    def repeated_lines(self, percent: int) -> Column:
        """Whether more than so many percent of the lines with a word equal an earlier line."""
        full = F.filter(F.split(self.text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
        return let(full, lambda x: (F.size(x) - F.size(F.array_distinct(x))) * 100 > F.size(x) * percent)


class KnownFacts(Facts):
    """The same where a table has the base figures as columns."""

    COLUMNS = ("n_words", "word_chars", "n_symbols", "n_repeat_words")
    n_words, word_chars, n_symbols, n_repeat_words = (property(lambda self, name=name: F.col(name)) for name in COLUMNS)


@dataclass(frozen=True)
class Rule:
    """``rejects``: from the facts of a text to a boolean column, null-free."""

    name: str
    rejects: Callable[[Facts], Column]


#: A text is rejected if any of these says so; the order here means nothing.
RULES = (
    Rule("few_words", lambda t: t.n_words < 50),
    Rule("repeated_words", lambda t: t.n_repeat_words * 100 > t.n_words * 50),
    Rule("symbols", lambda t: t.n_symbols * 10 > t.n_words),
    Rule("exclamations", lambda t: t.count("!") * 5 > t.n_words),
    Rule("capitals", lambda t: t.count(CAPITALS) * 10 > t.word_chars * 3),
    Rule("word_length", lambda t: ~t.word_chars.between(t.n_words * 2, t.n_words * 12)),
    Rule("repeated_lines", lambda t: t.repeated_lines(50)),
)


@dataclass(frozen=True)
class Measured:
    """Cost (seconds per row) and selectivity (rejected share) of a rule on the sample."""

    rule: Rule
    cost: float
    selectivity: float

    @property
    def worth(self) -> float:
        return self.selectivity / max(self.cost, 1e-12)


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, sample_rows: int = 4000, seed: int = 17) -> list[Measured]:
    """Time every rule alone on a sample of about ``sample_rows`` rows, best of three runs; best worth first.

    What a run without a rule takes (starting the job, reading the texts) is no rule's cost.

    ``docs`` has a column text; where it has the base figures too, rules read them there. The sample is drawn
    while scanning and decides the order only, never the verdict. On an empty sample the order stays.
    """
    share = min(1.0, sample_rows / max(docs.count(), 1))
    sample = docs.select("text").sample(share, seed)
    known = set(KnownFacts.COLUMNS) <= set(docs.columns)
    sample = Saved(with_figures(sample) if known else sample, "rule-sample")
    facts = (KnownFacts if known else Facts)(F.col("text"))
    rows = sample.df.count()

    def timed(rejects: Column) -> tuple[float, int]:
        seconds, hits = [], 0
        for _ in range(3):
            start = time.perf_counter()
            hits = sample.df.agg(F.count_if(rejects)).first()[0]
            seconds.append(time.perf_counter() - start)
        return min(seconds), hits

    found = []
    if rows:
        bare, _ = timed(F.length("text") < 0)
        for rule in rules:
            seconds, hits = timed(rule.rejects(facts))
            found.append(Measured(rule, max(seconds - bare, 1e-3) / rows, hits / rows))
    sample.drop()
    if not rows:
        return [Measured(rule, 0.0, 0.0) for rule in rules]
    return sorted(found, key=lambda m: (-m.worth, m.cost))


def first_rejection(facts: Facts, order: list[Rule]) -> Column:
    """Name of the first rule of ``order`` that rejects, null if none does; later rules are not evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(order):
        verdict = F.when(rule.rejects(facts), F.lit(rule.name)).otherwise(verdict)
    return verdict


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, text: str = "text", out: str = "rejected_by", sample_rows: int = 4000) -> DataFrame:
    """``docs`` with a column ``out``: which rule rejected the row, null if it is kept.

    Null and empty texts have no words. Repeated rows get equal verdicts. Other columns pass
    through; a column already named ``out`` is replaced. The name given is that of the first rule
    in the measured order, whether a row is rejected at all does not depend on the order.
    """
    order = [m.rule for m in measure(docs.select(F.col(text).alias("text")), rules, sample_rows=sample_rows)]
    return docs.withColumn(out, first_rejection(Facts(F.col(text)), order))


def with_figures(docs: DataFrame) -> DataFrame:
    """``docs`` with the base figures as further columns."""
    return docs.withColumn("_f", base_figures(F.col("text"))).select(*[F.col(c) for c in docs.columns], "_f.*")


def figures_and_verdict(docs: DataFrame) -> DataFrame:
    """doc_id, the base figures, ``base_failed`` and ``kept``; one row per row of ``docs``.

    The base figures are there for every row, so the rules read them; the cascade computes the others.
    """
    figures = with_figures(docs.select("doc_id", "text"))
    order = [m.rule for m in measure(figures)]
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    verdict = first_rejection(KnownFacts(F.col("text")), order).isNull()
    return figures.withColumn("base_failed", failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(F.col("base_failed"), False).otherwise(verdict).alias("kept"))
