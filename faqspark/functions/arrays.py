"""Array helpers built from higher-order functions, all linear in the array length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``.

    An array used inside a lambda would otherwise be recomputed for every element.
    """
    return F.transform(F.array(value), body)[0]


def positions(array: Column, keep: Callable[[Column], Column]) -> Column:
    """0-based positions ``i`` of a non-empty array for which ``keep(i)`` holds."""
    return F.filter(F.sequence(F.lit(0), F.size(array) - 1), keep)


def run_starts(ordered: Column) -> Column:
    """0-based start positions of the runs of equal values in a sorted, non-empty array."""
    return positions(ordered, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))


def run_lengths(starts: Column, total: Column) -> Column:
    """Length of each run, given the run starts and the total number of elements."""
    return F.transform(
        starts, lambda start, k: F.coalesce(F.get(starts, k + 1), total) - start
    )
