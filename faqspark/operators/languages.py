"""The language of texts that come without one, from their letters.

A text's letters are read in threes, words apart by one blank, and each three falls in one of a fixed number of cells. A language is
known by how often each cell occurs in its texts; a text gets the language under which its threes are likeliest.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from faqspark.runtime import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Cells that threes of letters fall in, and the factors of their code points.
CELLS, FACTORS = 1 << 16, (1_000_003, 10_007, 1)
# Weights are whole thousandths of a natural logarithm, so sums do not depend on their order.
UNIT = 1000
# A text of fewer threes is unknown, and so is one where the best language leads the next by less than this for each three, or
# knows a smaller share of them than this.
MIN_THREES, LEAD, KNOWN = 3, 20, 0.5
# Characters that are read at a time.
STRETCH = 1 << 16


def letters(text: Column) -> Column:
    """Lower-cased words of letters between single blanks."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+", " ")), F.lit(" "))


def _threes(text: str) -> Iterator[np.ndarray]:
    """Cells of all threes of a text, in stretches of bounded size."""
    for start in range(0, len(text) - 2, STRETCH):
        codes = np.frombuffer(text[start:start + STRETCH + 2].encode("utf-32-le"), np.uint32).astype(np.int64)
        n = len(codes) - 2
        yield sum(factor * codes[k:k + n] for k, factor in enumerate(FACTORS)) % CELLS


def language_profiles(known: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, cell, n``: how often each cell occurs in the texts of each language, over all rows that have one.

    At most ``CELLS`` rows for a language. Counts are summed up inside batches before they are exchanged, so a language that holds
    most rows costs no more than another. Null and empty texts count nothing.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts = batch.column("lang"), batch.column("letters")
            sums: dict[str, np.ndarray] = {}
            for name, text in zip(names, texts):
                own = sums.setdefault(name.as_py(), np.zeros(CELLS, np.int64))
                for cells in _threes(text.as_py()):
                    own += np.bincount(cells, minlength=CELLS)
            for name, own in sums.items():
                cell = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(cell), pa.string()), pa.array(cell.astype(np.int32)), pa.array(own[cell])], names=["lang", "cell", "n"])

    rows = known.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), letters(F.col(text)).alias("letters"))
    counted = rows.mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    return stored(counted, "language-profiles")


def _weights(profiles: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, weights and whether a cell is known, by cell and language; add-one smoothing. Bounded by the number of languages."""
    table = profiles.toArrow()
    names = sorted(set(table.column("lang").to_pylist()))
    counts = np.zeros((CELLS, len(names)), np.int64)
    place = np.searchsorted(np.array(names, object), np.array(table.column("lang").to_pylist(), object)) if names else []
    counts[table.column("cell").to_numpy(), place] = table.column("n").to_numpy()
    return names, np.floor(UNIT * np.log((counts + 1) / (counts.sum(axis=0) + CELLS))).astype(np.int32), counts > 0


def with_language(df: DataFrame, profiles: DataFrame, text: str = "text", name: str = "found_lang") -> DataFrame:
    """``df`` with the language of each text as column ``name``; ties go to the first name, unknown texts get null.

    Unknown are texts with hardly any letter, of letters that no language has, and those that two languages fit alike. The weights
    are sent to every task: four bytes for a cell and language, 26 MB for a hundred languages, whatever the corpus. A column that is
    called like the new one is replaced.
    """
    names, weights, seen = _weights(profiles)
    sent = df.sparkSession.sparkContext.broadcast((weights, seen))

    @F.arrow_udf("int")
    def best(texts: pa.Array) -> pa.Array:
        weights, seen = sent.value
        out = []
        for text in texts:
            score, known, n = np.zeros(weights.shape[1], np.int64), np.zeros(weights.shape[1], np.int64), 0
            for cells in _threes(text.as_py()):
                cell, times = np.unique(cells, return_counts=True)
                score += times @ weights[cell].astype(np.int64)
                known += times @ seen[cell].astype(np.int64)
                n += len(cells)
            first = int(score.argmax())
            second = max(np.delete(score, first), default=None)
            sure = n >= MIN_THREES and known[first] >= KNOWN * n and (second is None or score[first] - second >= LEAD * n)
            out.append(first if sure else None)
        return pa.array(out, pa.int32())

    if not names:
        return df.withColumn(name, F.lit(None).cast("string"))
    return df.withColumn(name, F.get(F.array(*map(F.lit, names)), best(letters(F.col(text)))))
