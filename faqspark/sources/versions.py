"""Tables on shared storage that grow by numbered batches and are folded as they grow.

``batches/batch=N`` holds what batch N added, ``folded/batch=N`` the whole table up to batch N. A reader takes the newest
fold and the batches after it. A batch that is written again replaces itself; until it is complete nobody reads it.
A fold happens once the batches after the last one outweigh a part of it, so each row is rewritten a logarithmic number of
times. What a replay of the newest batch may still read is kept until the next fold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, types as T

from faqspark.runtime import _filesystem

BATCHES, FOLDED = "batches", "folded"
# Rows of the batches after a fold, as a share of its own, from which on they are folded in.
GROWN = 0.5


def _names(spark: SparkSession, folder: str) -> list[str]:
    path, files = _filesystem(spark, folder)
    return [str(entry.getPath().getName()) for entry in files.listStatus(path)] if files.exists(path) else []


def _numbers(spark: SparkSession, root: str, kind: str) -> list[int]:
    """Numbers of the complete folders of a kind that hold any rows."""
    found = []
    for name in _names(spark, f"{root}/{kind}"):
        inside = _names(spark, f"{root}/{kind}/{name}") if name.startswith("batch=") else []
        if "_SUCCESS" in inside and any(not n.startswith(("_", ".")) for n in inside):
            found.append(int(name.removeprefix("batch=")))
    return sorted(found)


def _path(root: str, kind: str, number: int) -> str:
    return f"{root}/{kind}/batch={number:012d}"


def state(spark: SparkSession, root: str, before: int | None = None) -> tuple[int | None, list[int]]:
    """The newest fold and the batches after it, of those numbered under ``before`` if it is given."""
    def earlier(numbers: list[int]) -> list[int]:
        return [n for n in numbers if before is None or n < before]

    folds = earlier(_numbers(spark, root, FOLDED))
    base = folds[-1] if folds else None
    return base, [n for n in earlier(_numbers(spark, root, BATCHES)) if base is None or n > base]


def add(rows: DataFrame, root: str, number: int, *by: str) -> None:
    """Write batch ``number``, partitioned ``by`` columns."""
    rows.write.mode("overwrite").partitionBy(*by).parquet(_path(root, BATCHES, number))


def _loaded(spark: SparkSession, root: str, kind: str, numbers: list[int], text: Iterable[str]) -> DataFrame:
    reader = spark.read.option("basePath", f"{root}/{kind}").option("mergeSchema", True)
    paths = [_path(root, kind, n) for n in numbers]
    # Values of partition columns may look like numbers: those named are read as the text they were.
    fields = [T.StructField(f.name, T.StringType()) if f.name in set(text) else f for f in reader.parquet(*paths).schema.fields]
    return reader.schema(T.StructType(fields)).parquet(*paths)


def read(spark: SparkSession, root: str, before: int | None = None, text: Iterable[str] = ()) -> DataFrame | None:
    """All rows with the number of their ``batch``, a folded row that of its fold; None if there are none."""
    base, batches = state(spark, root, before)
    parts = [_loaded(spark, root, kind, some, text) for kind, some in ((FOLDED, [base] if base is not None else []), (BATCHES, batches)) if some]
    return None if not parts else parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def fold(
    spark: SparkSession, root: str, merge: Callable[[DataFrame], DataFrame], *by: str, grown: float = GROWN, text: Iterable[str] = ()
) -> bool:
    """Write ``merge`` of all rows as a fold if they have grown enough; tells whether it did.

    The columns that ``merge`` returns become the table's. Folders that neither readers nor a replay of the newest batch need
    are deleted.
    """
    base, batches = state(spark, root)
    if not batches:
        return False
    if base is not None:
        new, old = (_loaded(spark, root, kind, some, text).count() for kind, some in ((BATCHES, batches), (FOLDED, [base])))
        if new < old * grown:
            return False
    newest = batches[-1]
    merged = merge(read(spark, root, text=text))
    merged.drop("batch").write.mode("overwrite").partitionBy(*by).parquet(_path(root, FOLDED, newest))
    for kind in (FOLDED, BATCHES):
        for number in _numbers(spark, root, kind):
            if base is not None and number < base or kind == BATCHES and number == base:
                path, files = _filesystem(spark, _path(root, kind, number))
                files.delete(path, True)
    return True
