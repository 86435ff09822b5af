"""Positions inside groups that may be far larger than one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from faqspark.runtime import stored

PAGE = 1000


def with_position(
    df: DataFrame, group: list[str], slice_by: Column, order: list[str]
) -> DataFrame:
    """Add ``position`` (from 1) and ``group_size`` of each row in its ordered group.

    ``slice_by`` must never fall as ``order`` rises. It cuts a group into consecutive slices:
    rows are ranked inside their slice, and the slice sizes give the offsets. A group holding a
    third of all rows is thus spread over as many tasks as it has slices; only one row per slice
    ever meets in one task.

    Of messages, a slice of one minute is bounded whatever their number: after de-duplication
    a channel has at most one message per microsecond.

    The input is written once: counting the slices and ranking inside them read the same stored rows, so
    whatever produced them runs once. The exchange is spelled out because rows that arrive partitioned by the group alone, say
    from a join, would pass as clustered by (group, slice) and stay in one task.
    """
    sliced = stored(df.withColumn("_slice", slice_by), "slices").repartition(*group, "_slice")
    sizes = sliced.groupBy(*group, "_slice").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *group,
        "_slice",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(whole).alias("group_size"),
    )
    inside = Window.partitionBy(*group, "_slice").orderBy(*order)
    return (
        sliced.withColumn("_local", F.row_number().over(inside))
        .join(offsets, [*group, "_slice"])
        .withColumn("position", F.col("_offset") + F.col("_local"))
        .drop("_slice", "_offset", "_local")
    )


def page_number(page: int) -> Column:
    """0-based page of a position; a page bounds what any list column can hold."""
    return F.floor((F.col("position") - 1) / page).cast("int")
