"""Sorted outputs of any size: range partitions with a position column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readsift.session import stage

_ROW_BITS = 33


def sort_ranges(df: DataFrame, by: Sequence) -> DataFrame:
    """All rows in order: ranges of the sort keys, each sorted by itself.

    A file or partition holds a range, and names of written files rise with it. No group has to
    fit in one task.
    """
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def with_position(
    df: DataFrame, group: Sequence[str], by: Sequence, out: str = "position"
) -> DataFrame:
    """Adds the place of each row, from 1, in the order ``by`` within its ``group``.

    Rows are dealt to ranges and stored with their place there; how many rows of a group
    stand in the ranges before is one small row per range and group. ``by`` should leave no ties.
    """
    group = list(group)
    keys = [*[F.col(c) for c in group], *by]
    placed = sort_ranges(df, keys).withColumn("_row", F.monotonically_increasing_id())
    placed = stage(placed, "sorted").withColumn("_part", F.shiftright("_row", _ROW_BITS))
    parts = placed.groupBy(*group, "_part").agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    above = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(above), F.lit(0)))
    names = {c: f"_of_{c}" for c in [*group, "_part"]}
    parts = parts.withColumnsRenamed(names)
    same = F.lit(True)
    for c, renamed in names.items():
        same = same & F.col(c).eqNullSafe(F.col(renamed))
    position = F.col("_row") - F.col("_first") + F.col("_before") + 1
    return placed.join(parts, same).select(*df.columns, position.alias(out))
