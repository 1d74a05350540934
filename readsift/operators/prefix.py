"""Running sums and maxima over ordered groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 65536


def running_sum(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    tie: Sequence[str] = (),
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``out``: the inclusive running sum of ``value`` per ``group``.

    NULL group values form a group of their own.
    """
    value = value.cast("long")
    return _running(df, group, order, value, out, tie, block, F.sum, lambda a, b: a + b, F.lit(0))


def running_max(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    tie: Sequence[str] = (),
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``out``: the inclusive running maximum of ``value`` per ``group``, NULLs left out."""
    return _running(df, group, order, value, out, tie, block, F.max, F.greatest, None)


def _running(df, group, order, value, out, tie, block, fold, merge, empty) -> DataFrame:
    """Running fold by blocks.

    A plain window puts a whole group into one task. Here a group is cut into
    blocks of ``block`` consecutive values of the last (whole-number) order column;
    the fold runs inside each block, and block results, one row each, are folded
    per group and merged in. The only per-group step sees the block results. Positions
    with few gaps suit best: a block should hold many rows.
    """
    group, order = list(group), list(order)
    lead, last = order[:-1], order[-1]
    blocked = df.withColumn("_block", F.floor(F.col(last) / F.lit(block)).cast("long")).withColumn(
        "_value", value
    )
    block_keys = [*group, *lead, "_block"]
    inside = Window.partitionBy(*block_keys).orderBy(last, *tie).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    earlier = Window.partitionBy(*group).orderBy(*lead, "_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    totals = blocked.groupBy(*block_keys).agg(fold("_value").alias("_total"))
    before = fold("_total").over(earlier)
    starts = totals.select(
        *[F.col(k).alias(f"_b_{k}") for k in block_keys],
        (before if empty is None else F.coalesce(before, empty)).alias("_before"),
    )
    cond = None
    for k in block_keys:
        eq = blocked[k].eqNullSafe(starts[f"_b_{k}"])
        cond = eq if cond is None else cond & eq
    return (
        blocked.join(starts, cond, "left")
        .withColumn(out, merge(fold("_value").over(inside), F.col("_before")))
        .drop("_block", "_value", "_before", *[f"_b_{k}" for k in block_keys])
    )
