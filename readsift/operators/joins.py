"""Joins of large row sets with dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def key_match(left: DataFrame, right: DataFrame, pairs, null_safe=()) -> Column:
    """Conjunction of equalities, with ``<=>`` for the keys in ``null_safe``."""
    cond = None
    for lcol, rcol in pairs:
        a, b = left[lcol], right[rcol]
        eq = a.eqNullSafe(b) if lcol in null_safe else a == b
        cond = eq if cond is None else cond & eq
    return cond


def dimension_join(
    rows: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    null_safe: Sequence[str] = (),
) -> DataFrame:
    """Join many ``rows`` with a smaller ``dim`` on the columns ``on``.

    One plan at every size: a plain equality join without hints. Adaptive execution sends
    the dimension to all tasks if the shuffle shows it to be small, and splits partitions
    of ``rows`` that a hot key makes too large, by their measured size. ``null_safe``
    names keys on which NULL matches NULL.
    """
    dim = dim.withColumnsRenamed({k: f"_dim_{k}" for k in on})
    cond = key_match(rows, dim, [(k, f"_dim_{k}") for k in on], null_safe)
    return rows.join(dim, cond, how).drop(*[f"_dim_{k}" for k in on])
