"""A filter of wanted keys that stands in a scan, ahead of the shuffle of a join."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits per key; keys of one range of hashes, whose table is at most 64 MB; and the number
# of ranges, each of which reads the rows once, beyond which moving all rows costs less.
KEY_BITS = 16
RANGE_KEYS = 1 << 25
MAX_RANGES = 4


def _range_of(key: Column, ranges: int) -> Column:
    return F.pmod(F.shiftrightunsigned(key, 44), F.lit(ranges))


def _bit_table(keys: DataFrame, bits: int) -> np.ndarray:
    """Set bits of the keys ``h``, 64 to a word; words are put together by the executors."""
    place = F.col("h").bitwiseAND(F.lit(bits - 1))
    words = (
        keys.select(F.shiftright(place, 6).alias("word"), place.bitwiseAND(F.lit(63)).cast("int").alias("at"))
        .select("word", F.expr("shiftleft(1L, at)").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("set"))
        .toArrow()
    )
    table = np.zeros(bits // 64, np.uint64)
    table[words["word"].to_numpy()] = words["set"].to_numpy().view(np.uint64)
    return table


def _tester(shared, bits: int):
    @F.pandas_udf("boolean")
    def test(keys: pd.Series) -> pd.Series:
        place = keys.to_numpy() & np.int64(bits - 1)
        word = shared.value[place >> 6]
        return pd.Series((word >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1)

    return test


def keep_candidates(
    rows: DataFrame,
    key: Column,
    wanted: DataFrame,
    range_keys: int = RANGE_KEYS,
    max_ranges: int = MAX_RANGES,
) -> DataFrame:
    """``rows`` without most of those whose 64-bit ``key`` is not in column ``h`` of ``wanted``.

    No wanted row is lost, so an exact join may follow. Keys are cut into ranges of their hash,
    and each range has a bit table of its own with ``KEY_BITS`` bits a key, so tables are bounded
    and no table fills up. Each range reads the rows once; with more than ``max_ranges``
    the rows are left as they are.
    """
    n = wanted.count()
    ranges = max(1, -(-n // range_keys))
    if ranges > max_ranges:
        return rows
    bits = 1 << max(16, (min(n, range_keys) * KEY_BITS - 1).bit_length())
    context = rows.sparkSession.sparkContext
    out = None
    for r in range(ranges):
        mine = wanted if ranges == 1 else wanted.where(_range_of(F.col("h"), ranges) == r)
        test = _tester(context.broadcast(_bit_table(mine, bits)), bits)
        some = rows if ranges == 1 else rows.where(_range_of(key, ranges) == r)
        some = some.where(test(key))
        out = some if out is None else out.unionByName(some)
    return out
