"""What several operators share: staged tables, bit filters, row keys."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest Arrow batch that is sent to a Python worker at once.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEAN_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Largest bit filter that is ever sent to the tasks: 2^27 bits are 16 MB.
MAX_FILTER_BITS = 1 << 27
_FILTER_BITS_PER_KEY = 16
_own_folder: list[str] = []


def staging_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, named by ``spark.checkpoint.dir``.

    Where it is unset (tests, one machine) a temporary folder is made.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not _own_folder:
            _own_folder.append(tempfile.mkdtemp(prefix="llm-"))
        base = _own_folder[0]
    return base.rstrip("/")


def bound_batches(spark: SparkSession) -> None:
    """Let no Arrow batch of this session hold more than ``BATCH_BYTES`` and one row.

    Batches are counted in rows by default, and 10,000 long texts with their copies in the
    JVM, in Arrow and in Python are more than a small executor has. A lower limit stays.
    """
    held = spark.conf.get(_BATCH_SETTING)
    if not held.rstrip("b").isdigit() or not 0 < int(held.rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, f"{BATCH_BYTES}b")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    The step then runs once, its lineage ends here, and a lost executor loses none of it.
    Its shuffle files go as soon as the table is written.
    """
    spark = df.sparkSession
    bound_batches(spark)
    path = f"{staging_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN_SETTING)
    spark.conf.set(_CLEAN_SETTING, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEAN_SETTING, before)
    return spark.read.schema(df.schema).parquet(path)


def text_column(name: str = "text") -> Column:
    """The text, a null counting as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def rows_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc`` and ``text`` of every row, whatever other columns the table has."""
    bound_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc"), text_column(text_col).alias("text"))


class BitFilter:
    """A Bloom filter with one hash: set bits for 64-bit keys, tested inside tasks.

    Its size follows the number of keys up to ``MAX_FILTER_BITS``, so what is broadcast is
    bounded. A fuller filter lets more rows through, never fewer, so it may only stand
    before an exact step.
    """

    def __init__(self, keys: DataFrame, column: str, max_bits: int = MAX_FILTER_BITS):
        spark = keys.sparkSession
        wanted = max(1 << 16, keys.count() * _FILTER_BITS_PER_KEY)
        self.bits = min(max_bits, 1 << (wanted - 1).bit_length())
        place = F.pmod(F.col(column), F.lit(self.bits))
        table = bit_table(keys.select(place.alias("place")), self.bits)
        self._shared = spark.sparkContext.broadcast(table)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key (int64 or uint64) may be in the set. For use in tasks."""
        return test_bits(self._shared.value, keys)

    def column(self, key: Column) -> Column:
        """The same test as a column."""
        shared = self._shared

        @F.pandas_udf("boolean")
        def maybe(keys: pd.Series) -> pd.Series:
            return pd.Series(test_bits(shared.value, keys.to_numpy()))

        return maybe(key)


def bit_table(places: DataFrame, bits: int) -> np.ndarray:
    """The set bits at ``place``, 64 to a word. Only words reach the driver: ``bits`` / 4 bytes."""
    rows = (
        places.select(
            F.shiftright("place", 6).alias("word"),
            F.expr("shiftleft(1L, cast(place & 63L as int))").alias("bit"),
        )
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    table = np.zeros(bits // 64, np.uint64)
    table[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return table


def test_bits(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys.astype(np.int64, copy=False).view(np.uint64) & np.uint64(len(table) * 64 - 1)
    word = table[(place >> np.uint64(6)).astype(np.int64)]
    return (word >> (place & np.uint64(63))) & np.uint64(1) == 1
