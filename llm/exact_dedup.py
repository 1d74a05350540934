"""Exact dedup behind a two-pass Bloom filter (operator 3).

Pass one hashes every normalised text and counts, for two places per hash, how many rows
set them; places set more than once make the filter. In pass two a row whose places are
not both in it has no copy and passes straight through. Only the other rows are
grouped by the SHA-256 of their text, which decides. The filter has 16 bits a row up to
``max_bits``; beyond that more rows take part in the grouping and the result is the same.

Copies are grouped by digest after a partial aggregation per task, and rows are matched
with (digest, id) or by a join that Spark may split, so a text that a third of all rows hold
does not meet in one task.

Defined cases: a null text counts as empty, so null and empty texts are copies; a null
id is larger than any other and stays only where no other id has the text; of rows that repeat
the id that stays, exactly one is kept; an empty table gives an empty result; other
columns, whatever their names, are kept by ``drop_copies`` and ignored by ``find_copies``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import bit_table, stage, test_bits, text_column

#: Largest filter: 2^27 bits are 16 MB in each task.
MAX_BITS = 1 << 27
_BITS_PER_ROW = 16


def normalised(text: Column) -> Column:
    """Each run of white space (blank, tab to carriage return) as one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


class RepeatFilter:
    """Which hashes may occur on more than one row."""

    def __init__(self, hashes: DataFrame, column: str, max_bits: int = MAX_BITS):
        wanted = max(1 << 16, hashes.count() * _BITS_PER_ROW)
        self.bits = min(max_bits, 1 << (wanted - 1).bit_length())
        low, high = (F.col(column), F.shiftrightunsigned(column, 32))
        places = F.array(*[x.bitwiseAND(F.lit(self.bits - 1)) for x in (low, high)])
        twice = (
            hashes.select(F.explode(places).alias("place"))
            .groupBy("place")
            .agg(F.count("*").alias("n"))
            .where("n > 1")
        )
        table = bit_table(twice.select("place"), self.bits)
        self._shared = hashes.sparkSession.sparkContext.broadcast(table)

    def column(self, key: Column) -> Column:
        shared = self._shared

        @F.pandas_udf("boolean")
        def maybe(keys: pd.Series) -> pd.Series:
            low = keys.to_numpy()
            high = (low.view(np.uint64) >> np.uint64(32)).view(np.int64)
            return pd.Series(test_bits(shared.value, low) & test_bits(shared.value, high))

        return maybe(key)


def find_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """Per row: ``doc_id, keep_id, group_size, kept, text_sha256``; dropped rows too."""
    clean = normalised(text_column(text_col))
    hashed = stage(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), clean.alias("clean")).select(
            "doc_id",
            F.unhex(F.sha2("clean", 256)).alias("digest"),
            F.xxhash64("clean").alias("hash"),
        ),
        "hashed",
    )
    flagged = hashed.withColumn("maybe", RepeatFilter(hashed, "hash", max_bits).column(F.col("hash")))
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    alone = flagged.where(~F.col("maybe")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        sha,
    )
    some = flagged.where("maybe").select("doc_id", "digest")
    groups = some.groupBy("digest").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    same = Window.partitionBy("digest", "doc_id").orderBy("doc_id")
    repeated = some.withColumn("nth", F.row_number().over(same)).join(groups, "digest")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)
    return alone.unionByName(
        repeated.select("doc_id", "keep_id", "group_size", kept.alias("kept"), sha)
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each group of equal texts."""
    clean = normalised(text_column(text_col))
    slim = stage(
        docs.select(F.xxhash64(clean).alias("hash")),
        "hashes",
    )
    maybe = RepeatFilter(slim, "hash", max_bits).column(F.col("hash"))
    flagged = (
        docs.select(
            F.struct("*").alias("row"),
            F.col(id_col).cast("long").alias("id"),
            F.xxhash64(clean).alias("hash"),
        ).withColumn("maybe", maybe)
    )
    alone = flagged.where(~F.col("maybe"))
    digest = F.unhex(F.sha2(normalised(text_column(f"row.{text_col}")), 256))
    some = flagged.where("maybe").withColumn("digest", digest)
    winners = some.groupBy("digest").agg(F.min("id").alias("keep_id"))
    won = some.join(
        winners.withColumnRenamed("digest", "d"),
        (F.col("digest") == F.col("d")) & F.col("id").eqNullSafe(F.col("keep_id")),
    )
    one = won.select("row", "digest").dropDuplicates(["digest"])
    return alone.select("row.*").unionByName(one.select("row.*"))


def query(spark, sf_dir: str) -> DataFrame:
    return find_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]+', ' ', 'g')) AS s
  FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS keep_id,
       count(*) OVER (PARTITION BY s) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY s) AS kept, s AS text_sha256
FROM t
"""
