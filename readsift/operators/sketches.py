"""Distinct k-mers over samples and runs by sketches that can be stored and united.

A sketch has 2^``LG_K`` registers. Its estimate has a relative standard error of about
1.04 / sqrt(2^LG_K), under 1 % here, and uniting sketches loses nothing: the union's estimate is
that of one sketch over all k-mers. So runs are added to a stored table, and totals over
any samples, runs or clades come without the k-mers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readsift.operators.joins import dimension_join

LG_K = 14
SCHEMA = "sample string, taxid int, n_kmers long, sketch binary"


def kmer_sketches(known: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """Per sample and taxon: k-mers and the sketch of distinct ones, of the rows of ``Matches.kmers``.

    Sketches are filled in every task before anything is shuffled.
    """
    return known.groupBy("sample", "taxid").agg(
        F.sum("n").alias("n_kmers"),
        F.hll_sketch_agg("kmer", lg_k).alias("sketch"),
    )


def add_run(sketches: DataFrame, path: str) -> None:
    """Add the sketches of a run to those stored at a path."""
    sketches.select("sample", "taxid", "n_kmers", "sketch").write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The stored sketches of all runs; a sample or taxon may have several rows."""
    return spark.read.schema(SCHEMA).parquet(path)


def unite(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row for each value of ``by``, whatever runs, samples and taxa it takes together."""
    return sketches.groupBy(*by).agg(
        F.sum("n_kmers").alias("n_kmers"), F.hll_union_agg("sketch").alias("sketch")
    )


def clade_sketches(sketches: DataFrame, closure: DataFrame, by: Sequence[str] = ("sample",)) -> DataFrame:
    """Sketches of clades: each taxon's with those of all taxa below it.

    Rows are united per taxon before they meet the tree, so a sketch is repeated for the few
    ancestors of its taxon only.
    """
    each = unite(sketches, [*by, "taxid"])
    tree = closure.select(F.col("ancestor").alias("clade"), F.col("descendant").alias("taxid"))
    above = dimension_join(each, tree.distinct(), ["taxid"], how="inner").drop("taxid")
    return unite(above.withColumnRenamed("clade", "taxid"), [*by, "taxid"])


def estimated(sketches: DataFrame, out: str = "n_unique_kmers") -> DataFrame:
    """The sketch replaced by its estimate."""
    return sketches.withColumn(out, F.hll_sketch_estimate("sketch")).drop("sketch")
