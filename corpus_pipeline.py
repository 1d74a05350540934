"""A cleaning pipeline over ``documents`` made of the operators in ``llm``.

Each stage takes all that its predecessor kept: toxic documents go, then all but one of exact and
of near copies, then documents that hold a benchmark window; the last encodes what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm.bpe import digests
from llm.common import stage
from llm.decontaminate import drop_contaminated
from llm.exact_dedup import drop_copies
from llm.minhash_dedup import drop_near_copies
from llm.toxicity import drop_toxic

#: Near copies in the pipeline: five-word shingles, similarity of at least 0.8.
SHINGLE = 5
PERCENT = 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier fitted on their labels does not reject."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_copies(docs, SHINGLE, PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token number and digests of ids and decoded text of every document left."""
    return digests(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

#: No SQL can express the fitted model of the first stage; tests compare each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and reread as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
