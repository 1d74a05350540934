"""Outputs: reads per taxon, tables, lists, dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from readsift.schemas import TABLE_HEADERS

FASTA_WIDTH = 60


def read_record(fmt: str = "fasta") -> Column:
    """One read as FASTA (60 bases a line) or FASTQ text, with its full header."""
    if fmt == "fasta":
        wrapped = F.regexp_replace("seq", f"(.{{{FASTA_WIDTH}}})(?=.)", "$1\n")
        return F.concat(F.lit(">"), "description", F.lit("\n"), wrapped)
    if fmt == "fastq":
        return F.concat(
            F.lit("@"), "description", F.lit("\n"), "seq", F.lit("\n+\n"), F.col("qual")
        )
    raise ValueError(f"unknown format {fmt}")


def write_reads(
    reads: DataFrame,
    path: str,
    fmt: str = "fasta",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    compression: str | None = None,
    records_per_file: int | None = None,
) -> None:
    """Write reads, one folder per value of ``partition_by`` (sample, target, mate).

    With ``records_per_file`` no file has more: a compressed file is read by one task. A read without quality cannot be written as FASTQ and fails the job.
    """
    if fmt == "fastq":
        reads = reads.withColumn(
            "qual",
            F.when(
                F.col("qual").isNull(), F.raise_error(F.lit("FASTQ output needs FASTQ input"))
            ).otherwise(F.col("qual")),
        )
    out = reads.select(read_record(fmt).alias("value"), *partition_by)
    if partition_by:
        # a folder's reads meet in few tasks, and adaptive execution splits large folders by size
        out = out.hint("rebalance", *partition_by)
    writer = out.write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.text(path)


def count_written(spark: SparkSession, path: str, fmt: str = "fasta") -> DataFrame:
    """Records per sample of reads written with a folder per sample: sample, ``_reads``.

    Of FASTQ records the four lines are counted, of FASTA records the headers.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    sample = F.regexp_extract("_metadata.file_path", r"/sample=([^/]*)/", 1)
    counted = lines.groupBy(F.url_decode(sample).alias("sample")).agg(
        F.count_if(F.col("value").startswith(">")).alias("headers"), F.count(F.lit(1)).alias("lines")
    )
    n = F.col("headers") if fmt == "fasta" else F.floor(F.col("lines") / 4)
    return counted.select("sample", n.cast("long").alias("_reads"))


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    headers: dict[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Tab-separated table with a header; strings quoted, NULL as NA.

    Columns get the header names users of the written tables know. Columns in
    ``partition_by`` go into folder names, such as one folder per sample.
    """
    names = TABLE_HEADERS if headers is None else headers
    cols = []
    for f in df.schema.fields:
        col = F.col(f.name)
        if f.name in partition_by:
            cols.append(col)
            continue
        if isinstance(f.dataType, StringType):
            col = F.concat(F.lit('"'), F.replace(col, F.lit('"'), F.lit('\\"')), F.lit('"'))
        cols.append(col.alias(f'"{names.get(f.name, f.name)}"'))
    writer = df.select(*cols).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path, sep="\t", header=True, quote="\0", nullValue="NA", escapeQuotes=False)


def write_taxon_list(taxa: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One taxid per line, no header; one folder per sample."""
    out = taxa.select(F.col("taxid").cast("string").alias("value"), "sample")
    out.write.mode(mode).partitionBy("sample").text(path)


def write_contig_genomes(contigs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Contig to genome table with a header."""
    contigs.select("accession", "genome").write.mode(mode).csv(
        path, sep="\t", header=True, quote="\0", nullValue="NA"
    )


def write_contig_lengths(lengths: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Contig length table without header; the contig's number is a third column."""
    lengths.select("accession", "contig_length", "contig_no").write.mode(mode).csv(
        path, sep="\t", header=False, quote="\0"
    )
